"""Corpus statistics, gates and report figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

#: The set label of each fix tag.
FIX_SETS = (
    ("unknown", "F1"), ("negation", "F2"), ("noul_choice", "F3"), ("permutation", "F4"), ("dates", "F5"), ("numbers", "F6"),
    ("padding", "F7"), ("injection", "F8"), ("multihop", "F9"), ("inverted", "F10"), ("ordinal", "F11"), ("policy", "F12"),
)
BALANCE_LEAST, BALANCE_SHARE = 5, 0.6


def set_of(source: Column, fix: Column) -> Column:
    """G for generated, P for public, else the fix tag's set (or the tag)."""
    out = F.when(source.startswith("gen:"), "G").when(source.startswith("pub:"), "P")
    for name, label in FIX_SETS:
        out = out.when(fix == name, label)
    return out.otherwise(F.coalesce(fix, F.lit("?")))


def describe(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, mean, median, nearest-rank p90 and max.

    Ranks are running sums over the counts of distinct values, so a key is as
    large as its values are many, whatever its rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*keys)
    counts = counts.withColumn("_n", F.sum("_c").over(whole)).withColumn("_upto", F.sum("_c").over(whole.orderBy(value)))
    at = lambda place: F.min(F.when(F.col("_upto") > place, F.col(value)))  # noqa: E731  the value at a place from 0
    p90 = F.least(F.col("_n") - 1, F.floor(F.lit(0.9) * F.col("_n")))
    middle = (at(F.floor((F.col("_n") - 1) / 2)) + at(F.floor(F.col("_n") / 2))) / 2
    mean = F.sum(F.col(value).cast("double") * F.col("_c")) / F.sum("_c")
    return counts.groupBy(*keys).agg(F.sum("_c").alias("n"), mean.alias("mean"), middle.alias("median"), at(p90).alias("p90"), F.max(value).alias("max"))


def option_bucket(n: Column) -> Column:
    return F.when(n <= 8, "2-8").when(n <= 30, "9-30").otherwise("31-62")


def gold_position(place: Column, n: Column) -> Column:
    """The gold's place as a share of the way, one digit."""
    return X.fixed_text(place / F.greatest(F.lit(1), n - 1), 1)


def label_balance(df: DataFrame, key: str, label: str) -> DataFrame:
    """Keys of at least five rows of which one label has over 60 per cent."""
    counts = df.groupBy(key, label).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.sum("n").alias("total"), F.max("n").alias("top")).where((F.col("total") >= BALANCE_LEAST) & (F.col("top") > BALANCE_SHARE * F.col("total")))


def drop_summary(drops: DataFrame) -> DataFrame:
    return drops.groupBy(F.concat_ws(": ", "stage", "reason").alias("reason")).agg(F.count("*").alias("n"))


def usage(calls: DataFrame) -> DataFrame:
    """Calls, tokens and seconds per provider/model; null counts as 0."""
    zero = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    return calls.groupBy(F.concat_ws("/", "provider", "model").alias("model")).agg(F.count("*").alias("calls"), zero("prompt_tokens").alias("prompt_tokens"), zero("completion_tokens").alias("completion_tokens"), zero("latency_s").alias("seconds"))


def events(log: DataFrame) -> DataFrame:
    return log.groupBy(F.concat_ws(":", "provider", "event", F.coalesce(F.col("status").cast("string"), F.lit("None"))).alias("event")).agg(F.count("*").alias("n"))


def gates(rows: DataFrame) -> DataFrame:
    """One row over (schema_ok, pii_hits, label_ok, abstain_missing)."""
    return rows.agg(F.count("*").alias("n"), F.count_if(~F.col("schema_ok")).alias("schema_fail"), F.count_if(F.col("pii_hits") > 0).alias("pii_rows"), F.bool_and("label_ok").alias("argmax_ok"), F.count_if("abstain_missing").alias("abstain_missing"))


def adherence(cards: DataFrame) -> DataFrame:
    """Card plan against rows: question counts met, targets hit, mean length ratio."""
    return cards.agg(F.count_if(F.col("n_planned") == F.col("n_made")).alias("count_match"), F.count_if(F.col("target") == F.col("label")).alias("target_hit"), F.count("target").alias("targets"), F.avg(F.try_divide(F.col("words").cast("double"), F.col("planned_words"))).alias("length_ratio"))


def mean_of_means(ratings: DataFrame, item: str, rater: str, value: str) -> DataFrame:
    """Mean of rater means per item, with the winner marked (first name on ties)."""
    means = ratings.groupBy(item, rater).agg(F.avg(value).alias("_m")).groupBy(item).agg(F.round(F.avg("_m"), 9).alias("mean"), F.count("*").alias("raters"))
    top = means.agg(F.max(F.struct("mean")).alias("_t"))
    first = means.crossJoin(F.broadcast(top)).where(F.col("mean") == F.col("_t.mean")).agg(F.min(item).alias("_w"))
    return means.crossJoin(F.broadcast(first)).select(item, "mean", "raters", (F.col(item) == F.col("_w")).alias("winner"))


def calibration(df: DataFrame, confidence: Column, hit: Column, bins: int = 10) -> DataFrame:
    """Expected calibration error over equal bins (the usual published definition)."""
    binned = df.select(F.least(F.floor(confidence * bins), F.lit(bins - 1)).alias("bin"), confidence.alias("_c"), hit.cast("double").alias("_h"))
    each = binned.groupBy("bin").agg(F.count("*").alias("n"), F.avg("_c").alias("conf"), F.avg("_h").alias("acc"))
    return each.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.abs(F.col("conf") - F.col("acc"))) / F.sum("n")).alias("ece"))


def share_text(a: Column, b: Column) -> Column:
    return F.concat(a.cast("string"), F.lit("/"), b.cast("string"), F.lit(" ("), X.percent(a, b), F.lit(")"))


def corpus_stats(questions: DataFrame) -> DataFrame:
    """(section, key, n) over questions(id, set, domain, kind, n_options, place, label), one row a question.

    Sections: rows by set, question types, option buckets of choices, levels of scores, questions a row, yes share of
    yes/no questions by domain, and the gold's place among a choice's options by set.
    """
    rows = questions.groupBy("id", "set").agg(F.count("*").alias("_q"))
    count = lambda df, section, key: df.groupBy(key.alias("key")).agg(F.count("*").cast("string").alias("n")).select(F.lit(section).alias("section"), F.col("key").cast("string").alias("key"), "n")
    choice, score, noul = (questions.where(F.col("kind") == k) for k in ("choice", "score", "noul"))
    yes = noul.groupBy("domain").agg(F.concat_ws("/", F.count_if(F.col("label") == "yes").cast("string"), F.count("*").cast("string")).alias("n"))
    parts = [
        count(rows, "by_set", F.col("set")),
        count(questions, "type", F.col("kind")),
        count(choice, "options", option_bucket(F.col("n_options"))),
        count(score, "levels", F.col("n_options")),
        count(rows, "questions", F.col("_q")),
        yes.select(F.lit("noul_yes").alias("section"), F.col("domain").alias("key"), "n"),
        count(choice.where("place is not null"), "gold_place", F.concat_ws(" ", "set", gold_position(F.col("place"), F.col("n_options")))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def domain_label_balance(questions: DataFrame) -> DataFrame:
    """Flags of label_balance over two keys a yes/no question (its domain's and its field's) and one any other."""
    keys = F.array_compact(F.array(F.concat_ws(" ", "domain", "field"), F.when(F.col("kind") == "noul", F.concat("domain", F.lit(" noul")))))
    return label_balance(questions.withColumn("key", F.explode(keys)), "key", "label")


def mix_manifest(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """(section, key, n): rows by source and language, permuted copies, and rows dropped by verdict.

    rows(id, source, lang), dropped(id, verdict).
    """
    count = lambda df, section, key: df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(section).alias("section"), "key", "n")
    perm = rows.where(F.col("id").endswith("-perm"))
    parts = [count(rows, "source", F.col("source")), count(rows, "lang", F.col("lang")), count(perm, "permuted", F.lit("copies")), count(dropped, "dropped", F.col("verdict"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_report(rows: DataFrame, source: Column) -> DataFrame:
    """Rows by split and source suffix, the part after the last + of a derived row's source."""
    return rows.groupBy("split", F.substring_index(source, "+", -1).alias("suffix")).agg(F.count("*").alias("n"))


def language_summary(rows: DataFrame) -> DataFrame:
    """One line over (ok, folded, prob): rows checked, passed, written without their own letters, and the least probability."""
    return rows.agg(F.count("*").alias("checked"), F.count_if("ok").alias("passed"), F.count_if("folded").alias("folded"), F.min("prob").alias("min_prob"))
