"""Several annotators to one soft label, with explicit drop reasons.

Long input: one row per (id, field, teacher) with ``dist``, an array of
probabilities in option order, null where the teacher did not answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist as D

UNKNOWN = "unknown"
VERIFIED_VOTES = 2


def aggregate_labels(answers: DataFrame, keys: list[str]) -> DataFrame:
    """keys, gold, label_at and reason: every teacher must answer, two must share a top option, and the mean must agree."""
    grouped = answers.groupBy(*keys).agg(F.count("*").alias("_asked"), F.array_sort(F.collect_list(F.when(F.col("dist").isNotNull(), F.struct("teacher", "dist")))).alias("_given"))
    given = F.transform("_given", lambda s: s["dist"])
    tops = F.flatten(F.transform(given, lambda d: D.argmax_set(d)))
    majority = F.filter(F.array_distinct(tops), lambda t: F.size(F.filter(tops, lambda x: x == t)) >= VERIFIED_VOTES)
    scored = grouped.withColumn("_gold", F.when(F.size("_given") > 0, D.smooth(D.mean(given)))).withColumn("_major", majority)
    reason = (
        F.when(F.size("_given") < F.greatest(F.lit(2), F.col("_asked")), "teacher_missing")
        .when(F.size("_major") == 0, "no_majority")
        .when(~F.array_contains("_major", D.argmax(F.col("_gold"))), "mean_disagrees_with_majority")
    )
    return scored.select(*keys, F.when(reason.isNull(), F.col("_gold")).alias("gold"), F.when(reason.isNull(), D.argmax(F.col("_gold"))).alias("label_at"), reason.alias("reason"))


def half_rule(fields: DataFrame, row_keys: list[str], kept: Column) -> DataFrame:
    """row_keys, n_asked, n_kept and row_kept: a row may lose half of its questions, not more, and not all."""
    counts = fields.groupBy(*row_keys).agg(F.count("*").alias("n_asked"), F.count_if(kept).alias("n_kept"))
    return counts.withColumn("row_kept", ((F.col("n_asked") - F.col("n_kept")) * 2 <= F.col("n_asked")) & (F.col("n_kept") > 0))


def writer_disagrees(labelled: DataFrame, writer: DataFrame, keys: list[str]) -> DataFrame:
    """Fields whose writer's top option is not the gold label; broken writer distributions do not count."""
    clean = writer.select(*keys, D.normalize(F.col("dist")).alias("_w")).where(F.col("_w").isNotNull() & ~F.exists("_w", lambda p: p.isNull()))
    return labelled.join(clean, keys).where(D.argmax(F.col("_w")) != F.col("label_at")).select(*keys)


def all_must_answer(answers: DataFrame, keys: list[str]) -> DataFrame:
    """Plain mean per key, null unless all teachers, and two at least, answered."""
    grouped = answers.groupBy(*keys).agg(F.count("*").alias("_n"), F.array_sort(F.collect_list(F.struct("teacher", "dist"))).alias("_all"))
    given = F.filter("_all", lambda s: s["dist"].isNotNull())
    return grouped.select(*keys, F.when(F.size(given) >= F.greatest(F.lit(2), F.col("_n")), D.mean(F.transform(given, lambda s: s["dist"]))).alias("mean"))


def agreement(answers: DataFrame, keys: list[str]) -> DataFrame:
    """One row: questions, unanimous and trivial ones (all tops at 0.95 or more), mean total variation of pairs."""
    grouped = answers.where("dist is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("teacher", "dist"))).alias("_all")).where(F.size("_all") >= 2)
    tops = F.transform("_all", lambda s: D.argmax(s["dist"]))
    same = F.size(F.array_distinct(tops)) == 1
    sure = F.forall("_all", lambda s: F.array_max(s["dist"]) >= 0.95)
    facts = grouped.agg(F.count("*").alias("questions"), F.count_if(same).alias("unanimous"), F.count_if(same & sure).alias("trivial"))
    return facts.crossJoin(pairwise(answers, keys).agg(F.avg("tv").alias("mean_tv")))


def teacher_sets(answers: DataFrame, keys: list[str]) -> DataFrame:
    """How many questions each set of teachers answered together."""
    each = answers.where("dist is not null").groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("teacher")), "+").alias("teachers"))
    return each.groupBy("teachers").agg(F.count("*").alias("n"))


def pairwise(answers: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, b, agree, tv for every pair of teachers of a question."""
    left = answers.where("dist is not null").select(*keys, F.col("teacher").alias("a"), F.col("dist").alias("_da"))
    right = answers.where("dist is not null").select(*keys, F.col("teacher").alias("b"), F.col("dist").alias("_db"))
    pairs = left.join(right, keys).where("a < b")
    return pairs.select(*keys, "a", "b", (D.argmax(F.col("_da")) == D.argmax(F.col("_db"))).alias("agree"), D.total_variation(F.col("_da"), F.col("_db")).alias("tv"))


def pair_agreement(answers: DataFrame, keys: list[str]) -> DataFrame:
    return pairwise(answers, keys).groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if("agree").alias("agreed"))


def verified(answers: DataFrame, gold: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per set: fields with two votes or more, and those on which two votes hit the gold option."""
    votes = answers.where("dist is not null").join(gold.select(*keys, name, "gold_at"), keys)
    each = votes.groupBy(*keys, name).agg(F.count("*").alias("_n"), F.count_if(D.argmax(F.col("dist")) == F.col("gold_at")).alias("_hit")).where("_n >= 2")
    return each.groupBy(name).agg(F.count("*").alias("n"), F.count_if(F.col("_hit") >= VERIFIED_VOTES).alias("agreed"))


def flips(answers: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """One row: answers on an injected field, and those that left the gold option."""
    both = answers.where("dist is not null").join(gold.select(*keys, "gold_at"), keys)
    return both.agg(F.count("*").alias("total"), F.count_if(D.argmax(F.col("dist")) != F.col("gold_at")).alias("flips"))


def disputed(votes: DataFrame, template: str) -> DataFrame:
    """Templates with two rows or more that fewer than half of the votes confirm."""
    return votes.groupBy(template).agg(F.count("*").alias("n"), F.count_if("agree").alias("agreed")).where((F.col("n") >= 2) & (F.col("agreed") * 2 < F.col("n")))


def rejected(votes: DataFrame, second: DataFrame, template: str) -> DataFrame:
    """Disputed templates that a second verifier disputes too, or has no two votes on."""
    cleared = second.groupBy(template).agg(F.count("*").alias("n"), F.count_if("agree").alias("agreed")).where((F.col("n") >= 2) & (F.col("agreed") * 2 >= F.col("n")))
    return disputed(votes, template).join(cleared, template, "left_anti").select(template)


def clear_questions(answers: DataFrame, gold: DataFrame, keys: list[str], least: float, wanted: Column | None = None) -> DataFrame:
    """Keys (of the wanted kind) on which all teachers share the top option and the gold reaches the least share."""
    same = answers.where("dist is not null").groupBy(*keys).agg(F.count_distinct(D.argmax(F.col("dist"))).alias("_tops")).where("_tops = 1")
    found = gold.join(same, keys, "left_semi").where(F.array_max("gold") >= least)
    return found if wanted is None else found.where(wanted)


def stable_half(df: DataFrame, keys: list[str], parity: int, need: int) -> DataFrame:
    """Rows whose key hash has the parity, or all rows where those are fewer than needed."""
    marked = df.withColumn("_half", F.conv(F.substring(F.sha2(F.to_json(F.array(*[F.col(k).cast("string") for k in keys])), 256), 1, 2), 16, 10).cast("int") % 2 == parity)
    enough = marked.agg((F.count_if("_half") >= need).alias("_enough"))
    return marked.crossJoin(F.broadcast(enough)).where(~F.col("_enough") | F.col("_half")).drop("_half", "_enough")


def teacher_pair(order: Column, labs: Column, touched: Column) -> Column:
    """The first two teachers whose labs wrote or edited nothing of the row; null if there are fewer."""
    free = F.filter(F.arrays_zip(order.alias("t"), labs.alias("l")), lambda s: ~F.array_contains(touched, s["l"]))
    return F.when(F.size(free) >= 2, F.transform(F.slice(free, 1, 2), lambda s: s["t"]))


def filled_from(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of fallback for keys that no teacher answered in primary, and primary for the rest."""
    silent = primary.groupBy(*keys).agg(F.count("dist").alias("_n")).where("_n = 0").select(*keys)
    return primary.join(silent, keys, "left_anti").unionByName(fallback.join(silent, keys, "left_semi"))


def needs_unknown(abstain: Column, values: Column, dist: Column) -> Column:
    """The abstain flag, or gold mass on the unknown option."""
    return F.coalesce(abstain, F.lit(False)) | F.exists(F.arrays_zip(values.alias("v"), dist.alias("p")), lambda s: (s["v"] == UNKNOWN) & (s["p"] > 0))
