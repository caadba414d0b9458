"""Derived rows: unknown, negation, twins, permutations, padding, injection, inversion, ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dist as D
from ..functions import text as X
from . import scans as SC
from .dedup import require_shared_dir
from .picks import cyclic

#: Fixed values.
KEPT_TAGS = ("domain", "writer", "group", "fmt")
BUDGETS = (1000, 2000, 3000)
PLACES = ("start", "middle", "end")
TWIN_GAP = 0.25
#: Rows are counted by so many leading bits of their hash.
RANGE_BITS = 10


def base_tags(tags: Column) -> Column:
    """The tags that a derived row inherits."""
    return F.filter(tags, lambda t: F.exists(F.array(*[F.lit(f"{k}:") for k in KEPT_TAGS]), lambda k: t.startswith(k)))


def unknown_rows(rows: DataFrame, prior: Column, values: Column) -> DataFrame:
    """each source as three rows: fact removed with unknown, without unknown (smoothed prior), control."""
    wide = F.array_append(values, F.lit("unknown"))
    kinds = F.array(
        F.struct(F.lit("removed").alias("twin"), wide.alias("options"), D.one_hot(F.lit("unknown"), wide).alias("dist")),
        F.struct(F.lit("no_unknown").alias("twin"), values.alias("options"), D.smooth(prior).alias("dist")),
        F.struct(F.lit("control").alias("twin"), wide.alias("options"), D.smooth(F.array_append(prior, F.lit(0.0))).alias("dist")),
    )
    return rows.select(*rows.columns, F.explode(kinds).alias("_t")).select(*rows.columns, "_t.twin", "_t.options", "_t.dist")


def negation_holds(p_yes: Column, p_yes_negated: Column) -> Column:
    """the negated question has about the complement, on the other side of one half."""
    return (F.abs(p_yes_negated - (1 - p_yes)) <= TWIN_GAP) & ((p_yes > 0.5) != (p_yes_negated > 0.5))


def twin_holds(p_yes: Column, p_yes_choice: Column) -> Column:
    """the choice that asks the same has about the same answer, on the same side of one half."""
    return (F.abs(p_yes_choice - p_yes) <= TWIN_GAP) & ((p_yes > 0.5) == (p_yes_choice > 0.5))


def negation_twins(rows: DataFrame, p_yes: Column) -> DataFrame:
    """each yes/no row and its negation, with complementary distributions (no, yes)."""
    pair = F.array(F.struct(F.lit("plain").alias("twin"), F.array(1 - p_yes, p_yes).alias("dist")), F.struct(F.lit("negated").alias("twin"), D.complement(F.array(1 - p_yes, p_yes)).alias("dist")))
    return rows.select(*rows.columns, F.explode(pair).alias("_t")).select(*rows.columns, "_t.twin", "_t.dist")


def choice_twins(rows: DataFrame, p_yes: Column, options: Column, yes_option: Column) -> DataFrame:
    """each yes/no row and the two-option choice that asks the same."""
    pair = F.array(F.struct(F.lit("noul").alias("twin"), F.array(1 - p_yes, p_yes).alias("dist")), F.struct(F.lit("choice").alias("twin"), D.choice_twin(p_yes, options, yes_option).alias("dist")))
    return rows.select(*rows.columns, F.explode(pair).alias("_t")).select(*rows.columns, "_t.twin", "_t.dist")


def permutations(rows: DataFrame, options: str, row_id: str, seed: int, copies: int = 3, least: int = 3) -> DataFrame:
    """copies of rows with at least three options, each in a hash order of its own."""
    many = rows.where(F.size(options) >= least).withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    keyed = F.transform(options, lambda o, i: F.struct(F.xxhash64(F.lit(seed), F.col(row_id), F.col("perm"), i).alias("k"), o.alias("o")))
    return many.withColumn(options, F.transform(F.array_sort(keyed), lambda s: s["o"]))


def _placed(rows: DataFrame, row_id: str, state: str, domain: str, index: str, seed: int) -> DataFrame:
    """rows with _at, their place from 0 in order of domain and hash, and their domain's places (_first, _n) and what is outside it (_m, _chars).

    Places are counted by ranges of the hash, and a domain's figures come with the
    range's start, so that no task sorts or reads a whole domain.
    """
    h = F.xxhash64(F.lit(seed), row_id, state)
    keyed = rows.withColumn("_h", h).withColumn("_b", F.shiftrightunsigned("_h", 64 - RANGE_BITS))
    chars = F.coalesce(F.length(state), F.lit(0)).cast("long")
    ranges = keyed.groupBy(F.col(domain).alias("_d"), F.col("_b").alias("_rb")).agg(F.count("*").alias("n"), F.sum(chars).alias("chars"))
    before = lambda n, w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    domains = ranges.groupBy("_d").agg(F.sum("n").alias("_n"), F.sum("chars").alias("_chars"))
    whole = Window.partitionBy(F.lit(0))
    domains = domains.select("_d", "_n", before("_n", whole.orderBy("_d")).alias("_first"), (F.sum("_n").over(whole) - F.col("_n")).alias("_m"), (F.sum("_chars").over(whole) - F.col("_chars")).alias("_chars"))
    ranges = ranges.select("_d", "_rb", before("n", Window.partitionBy("_d").orderBy("_rb")).alias("_skip"))
    figures = ("_first", "_n", "_m", "_chars")
    starts = ranges.join(domains.select(F.col("_d").alias("_e"), *figures), F.col("_d").eqNullSafe(F.col("_e"))).select("_d", "_rb", (F.col("_first") + F.col("_skip")).alias("_start"), *figures)
    inside = F.row_number().over(Window.partitionBy(domain, "_b").orderBy("_h", row_id, state, index)) - 1
    placed = keyed.withColumn("_in", inside).join(starts, F.col(domain).eqNullSafe(F.col("_d")) & (F.col("_b") == F.col("_rb")))
    return placed.select(*rows.columns, (F.col("_start") + F.col("_in")).alias("_at"), *figures)


def padded(rows: DataFrame, row_id: str, state: str, domain: str, index: str, seed: int, budgets: tuple[int, ...] = BUDGETS) -> DataFrame:
    """each state with states of other domains, up to a budget of estimated tokens.

    Every row of another domain and id can be padding.  Each row walks all
    places outside its domain in an order of its own, a permutation seeded by
    its hash, and looks up only as many as its budget takes: rounds of draws
    follow until the budget is reached or no other row is left.  A null state
    counts as empty and is no padding; a null domain is a domain of its own.
    """
    require_shared_dir(rows)
    placed = _placed(rows, row_id, state, domain, index, seed).checkpoint()
    seeds = lambda k: F.xxhash64(F.lit(seed), F.lit(k), row_id, state)
    # draws are numbers below 2^_p, the least power of two that holds the _m other places; those of _m and more are passed over
    asks = placed.where("_m > 0").withColumn("_p", F.length(F.bin(F.col("_m") - 1)) - F.when(F.col("_m") == 1, 1).otherwise(0))
    asks = asks.withColumn("_mask", F.expr("shiftleft(1L, _p) - 1")).withColumn("_odd", F.expr("least(_mask, shiftleft(1L, 62 - _p) - 1)"))
    odd = lambda k: seeds(k).bitwiseAND(F.col("_odd")).bitwiseOR(F.lit(1))
    need = cyclic(F.col(index), list(budgets)) * X.CHARS_PER_TOKEN - F.coalesce(F.length(state), F.lit(0))
    asks = asks.select(
        "_at", F.col(row_id).alias("_id"), "_n", "_first", "_m", "_p", "_mask", odd(1).alias("_a"), seeds(2).bitwiseAND(F.col("_mask")).alias("_c"), odd(3).alias("_e"),
        need.cast("double").alias("_need"), F.lit(False).alias("_any"), F.lit(0).cast("long").alias("_k"), (F.greatest("_chars", F.lit(1)) / (F.col("_mask") + 1)).alias("_yield"),
    )
    others = placed.select(F.col("_at").alias("_place"), F.col(row_id).alias("_other"), F.length(state).alias("_size"))
    pairs, turn = None, 0
    while True:
        count = (F.ceil(1.5 * F.greatest(F.col("_need"), F.lit(0.0)) / F.col("_yield")) + 4) * (1 << min(turn, 20))
        asks = asks.withColumn("_to", F.least(F.col("_mask") + 1, F.col("_k") + count)).checkpoint()
        if asks.isEmpty():
            break
        draws = asks.withColumn("_j", F.explode(F.sequence(F.col("_k"), F.col("_to") - 1))).withColumn("_v", (F.col("_a") * F.col("_j") + F.col("_c")).bitwiseAND(F.col("_mask")))
        draws = draws.withColumn("_v", F.expr("_v ^ shiftrightunsigned(_v, cast((_p + 2) div 2 AS INT))")).withColumn("_v", (F.col("_e") * F.col("_v")).bitwiseAND(F.col("_mask"))).where("_v < _m")
        draws = draws.withColumn("_place", F.col("_v") + F.when(F.col("_v") >= F.col("_first"), F.col("_n")).otherwise(0))
        usable = draws.join(others, "_place").where(F.col("_size").isNotNull() & ~F.col("_other").eqNullSafe(F.col("_id")))
        walk = Window.partitionBy("_at").orderBy("_j")
        had = F.sum("_size").over(walk.rowsBetween(Window.unboundedPreceding, -1))
        # the first other state always joins, as in a loop that adds before it looks
        taken = usable.withColumn("_had", had).where(F.when(F.col("_had").isNull(), ~F.col("_any") | (F.col("_need") > 0)).otherwise(F.col("_had") < F.col("_need")))
        taken = taken.select("_at", "_j", "_place", "_size").checkpoint()
        pairs = taken if pairs is None else pairs.union(taken)
        got = taken.groupBy("_at").agg(F.sum("_size").alias("_got"))
        asks = asks.join(got, "_at", "left").withColumn("_any", F.col("_any") | F.col("_got").isNotNull()).withColumn("_need", F.col("_need") - F.coalesce("_got", F.lit(0)))
        asks = asks.withColumn("_k", F.col("_to")).where((~F.col("_any") | (F.col("_need") > 0)) & (F.col("_k") <= F.col("_mask"))).drop("_got", "_to")
        turn += 1
    out = placed.select(*rows.columns, "_at").withColumn("budget", cyclic(F.col(index), list(budgets)))
    none = F.array().cast("array<string>")
    if pairs is None:
        return out.withColumn("others", none).drop("_at")
    texts = pairs.join(placed.select(F.col("_at").alias("_place"), F.col(state).alias("_state")), "_place")
    texts = texts.groupBy("_at").agg(F.array_sort(F.collect_list(F.struct("_j", "_state"))).alias("_all"))
    filled = texts.select("_at", F.transform("_all", lambda s: s["_state"]).alias("others"))
    return out.join(filled, "_at", "left").withColumn("others", F.coalesce("others", none)).drop("_at")


def injected(state: Column, text: Column, place: Column) -> Column:
    """F8: the text as a line of its own at the start, in the middle or at the end."""
    lines = F.split(state, "\n")
    at = F.when(place == "start", 0).when(place == "end", F.size(lines)).otherwise(F.floor(F.size(lines) / 2).cast("int"))
    return F.array_join(F.concat(F.slice(lines, F.lit(1), at), F.array(text), F.slice(lines, at + 1, F.size(lines))), "\n")


def injected_array(items: Column, item: Column, place: Column) -> Column:
    at = F.when(place == "start", 0).when(place == "end", F.size(items)).otherwise(F.floor(F.size(items) / 2).cast("int"))
    return F.concat(F.slice(items, F.lit(1), at), F.array(item), F.slice(items, at + 1, F.size(items)))


def far_end(values: Column, gold_at: Column) -> Column:
    """F8: the wrong answer for a score: the end of the scale away from the gold."""
    return F.when(gold_at >= F.size(values) / 2, F.get(values, F.lit(0))).otherwise(F.get(values, F.size(values) - 1))


def wrong_answer(kind: Column, values: Column, gold_at: Column, row_hash: Column) -> Column:
    others = F.filter(values, lambda v: v != F.get(values, gold_at))
    return F.when(kind == "score", far_end(values, gold_at)).otherwise(F.get(others, F.pmod(row_hash, F.size(others).cast("long")).cast("int")))


def ordinal_rows(answers: DataFrame, keys: list[str]) -> DataFrame:
    """score questions whose teachers' tops are exactly two neighbouring levels, with the smoothed mean."""
    grouped = answers.where("dist is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("teacher", "dist"))).alias("_all"))
    tops = F.array_distinct(F.transform("_all", lambda s: D.argmax(s["dist"])))
    split = grouped.where((F.size(tops) == 2) & (F.array_max(tops) - F.array_min(tops) == 1))
    return split.select(*keys, D.ordinal_smooth(D.mean(F.transform("_all", lambda s: s["dist"]))).alias("dist"))


def rule_rows(rows: DataFrame, order: list[Column], rules: list[str], variants: int) -> DataFrame:
    """rows with i (their place in that order), rule and variant, cycling over the rules and then over their variants."""
    placed = SC.numbered(rows, [], order, "i")
    return placed.withColumn("rule", cyclic(F.col("i"), rules)).withColumn("variant", F.pmod(F.floor(F.col("i") / len(rules)), F.lit(variants)))


def numbered(rows: DataFrame, partition: str, order: list[str]) -> DataFrame:
    """rows with index, from 0 inside each partition."""
    return SC.numbered(rows, [partition], [F.col(c) for c in order], "index")
