import random

import pytest
from pyspark.sql import functions as F

from verdancy.functions import text as X
from verdancy.operators import dedup as DD

LONG = "Der Kunde meldet, dass die Lieferung seit drei Tagen überfällig ist und niemand am Telefon erreichbar war. Er verlangt eine schnelle Antwort."


def judged(spark, rows):
    df = spark.createDataFrame([(i, s, g, q) for i, (s, g, q) in enumerate(rows)], "ord long, state string, g string, q string")
    key = X.state_key(F.col("state"))
    return {r.ord: (r.dup_of, r.kind) for r in DD.dedup(df, key, F.col("g"), X.canonical_sha(key, F.col("q")), "ord").collect()}


def test_kinds_and_group_exemption(spark):
    edited = LONG.replace("drei", "vier")
    got = judged(spark, [(LONG, "a", "1"), (LONG.upper() + "  ", "b", "2"), (LONG, "a", "3"), (edited, "c", "4"), ("Etwas ganz anderes steht in dieser Zeile hier.", "d", "5"), (LONG, "z", "1")])
    assert got[0] == (None, None)
    assert got[1] == (0, "exact")
    assert got[2] == (None, None)
    assert got[3] == (0, "minhash")
    assert got[4] == (None, None)
    assert got[5] == (0, "identical_row")


def test_split_shares_and_stability(spark):
    rows = spark.range(20000).select(DD.split_name(F.concat(F.lit("group:"), F.col("id").cast("string"))).alias("s")).groupBy("s").count().collect()
    share = {r.s: r["count"] / 20000 for r in rows}
    assert share["test"] == pytest.approx(0.10, abs=0.01) and share["calib"] == pytest.approx(0.05, abs=0.01) and share["train"] == pytest.approx(0.82, abs=0.02)


def test_conflicts(spark):
    df = spark.createDataFrame([(1, "k", "x"), (2, "k", "x"), (3, "j", "x"), (4, "j", "y")], "id long, k string, t string")
    got = {r.id: r.verdict for r in DD.resolve_conflicts(df, F.col("k"), F.col("t"), ["id"]).collect()}
    assert got == {1: "keep", 2: "duplicate", 3: "conflict", 4: "conflict"}


def test_permuted_copies_differ_and_hold_the_same_options(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("id"), F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("o"))
    rows = DD.permuted(df, "o", 3, "id").collect()
    assert len(rows) == 50 and all(r.o != ["a", "b", "c"] and sorted(r.o) == ["a", "b", "c"] and r.id.endswith("-perm") for r in rows)


def in_order(entries):
    """The rows that a plain pass keeps, of {ord: (group, buckets)}."""
    kept, held = set(), {}
    for o, (g, buckets) in sorted(entries.items()):
        if not any(other != g for b in buckets for other in held.get(b, ())):
            kept.add(o)
            for b in buckets:
                held.setdefault(b, []).append(g)
    return kept


@pytest.mark.parametrize("seed, groups, buckets", [(1, 3, 8), (2, 40, 5), (3, 2, 60), (4, 1, 4)])
def test_rounds_keep_what_a_pass_in_order_keeps(spark, seed, groups, buckets):
    rng = random.Random(seed)
    entries = {o: (f"g{rng.randrange(groups)}", {rng.randrange(buckets) for _ in range(rng.randint(1, 3))}) for o in rng.sample(range(5000), 160)}
    df = spark.createDataFrame([(o, g, f"b{b}") for o, (g, bs) in entries.items() for b in bs], "ord long, grp string, bucket string")
    assert {r.ord for r in DD.kept_first(df).collect()} == in_order(entries)


def test_a_chain_of_rows_that_wait_for_each_other(spark):
    entries = {o: (f"g{o}", {o, o + 1}) for o in range(9)}
    df = spark.createDataFrame([(o, g, f"b{b}") for o, (g, bs) in entries.items() for b in bs], "ord long, grp string, bucket string")
    assert {r.ord for r in DD.kept_first(df).collect()} == in_order(entries) == {0, 2, 4, 6, 8}


@pytest.mark.parametrize("seed, groups, buckets, at_once", [(5, 3, 8, 0), (6, 40, 5, 0), (7, 2, 60, 60), (8, 6, 40, 150)])
def test_rounds_alone_and_rounds_before_the_pass_keep_the_same(spark, seed, groups, buckets, at_once):
    rng = random.Random(seed)
    entries = {o: (f"g{rng.randrange(groups)}", {rng.randrange(buckets) for _ in range(rng.randint(1, 3))}) for o in rng.sample(range(5000), 160)}
    df = spark.createDataFrame([(o, g, f"b{b}") for o, (g, bs) in entries.items() for b in bs], "ord long, grp string, bucket string")
    assert {r.ord for r in DD.kept_first(df, at_once).collect()} == in_order(entries)


def test_a_long_chain_takes_no_round_for_each_row(spark, monkeypatch):
    rounds = []
    firsts = DD._firsts_of_both
    monkeypatch.setattr(DD, "_firsts_of_both", lambda live: rounds.append(1) or firsts(live))
    df = spark.createDataFrame([(o, f"g{o}", f"b{b}") for o in range(400) for b in (o, o + 1)], "ord long, grp string, bucket string")
    assert sorted(r.ord for r in DD.kept_first(df).collect()) == list(range(0, 400, 2)) and not rounds
