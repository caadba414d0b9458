"""Running numbers, sums and islands against plain loops, with one key in many ranges."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from verdancy.operators import picks as P
from verdancy.operators import scans as SC


def table(spark, n, seed, hot=0.6):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    rows = [(i, rng.choice(["k1", "k2", None]) if rng.random() > hot else "hot", rng.choice([1, 2, 3, None]), rng.choice("ab")) for i in ids]
    return rows, spark.createDataFrame(rows, "id long, key string, size int, kind string").repartition(5)


@pytest.fixture
def ranges(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def by_key(rows):
    key = lambda r: (r[1] is not None, r[1] or "", r[0])
    return {k: list(g) for k, g in itertools.groupby(sorted(rows, key=key), lambda r: r[1])}


def test_places_and_sums(spark, ranges):
    rows, df = table(spark, 700, 1)
    got = {r.id: (r.place, r.before) for r in SC.running(df, ["key"], [F.col("id")], {"before": F.col("size")}, "place").collect()}
    want = {}
    for group in by_key(rows).values():
        total = 0
        for place, r in enumerate(group):
            want[r[0]] = (place, total)
            total += r[2] or 0
    assert got == want
    spread = SC._ranged(df, ["key"], [F.col("id")])[0].where("key = 'hot'").agg(F.count_distinct("_range")).first()[0]
    assert spread > 1  # one key, many tasks


@pytest.mark.parametrize("seed", [2, 3, 4])
def test_islands_across_ranges(spark, ranges, seed):
    rows, df = table(spark, 400, seed, 0.8)
    if seed == 4:  # one island over all ranges
        rows = [(*r[:3], "a") for r in rows]
        df = spark.createDataFrame(rows, df.schema).repartition(5)
    got = {r.id: (r.island, r.chunk) for r in P.islands(df, "key", ["id"], F.col("kind"), 6).collect()}
    want = {}
    for group in by_key(rows).values():
        for island, (_, run) in enumerate(itertools.groupby(group, lambda r: r[3]), 1):
            for k, r in enumerate(run):
                want[r[0]] = (island, k // 6)
    assert got == want


def test_budgets_batches_and_repeated_rows(spark, ranges):
    rows, df = table(spark, 300, 5)
    kept = {r.id for r in P.until_budget(df, "key", [F.col("id")], F.col("size"), F.lit(1), F.lit(20)).collect()}
    want = set()
    for group in by_key(rows).values():
        total = 1
        for r in group:
            if total < 20:
                want.add(r[0])
            total += r[2] or 0
    assert kept == want
    twice = df.select("key").union(df.select("key"))
    batches = P.fixed_batches(twice, "key", ["key"], 7).groupBy("key", "batch").count().collect()
    for key, group in by_key(rows).items():
        sizes = sorted((r.batch, r["count"]) for r in batches if r.key == key)
        n = 2 * len(group)
        assert sizes == [(b, min(7, n - 7 * b)) for b in range(-(-n // 7))]


def test_positional_join_is_zip(spark, ranges):
    rows, df = table(spark, 200, 6)
    other = spark.createDataFrame([(f"item {i}", (i * 37) % 101) for i in range(101)], "item string, weight int").repartition(3)
    got = sorted((r.place, r.id, r.item) for r in SC.zipped(df, other, [-F.col("id")], [F.col("weight")]).collect())
    items = [w for _, w in sorted((w, i) for i, w in ((f"item {i}", (i * 37) % 101) for i in range(101)))]
    assert got == [(k, i, item) for k, (i, item) in enumerate(zip(sorted((r[0] for r in rows), reverse=True), items))]


def test_no_rows(spark):
    none = spark.createDataFrame([], "id long, key string, size int, kind string")
    assert P.islands(none, "key", ["id"], F.col("kind")).count() == 0
    assert SC.zipped(none, spark.range(3).withColumnRenamed("id", "other"), [F.col("id")], [F.col("other")]).count() == 0
