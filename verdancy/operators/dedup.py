"""Deduplication, hash splits and mixes.

Every operator takes its order from an explicit column; nothing depends on the
order of partitions.
"""

from __future__ import annotations

import itertools
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as X

#: Shares of the splits; the rest is train.
SPLITS = (("test", 0.10), ("calib", 0.05), ("valid", 0.03))
SPLIT_SEED = "splits-v1"
PERMUTATIONS, BANDS, ROWS = 128, 9, 13
SHINGLE = 5


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; a partial minimum by key, so that no key is sorted in one task."""
    packed = df.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*order).alias("_o"), F.struct(*df.columns).alias("_r"))
    return packed.groupBy(*[f"_{k}" for k in keys]).agg(F.min_by("_r", "_o").alias("_r")).select("_r.*")


def exact_groups(df: DataFrame, key: Column, group: Column, order: str) -> DataFrame:
    """df with dup_of and kind: exact if an earlier row of another group has the key. The key travels as its digest."""
    keyed = df.withColumn("_key", X.digest(key)).withColumn("_group", group)
    first = keyed.groupBy("_key").agg(F.min(F.struct(order, "_group")).alias("_first"))
    out = keyed.join(first, "_key", "left")
    dup = (F.col("_first._group") != F.col("_group")) & (F.col(f"_first.{order}") < F.col(order))
    return out.select(*df.columns, F.when(dup, F.col(f"_first.{order}")).alias("dup_of"), F.when(dup, "exact").alias("kind"))


def identical_rows(df: DataFrame, parts: list[Column], order: str) -> DataFrame:
    """df with dup_of: the first row with the same parts, whatever its group."""
    keyed = df.withColumn("_sha", X.canonical_sha(*parts))
    first = keyed.groupBy("_sha").agg(F.min(order).alias("_first"))
    return keyed.join(first, "_sha").select(*df.columns, F.when(F.col("_first") < F.col(order), F.col("_first")).alias("dup_of"))


def _mix(x: np.ndarray, spare: np.ndarray | None = None) -> np.ndarray:
    """x mixed in place; spare is room for as many numbers."""
    spare = np.empty_like(x) if spare is None else spare
    for shift, factor in _STEPS:
        np.right_shift(x, shift, out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor is not None:
            np.multiply(x, factor, out=x)
    return x


_STEPS = ((np.uint64(33), np.uint64(0xFF51AFD7ED558CCD)), (np.uint64(29), np.uint64(0xC4CEB9FE1A85EC53)), (np.uint64(32), None))


def band_hashes(keys: list[str]) -> np.ndarray:
    """Band hashes (keys x bands) of MinHash signatures over character shingles; a shorter key is one gram."""
    codes = [np.frombuffer(k.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for k in keys]
    sizes = np.maximum([len(c) for c in codes], SHINGLE)
    starts = np.cumsum(sizes) - sizes
    flat = np.full(int(sizes.sum()), 0x110000, dtype=np.uint64)
    for start, code in zip(starts, codes):
        flat[start : start + len(code)] = code
    grams = np.zeros(max(len(flat) - SHINGLE + 1, 0), dtype=np.uint64)
    for k in range(SHINGLE):
        grams = _mix(grams + flat[k : len(grams) + k] + np.uint64(k + 1))
    whole = np.ones(len(flat), dtype=bool)  # positions where a gram of one key begins
    for k in range(1, SHINGLE):
        whole[starts + sizes - k] = False
    at = np.flatnonzero(whole)
    grams, first = grams[at], np.searchsorted(at, starts)
    seeded, spare = np.empty_like(grams), np.empty_like(grams)
    out = np.zeros((len(keys), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        for seed in _SEEDS[b * ROWS : (b + 1) * ROWS]:
            out[:, b] = _mix(out[:, b] + np.minimum.reduceat(_mix(np.bitwise_xor(grams, seed, out=seeded), spare), first))
    return out.view(np.int64)


_SEEDS = np.random.Generator(np.random.PCG64(17)).integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)
#: Characters that are hashed at once, so few that their hashes stay in a core's cache; a longer key is alone.
CHARS_AT_ONCE = 1 << 15


@F.pandas_udf(ST.ArrayType(ST.LongType()))
def _bands(key: pd.Series) -> pd.Series:
    keys = [k or "" for k in key]
    out, held, size = [], [], 0
    for k in keys:
        if held and size + len(k) > CHARS_AT_ONCE:
            out += band_hashes(held).tolist()
            held, size = [], 0
        held.append(k)
        size += len(k)
    return pd.Series(out + (band_hashes(held).tolist() if held else []), dtype=object)


def band_table(df: DataFrame, key: Column, *columns: str) -> DataFrame:
    """columns and bands, the band hashes of MinHash signatures over character shingles."""
    return df.select(*columns, _bands(key).alias("bands"))


def _two_firsts(rows: DataFrame, bucket: list[str], when: Column | None = None, name: str = "") -> DataFrame:
    """For each bucket of rows(ord, grp) the first row (struct o, grp) and the first of another group than its (other).

    Partial minima by bucket and group, then over the groups: a bucket's rows never meet in one task.
    """
    order = F.col("ord") if when is None else F.when(when, F.col("ord"))
    each = rows.groupBy(*bucket, "grp").agg(F.min(order).alias("o")).where("o is not null")
    first = each.groupBy(*bucket).agg(F.min(F.struct("o", "grp")).alias("_f"))
    other = F.min(F.when(F.col("grp") != F.col("_f.grp"), F.col("o")))
    return each.join(first, bucket).groupBy(*bucket, F.col("_f").alias(f"{name}first")).agg(other.alias(f"{name}other"))


def _earlier(name: str) -> Column:
    """The first row of the bucket of another group than the row's, if it comes before the row."""
    found = F.when(F.col("grp") != F.col(f"{name}first.grp"), F.col(f"{name}first.o")).otherwise(F.col(f"{name}other"))
    return F.when(found < F.col("ord"), found)


def _firsts_of_both(live: DataFrame) -> DataFrame:
    """_two_firsts of all rows of a bucket (any_) and of its kept ones (kept_), out of one table of minima by bucket and group."""
    each = live.groupBy("bucket", "grp").agg(F.min("ord").alias("o"), F.min(F.when(F.col("kept"), F.col("ord"))).alias("ko"))
    kept = F.when(F.col("ko").isNotNull(), F.struct(F.col("ko").alias("o"), "grp"))
    first = each.groupBy("bucket").agg(F.min(F.struct("o", "grp")).alias("any_first"), F.min(kept).alias("kept_first"))
    other = lambda name, o: F.min(F.when(F.col("grp") != F.col(f"{name}first.grp"), F.col(o))).alias(f"{name}other")
    return each.join(first, "bucket").groupBy("bucket", "any_first", "kept_first").agg(other("any_", "o"), other("kept_", "ko"))


#: So few open entries (tens of MB) are passed through in order by one task; more are settled in rounds.
AT_ONCE = 1 << 18


def _lost_in_order(live: pd.DataFrame) -> pd.DataFrame:
    """The rows (ord) that go in a plain pass over entries(ord, grp, bucket, kept)."""
    live = live.sort_values("ord", kind="stable")
    held, lost = {}, []  # up to two groups a bucket say whether another than the row's has it
    for o, rows in itertools.groupby(zip(live["ord"], live["grp"], live["bucket"], live["kept"]), key=lambda r: r[0]):
        rows = list(rows)
        if not rows[0][3] and any(other != g for _, g, b, _ in rows for other in held.get(b, ())):
            lost.append(o)
            continue
        for _, g, b, _ in rows:
            if len(groups := held.setdefault(b, set())) < 2:
                groups.add(g)
    return pd.DataFrame({"ord": pd.Series(lost, dtype=live["ord"].dtype)})


def kept_first(entries: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """The rows that a pass in order keeps: (ord) of entries(ord, grp, bucket), where a row goes if a kept row before it,
    of another group, shares a bucket.

    Decided in rounds, whole buckets at a time: a row stays once no undecided or kept row of another group is before it
    in any of its buckets, and goes once a kept one is.  The first undecided row is always decided, and a bucket's first
    row decides all that it beats, so the rounds are as many as the longest chain of rows that wait for each other.
    A bucket whose rows are all decided leaves with its round, so that a round reads what is still open and no more;
    what is left when at most at_once entries are open is passed through in order, so that a long chain takes no rounds.
    """
    require_shared_dir(entries)
    mixed = entries.groupBy("bucket").agg((F.min("grp") != F.max("grp")).alias("_mixed")).where("_mixed").select("bucket")
    live = entries.join(mixed, "bucket", "left_semi").withColumn("kept", F.lit(False)).checkpoint()
    gone = None
    while open_entries := live.count():
        if open_entries <= at_once:
            lost = live.groupBy().applyInPandas(_lost_in_order, ST.StructType([ST.StructField("ord", entries.schema["ord"].dataType)])).checkpoint()
            gone = lost if gone is None else gone.union(lost)
            break
        seen = live.where("not kept").join(_firsts_of_both(live), "bucket").groupBy("ord").agg(F.max(_earlier("any_").isNotNull()).alias("_waits"), F.max(_earlier("kept_").isNotNull()).alias("_goes"))
        seen = seen.where("_goes or not _waits").checkpoint()
        lost = seen.where("_goes").select("ord")
        gone = lost if gone is None else gone.union(lost)
        after = live.join(seen, "ord", "left").where("not coalesce(_goes, false)")
        after = after.select("ord", "grp", "bucket", (F.col("kept") | ~F.coalesce("_waits", F.lit(True))).alias("kept"))
        unsettled = after.where("not kept").select("bucket").distinct()
        live = after.join(unsettled, "bucket", "left_semi").checkpoint()
    rows = entries.select("ord").distinct()
    return rows if gone is None else rows.join(gone, "ord", "left_anti")


def dedup(df: DataFrame, key: Column, group: Column, sha: Column, order: str) -> DataFrame:
    """df with dup_of and kind by the order-dependent pass: identical row, exact key, shared MinHash band.

    A row goes if a row before it is the same (identical_row, whether that one
    stayed or not), or if a kept row before it, of another group, has its key
    (exact) or shares a band (minhash).  Which rows stay is settled in rounds
    (:func:`kept_first`); what a row is a copy of is read off the kept rows after.
    Keys travel as digests and the signatures are worked out once.  Orders must be
    unique and not null.
    """
    require_shared_dir(df)
    # signatures are the work of the job: rows are dealt evenly, as a file or a range of rows may be one task
    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), order)
    rows = band_table(dealt.withColumn("_key", key).withColumns({"_grp": group.cast("string"), "_sha": sha}), F.col("_key"), order, "_key", "_grp", "_sha")
    rows = rows.select(F.col(order).alias("ord"), X.digest(F.col("_key")).alias("key"), F.coalesce("_grp", F.lit("\0")).alias("grp"), X.digest(F.col("_sha")).alias("sha"), "bands").checkpoint()
    same = rows.groupBy("sha").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = rows.select("ord", "sha").join(same, "sha").where("ord > first").select("ord", F.col("first").alias("dup_of"), F.lit("identical_row").alias("kind"))
    judged = rows.join(repeated.select("ord"), "ord", "left_anti")
    buckets = F.concat(F.array(F.hex("key")), F.transform("bands", lambda h, i: F.concat_ws(":", i.cast("string"), h.cast("string"))))
    stay = kept_first(judged.select("ord", "grp", F.explode(buckets).alias("bucket"))).checkpoint()
    kept, lost = judged.join(stay, "ord", "left_semi"), judged.join(stay, "ord", "left_anti")
    by_key = lost.join(_two_firsts(kept, ["key"]), "key").select("ord", _earlier("").alias("exact"))
    band = lambda side: side.select("ord", "grp", F.posexplode("bands").alias("place", "hash"))
    by_band = band(lost).join(_two_firsts(band(kept), ["place", "hash"]), ["place", "hash"]).groupBy("ord").agg(F.min(_earlier("")).alias("near"))
    found = lost.select("ord").join(by_key, "ord", "left").join(by_band, "ord", "left")
    found = found.select("ord", F.coalesce("exact", "near").alias("dup_of"), F.when(F.col("exact").isNotNull(), "exact").otherwise("minhash").alias("kind"))
    verdicts = repeated.unionByName(found).withColumnRenamed("ord", order)
    return df.join(verdicts, order, "left")


def require_shared_dir(df: DataFrame) -> str:
    """The folder that executors share, which checkpoint() needs; only a local session gets one of its own."""
    spark = df.sparkSession
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verdancy-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def split_name(group: Column, seed: str = SPLIT_SEED) -> Column:
    """Stable split of a group: its hash against cumulative shares."""
    number = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}|"), group), 256), 1, 12), 16, 10).cast("double") / float(16**12)
    out, edge = None, 0.0
    for name, share in SPLITS:
        edge += share
        out = F.when(number < edge, name) if out is None else out.when(number < edge, name)
    return out.otherwise("train")


def split_group(tags: Column, row_id: Column) -> Column:
    """The whole group tag, or id:<id>."""
    return F.coalesce(F.get(F.filter(tags, lambda t: t.startswith("group:")), F.lit(0)), F.concat(F.lit("id:"), row_id))


def resolve_conflicts(df: DataFrame, key: Column, targets: Column, order: list[str]) -> DataFrame:
    """df with verdict: keep, duplicate (a later equal copy) or conflict (copies whose targets differ)."""
    keyed = df.withColumn("_key", X.digest(key)).withColumn("_target", targets)
    facts = keyed.groupBy("_key").agg((F.min("_target") != F.max("_target")).alias("_differ"), F.min(F.struct(*order)).alias("_first"))
    verdict = F.when(F.col("_differ"), "conflict").when(F.struct(*order) == F.col("_first"), "keep").otherwise("duplicate")
    return keyed.join(facts, "_key").select(*df.columns, verdict.alias("verdict"))


def followers(df: DataFrame, dropped: DataFrame, suffix: str = "-perm") -> DataFrame:
    """df less the dropped ids and the permuted copies of them."""
    return df.withColumn("_base", F.regexp_replace("id", f"{suffix}$", "")).join(dropped.select(F.col("id").alias("_base")), "_base", "left_anti").drop("_base")


def take(df: DataFrame, n: int, seed: int, row_id: str) -> DataFrame:
    """n rows in hash order; 0 takes all."""
    return df.orderBy(F.xxhash64(F.lit(seed), row_id), row_id).limit(n) if n else df


def mixed(specs: list[tuple[DataFrame, int]], seed: int, row_id: str) -> DataFrame:
    """The union of sources, of each so many rows in hash order; 0 takes all."""
    out = None
    for df, n in specs:
        part = take(df, n, seed, row_id)
        out = part if out is None else out.unionByName(part)
    return out


def sampled(df: DataFrame, share: float, seed: int, row_id: str) -> DataFrame:
    """Each row with probability share, by a hash of its id."""
    return df.where(F.pmod(F.xxhash64(F.lit(seed), row_id), F.lit(1_000_000)) < int(share * 1_000_000))


def permuted(df: DataFrame, options: str, seed: int, row_id: str, least: int = 3) -> DataFrame:
    """Copies of rows with at least three options, in another order; ids end in -perm."""
    keyed = F.transform(options, lambda o, i: F.struct(F.xxhash64(F.lit(seed), F.col(row_id).cast("string"), i).alias("k"), o.alias("o")))
    mixed = F.transform(F.array_sort(keyed), lambda s: s["o"])
    # an order that came out unchanged is turned by one
    turned = F.concat(F.slice(mixed, 2, 1 << 20), F.slice(mixed, 1, 1))
    out = df.where(F.size(options) >= least).withColumn(options, F.when(mixed == F.col(options), turned).otherwise(mixed))
    return out.withColumn(row_id, F.concat(F.col(row_id).cast("string"), F.lit("-perm")))

