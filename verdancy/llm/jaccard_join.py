"""Word 5-gram Jaccard self-join by chosen paths.

Result.  One row per document: ``copy_of`` is the smallest doc_id with the same
set of word 5-grams, ``class_id`` the smallest doc_id of its connected group of
links, ``n_links`` the number of other documents at a Jaccard similarity of
``threshold`` or more, exact copies among them.

Method.  Documents with one set are collapsed to one row first.  Each set is
embedded by ``TOKENS`` minhash tokens.  In each of several runs a tree is grown:
a node samples two token places, and sets that agree there go to one child.  A
child of up to ``LEAF`` sets is a leaf and is compared by brute force.  A larger
one is split again, on fresh places, for as long as that lowers the number of
pairs to compare: in a bucket of loosely related sets every split does, while in
one whose sets agree on more than half of their tokens two children hold more
pairs than their parent, and it is compared as it stands.  So the rows of a tree
stay in proportion to its sets.  With two places a node a pair at the threshold
survives a run with probability q (see ``_runs``), and runs are added until
1 - (1 - q)**runs reaches ``recall``.

A bucket of up to ``BLOCK`` sets and ``BLOCK_GRAMS`` grams is one unit of work;
only one beyond that is dealt to blocks, each pair of which is a unit, so that a
task holds two blocks whatever the bucket's size.

A pair is judged only in the first bucket that it shares, so links are counted
once.  In a bucket, token agreement drops pairs that are plainly apart (over
five standard deviations); the rest is decided on the exact 5-gram sets, for
which only the texts of sets in such a pair are fetched.

Edge cases.  Null or empty texts have no 5-gram and no links; a text of one to
four words is one gram.  Rows that repeat a doc_id count as documents.  A row
with a null doc_id has links as any other; its class is null unless a row of its
group has an id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .common import Scratch, saved, shuffle_partitions
from .components import components
from .grouped import groups

GRAM = 5
TOKENS = 64
PLACES = 2
LEAF = 1024
DEPTH = 32  # an end for trees of equal tokens; the rule of pairs ends others long before
BLOCK = 2048
BLOCK_GRAMS = 1 << 21
#: Rows of ids and hashes, 16 bytes each, up to which the wanted texts are found by a broadcast semi-join, else by a shuffle.
BROADCAST_ROWS = 1 << 20
RECALL = 0.99999
CHUNK_BYTES = (1 << 20) - 1

_RNG = np.random.Generator(np.random.PCG64(71))
_FACTORS = _RNG.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(1, 1 << 63, TOKENS, dtype=np.uint64)


def _runs(threshold: float, recall: float) -> int:
    """Runs that find a pair at the threshold with probability recall, were every tree grown to full depth."""
    miss = 0.0
    for _ in range(DEPTH):
        miss = (1 - threshold * (1 - miss)) ** PLACES
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def grams(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every word n-gram, in document order."""
    counts = w.counts()
    starts = T.window_starts(w, GRAM)
    short = np.flatnonzero((counts > 0) & (counts < GRAM))
    starts = np.concatenate([starts, w.doc_word[short]])
    width = np.concatenate([np.full(len(starts) - len(short), GRAM), counts[short]])
    h = T.window_hashes(T.word_hashes(w), starts, width)
    doc = w.doc_of()[starts]
    if len(short):
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    return doc, h


def _sets(doc: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document, gram) pairs, sorted."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, dtype=bool)
    return doc[new], h[new]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = T.strings(batch.column("text"))
        for a, b in T.slices(texts, CHUNK_BYTES):
            w = T.words(texts.slice(a, b - a))
            doc, h = _sets(*grams(w), b - a)
            sig = np.zeros((b - a, TOKENS), dtype=np.uint32)
            low = np.zeros(b - a, dtype=np.uint64)
            high = np.zeros(b - a, dtype=np.uint64)
            size = np.bincount(doc, minlength=b - a)
            if len(h):
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                at = doc[first]
                for k in range(TOKENS):
                    sig[at, k] = np.minimum.reduceat(((h * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)).astype(np.uint32), first)
                low[at] = np.add.reduceat(T.mix(h ^ np.uint64(0x5851F42D4C957F2D)), first)
                high[at] = np.add.reduceat(T.mix(h ^ np.uint64(0x14057B7EF767814F)), first)
            keys = np.stack([low, high], axis=1).astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("th").slice(a, b - a),
                    pa.array([keys[16 * i : 16 * i + 16] for i in range(b - a)], pa.binary()),
                    pa.array(size, pa.int32()),
                    pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * TOKENS, pa.array(sig.ravel().view(np.int32))),
                ],
                names=["doc_id", "th", "k", "n", "sig"],
            )


def _sides(group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the unit's two blocks; of a unit within one block, all rows twice."""
    rows = np.arange(group.num_rows)
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    if i == j:
        return rows, rows
    block = group.column("block").to_numpy(zero_copy_only=False)
    return rows[block == i], rows[block == j]


def _met(group: pa.RecordBatch, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs share an earlier bucket, by products of bounded 0/1 matrices."""
    paths = group.column("paths")
    n = group.num_rows
    lists = paths.flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(n), paths.value_lengths().to_numpy(zero_copy_only=False))
    early = lists < group.column("path")[0].as_py()
    lists, of = lists[early], of[early]
    met = np.zeros((len(left), len(right)), dtype=bool)
    _, index, count = np.unique(lists, return_inverse=True, return_counts=True)
    often = count[index] > 1
    of, index = of[often], np.unique(index[often], return_inverse=True)[1]
    order = np.argsort(index, kind="stable")
    of, index = of[order], index[order]
    for low in range(0, int(index[-1]) + 1 if len(index) else 0, 512):
        a, b = np.searchsorted(index, [low, low + 512])
        m = np.zeros((n, min(512, int(index[-1]) + 1 - low)), dtype=np.float32)
        m[of[a:b], index[a:b] - low] = 1
        met |= (m[left] @ m[right].T) > 0
    return met


def _open_pairs(group: pa.RecordBatch, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs that this unit has to judge: of two sets, and not met in an earlier bucket."""
    todo = ~_met(group, left, right)
    if left is right:
        np.fill_diagonal(todo, False)
    return todo


def _plausible(slack: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["path", "i", "j"]):
            left, right = _sides(group)
            if group.num_rows < 2 or not len(left) or not len(right):
                continue
            sig = group.column("sig").flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, TOKENS)
            agree = np.zeros((len(left), len(right)), dtype=np.int8)
            for k in range(TOKENS):
                agree += sig[left, k][:, None] == sig[right, k][None, :]
            near = agree >= math.ceil(slack * TOKENS)
            if left is right:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            near &= _open_pairs(group, left, right)
            keep = np.zeros(group.num_rows, dtype=bool)
            keep[left[near.any(axis=1)]] = True
            keep[right[near.any(axis=0)]] = True
            if keep.any():
                yield group.filter(pa.array(keep)).select(["path", "i", "j", "block", "k", "copies", "paths"])

    return run


def _overlaps(doc: np.ndarray, h: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left's and right's sets, by products of bounded 0/1 matrices."""
    n = int(max(left[-1], right[-1])) + 1
    _, index, count = np.unique(h, return_inverse=True, return_counts=True)
    often = count[index] > 1
    doc, index = doc[often], index[often]
    order = np.argsort(index, kind="stable")
    doc, index = doc[order], index[order]
    index = np.cumsum(np.r_[False, index[1:] != index[:-1]]) if len(index) else index
    total = np.zeros((len(left), len(right)), dtype=np.float64)
    step = max(256, (1 << 22) // max(n, 1))
    for low in range(0, int(index[-1]) + 1 if len(index) else 0, step):
        a, b = np.searchsorted(index, [low, low + step])
        m = np.zeros((n, min(step, int(index[-1]) + 1 - low)), dtype=np.float32)
        m[doc[a:b], index[a:b] - low] = 1
        total += m @ m.T if left is right else m[left] @ m[right].T
    return total


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["path", "i", "j"]):
            n = group.num_rows
            left, right = _sides(group)
            if n < 2 or not len(left) or not len(right):
                continue
            doc, h = _sets(*grams(T.words(T.strings(group.column("text")))), n)
            size = np.bincount(doc, minlength=n).astype(np.float64)
            common = _overlaps(doc, h, left, right)
            linked = common >= threshold * (size[left][:, None] + size[right][None, :] - common) - 1e-9
            linked &= _open_pairs(group, left, right)
            if not linked.any():
                continue
            copies = group.column("copies").to_numpy(zero_copy_only=False)
            degree = np.zeros(n, dtype=np.int64)
            degree[left] += linked @ copies[right]
            if left is not right:
                degree[right] += copies[left] @ linked
            label = np.arange(n)
            while True:
                least = label.copy()
                least[left] = np.minimum(least[left], np.where(linked, label[right][None, :], n).min(axis=1))
                least[right] = np.minimum(least[right], np.where(linked, label[left][:, None], n).min(axis=0))
                least = least[least]
                if (least == label).all():
                    break
                label = least
            k = group.column("k").to_pylist()
            at = np.flatnonzero(degree)
            yield pa.RecordBatch.from_arrays([pa.array([k[x] for x in at], pa.binary()), pa.array([k[label[x]] for x in at], pa.binary()), pa.array(degree[at], pa.int64())], names=["u", "v", "links"])

    return run


def _buckets(classes: DataFrame, runs: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Leaves (k, path, n, grams) of all runs, and the classes that are in one."""

    def children(path) -> list:
        """The buckets of a set below a node: of two places, each with the set's token there."""
        place = F.pmod(F.xxhash64(path), F.lit(TOKENS))
        other = F.pmod(place + 1 + F.pmod(F.xxhash64(path, F.lit(1)), F.lit(TOKENS - 1)), F.lit(TOKENS))
        return [F.xxhash64(path, p, F.get("sig", p.cast("int"))) for p in (place, other)]

    def met(rows: DataFrame) -> DataFrame:
        """Rows whose bucket holds two sets or more, with its size."""
        sizes = rows.groupBy("path").agg(F.count("*").alias("n"), F.sum("size").alias("grams")).where("n > 1")
        return scratch.saved(rows.join(sizes, "path"), "bucket")

    roots = [bucket for run in range(runs) for bucket in children(F.lit(run).cast("long"))]
    level = met(classes.select("k", "size", F.explode(F.array(*roots)).alias("path")))
    alive = scratch.saved(classes.join(level.select("k").distinct(), "k", "left_semi"), "alive")
    leaves = level.where(F.col("n") <= LEAF)
    for _ in range(DEPTH):
        grow = level.where(F.col("n") > LEAF)
        if grow.isEmpty():
            break
        below = grow.join(alive.select("k", "sig"), "k").select("k", "size", F.col("path").alias("parent"), "n", "grams", F.explode(F.array(*children(F.col("path")))).alias("path"))
        below = scratch.saved(below, "below")
        counts = below.groupBy("parent", "path").agg(F.first("n").alias("whole"), F.count("*").cast("double").alias("part"))
        pays = counts.groupBy("parent").agg((F.sum(F.col("part") * (F.col("part") - 1)) < F.first("whole").cast("double") * (F.first("whole") - 1)).alias("pays"))
        below = below.join(pays, "parent")
        stay = below.where("not pays").select("k", "size", F.col("parent").alias("path"), "n", "grams").distinct()
        leaves = leaves.unionByName(stay.select(*leaves.columns))
        level = met(below.where("pays").select("k", "size", "path"))
        leaves = leaves.unionByName(level.where(F.col("n") <= LEAF).select(*leaves.columns))
    else:
        leaves = leaves.unionByName(level.where(F.col("n") > LEAF).select(*leaves.columns))
    return leaves.select("k", "path", "n", "grams"), alive


def jaccard_join(docs: DataFrame, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) for every row of docs."""
    return grouped_rows(docs, threshold, recall).select("doc_id", "class_id", "copy_of", "n_links")


def grouped_rows(docs: DataFrame, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """jaccard_join's rows with th, the text's hash, and label, the key of the group: ids can repeat, in one group or in several."""
    with Scratch(docs.sparkSession) as scratch:
        return saved(_grouped(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), threshold, recall, scratch), "groups")


def _texts(docs: DataFrame, near: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(k, text) of the classes in near: from the row of the class's representative (ids can repeat, so the text's hash must
    agree too), or from a row without an id where no row of the class has one."""
    wanted = near.select("k").distinct().join(classes.select("k", "rep", F.col("th").alias("rep_th")), "k")
    wanted = scratch.saved(wanted, "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("th") == F.col("rep_th"))
    keys = wanted.select("rep", "rep_th").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        docs = docs.join(F.broadcast(keys), same, "left_semi")
    return docs.join(wanted, same).groupBy("k").agg(F.first("text").alias("text"))


def _grouped(docs: DataFrame, threshold: float, recall: float, scratch: Scratch) -> DataFrame:
    parts = shuffle_partitions(docs.sparkSession)
    sigs = scratch.saved(docs.mapInArrow(_signatures, "doc_id long, th long, k binary, n int, sig array<int>"), "signatures")
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("r")
    classes = sigs.where("n > 0").groupBy("k").agg(least, F.min("th").alias("th"), F.count("*").alias("copies"), F.min("sig").alias("sig"), F.min("n").cast("long").alias("size"))
    classes = scratch.saved(classes.select("k", F.col("r.doc_id").alias("rep"), F.coalesce("r.th", "th").alias("th"), "copies", "sig", "size"), "classes")
    leaves, alive = _buckets(classes, _runs(threshold, recall), scratch)
    leaves = scratch.saved(leaves, "leaves")

    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    units = leaves.withColumn("block", F.pmod(F.xxhash64("k"), blocks).cast("int")).select("k", "path", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    units = units.select("k", "path", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    paths = leaves.groupBy("k").agg(F.collect_set("path").alias("paths"))
    rows = units.join(alive.select("k", "copies", "sig").join(paths, "k"), "k")
    deviation = math.sqrt(threshold * (1 - threshold) / TOKENS)
    kind = "path long, i int, j int, block int, k binary, copies long, paths array<long>"
    dealt = lambda df: df.repartition(parts, "path", "i", "j").sortWithinPartitions("path", "i", "j")
    near = scratch.saved(dealt(rows).mapInArrow(_plausible(threshold - 5 * deviation), kind), "plausible")
    texts = _texts(docs, near, classes, scratch)
    links = scratch.saved(dealt(near.join(texts, "k")).mapInArrow(_links(threshold), "u binary, v binary, links long"), "links")

    degree = links.groupBy(F.col("u").alias("k")).agg(F.sum("links").alias("links"))
    label = components(links).select(F.col("node").alias("k"), "label")
    full = classes.select("k", "rep", "copies").join(degree, "k", "left").join(label, "k", "left").withColumn("label", F.coalesce("label", "k"))
    full = full.join(full.groupBy("label").agg(F.min("rep").alias("class_id")), "label")
    full = full.select("k", "label", "class_id", F.col("rep").alias("copy_of"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = sigs.where("n = 0").select("doc_id", "th", F.col("th").cast("string").cast("binary").alias("label"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links"))
    return sigs.where("n > 0").select("doc_id", "th", "k").join(full, "k").select("doc_id", "th", "label", "class_id", "copy_of", "n_links").union(alone)


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
