"""Runs of words that a text shares with a reference corpus.

A run of n words is hashed from its words' hashes, so the work is linear in a
text.  The reference's runs become a Bloom filter: an aggregate of at most
``MOST_BITS`` bits, which reaches the rows as one array (a scalar subquery) and is
probed in their projection.  Only the runs that pass it are exploded, and those
are joined with the reference's runs by hash and text, so the result is exact
whatever the filter lets through.

Texts without n words have no runs; a null text has none.  Row ids must be unique
and not null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

RUN = 8
BITS_PER_RUN, PROBES, STEP = 16, 3, 19
#: The filter's size at most (8 MB); a larger reference only lets more runs through to the exact join.
MOST_BITS = 1 << 26


def _hash(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def run_hashes(tokens: Column, n: int = RUN) -> Column:
    """A hash for each run of n tokens, in their order."""
    none = F.array().cast("array<bigint>")
    return X.let(_hash(tokens), lambda h: F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(1), F.size(h) - n + 1), lambda i: F.xxhash64(F.slice(h, i, n)))).otherwise(none))


def reference_runs(reference: DataFrame, text: str, n: int = RUN) -> DataFrame:
    """(hash, run) of the distinct runs of the reference texts."""
    tokens = X.word_tokens(F.col(text))
    runs = X.let(tokens, lambda t: F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, n), " "))))
    return reference.select(F.explode(runs).alias("run")).distinct().select(F.xxhash64(_hash(F.split("run", " "))).alias("hash"), "run")


def _places(h: Column, bits: int) -> list[Column]:
    return [F.pmod(F.shiftrightunsigned(h, STEP * k), F.lit(bits)) for k in range(PROBES)]


def bloom_filter(hashes: DataFrame, hash: str = "hash") -> tuple[DataFrame, int]:
    """(one row with the array words of 64 bits each, number of bits) of a column of hashes."""
    n = hashes.count()
    bits = min(MOST_BITS, max(1 << 10, 1 << math.ceil(math.log2(max(1, n * BITS_PER_RUN)))))
    place = hashes.select(F.explode(F.array(*_places(F.col(hash), bits))).alias("p"))
    words = place.groupBy(F.shiftright("p", 6).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))).alias("w"))
    dense = hashes.sparkSession.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("w", F.lit(0).cast("long")).alias("w"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "w"))), lambda s: s["w"]).alias("words")), bits


def may_hold(words: Column, h: Column, bits: int) -> Column:
    """Whether the filter may hold h: false is certain."""
    found = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in _places(h, bits)]
    return found[0] & found[1] & found[2]


def shared_runs(df: DataFrame, text: str, known: DataFrame, row_id: str, n: int = RUN) -> DataFrame:
    """(row_id, place, run) of every run of df's texts that known(hash, run) holds; place is the run's first word, from 0."""
    words, bits = bloom_filter(known.select("hash"))
    rows = df.select(row_id, F.col(text).alias("_text"), words.scalar().alias("_words"))
    tokens = X.word_tokens(F.col("_text"))

    def passing(t: Column) -> Column:
        each = F.transform(run_hashes(t, n), lambda h, i: F.struct(i.alias("place"), h.alias("hash")))
        kept = X.let(F.col("_words"), lambda w: F.filter(each, lambda s: may_hold(w, s["hash"], bits)))
        return F.transform(kept, lambda s: F.struct(s["place"].alias("place"), s["hash"].alias("hash"), F.array_join(F.slice(t, s["place"] + 1, n), " ").alias("run")))

    hits = rows.select(row_id, F.explode(X.let(tokens, passing)).alias("h")).select(row_id, "h.*")
    return hits.join(known, ["hash", "run"]).select(row_id, "place", "run")


def with_copied(df: DataFrame, text: str, reference: DataFrame, reference_text: str, row_id: str, n: int = RUN) -> DataFrame:
    """df with copied: the first run of n words that a text shares with a reference text, or null."""
    found = shared_runs(df, text, reference_runs(reference, reference_text, n), row_id, n)
    first = found.groupBy(row_id).agg(F.min_by("run", "place").alias("copied"))
    return df.join(first, row_id, "left")


def contaminated(df: DataFrame, text: str, reference: DataFrame, reference_text: str, row_id: str, n: int = RUN) -> DataFrame:
    """The rows that share a run of n words with a reference text."""
    found = shared_runs(df, text, reference_runs(reference, reference_text, n), row_id, n)
    return df.join(found.select(row_id).distinct(), row_id, "left_semi")
