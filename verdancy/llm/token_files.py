"""Token-id files: bit-plane shuffled, zstandard-compressed chunks with an index.

Format.  Ids go to disk in ascending doc_id order.  A *shard* is one range of
doc_ids and one task's work; it holds *chunks* of whole documents, about
``CHUNK_IDS`` ids each.  A chunk's ids are cut into *blocks* of ``BLOCK`` ids
(the last one holds what is left, padded with zeros to whole bytes).  Each block
is transposed by itself into bit planes (plane p holds bit p of each id, most
significant bit of a byte first), and each plane of a block is one zstandard
frame; a block has as many planes as its largest id needs.  ``planes="byte"``
stores byte planes by the same rule.  The frames of a chunk lie one after the
other in ``data``, and the index holds the number of planes of each block and
the bytes of each frame, so any block can be read alone (:func:`read_block`).

The container is Parquet, so that Spark's commit protocol keeps exactly one
copy of each task's output, wherever the store is.  The chunk index is made of
the columns beside the data (shard, chunk, first and last doc_id, counts, offset
of the chunk in its shard, planes and frame sizes) and can be read alone.

Edge cases.  Null text counts as empty: its only id is the end id.  Null doc_ids
come first.  Rows that repeat a doc_id (or have none) are ordered by text, and
shards are cut between them by the first characters of the text, so that one id
can fill many shards.  An empty table gives files without chunks and no rows.  A
document of any length stays whole in its chunk.  Input columns other than
doc_id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textcore as T
from .common import scratch_path, shuffle_partitions
from .unit_encoder import encoded

END_ID = 2
BLOCK = 1 << 15
CHUNK_IDS = 1 << 18
LEVEL = 1
TEXT_BYTES = 1 << 20
PREFIX = 32  # characters of the text by which rows of one doc_id are dealt to shards

_INDEX = [
    ("shard", pa.int32()), ("chunk", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("shard_start", pa.int64()),
    ("block", pa.int32()), ("planes", pa.string()), ("block_planes", pa.list_(pa.int32())), ("plane_bytes", pa.list_(pa.int32())),
]
_CHUNK = pa.schema([*_INDEX, ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])
CHUNK_SCHEMA = (
    "shard int, chunk int, first_doc long, last_doc long, n_docs int, n_ids long, shard_start long, block int, planes string, block_planes array<int>, plane_bytes array<int>, "
    "doc_ids array<long>, lengths array<long>, data binary"
)
INDEX_COLUMNS = [name for name, _ in _INDEX]


def block_streams(ids: np.ndarray, planes: str = "bit") -> list[bytes]:
    """The planes of one block of ids, lowest plane first."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if planes == "bit":
        return [np.packbits((ids >> np.uint32(p)) & np.uint32(1)).tobytes() for p in range(top)]
    return [((ids >> np.uint32(8 * p)) & np.uint32(255)).astype(np.uint8).tobytes() for p in range(-(-top // 8))]


def join_streams(streams: list[bytes], n: int, planes: str = "bit") -> np.ndarray:
    """The inverse of block_streams for n ids."""
    ids = np.zeros(n, dtype=np.uint32)
    for p, stream in enumerate(streams):
        part = np.frombuffer(stream, dtype=np.uint8)
        ids |= np.unpackbits(part, count=n).astype(np.uint32) << np.uint32(p) if planes == "bit" else part.astype(np.uint32) << np.uint32(8 * p)
    return ids


def write_blocks(ids: np.ndarray, planes: str, compressor: zstandard.ZstdCompressor) -> tuple[list[int], list[int], bytes]:
    """(planes of each block, bytes of each frame, frames) of a chunk's ids."""
    block_planes, frames = [], []
    for a in range(0, len(ids), BLOCK):
        streams = block_streams(ids[a : a + BLOCK], planes)
        block_planes.append(len(streams))
        frames += [compressor.compress(s) for s in streams]
    return block_planes, [len(f) for f in frames], b"".join(frames)


def read_block(chunk, k: int, data: bytes | None = None) -> np.ndarray:
    """The ids of block k of a chunk row: only the frames of that block are looked at."""
    first = sum(chunk["block_planes"][:k])
    sizes = chunk["plane_bytes"][first : first + chunk["block_planes"][k]]
    at = sum(chunk["plane_bytes"][:first])
    data = chunk["data"] if data is None else data
    unpack, streams = zstandard.ZstdDecompressor(), []
    for size in sizes:
        streams.append(unpack.decompress(data[at : at + size]))
        at += size
    return join_streams(streams, min(chunk["block"], chunk["n_ids"] - k * chunk["block"]), chunk["planes"])


class _Writer:
    def __init__(self, shard: int, planes: str):
        self.shard, self.planes, self.chunk, self.start = shard, planes, 0, 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.docs: list[list] = []
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.held = 0

    def add(self, docs: list, ids: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take documents; give the chunks that are full."""
        ends = np.cumsum(lengths)
        first, done = 0, 0
        while first < len(docs):
            last = min(len(docs), int(np.searchsorted(ends, done + CHUNK_IDS - self.held)) + 1)
            upto = int(ends[last - 1])
            self.docs.append(docs[first:last])
            self.ids.append(ids[done:upto])
            self.lengths.append(lengths[first:last])
            self.held += upto - done
            first, done = last, upto
            if self.held >= CHUNK_IDS:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        ids, lengths = np.concatenate(self.ids), np.concatenate(self.lengths)
        docs = [d for x in self.docs for d in x]
        block_planes, plane_bytes, data = write_blocks(ids, self.planes, self.compressor)
        row = {
            "shard": self.shard, "chunk": self.chunk, "first_doc": docs[0], "last_doc": docs[-1], "n_docs": len(docs), "n_ids": len(ids), "shard_start": self.start,
            "block": BLOCK, "planes": self.planes, "block_planes": block_planes, "plane_bytes": plane_bytes, "doc_ids": docs, "lengths": lengths.tolist(), "data": data,
        }
        self.chunk += 1
        self.start += len(ids)
        self.docs, self.ids, self.lengths, self.held = [], [], [], 0
        return pa.RecordBatch.from_pylist([row], schema=_CHUNK)


def _encode(vocabulary: str, end_id: int | None, planes: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(TaskContext.get().partitionId(), planes)
        for batch in batches:
            for a, b, ids, lengths in encoded(batch.column("text"), vocabulary, TEXT_BYTES):
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(lengths), end_id)
                    lengths = lengths + 1
                yield from writer.add(batch.column("doc_id").slice(a, b - a).to_pylist(), ids, lengths)
        if writer.docs:
            yield writer.flush()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = END_ID, planes: str = "bit") -> None:
    """Encode docs(doc_id, text) and write the token files to path."""
    keyed = docs.select("doc_id", "text", F.substring("text", 1, PREFIX).alias("prefix"))
    dealt = keyed.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id", "prefix").sortWithinPartitions("doc_id", "text").drop("prefix")
    dealt.mapInArrow(_encode(vocabulary, end_id, planes), CHUNK_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index alone, with the global start of each chunk."""
    index = spark.read.schema(CHUNK_SCHEMA).parquet(path).select(*INDEX_COLUMNS)
    return index.withColumn("start", F.col("shard_start") + F.coalesce(_shard_start(_shard_starts(index)), F.lit(0)))


def _shard_starts(index: DataFrame) -> dict[int, int]:
    """Ids before each shard: one row a shard, that is a task of the write, comes to the driver."""
    total, starts = 0, {}
    for shard, n in sorted((r["shard"], r["n"]) for r in index.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()):
        starts[shard] = total
        total += n
    return starts


def _shard_start(starts: dict[int, int]):
    if not starts:
        return F.lit(0)
    return F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("shard")).cast("long")


def _decode(starts: dict[int, int], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.concatenate([read_block(row, k) for k in range(len(row["block_planes"]))])
                ends = np.cumsum(row["lengths"])
                base = starts[row["shard"]] + row["shard_start"]
                raw = memoryview(ids.astype("<u4")).cast("B")
                begins = [0, *ends[:-1].tolist()]
                sums = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(begins, ends.tolist())]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(base + np.array(begins, dtype=np.int64)), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.array([0, *ends], dtype=np.int32), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of token files."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    starts = _shard_starts(chunks.select("shard", "n_ids"))
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return chunks.mapInArrow(_decode(starts, with_ids), kind)


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)
