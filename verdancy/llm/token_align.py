"""Alignment of two tokenizers' tokens by the byte offsets at which both end one.

Method.  A whole slice of an Arrow batch is encoded by both tokenizers (A byte
level BPE, B pieces with byte fallback; each distinct unit of text once a worker,
:class:`PairUnits`) and treated as one run of bytes.  The ends of all A tokens and
of all B tokens are counted by one bincount each over the byte offsets; where both
are present the run is cut into groups.  Prefix sums over tokens and groups, cut at
the documents' offsets, give each document its counts.  A *link* is an A-B pair of
token occurrences in one group.

Corpus counts.  How many documents hold an id pair linked is a sum over all
documents.  Slices are joined to *blocks* of about ``BLOCK_BYTES`` of text, and a
block's distinct pairs, each with its number of documents in the block, are what is
shuffled: once to be added up by pair (partial sums in the tasks), once to bring
the sums back to the blocks that ask for them.  The highest count of each A id has
a row an id of vocabulary A, and that size is what makes its broadcast safe; the
sums themselves are joined by shuffles.  A pair that every document holds is one
row a block.

Memory.  Spark's Parquet writer looks at its buffers every 100 rows and its reader
takes 4,096 rows at a time, however long they are.  So no list of a saved row has
more than ``ROW_ENTRIES`` entries: a document with more pairs has several rows, and
so has a block's list of pairs.  They meet again, a block at a time, at the end.

Edge cases.  Null and empty texts, and texts whose tokens of A or of B do not spell
the text with its space before it (B writes U+2581 as a space), have no tokens:
zeros and an empty groups_sha256.  Strings of special tokens are plain text.  Long
groups (one word of many thousand letters) are linked by their distinct ids with
how often each occurs, never token by token.  Rows that repeat a doc_id, or have
none, are documents of their own.  An empty table gives no rows.  Columns other
than doc_id and text are not read, so none can clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .common import Scratch, saved
from .unit_encoder import _MARKS, _WIDE, _ranges

#: Text of one slice, the unit of work in memory, and of a block, the unit in which pairs are counted.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
#: Entries of a saved row's lists, and rows of an Arrow batch. Figures of memory, not of results.
ROW_ENTRIES = 512
BATCH_ROWS = 512
#: Groups of more links than this are linked by their distinct ids.
LONG_GROUP = 4096
#: Bytes of units and ids that a worker keeps; beyond, it forgets those met once. A figure of memory, not of results.
CACHE_BYTES = 160 << 20
UNIT_COST = 220
LONGEST_KEPT = 256
#: Bytes of new units that go to a tokenizer in one text.
JOINED_BYTES = 1 << 16
_CUT = re.compile(r"(?<=\S)(?= )")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_level() -> dict[str, int]:
    """The character that byte-level BPE writes for each byte: printable Latin-1 as itself, the others from U+0100 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Bytes:
    """Tokenizer A: byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = True
        written = _byte_level()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spelt = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.spelt[i] = bytes(written[c] for c in token) if all(c in written for c in token) else token.encode()
        self.opens = np.array([s.startswith(b" ") for s in self.spelt])

    def after_space(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text with a space before it."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def bare(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class _Pieces:
    """Tokenizer B: a sentencepiece model, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.tokenizer.id_to_piece(i) for i in range(self.tokenizer.get_piece_size())]
        self.spelt = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in names]
        self.opens = np.array([s.startswith(b" ") for s in self.spelt])
        self.space = self.tokenizer.piece_to_id("▁")  # the library gives an empty text no space
        # a letter and a mark, or a line end and what is beside it, never share a piece: where a text may be cut
        cut = re.compile("|".join(pattern for pattern, _ in _MARKS))
        self.cuts_at_marks = not any(cut.search(p) for p in names if not p.startswith("<"))
        if any(re.search("[^▁]▁", p) for p in names):
            raise ValueError("a piece of this model goes on after a word: texts cannot be cut at spaces")

    def after_space(self, texts: list[str]) -> list[list[int]]:
        return [ids if t else [self.space] for t, ids in zip(texts, self.tokenizer.encode(texts, num_threads=1))]

    def bare(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text without the space: it is put behind a line end, which shares no piece, and the ids of space and line end go."""
        return [ids[2:] for ids in self.tokenizer.encode(["\n" + t for t in texts], num_threads=1)]


class _Table:
    """The ids of numbered units under one tokenizer."""

    def __init__(self):
        self.ids, self.offsets = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def append(self, ids: list[np.ndarray], lengths: list[np.ndarray]) -> None:
        self.ids = np.concatenate([self.ids, *ids])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(lengths))])

    def keep(self, units: np.ndarray) -> None:
        size = np.diff(self.offsets)
        self.ids = _ranges(self.ids, self.offsets[:-1][units], size[units])
        self.offsets = np.concatenate([[0], np.cumsum(size[units])])

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units one after the other, number of ids of each)."""
        size = np.diff(self.offsets)[units]
        return _ranges(self.ids, self.offsets[:-1][units], size), size


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for x in lists for i in x), np.uint32, int(lengths.sum())), lengths


@dataclass
class Encoded:
    """Tokens of n texts under one tokenizer: all ids in order, and how many are each text's."""

    ids: np.ndarray
    counts: np.ndarray


class PairUnits:
    """Both encodings of texts, each with a space before it, by units that neither tokenizer looks across.

    A unit is named by its text after a space, or by NUL and its text where it
    stands behind a mark.  Texts that hold NUL go to the tokenizers whole.
    """

    def __init__(self, byte_path: str, piece_path: str):
        self.sides = _Bytes(byte_path), _Pieces(piece_path)
        self.marks = _MARKS if self.sides[1].cuts_at_marks else []
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.tables = _Table(), _Table()
        self.uses, self.spelt = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        self.held = 0

    def _trim(self) -> None:
        """Keep the units met twice or more, the most used first, up to half of the bytes."""
        names = list(self.index)
        cost = UNIT_COST + 4 * sum(np.diff(t.offsets) for t in self.tables) + np.fromiter(map(len, names), np.int64, len(names))
        order = np.argsort(-self.uses, kind="stable")
        order = order[(self.uses[order] > 1) & (cost[order] <= UNIT_COST + 9 * LONGEST_KEPT)]
        keep = np.sort(order[np.cumsum(cost[order]) <= CACHE_BYTES // 2])
        for table in self.tables:
            table.keep(keep)
        self.uses, self.spelt = np.ones(len(keep), dtype=np.int64), self.spelt[keep]
        self.index = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.held = int(cost[keep].sum())

    def encode(self, texts: pa.Array) -> tuple[Encoded, Encoded, np.ndarray]:
        """(A, B, whether both spell the text) of a large_string array without nulls and empty texts."""
        n = len(texts)
        holds = lambda found: found.to_numpy(zero_copy_only=False)
        kind = np.where(holds(pc.match_substring(texts, "\0")), 2, holds(pc.match_substring_regex(texts, _WIDE)))  # 0 cut at every space, 1 at some, 2 whole
        if self.held > CACHE_BYTES:
            self._trim()
        plain = np.flatnonzero(kind == 0)
        marked = texts.take(pa.array(plain))
        for pattern, put in self.marks:
            marked = pc.replace_substring_regex(marked, pattern, put)
        found = pc.split_pattern(marked, " ")
        coded = found.flatten().dictionary_encode()
        units = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        counts = np.zeros(n, dtype=np.int64)
        counts[plain] = found.value_lengths().to_numpy(zero_copy_only=False)
        wide = [(k, [u[1:] for u in _CUT.split(" " + texts[k].as_py())]) for k in np.flatnonzero(kind == 1).tolist()]
        if wide:
            counts[[k for k, _ in wide]] = [len(cut) for _, cut in wide]
            of_wide, more, few = np.repeat(kind == 1, counts), self._numbers([u for _, cut in wide for u in cut]), units
            units = np.empty(len(of_wide), dtype=np.int64)
            units[of_wide], units[~of_wide] = more, few
        self.uses += np.bincount(units, minlength=len(self.uses))
        owner = np.repeat(np.arange(n), counts)
        spelt = np.bincount(owner, weights=~self.spelt[units], minlength=n) == 0
        whole = np.flatnonzero(kind == 2).tolist()
        sides = []
        for side, table in zip(self.sides, self.tables):
            ids, size = table.of(units)
            lengths = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
            if whole:
                parts = np.split(ids, np.cumsum(lengths)[:-1])
                for k in whole:
                    text = texts[k].as_py()
                    parts[k] = np.array(side.after_space([text])[0], dtype=np.uint32)
                    lengths[k] = len(parts[k])
                    spelt[k] &= b"".join(side.spelt[i] for i in parts[k]) == b" " + text.encode()
                ids = np.concatenate(parts)
            sides.append(Encoded(ids, lengths))
        return *sides, spelt

    def _numbers(self, names: list[str]) -> np.ndarray:
        index = self.index
        new = [u for u in dict.fromkeys(names) if u not in index]
        if new:
            kinds = [0 if u[:1] == "\0" else 1 if not u or " " in u else 2 for u in new]
            self._append([u for u, k in zip(new, kinds) if k == 0], [s.bare for s in self.sides], 1)
            self._append([u for u, k in zip(new, kinds) if k == 1], [s.after_space for s in self.sides], 0)
            joined = [u for u, k in zip(new, kinds) if k == 2]
            size = np.cumsum([len(u) + 1 for u in joined], dtype=np.int64)
            for a, b in zip(*(lambda cut: (cut[:-1], cut[1:]))([0, *(np.flatnonzero(np.diff(size // JOINED_BYTES)) + 1).tolist(), len(joined)])):
                self._append_joined(joined[a:b])
        return np.fromiter(map(index.__getitem__, names), np.int64, len(names))

    def _append_joined(self, new: list[str]) -> None:
        """Units without spaces go side by side in one text: the ids that begin with a space begin the units."""
        if not new:
            return
        got = []
        for side in self.sides:
            ids = np.array(side.after_space([" ".join(new)])[0], dtype=np.uint32)
            begin = np.flatnonzero(side.opens[ids])
            got.append((ids, np.diff(np.append(begin, len(ids)))))
        if all(len(lengths) == len(new) for _, lengths in got):
            self._take(new, got, 0)
        else:  # a unit holds U+2581, which B writes as a space
            self._append(new, [s.after_space for s in self.sides], 0)

    def _append(self, new: list[str], encode: list, skip: int) -> None:
        if new:
            self._take(new, [_flat(f([u[skip:] for u in new])) for f in encode], skip)

    def _take(self, new: list[str], got: list[tuple[np.ndarray, np.ndarray]], skip: int) -> None:
        n = len(self.index)
        self.index.update(zip(new, range(n, n + len(new))))
        want = [(u[1:] if skip else " " + u).encode() for u in new]
        size = np.fromiter(map(len, want), np.int64, len(want))
        right = np.ones(len(new), dtype=bool)
        for side, table, (ids, lengths) in zip(self.sides, self.tables, got):
            table.append([ids], [lengths])
            words = list(map(side.spelt.__getitem__, ids.tolist()))
            ends = _starts(np.fromiter(map(len, words), np.int64, len(words)))[_starts(lengths)]
            if not (np.diff(ends) == size).all() or b"".join(words) != b"".join(want):  # some unit of these is not spelt
                cut = _starts(lengths).tolist()
                right &= [b"".join(words[x:y]) == w for x, y, w in zip(cut, cut[1:], want)]
        self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])
        self.spelt = np.concatenate([self.spelt, right])
        self.held += UNIT_COST * len(new) + 4 * sum(len(ids) for ids, _ in got) + sum(map(len, new))


@dataclass
class Aligned:
    """Alignment of the documents of a slice; group numbers run on through the slice."""

    n_groups: np.ndarray
    n_links: np.ndarray
    group_a: np.ndarray  # group of each A token
    group_b: np.ndarray
    first_a: np.ndarray  # first A token of each group, and their number at the end
    first_b: np.ndarray


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def align(a: Encoded, b: Encoded, size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Cut one run of bytes, which both spell, where tokens of both end. size_a and size_b are bytes by id."""
    end_a, end_b = np.cumsum(size_a[a.ids]), np.cumsum(size_b[b.ids])
    total = int(end_a[-1]) if len(end_a) else 0
    both = (np.bincount(end_a, minlength=total + 1) > 0) & (np.bincount(end_b, minlength=total + 1) > 0)
    groups = np.cumsum(both)  # groups that end at or before each byte offset
    group_a, group_b = groups[end_a] - both[end_a], groups[end_b] - both[end_b]
    n = int(groups[-1])
    in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    doc_end = np.concatenate([[0], end_a])[_starts(a.counts)]  # byte offsets of the documents
    doc_group = groups[doc_end]
    links = _starts(in_a * in_b)
    return Aligned(np.diff(doc_group), np.diff(links[doc_group]), group_a, group_b, _starts(in_a), _starts(in_b))


def _decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 .. n - 1, right-aligned with a place for a separator, and which places are used."""
    wide = len(str(max(n - 1, 0)))
    numbers = np.arange(n)
    digits = np.empty((n, wide + 1), dtype=np.uint8)
    used = np.ones((n, wide + 1), dtype=bool)
    for k in range(wide):
        power = 10 ** (wide - 1 - k)
        digits[:, k] = numbers // power % 10 + 48
        used[:, k] = (numbers >= power) | (power == 1)
    return digits, used


def group_texts(a: Encoded, b: Encoded, cut: Aligned, decimals: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """For each document a1,a2|b1;a3|b2,b3: the ids of A and of B of its groups in order."""
    digits, used = decimals
    n_a, n_b = len(a.ids), len(b.ids)
    at_a = np.arange(n_a) + cut.first_b[cut.group_a]
    at_b = np.arange(n_b) + cut.first_a[cut.group_b + 1]
    ids = np.empty(n_a + n_b, dtype=np.int64)
    ids[at_a], ids[at_b] = a.ids, b.ids
    mark = np.full(n_a + n_b, ord(","), dtype=np.uint8)
    mark[at_a[cut.first_a[1:] - 1]] = ord("|")
    mark[at_b[cut.first_b[1:] - 1]] = ord(";")
    table = digits[ids]
    table[:, -1] = mark
    seen = used[ids]
    ends = _starts(seen.sum(axis=1))[_starts(a.counts + b.counts)]
    flat = table[seen].tobytes()
    return [flat[x : y - 1] if y > x else b"" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


def link_pairs(a: Encoded, b: Encoded, cut: Aligned, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, times, pairs of each document): the distinct pairs of each document, in order, and their links. bits: of an A and of a B id."""
    shift = bits[0] + bits[1]
    n_docs = len(a.counts)
    doc_a = np.repeat(np.arange(n_docs), a.counts)
    in_a, in_b = np.diff(cut.first_a), np.diff(cut.first_b)
    long = in_a * in_b > LONG_GROUP
    reps = np.where(long[cut.group_a], 0, in_b[cut.group_a])
    of = np.repeat(np.arange(len(a.ids)), reps)
    other = np.arange(len(of)) - np.repeat(np.cumsum(reps) - reps, reps) + cut.first_b[cut.group_a[of]]
    keys = [(doc_a[of] << shift) | (a.ids[of].astype(np.int64) << bits[1]) | b.ids[other].astype(np.int64)]
    keys[0].sort()
    times = []
    new = np.flatnonzero(np.concatenate([[True], keys[0][1:] != keys[0][:-1]])) if len(keys[0]) else np.zeros(0, dtype=np.int64)
    times.append(np.diff(np.append(new, len(keys[0]))))
    keys[0] = keys[0][new]
    for g in np.flatnonzero(long).tolist():
        (x, nx), (y, ny) = (np.unique(s.ids[f[g] : f[g + 1]].astype(np.int64), return_counts=True) for s, f in ((a, cut.first_a), (b, cut.first_b)))
        keys.append(((int(doc_a[cut.first_a[g]]) << shift) + ((x << bits[1])[:, None] | y[None, :])).ravel())
        times.append((nx[:, None] * ny[None, :]).ravel())
    key, many = np.concatenate(keys), np.concatenate(times)
    if len(keys) > 1:
        key, back = np.unique(key, return_inverse=True)
        many = np.bincount(back, weights=many, minlength=len(key)).astype(np.int64)
    return key & ((1 << shift) - 1), many, np.bincount(key >> shift, minlength=n_docs)


_UNITS: dict[tuple[str, str], PairUnits] = {}


def pair_units(byte_path: str, piece_path: str) -> PairUnits:
    """One encoder a worker and pair of vocabularies."""
    if (byte_path, piece_path) not in _UNITS:
        _UNITS[byte_path, piece_path] = PairUnits(byte_path, piece_path)
    return _UNITS[byte_path, piece_path]


def _bits(side: _Bytes | _Pieces) -> int:
    """Of an id of that vocabulary."""
    return max(1, (len(side.spelt) - 1).bit_length())


#: A row holds some pairs of a document (doc: its number in the block, at: the pairs' places in the block's list), or some of the block's list, from a place on.
BLOCK_SCHEMA = (
    "block long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<long>, "
    "place int, pair array<long>, docs array<int>"
)
_PER_DOC = ("n_a", "n_b", "n_groups", "n_links")
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in BLOCK_SCHEMA.split(", "))])


def _cuts(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, entries) of each row, where runs of so many entries are cut into rows of at most that many; an empty run has a row."""
    rows = np.maximum(1, -(-counts // most))
    run = np.repeat(np.arange(len(counts)), rows)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(rows) - rows, rows)
    return run, np.minimum(counts[run] - nth * most, most)


def _rows(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Rows with these columns, the others null, some at a time."""
    n = len(columns["block"])
    whole = pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)
    for k in range(0, n, BATCH_ROWS):
        yield whole.slice(k, BATCH_ROWS)


class _Blocks:
    def __init__(self, byte_path: str, piece_path: str):
        self.units = pair_units(byte_path, piece_path)
        sides = self.units.sides
        self.sizes = [np.array([len(s) for s in side.spelt], dtype=np.int64) for side in sides]
        self.bits = tuple(_bits(side) for side in sides)
        self.decimals = _decimal(max(len(side.spelt) for side in sides))
        self.number, self.bytes, self.parts = TaskContext.get().partitionId() << 33, 0, []

    def add(self, doc_ids: pa.Array, texts: pa.Array) -> None:
        """Align the documents of a slice."""
        n = len(texts)
        found = {k: np.zeros(n, dtype=np.int64) for k in (*_PER_DOC, "n_pairs")}
        sha = [""] * n
        some = np.flatnonzero(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        a, b, spelt = self.units.encode(texts.take(pa.array(some)))
        if not spelt.all():
            a, b = (Encoded(s.ids[np.repeat(spelt, s.counts)], s.counts[spelt]) for s in (a, b))
            some = some[spelt]
        pair = times = np.zeros(0, dtype=np.int64)
        if len(some):
            cut = align(a, b, *self.sizes)
            pair, times, n_pairs = link_pairs(a, b, cut, self.bits)
            for k, v in zip((*_PER_DOC, "n_pairs"), (a.counts, b.counts, cut.n_groups, cut.n_links, n_pairs)):
                found[k][some] = v
            for k, text in zip(some.tolist(), group_texts(a, b, cut, self.decimals)):
                sha[k] = hashlib.sha256(text).hexdigest()
        own, at = np.unique(pair, return_inverse=True)
        self.parts.append((doc_ids.to_pylist(), found, sha, own, at.astype(np.int32), times.astype(np.int32 if not len(times) or times.max() < 1 << 31 else np.int64)))
        self.bytes += int(pc.sum(pc.binary_length(texts)).as_py() or 0)

    def flush(self) -> Iterator[pa.RecordBatch]:
        pairs, back = np.unique(np.concatenate([p[3] for p in self.parts]), return_inverse=True)
        starts = _starts([len(p[3]) for p in self.parts])
        at = np.concatenate([back[s:][p[4]].astype(np.int32) for s, p in zip(starts[:-1], self.parts)])
        joined = lambda k: np.concatenate([p[1][k] for p in self.parts])
        lists = lambda values, sizes, kind: pa.ListArray.from_arrays(pa.array(_starts(sizes), pa.int32()), pa.array(values, kind))
        block = lambda rows: pa.array(np.full(len(rows), self.number), pa.int64())
        doc, sizes = _cuts(joined("n_pairs"), ROW_ENTRIES)
        of_docs = {"block": block(doc), "doc": pa.array(doc, pa.int32()), "doc_id": pa.array([d for p in self.parts for d in p[0]], pa.int64()).take(pa.array(doc))}
        of_docs |= {k: pa.array(joined(k)[doc], pa.int64()) for k in _PER_DOC}
        of_docs["groups_sha256"] = pa.array([s for p in self.parts for s in p[2]], pa.string()).take(pa.array(doc))
        of_docs |= {"at": lists(at, sizes, pa.int32()), "times": lists(np.concatenate([p[5] for p in self.parts]), sizes, pa.int64())}
        run, sizes = _cuts(np.array([len(pairs)]), ROW_ENTRIES)
        of_pairs = {"block": block(run), "place": pa.array(_starts(sizes)[:-1], pa.int32()), "pair": lists(pairs, sizes, pa.int64())}
        of_pairs["docs"] = lists(np.bincount(at, minlength=len(pairs)).astype(np.int32), sizes, pa.int32())
        self.number, self.bytes, self.parts = self.number + 1, 0, []
        yield from _rows(of_docs)
        yield from _rows(of_pairs)


def _blocks(byte_path: str, piece_path: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(byte_path, piece_path)
        for batch in batches:
            texts = T.strings(batch.column("text"))
            for a, b in T.slices(texts, min(SLICE_BYTES, block_bytes)):
                blocks.add(batch.column("doc_id").slice(a, b - a), texts.slice(a, b - a))
                if blocks.bytes >= block_bytes:
                    yield from blocks.flush()
        if blocks.parts:
            yield from blocks.flush()

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _counted(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block from their rows; right has (place in the block's list of pairs, twice the count and 1 if it is its A id's highest)."""
    at, times = (left.column(c).combine_chunks() for c in ("at", "times"))
    ends = _starts(pc.list_value_length(at).to_numpy(zero_copy_only=False))
    at, times = at.flatten().to_numpy(), times.flatten().to_numpy()
    count = np.zeros(right.num_rows, dtype=np.int64)  # a row for each place
    count[right.column("place").to_numpy()] = right.column("count").to_numpy()
    value = count[at]
    _, first, doc = np.unique(left.column("doc").to_numpy(), return_index=True, return_inverse=True)
    found = left.take(pa.array(first))
    row = {c: found.column(c) for c in ("doc_id", *_PER_DOC, "groups_sha256")}
    for name, links in (("n_best", times * (value & 1)), ("count_sum", times * (value >> 1))):
        sums = np.zeros(len(first), dtype=np.int64)
        np.add.at(sums, doc, np.diff(_starts(links)[ends]))
        row[name] = pa.array(sums)
    return pa.table({k: row[k] for k in (f.split()[0] for f in _RESULT.split(", "))})


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each row of docs(doc_id, text) with its tokens, groups, links and what the links count in all of docs."""
    with Scratch(docs.sparkSession) as scratch:
        blocks = scratch.saved(docs.select("doc_id", "text").mapInArrow(_blocks(byte_path, piece_path, block_bytes), BLOCK_SCHEMA), "aligned")
        pairs = blocks.where("place IS NOT NULL").select("block", "place", F.posexplode(F.arrays_zip("pair", "docs")).alias("nth", "p"))
        pairs = pairs.select("block", (F.col("place") + F.col("nth")).alias("place"), "p.pair", "p.docs")
        counts = scratch.saved(pairs.groupBy("pair").agg(F.sum("docs").alias("n")), "pair_counts")
        by_a = F.shiftright("pair", _bits(_Pieces(piece_path)))
        best = counts.groupBy(by_a.alias("a")).agg(F.max("n").alias("most"))  # one row an id of vocabulary A at most
        ranked = counts.withColumn("a", by_a).join(F.broadcast(best), "a").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("count"))
        back = pairs.select("block", "place", "pair").join(ranked, "pair").select(F.col("block").alias("asks"), "place", "count")
        of_docs = blocks.where("doc IS NOT NULL").drop("place", "pair", "docs")
        found = of_docs.groupBy("block").cogroup(back.groupBy("asks")).applyInArrow(_counted, _RESULT)
        return saved(found, "aligned_tokens")


def op11_token_align(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
