"""Byte-level BPE with the tokenizers library, each distinct unit of text encoded once a worker.

A text is cut before every space that a non-space follows, between a letter and
a mark, and between a lone newline and a letter.  The library's own splitting
pattern always begins a new piece there (a white-space run gives up exactly its
last space to the word), so the ids of a text are the ids of its units in order.
Units are found and numbered in Arrow.  New ones that begin with a space go to
the library side by side in one text: as a unit's one space is its first byte,
the ids that stand for a space begin the units.  Texts that hold a special
token's string go to the library whole, as such a string can take neighbouring
white space out of its context.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import textcore as T

_CUT = re.compile(r" (?=\S)")
# texts with a space that no word follows: Python's white space, spelt out for Arrow
_WIDE = r"^ | $| [\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
# a letter and a mark that ends its word (the apostrophe may not), or a line end and the letter after it
_MARKS = [(f"({_LETTER})" + r"([!-&(-/:-@\[-`{-~\n])", "\\1 \0\\2"), (r"([!-~]\n)" + f"({_LETTER})", "\\1 \0\\2")]
#: Bytes of units and ids that a worker keeps; beyond, it forgets the rarer ones. A figure of memory, not of results.
CACHE_BYTES = 96 << 20
UNIT_COST = 200  # bytes of a kept unit beside its text and ids
#: Longer units (texts without spaces) are encoded when met and not kept.
LONGEST_KEPT = 256


class UnitEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids whose first byte is a space
        self.spaced[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.offsets = np.zeros(1, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)
        self.held = 0

    def _trim(self) -> None:
        """Keep the long-lived units met twice or more, the most used first, up to half of the bytes."""
        names = list(self.index)  # in the order of their numbers
        size = np.diff(self.offsets)
        cost = UNIT_COST + 4 * size + np.fromiter(map(len, names), np.int64, len(names))
        order = np.argsort(-self.uses, kind="stable")
        order = order[(self.uses[order] > 1) & (cost[order] <= UNIT_COST + 5 * LONGEST_KEPT)]
        keep = np.sort(order[np.cumsum(cost[order]) <= CACHE_BYTES // 2])
        self.ids = _ranges(self.ids, self.offsets[:-1][keep], size[keep])
        self.offsets = np.concatenate([[0], np.cumsum(size[keep])])
        self.uses = np.ones(len(keep), dtype=np.int64)
        self.index = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.held = int(cost[keep].sum())

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text) of a large_string array without nulls."""
        n = len(texts)
        holds = lambda found: found.to_numpy(zero_copy_only=False)
        whole = np.zeros(n, dtype=bool)
        for string in (*self.special, "\0"):
            whole |= holds(pc.match_substring(texts, string))
        kind = np.where(whole, 2, holds(pc.match_substring_regex(texts, _WIDE)))  # 0 cut at every space, 1 at some, 2 whole
        if self.held > CACHE_BYTES:
            self._trim()
        plain = np.flatnonzero(kind == 0)
        marked = texts.take(pa.array(plain))
        for pattern, put in _MARKS:
            marked = pc.replace_substring_regex(marked, pattern, put)
        found = pc.split_pattern(marked, " ")
        words = found.flatten()
        count = found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(count) - count
        rest = np.ones(len(words), dtype=bool)
        rest[first] = False
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        used = np.zeros(len(coded.dictionary), dtype=bool)
        used[at[rest]] = True
        names = coded.dictionary.filter(pa.array(used)).to_pylist()
        number = np.zeros(len(used), dtype=np.int64)
        number[used] = self._numbers(names)
        units = number[at]
        units[first] = self._numbers([" " + head for head in words.take(pa.array(first)).to_pylist()])
        counts = np.zeros(n, dtype=np.int64)
        counts[plain] = count
        wide = [(k, _CUT.split(texts[k].as_py())) for k in np.flatnonzero(kind == 1).tolist()]
        if wide:
            more = self._numbers([u for _, cut in wide for u in (" " + cut[0], *cut[1:])])
            counts[[k for k, _ in wide]] = [len(cut) for _, cut in wide]
            units = self._merged(units, more, kind, counts)
        self.uses += np.bincount(units, minlength=len(self.uses))
        size = np.diff(self.offsets)[units]
        flat = _ranges(self.ids, self.offsets[:-1][units], size)
        ends = np.concatenate([[0], np.cumsum(size)])
        last = np.cumsum(counts)
        lengths = ends[last] - ends[last - counts]
        whole = np.flatnonzero(kind == 2).tolist()
        if whole:
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            for k, ids in zip(whole, self._encode([texts[k].as_py() for k in whole])):
                parts[k] = np.array(ids, dtype=np.uint32)
                lengths[k] = len(ids)
            flat = np.concatenate(parts)
        return flat, lengths

    @staticmethod
    def _merged(units: np.ndarray, more: np.ndarray, kind: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The unit numbers of both kinds of text, in the order of the texts."""
        of_wide = np.repeat(kind == 1, counts)
        out = np.empty(len(of_wide), dtype=np.int64)
        out[of_wide] = more
        out[~of_wide] = units
        return out

    def _numbers(self, names: list[str]) -> np.ndarray:
        """The number of each unit; new ones are encoded first.

        A unit follows a space, but for one named with a space before it (the start of a text) or with a NUL (after a mark).
        """
        index = self.index
        new = [u for u in dict.fromkeys(names) if u not in index]
        if new:
            heads = [u for u in new if u[:1] in (" ", "\0")]
            self._add(heads, self._encode([u[1:] for u in heads]))
            wide = [u for u in new if " " in u[1:] and u[0] != " "]
            self._add(wide, self._encode([" " + u for u in wide]))
            self._add_joined([u for u in new if " " not in u and u[0] != "\0"])
        return np.fromiter(map(index.__getitem__, names), np.int64, len(names))

    def _add_joined(self, new: list[str]) -> None:
        if not new:
            return
        ids = np.array(self._encode([" " + " ".join(new)])[0], dtype=np.uint32)
        begin = np.flatnonzero(self.spaced[ids])
        if len(begin) != len(new):  # not expected: a unit's space is its first byte
            self._add(new, self._encode([" " + u for u in new]))
            return
        self._append(new, ids, np.diff(np.append(begin, len(ids))))

    def _add(self, new: list[str], got: list[list[int]]) -> None:
        if new:
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            self._append(new, np.fromiter((i for x in got for i in x), np.uint32, int(lengths.sum())), lengths)

    def _append(self, new: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.offsets) - 1
        self.index.update(zip(new, range(n, n + len(new))))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        self.held += UNIT_COST * len(new) + 4 * len(ids) + sum(map(len, new))


def _ranges(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[s : s + n] of every start and size, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder a worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def encoded(texts: pa.Array, path: str, max_bytes: int):
    """(first row, end row, ids, lengths) of slices of about max_bytes of a text column; null is the empty text."""
    texts = T.strings(texts)
    tokens = encoder(path)
    for a, b in T.slices(texts, max_bytes):
        yield a, b, *tokens.encode(texts.slice(a, b - a))
