"""BPE encoding and decoding by prefix-sharing trie traversal.

The vocabulary's normaliser and splitting pattern are the library's own; the
merges are not.  BPE encodings have a prefix property: a sequence of tokens is
an encoding exactly if each token encodes to itself and each neighbouring pair
is an encoding of its two tokens.  So the encoding of a prefix is the encoding
of a shorter prefix and one *last token*, and only that token is kept for each
trie node.  The distinct words of a chunk form the trie; it is walked depth
first in sorted order, with the states of the current path on a stack, so the
states of a shared prefix are worked out once.  The word-end symbol makes a
word's last character a symbol of its own; it is one more step from the path.

Whether a pair of tokens is its own encoding is found by undoing merges at their
border, the later-made token first: the pair holds unless two parts that met
there had a merge of their own before one of them was merged away from it.

White space only separates words in this vocabulary, and letters and marks are
never one piece, so a text's encoding is that of its units (white-space bounded
strings, cut further between letters and marks) in order; each distinct unit is
encoded once a worker (a cache bounded by bytes).  Units that hold a special
token's string go to the library.

Edge cases.  Null text counts as empty: no ids, hash of the empty text.  Symbols
that the vocabulary lacks are left out, as the library does.  Rows are
independent: order, ties and repeated rows do not matter.  Input columns named
like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import textcore as T
from .common import widened, without

#: Bytes of a worker's cache generation; units not met for a whole generation are forgotten. A figure of memory, not of results.
CACHE_BYTES = 96 << 20
UNIT_COST = 400  # bytes of a kept unit beside its text, ids and tokens
CACHE_PAIRS = 400_000
TEXT_BYTES = 2 << 20
RESULT = ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")

_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
_MARK = r"[!-&(-/:-@\[-`{-~]"  # but for the apostrophe, which begins some pieces
_BORDERS = [f"({_LETTER})({_MARK})", f"({_MARK})({_LETTER})"]
_SPACE = r"[\t-\r ]+"
# the splitting pattern over the characters below U+0100, of which NFC changes none
_PLAIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff0-9\u00b2\u00b3\u00b9\u00bc-\u00be]+")
_OTHER = re.compile("[^\x00-\x84\x86-\x9f\xa1-\xff]")


def byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself where it is printed, else the next from U+0100."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTES = byte_letters()


class TrieBpe:
    """Encodings of words by last-token states over the trie of the words."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], end: str):
        self.vocab, self.end = vocab, end
        self.rank = {tuple(m): k for k, m in enumerate(merges)}
        self.made = {a + b: (k, a, b) for (a, b), k in self.rank.items()}
        self.single = frozenset(t for t in vocab if len(t) == 1)
        self.longest = max(len(t) - (len(end) if t.endswith(end) else 0) for t in vocab)
        self._valid: dict[tuple[str, str], bool] = {}
        self._self: dict[str, bool] = {}

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            stem = token[: -len(self.end)]
            return [*stem[:-1], stem[-1] + self.end]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE: the best-ranked pair, leftmost first, until none is left."""
        symbols = list(symbols)
        while len(symbols) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(symbols, symbols[1:])]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] == len(self.rank):
                break
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def _own(self, token: str) -> bool:
        """Whether a string is a token that its own symbols are encoded as; only tokens of the vocabulary are remembered."""
        if token not in self.vocab:
            return False
        known = self._self[token] = self.merge(self._symbols(token)) == [token]
        return known

    def _pair(self, a: str, b: str) -> bool:
        known = self._valid.get((a, b))
        if known is None:
            if len(self._valid) >= CACHE_PAIRS:
                self._valid.clear()
            known = self._valid[a, b] = self._holds(a, b)
        return known

    def _holds(self, a: str, b: str) -> bool:
        """Whether the symbols of a and of b side by side are encoded as these two tokens, given that each alone is one."""
        symbol = (-1, "", "")
        until = len(self.rank)  # the border's parts have been side by side up to this merge
        while True:
            if self.rank.get((a, b), until) < until:
                return False
            of_a, of_b = self.made.get(a, symbol), self.made.get(b, symbol)
            if of_a[0] > of_b[0]:
                until, a = of_a[0], of_a[2]
            elif of_b[0] >= 0:
                # of equal merges the leftmost, that over the border, comes first
                until, b = of_b[0] + 1, of_b[1]
            else:
                return True

    def _last(self, word: str, n: int, states: list[str], end: str) -> str:
        """The last token of the first n characters (and the end mark): the one candidate that fits its prefix."""
        own, valid = self._self.get, self._valid.get
        # most often the last token of the path grows by the character, or the character stands alone
        grown = n - 1 - len(states[n - 1])
        for start in (grown, n - 1):
            token = word[start:n] + end
            good = own(token)
            if good is None:
                good = self._own(token)
            if good:
                if not start:
                    return token
                before = states[start]
                fits = valid((before, token))
                if fits is None:
                    fits = self._pair(before, token)
                if fits:
                    return token
        for start in (*range(max(0, n - self.longest), grown), *range(grown + 1, n - 1)):
            token = word[start:n] + end
            good = own(token)
            if (self._own(token) if good is None else good) and (not start or self._pair(states[start], token)):
                return token
        raise AssertionError("a symbol of the vocabulary is a token")

    def encode(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word."""
        out: dict[str, list[str]] = {}
        path, states = "", [""]  # states[n]: last token of the first n characters of path
        single, vocab, end, last = self.single, self.vocab, self.end, self._last
        for word in sorted(set(words)):
            size = len(word)
            if not word:
                out[word] = []
                continue
            if not (single.issuperset(word) and word[-1] + end in vocab):
                symbols = [*word[:-1], word[-1] + end]
                out[word] = self.merge([c for c in symbols if c in vocab])
                continue
            shared, most = 0, min(len(path), size - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            for n in range(shared + 1, size):
                states.append(last(word, n, states, ""))
            path = word[:-1]
            token = last(word, size, states, end)
            tokens = [token]
            at = size - len(token) + len(end)
            while at > 0:
                token = states[at]
                tokens.append(token)
                at -= len(token)
            tokens.reverse()
            out[word] = tokens
        return out


class WordTokenizer:
    """The library's pipeline of a word-end BPE file, with merges by TrieBpe."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.vocab: dict[str, int] = model["vocab"]
        self.trie = TrieBpe(self.vocab, merges, model["end_of_word_suffix"])
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.held = 0

    def _pieces(self, unit: str) -> list[str]:
        if not _OTHER.search(unit):
            found = _PLAIN.findall(unit.lower())
            return found if unit.isascii() and unit.isprintable() else [p.encode().decode("latin-1").translate(_BYTES) for p in found]
        text = self.library.normalizer.normalize_str(unit)
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _keep(self, unit: str, value: tuple[int, str, str]) -> None:
        self.cache[unit] = value
        self.held += UNIT_COST + len(unit) + len(value[1]) + len(value[2])

    def learn(self, units: Iterable[str]) -> None:
        """Encode new units: (number of ids, ids as text, tokens as text)."""
        pieces: dict[str, list[str]] = {}
        for unit in units:
            if "<" in unit and any(s in unit for s in self.special):
                got = self.library.encode(unit, add_special_tokens=False)
                self._keep(unit, (len(got.ids), " ".join(map(str, got.ids)), " ".join(got.tokens)))
            else:
                pieces[unit] = [unit.lower()] if unit.isascii() and unit.isalpha() else self._pieces(unit)
        tokens = self.trie.encode({p for x in pieces.values() for p in x})
        vocab = self.vocab
        for unit, parts in pieces.items():
            found = tokens[parts[0]] if len(parts) == 1 else [t for p in parts for t in tokens[p]]
            self._keep(unit, (len(found), " ".join([str(vocab[t]) for t in found]), " ".join(found)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """(number of ids, ids joined by spaces, decoded text) of each text of a large_string array without nulls."""
        whole = pa.array(np.zeros(len(texts), dtype=bool))
        for string in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, string))
        cut = texts
        for border in _BORDERS:
            cut = pc.replace_substring_regex(cut, border, r"\1 \2")
        found = pc.split_pattern_regex(pc.if_else(whole, texts, cut), _SPACE)
        doc = np.repeat(np.arange(len(texts)), found.value_lengths().to_numpy(zero_copy_only=False))
        coded = found.flatten().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        if self.held > CACHE_BYTES:
            self.older, self.cache, self.held = self.cache, {}, 0
        names = coded.dictionary.to_pylist()
        new = []
        for unit in names:
            if unit not in self.cache:
                known = self.older.get(unit)
                new.append(unit) if known is None else self._keep(unit, known)
        self.learn(new)
        count, ids, tokens = zip(*[self.cache[u] for u in names]) if names else ((), (), ())
        number = np.array(count, dtype=np.int64)[at] if names else np.zeros(0, dtype=np.int64)
        some = number > 0  # empty strings and units of other white space have no ids
        places = pa.array(at[some])
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[some], minlength=len(texts)))]).astype(np.int64))
        joined = lambda values: pc.binary_join(pa.LargeListArray.from_arrays(offsets, pa.array(values, pa.large_string()).take(places)), pa.scalar(" ", pa.large_string()))
        return np.bincount(doc, weights=number, minlength=len(texts)).astype(np.int64), joined(ids), joined(tokens)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _sha(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string())


def _encode(path: str, fields: list[str], full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            texts = T.strings(batch.column("text"))
            for a, b in T.slices(texts, TEXT_BYTES):
                counts, ids, decoded = tokenizer.encode(texts.slice(a, b - a))
                columns = [batch.column(f).slice(a, b - a) for f in fields]
                columns += [pa.array(counts), _sha(ids), _sha(decoded)]
                if full:
                    columns += [pa.array([[int(i) for i in x.split()] for x in ids.to_pylist()], pa.list_(pa.int32())), decoded.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *RESULT[: 5 if full else 3]])

    return run


def trie_bpe(docs: DataFrame, path: str, full: bool = True) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256 and, if full, ids and decoded."""
    docs = without(docs, RESULT)
    kinds = ["long", "string", "string", "array<int>", "string"]
    return docs.mapInArrow(_encode(path, docs.columns, full), widened(docs, list(zip(RESULT, kinds))[: 5 if full else 3]))


def op8_trie_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return trie_bpe(docs, public_tokenizers.path("word_bpe_49k.json"), full=False).drop("text")
