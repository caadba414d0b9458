"""Language identification of mixed-language text.

Script ranges narrow the candidates of each word to the languages that use its
script in the training rows; character trigrams and whole words (hashed,
add-one smoothed) score the word in each candidate; Viterbi with a switching
penalty labels the words, and runs of one label are the spans.  A text's
language is the one with most letters; its score is the share of the text's
letters that are labelled so in a script which the language uses.

Long texts.  Documents are labelled side by side, word by word.  One of more
than ``SEGMENT`` words is cut into segments that are labelled side by side too:
first each segment's best values from every state to every state, then the path
over the segments, then the words of every segment between its two known states.

Training is on the text and non-null language of rows given as training rows,
at most about ``MAX_TRAIN_DOCS`` of them, drawn by a hash of the id: the bound
is a parameter.  Prediction reads the text alone.

Edge cases.  Null text or text without a letter: ``und``, score 0, no spans.
Ties go to the first language in alphabetical order.  A script that no language
uses scores every language alike and adds nothing to a text's score, so a text
in such scripts alone has the first language and score 0.  Without training rows
all is ``und``.  Repeated rows have equal results.  Input columns named like a
result column are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .common import remainder, widened, without

MAX_TRAIN_DOCS = 20_000
BITS = 16
PENALTY = 12.0
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
CHUNK_BYTES = 1 << 20
SEGMENT = 1024  # words
TRANSFER = 1 << 21  # numbers of the segments' values that are held at once
RESULT = ("lang_pred", "score", "known_share", "spans")
SPANS = "array<struct<start:int,end:int,lang:string>>"

#: First code points of script ranges (Unicode blocks), and their script.
SCRIPTS = (
    (0x0000, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})

_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        kind = np.zeros(0x110000, dtype=np.uint8)  # 1 letter, 2 mark
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            category = unicodedata.category(chr(c))[0]
            if category == "L":
                kind[c] = 1
                small = chr(c).lower()
                if len(small) == 1:
                    lower[c] = ord(small)
            elif category == "M":
                kind[c] = 2
        starts = np.array([s for s, _ in SCRIPTS])
        names = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], dtype=np.uint8)
        script = names[np.searchsorted(starts, np.arange(0x110000), side="right") - 1]
        _TABLES.update(kind=kind, lower=lower, script=script)
    return _TABLES


@dataclass
class Letters:
    """Words (runs of letters and marks) of a run of documents."""

    start: np.ndarray  # first code point of each word, in the joined text
    end: np.ndarray
    doc: np.ndarray
    base: np.ndarray  # where each document begins in the joined text
    grams: np.ndarray  # hashed trigram of each letter
    gram_word: np.ndarray  # offset of each word's first trigram
    word: np.ndarray  # hash of each word
    script: np.ndarray
    n_letters: np.ndarray


def letters(texts: list[str]) -> Letters:
    t = _tables()
    joined = "\n" + "\n".join(texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    kind = t["kind"][code]
    inside = kind > 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    z = np.where(inside, t["lower"][code], 0).astype(np.uint64)
    is_letter = np.concatenate([[0], np.cumsum(kind == 1)])
    n_letters = is_letter[end] - is_letter[start]
    real = n_letters > 0
    start, end, n_letters = start[real], end[real], n_letters[real]
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(start - first, size)
    a, b, c = z[at - 1], z[at], z[at + 1]
    grams = (T.mix((a << np.uint64(42)) ^ (b << np.uint64(21)) ^ c) >> np.uint64(64 - BITS)).astype(np.int32)
    position = (np.arange(len(at)) - np.repeat(first, size)).astype(np.uint64)
    word = np.add.reduceat(T.mix(b * np.uint64(0x9E3779B97F4A7C15) + position), first) if len(first) else np.zeros(0, np.uint64)
    word = (T.mix(word) >> np.uint64(64 - BITS)).astype(np.int32)
    doc = np.searchsorted(base, start, side="right") - 1
    return Letters(start, end, doc, base, grams, first, word, t["script"][code[start]], n_letters)


@dataclass
class LanguageModel:
    langs: list[str]
    grams: np.ndarray  # 2**BITS x langs, log probabilities
    words: np.ndarray
    allowed: np.ndarray  # scripts x langs

    def word_scores(self, x: Letters) -> np.ndarray:
        scores = self.words[x.word].astype(np.float32)
        if len(x.gram_word):
            scores += np.add.reduceat(self.grams[x.grams], x.gram_word, axis=0)
        allowed = self.allowed[x.script]
        known = allowed.any(axis=1)
        scores[~known] = 0
        scores[known[:, None] & ~allowed] = -1e6
        return scores

    def known(self, x: Letters) -> np.ndarray:
        """The words whose script some language uses."""
        return self.allowed[x.script].any(axis=1) if len(x.script) else np.zeros(0, dtype=bool)

    def label(self, x: Letters, n_docs: int) -> np.ndarray:
        """The language index of each word."""
        scores = self.word_scores(x)
        count = np.bincount(x.doc, minlength=n_docs)
        begin = np.cumsum(count) - count
        out = np.zeros(len(scores), dtype=np.int32)
        # runs: short documents whole, with any state ahead and at the end, and the segments of long ones
        short = np.flatnonzero((count > 0) & (count <= SEGMENT))
        free = np.full(len(short), -1, dtype=np.int32)
        runs = [(begin[short], count[short], free, free)]
        long = np.flatnonzero(count > SEGMENT)
        if len(long):
            runs.append(_segments(scores, begin[long], count[long]))
        _viterbi(scores, *(np.concatenate(x) for x in zip(*runs)), out)
        return out


def _viterbi(scores: np.ndarray, begin: np.ndarray, count: np.ndarray, before: np.ndarray, last: np.ndarray, out: np.ndarray) -> None:
    """Label runs of words side by side, the longest first; before holds the state ahead of a run, last the one that ends it, -1 any."""
    if not len(begin):
        return
    order = np.argsort(-count, kind="stable")
    begin, count, before, last = begin[order], count[order], before[order, None], last[order]
    n_langs = scores.shape[1]
    steps = int(count[0])
    active = np.searchsorted(-count, -np.arange(steps), side="left")  # runs of more than t words
    jump = np.empty(len(scores), dtype=np.int32)  # state before a switch into a word
    stay = np.empty((len(scores), n_langs), dtype=bool)
    value = scores[begin] - np.where((before < 0) | (before == np.arange(n_langs)), 0, PENALTY).astype(scores.dtype)
    final = np.empty((len(order), n_langs), dtype=scores.dtype)
    for t in range(1, steps):
        k = active[t]
        if k < len(value):
            final[k : len(value)] = value[k:]
            value = value[:k]
        at = begin[:k] + t
        top = value.argmax(axis=1)
        switch = value[np.arange(k), top][:, None] - PENALTY
        keep = value >= switch
        jump[at], stay[at] = top, keep
        value = np.where(keep, value, switch) + scores[at]
    final[: len(value)] = value
    out[begin + count - 1] = np.where(last < 0, final.argmax(axis=1), last)
    for t in range(steps - 1, 0, -1):
        at = begin[: active[t]] + t
        now = out[at]
        out[at - 1] = np.where(stay[at, now], now, jump[at])


def _segments(scores: np.ndarray, begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, words, state ahead, state at the end) of the segments of long documents, on each document's best path."""
    n_langs = scores.shape[1]
    of = np.repeat(np.arange(len(begin)), -(-count // SEGMENT))
    first = np.searchsorted(of, np.arange(len(begin) + 1))
    at = (np.arange(len(of)) - first[of]) * SEGMENT
    starts, sizes = begin[of] + at, np.minimum(SEGMENT, count[of] - at)
    come = np.empty((len(of), n_langs), dtype=np.int32)
    final = np.empty((len(begin), n_langs))
    value = np.zeros(n_langs)
    held = max(1, TRANSFER // n_langs**2)
    for a in range(0, len(of), held):
        best = _transfers(scores, starts[a : a + held], sizes[a : a + held])
        for k in range(a, min(a + held, len(of))):
            if k == first[of[k]]:
                value = np.zeros(n_langs)  # ahead of the first word any state is free
            total = value[:, None] + best[k - a]
            come[k] = total.argmax(axis=0)
            value = total.max(axis=0)
            final[of[k]] = value
    before, last = np.empty(len(of), dtype=np.int32), np.empty(len(of), dtype=np.int32)
    for k in range(len(of) - 1, -1, -1):
        last[k] = final[of[k]].argmax() if k + 1 == first[of[k] + 1] else before[k + 1]
        before[k] = come[k, last[k]]
    return starts, sizes, before, last


def _transfers(scores: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """[s, i, j]: the greatest value of segment s from state i ahead of it to state j at its end."""
    order = np.argsort(-count, kind="stable")
    active = np.searchsorted(-count[order], -np.arange(int(count.max())), side="left")
    best = scores[begin[order]][:, None, :].astype(np.float64) - PENALTY * (1 - np.eye(scores.shape[1]))
    for t in range(1, len(active)):
        k = active[t]
        now = best[:k]
        np.maximum(now, now.max(axis=2, keepdims=True) - PENALTY, out=now)
        now += scores[begin[order[:k]] + t][:, None, :]
    out = np.empty_like(best)
    out[order] = best
    return out


def _collect_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        texts = T.strings(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for a, b in T.slices(texts, CHUNK_BYTES):
            x = letters(texts.slice(a, b - a).to_pylist())
            gram_doc = np.repeat(x.doc, np.diff(np.append(x.gram_word, len(x.grams))))
            for lang in sorted(set(langs[a:b])):
                rows = langs[a:b] == lang
                got = found.setdefault(lang, [np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(len(SCRIPT_NAMES))])
                mine = rows[x.doc] if len(x.doc) else np.zeros(0, dtype=bool)
                got[0] += np.bincount(x.grams[rows[gram_doc]] if len(gram_doc) else [], minlength=1 << BITS)
                got[1] += np.bincount(x.word[mine], minlength=1 << BITS)
                got[2] += np.bincount(x.script[mine], minlength=len(SCRIPT_NAMES))
    for lang, counts in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang]), *[pa.array([c.astype("<f4").tobytes()], pa.binary()) for c in counts]], names=["lang", "grams", "words", "scripts"])


def train(rows: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> LanguageModel:
    """Learn from rows(doc_id, text, lang); no more than about max_docs are drawn."""
    rows = rows.select("doc_id", "text", "lang").where("text is not null and lang is not null and doc_id is not null")
    rate = min(1.0, max_docs / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_000)) < int(rate * 1_000_000))
    parts = drawn.repartition(8).mapInArrow(_collect_counts, "lang string, grams binary, words binary, scripts binary").collect()
    langs = sorted({p["lang"] for p in parts})

    def total(name: str) -> np.ndarray:
        size = len(SCRIPT_NAMES) if name == "scripts" else 1 << BITS
        out = np.zeros((size, len(langs)))
        for p in parts:
            out[:, langs.index(p["lang"])] += np.frombuffer(p[name], dtype="<f4")
        return out

    def logs(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(counts))).astype(np.float32)

    scripts = total("scripts")
    return LanguageModel(langs, logs(total("grams")), logs(total("words")), scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0)))


def _runs(x: Letters, label: np.ndarray, langs: list[str], n_docs: int) -> tuple[list[list[dict]], np.ndarray]:
    new = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (x.doc[1:] != x.doc[:-1])]) if len(label) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(label)) - 1
    spans: list[list[dict]] = [[] for _ in range(n_docs)]
    for a, b in zip(new.tolist(), last.tolist()):
        d = int(x.doc[a])
        spans[d].append({"start": int(x.start[a] - x.base[d]), "end": int(x.end[b] - x.base[d]), "lang": langs[label[a]]})
    return spans


def _predict(model, fields: list[str], with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = model.value
        n_langs = max(1, len(m.langs))
        names = np.array([*m.langs, UNDETERMINED], dtype=object)
        for batch in batches:
            texts = T.strings(batch.column("text"))
            for a, b in T.slices(texts, CHUNK_BYTES):
                n = b - a
                x = letters(texts.slice(a, n).to_pylist())
                label = m.label(x, n) if m.langs else np.zeros(len(x.doc), np.int32)
                known = m.known(x) if m.langs else np.zeros(len(x.doc), dtype=bool)
                share = np.bincount(x.doc * n_langs + label, weights=x.n_letters, minlength=n * n_langs).reshape(n, n_langs)
                sure = np.bincount(x.doc * n_langs + label, weights=x.n_letters * known, minlength=n * n_langs).reshape(n, n_langs)
                total = share.sum(axis=1)
                # by letters in a known script, of texts that have such, else by all
                top = np.where(sure.any(axis=1), sure.argmax(axis=1), share.argmax(axis=1))
                best = np.where((total > 0) & bool(m.langs), top, len(m.langs))
                score = np.where(best < len(m.langs), sure.max(axis=1) / np.maximum(total, 1), 0.0)
                extra = [pa.array(sure.sum(axis=1) / np.maximum(total, 1))]
                columns = [batch.column(f).slice(a, n) for f in fields] + [pa.array(names[best], pa.string()), pa.array(score)] + extra
                if with_spans:
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                    columns.append(pa.array(_runs(x, label, m.langs, n) if m.langs else [[]] * n, kind))
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *RESULT[: 4 if with_spans else 3]])

    return run


def identify(docs: DataFrame, model: LanguageModel, with_spans: bool = True) -> DataFrame:
    """docs with lang_pred, score, known_share (of the letters, those in a script that some language uses) and, if asked for,
    the labelled spans in code points."""
    docs = without(docs, RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared, docs.columns, with_spans), widened(docs, list(zip(RESULT, ["string", "double", "double", SPANS]))[: 4 if with_spans else 3]))


def held_out() -> Column:
    return F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(remainder("doc_id", 4) != 2))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model, with_spans=False).drop("text", "known_share")
