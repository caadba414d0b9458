"""Quality classifier by gated-attention multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words.  Every passage becomes
numbers (byte classes, word statistics, a hashed byte-bigram histogram, and the
text's repeated-word share and length), an encoder maps them to a hidden
vector, gated attention weighs the passages, and a logistic output scores the
weighted sum.  Encoder, attention and output are learned together from document
labels by Adam; no passage is labelled.

Training is on at most about ``MAX_TRAIN_DOCS`` labelled documents of up to
``TRAIN_CHARS`` characters, drawn by a hash of the id; both bounds are documented
parameters of the fit, so what comes to the driver is bounded in bytes.  Every
text is scored whole, and a score reads that text alone.

Edge cases.  Null and empty texts are one passage of zeros and get that score.
Repeated rows get equal scores.  Repeated label rows of a document count once
(the smallest label); null labels do not count.  Without training rows every
score is 0.5.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .common import remainder, widened, without
from .quality_rules import base_counts

PASSAGE = 64
BIGRAMS = 32
MAX_TRAIN_DOCS = 4000
TRAIN_CHARS = 65_536
THRESHOLD = 0.3
HIDDEN, GATE = 24, 16
EPOCHS, BAGS, RATE, DECAY = 24, 64, 0.01, 1e-4
CHUNK_BYTES = (1 << 20) - 1
RESULT = ("score", "predicted", "attention")

_CLASSES = np.zeros(256, dtype=np.uint8)
for _k, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-?", b"!", b"#*$%&|<>=_~^{}[]\\/@+`", b"\n", bytes(range(0xC0, 256)))):
    _CLASSES[list(_set)] = _k + 1
N_CLASSES = 9
N_FEATURES = N_CLASSES + 5 + BIGRAMS + 2


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, offset of each document's first passage)."""
    w = T.words(texts)
    counts = w.counts()
    n_pass = np.maximum(1, -(-counts // PASSAGE))
    first = np.cumsum(n_pass) - n_pass
    total = int(n_pass.sum())
    doc_of = np.repeat(np.arange(w.n_docs), n_pass)
    begin_word = np.minimum(w.doc_word[doc_of] + (np.arange(total) - first[doc_of]) * PASSAGE, w.doc_word[doc_of + 1])
    n_words = np.minimum(w.doc_word[doc_of + 1] - begin_word, PASSAGE).astype(np.float32)
    at_first = np.arange(total) == first[doc_of]
    if len(w.start):
        begin_byte = np.where(at_first | (n_words == 0), w.doc_byte[doc_of], w.start[np.minimum(begin_word, len(w.start) - 1)])
    else:
        begin_byte = w.doc_byte[doc_of]
    of_byte = np.repeat(np.arange(total), np.diff(np.append(begin_byte, len(w.data))))
    size = np.maximum(np.bincount(of_byte, minlength=total), 1)[:, None]
    classes = np.bincount(of_byte * N_CLASSES + _CLASSES[w.data], minlength=total * N_CLASSES).reshape(total, N_CLASSES) / size
    pair = (w.data[:-1].astype(np.uint32) * 31 + w.data[1:].astype(np.uint32) * 17) % BIGRAMS if len(w.data) > 1 else np.zeros(0, np.uint32)
    inside = np.ones(len(pair), dtype=bool)  # no pair over the border of two documents
    border = w.doc_byte[(w.doc_byte > 0) & (w.doc_byte < len(w.data))]
    inside[border - 1] = False
    bigrams = np.bincount((of_byte[:-1] * BIGRAMS + pair)[inside], minlength=total * BIGRAMS).reshape(total, BIGRAMS) / size if len(pair) else np.zeros((total, BIGRAMS))
    of_word = np.repeat(np.arange(total), n_words.astype(np.int64))
    length = (w.end - w.start).astype(np.float64)
    many = np.maximum(n_words, 1)
    mean = np.bincount(of_word, weights=length, minlength=total) / many
    square = np.bincount(of_word, weights=length**2, minlength=total) / many
    h = T.word_hashes(w)
    keys = T.mix(h ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1]) + 1
    again = np.bincount(of_word[order[same]], minlength=total) / many
    last = w.data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    symbol_end = np.bincount(of_word, weights=(_CLASSES[last] == 6) | (_CLASSES[last] == 5), minlength=total) / many
    base = base_counts(w)
    repeat = (base["n_repeat_words"] / np.maximum(counts, 1))[doc_of]
    size_doc = np.log1p(counts)[doc_of]
    features = np.column_stack([classes, mean, np.sqrt(np.maximum(square - mean**2, 0)), again, symbol_end, n_words / PASSAGE, bigrams, repeat, size_doc]).astype(np.float32)
    return features, first


@dataclass
class MilModel:
    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.parts
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        raw = (v * u) @ p["a"]
        sizes = np.diff(np.append(first, len(x)))
        e = np.exp(raw - np.repeat(np.maximum.reduceat(raw, first), sizes))
        weight = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["o"] + p["c"], -30, 30)))
        return {"h": h, "v": v, "u": u, "weight": weight, "z": z, "score": score, "sizes": sizes}

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.parts, self.forward(x, first)
        d_out = (f["score"] - y) / len(y)
        d_z = np.repeat(d_out[:, None] * p["o"], f["sizes"], axis=0)
        d_weight = (d_z * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(d_weight * f["weight"], first), f["sizes"])
        d_raw = f["weight"] * (d_weight - mean)
        d_v = d_raw[:, None] * p["a"] * f["u"] * (1 - f["v"] ** 2)
        d_u = d_raw[:, None] * p["a"] * f["v"] * f["u"] * (1 - f["u"])
        d_h = f["weight"][:, None] * d_z + d_v @ p["v"].T + d_u @ p["u"].T
        d_pre = d_h * (1 - f["h"] ** 2)
        return {"w": x.T @ d_pre, "b": d_pre.sum(axis=0), "v": f["h"].T @ d_v, "u": f["h"].T @ d_u, "a": (f["v"] * f["u"]).T @ d_raw, "o": f["z"].T @ d_out, "c": d_out.sum()}

    def score(self, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = self.forward(((features - self.mean) / self.scale).clip(-8, 8), first)
        return got["score"], got["weight"]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> MilModel:
    """Learn from bags of passage features and their 0/1 labels, by minibatch Adam."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    scale = every.std(axis=0)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    parts = {"w": draw(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": draw(HIDDEN, GATE), "u": draw(HIDDEN, GATE), "a": draw(GATE), "o": draw(HIDDEN), "c": np.float64(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))}
    model = MilModel(every.mean(axis=0), np.where(scale > 1e-6, scale, 1).astype(np.float32), parts)
    ready = [((b - model.mean) / model.scale).clip(-8, 8) for b in bags]
    m = {k: np.zeros_like(v) for k, v in parts.items()}
    s = {k: np.zeros_like(v) for k, v in parts.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(ready))
        for k in range(0, len(order), BAGS):
            pick = order[k : k + BAGS]
            sizes = np.array([len(ready[i]) for i in pick])
            grad = model.gradient(np.concatenate([ready[i] for i in pick]), np.cumsum(sizes) - sizes, labels[pick])
            step += 1
            for name, g in grad.items():
                g = g + DECAY * parts[name]
                m[name] = 0.9 * m[name] + 0.1 * g
                s[name] = 0.999 * s[name] + 0.001 * g * g
                parts[name] = parts[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.999**step)) + 1e-8)
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = T.strings(batch.column("text"))
        for a, b in T.slices(texts, CHUNK_BYTES):
            features, first = passages(texts.slice(a, b - a))
            bags = [x.astype("<f4").tobytes() for x in np.split(features, first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> MilModel | None:
    """Learn from docs(doc_id, text) and labels(doc_id, label)."""
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    rate = min(1.0, max_docs / max(1, labels.count()))
    drawn = labels.where(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) < int(rate * 1_000_000))
    # about max_docs rows of two numbers: bounded whatever the size of the corpus
    short = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= TRAIN_CHARS)
    joined = short.join(F.broadcast(drawn), "doc_id")
    rows = sorted(joined.mapInArrow(_bags, "doc_id long, label int, bag binary").collect(), key=lambda r: (r["doc_id"], r["bag"]))
    if not rows:
        return None
    return fit([np.frombuffer(r["bag"], dtype="<f4").reshape(-1, N_FEATURES) for r in rows], np.array([r["label"] for r in rows], dtype=np.float64))


def _score(shared, fields: list[str], attention: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: MilModel | None = shared.value
        for batch in batches:
            texts = T.strings(batch.column("text"))
            for a, b in T.slices(texts, CHUNK_BYTES):
                features, first = passages(texts.slice(a, b - a))
                score, weight = model.score(features, first) if model else (np.full(b - a, 0.5), np.ones(len(features)))
                columns = [batch.column(f).slice(a, b - a) for f in fields] + [pa.array(score.astype(np.float64)), pa.array((score >= THRESHOLD).astype(np.int32))]
                if attention:
                    columns.append(pa.ListArray.from_arrays(np.append(first, len(features)).astype(np.int32), pa.array(weight.astype(np.float64))))
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *RESULT[: 3 if attention else 2]])

    return run


def score(docs: DataFrame, model: MilModel | None, attention: bool = True) -> DataFrame:
    """docs with score, predicted and, if asked for, the attention weight of each passage."""
    docs = without(docs, RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score(shared, docs.columns, attention), widened(docs, list(zip(RESULT, ["double", "int", "array<double>"]))[: 3 if attention else 2]))


def op7_mil_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = train(docs, labels.where(remainder("doc_id", 5) != 0))
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return score(docs.select("doc_id", held, "text"), model, attention=False).drop("text")
