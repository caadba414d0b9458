"""The quality classifier against plain loops, its edges, and the compression bands by hand."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from verdancy.llm import mil_quality as M
from verdancy.llm import quality_rules as Q

WORDS = "the of and to in that was with for this erble anre thin reed onshen from hand".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".", "!"]) for _ in range(n))


def score_by_loops(model, bag):
    p = model.parts
    hidden, raw = [], []
    for x in bag:
        x = [max(-8.0, min(8.0, float((v - m) / s))) for v, m, s in zip(x, model.mean, model.scale)]
        h = [math.tanh(sum(a * b for a, b in zip(x, p["w"][:, k])) + p["b"][k]) for k in range(M.HIDDEN)]
        v = [math.tanh(sum(a * b for a, b in zip(h, p["v"][:, k]))) for k in range(M.GATE)]
        u = [1 / (1 + math.exp(-sum(a * b for a, b in zip(h, p["u"][:, k])))) for k in range(M.GATE)]
        hidden.append(h)
        raw.append(sum(a * b * c for a, b, c in zip(v, u, p["a"])))
    weight = [math.exp(r) for r in raw]
    weight = [w / sum(weight) for w in weight]
    z = [sum(w * h[k] for w, h in zip(weight, hidden)) for k in range(M.HIDDEN)]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, p["o"])) + float(p["c"])))), weight


def test_scores_and_attention_are_those_of_plain_loops():
    rng = random.Random(1)
    docs = [text(rng, rng.choice([0, 1, 63, 64, 65, 200])) if k % 3 else "### $$ " * rng.randint(1, 90) for k in range(40)]
    features, first = M.passages(pa.array(docs, pa.large_string()))
    bags = np.split(features, first[1:])
    model = M.fit(bags, np.array([float(k % 3 > 0) for k in range(40)]))
    score, weight = model.score(features, first)
    weights = np.split(weight, first[1:])
    for k, bag in enumerate(bags):
        want, attention = score_by_loops(model, bag)
        assert score[k] == pytest.approx(want, rel=1e-3, abs=1e-5) and weights[k] == pytest.approx(attention, rel=1e-3, abs=1e-5)


def test_passages_are_runs_of_words_with_their_own_numbers():
    rng = random.Random(2)
    docs = ["", text(rng, 130), "one two two two", None, " \n lead " + text(rng, 63)]
    features, first = M.passages(pa.array([d or "" for d in docs], pa.large_string()))
    assert first.tolist() == [0, 1, 4, 5, 6] and len(features) == 7
    for k, d in enumerate(docs):
        words = (d or "").split()
        for j in range(max(1, -(-len(words) // M.PASSAGE))):
            part = words[j * M.PASSAGE : (j + 1) * M.PASSAGE]
            got = features[first[k] + j]
            lengths = [len(w) for w in part]
            mean = sum(lengths) / len(part) if part else 0
            assert got[M.N_CLASSES] == pytest.approx(mean, rel=1e-5)
            assert got[M.N_CLASSES + 1] == pytest.approx(math.sqrt(max(0, sum(n * n for n in lengths) / len(part) - mean**2)) if part else 0, abs=1e-3)
            assert got[M.N_CLASSES + 2] == pytest.approx((len(part) - len(set(part))) / max(1, len(part)), rel=1e-5)
            assert got[M.N_CLASSES + 4] == pytest.approx(len(part) / M.PASSAGE)


def test_classifier_edges(spark):
    rng = random.Random(3)
    long = text(rng, 60_000)
    rows = [(i, text(rng, 80) if i % 2 else "%% $$ ## " * 40, 0.1, 1) for i in range(60)] + [(100, long, 0.1, 1), (100, long, 0.1, 1), (None, "x", 0.1, 1), (101, None, 0.1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE double, predicted int")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    model = M.train(docs, marks)
    out = M.score(docs, model)
    assert sorted(out.columns) == ["attention", "doc_id", "predicted", "score", "text"]
    got = [r for r in out.collect()]
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= M.THRESHOLD) for r in got)
    same = [r for r in got if r.doc_id == 100]
    assert same[0] == same[1] and sum(same[0].attention) == pytest.approx(1) and len(same[0].attention) == -(-60_000 // M.PASSAGE)
    assert M.score(docs.limit(0), model).count() == 0
    assert {r.score for r in M.score(docs, M.train(docs, marks.limit(0))).collect()} == {0.5}


def test_compression_verdicts_by_hand():
    rng = random.Random(4)
    compressor = zstandard.ZstdCompressor(level=Q.LEVEL)
    size = lambda b: len(compressor.compress(b))
    samples = ["", "x", text(rng, 20), text(rng, 60), "again and " * 60, text(rng, 3000), ("same line here\n" * 300) + text(rng, 900), rng.randbytes(300).hex(), "".join(chr(rng.randint(33, 126)) for _ in range(9000))]
    for t in samples:
        data = t.encode()
        ratio, share, reason = Q.compression(data, compressor)
        if not data:
            assert (ratio, share, reason) == (None, None, None)
            continue
        least, most = [(a, b) for n, a, b in Q.BANDS if n <= len(data)][-1]
        want = "incompressible" if len(data) / size(data) < least else "repetitive" if len(data) / size(data) > most else None
        cuts = list(range(0, len(data), Q.CHUNK))
        if len(cuts) > 1 and len(data) - cuts[-1] < Q.SHORTEST:
            cuts.pop()
        bad = 0
        for a, b in zip(cuts, [*cuts[1:], len(data)]):
            low, high = Q.CHUNK_BAND if b - a >= Q.CHUNK else [(x, y) for n, x, y in Q.BANDS if n <= b - a][-1]
            bad += 0 if low <= (b - a) / size(data[a:b]) <= high else b - a
        assert ratio == pytest.approx(len(data) / size(data)) and (share is None) == (len(data) < Q.SHORTEST)
        if share is not None:
            assert share == pytest.approx(bad / len(data))
            want = want or ("chunks" if bad / len(data) > Q.CHUNK_SHARE else None)
        assert reason == want


def test_rules_edges(spark):
    rng = random.Random(5)
    rows = [(1, text(rng, 400), 1), (1, text(rng, 400), 1), (2, None, 2), (3, text(rng, 200_000), 3)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, n_words int, REASON string")
    out = Q.quality_rules(docs)
    assert sorted(out.columns) == sorted(["doc_id", "text", *Q.RESULT]) and out.count() == 4 and Q.quality_rules(docs.limit(0)).count() == 0


def test_bands_reject_what_the_base_rules_pass(spark):
    """Planted texts without repeated word windows and of enough words: noise and repetition go by their compression alone."""
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    noise = lambda n: " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) for _ in range(n))
    rows = [(1, prose(300)), (2, prose(3000)), (3, noise(60)), (4, noise(900)), (5, prose(120) + " " + "ab" * 9000), (6, prose(60) + " " + "-=" * 4000 + " " + prose(60)), (7, prose(900) + " " + noise(200)), (8, prose(80))]
    got = {r.doc_id: r for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if r.kept} == {1, 2, 8}
