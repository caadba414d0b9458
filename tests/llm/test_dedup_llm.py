"""Jaccard join and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from verdancy.llm import jaccard_join as J
from verdancy.llm.components import components
from verdancy.llm.substring_dedup import COVER, COVER_PERIOD, substring_dedup

SCHEMA = "doc_id long, text string, lang string, n_words int, key string"


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base = [[word() for _ in range(rng.randint(60, 160))] for _ in range(12)]
    passage = [word() for _ in range(70)]
    docs = []
    for b in base:
        docs.append(b)
        for _ in range(3):
            near = list(b)
            for _ in range(rng.randint(1, 4)):
                near[rng.randrange(len(near))] = word()
            docs.append(near)
    docs += [base[0], base[0], passage + base[1][:20], base[2][:30] + passage[5:60], ["x"] * 120, ["x"] * 60, [], ["one", "two"], ["one", "two"]]
    rows = [(i, rng.choice([" ", "\n", "  "]).join(d), "en", 1, "k") for i, d in enumerate(docs)]
    rows += [(9000, None, None, None, None), (9001, "", "en", 2, "k"), (None, "a b c d e f", "en", 3, "k"), (5, rows[5][1], "fr", 4, "k"), (7, rows[20][1], "fr", 4, "k"), (21, rows[8][1] + " tail", "en", 1, "k")]
    rng.shuffle(rows)
    return rows


def shingles(text):
    w = (text or "").split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_cover_has_every_difference():
    assert {(a - b) % COVER_PERIOD for a in COVER for b in COVER} == set(range(COVER_PERIOD))


@pytest.mark.parametrize("leaf, block, broadcast", [(1024, 2048, 1 << 20), (4, 2048, 0), (4, 3, 0)])
def test_jaccard_join_is_brute_force(spark, monkeypatch, leaf, block, broadcast):
    monkeypatch.setattr(J, "LEAF", leaf)  # 4: recursion
    monkeypatch.setattr(J, "BLOCK", block)  # 3: units of two blocks
    monkeypatch.setattr(J, "BROADCAST_ROWS", broadcast)  # 0: texts by a shuffle
    rows = corpus()
    got = J.jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sets = [shingles(r[1]) for r in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *[label[j] for j in links[i]]]) for i in range(n)]
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(least.get(label[i], r[0]), r[0])
    want = Counter((r[0], least.get(label[i]), len(links[i])) for i, r in enumerate(rows))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want


def test_row_without_id_links_its_neighbours(spark):
    w = [f"w{k}" for k in range(400)]
    rows = [(2, w[:100]), (None, w[8:108]), (1, w[16:116]), (None, w[200:300]), (None, w[204:304]), (None, w[200:300])]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in J.jaccard_join(df).collect())
    assert got == Counter([(2, 1, 2, 1), (None, 1, None, 2), (1, 1, 1, 1), (None, None, None, 2), (None, None, None, 2), (None, None, None, 2)])


def test_substring_dedup_is_brute_force(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, SCHEMA)
    out = substring_dedup(df)
    assert set(out.columns) == {"doc_id", "text", "lang", "key", "n_words", "n_removed", "kept_sha256", "kept_text"}
    first = {}
    for i, text, *_ in rows:
        w = (text or "").split()
        for k in range(len(w) - 49) if i is not None else ():
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, i), i)
    want = Counter()
    for i, text, *_ in rows:
        w = (text or "").split()
        gone = set()
        for k in range(len(w) - 49) if i is not None else ():
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        want[i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()] += 1
    got = out.collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert sum(r.n_removed for r in got) > 0
    for r in got:
        kept = (r.kept_text or "").split()
        assert len(kept) == r.n_words - r.n_removed
        assert r.n_removed or r.kept_text == r.text


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert J.jaccard_join(empty).count() == 0
    assert substring_dedup(empty).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)], "u long, v long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == got[101] == got[100] == 100


@pytest.mark.parametrize("leaf, block", [(1024, 2048), (40, 50)])
def test_jaccard_join_of_a_large_loose_group(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(J, "LEAF", leaf)
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(300):  # near copies of one text, from a changed word to a third of them
        near = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2, 3, 4, 8, 20, 40])):
            near[at] = word()
        texts.append(near)
    line = [word() for _ in range(8)]
    texts += [[word() for _ in range(30)] + line + [word() for _ in range(30)] for _ in range(200)]  # one common line
    texts += [texts[0]] * 40 + [["long"] + [word() for _ in range(30_000)]]
    rows = [(i, " ".join(t), "x", 1, "y", "z", 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string, n int, label string, path string, th int")
    got = {r.doc_id: r for r in J.jaccard_join(docs).collect()}
    sets = [shingles(r[1]) for r in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9] for i in range(540)] + [[] for _ in range(n - 540)]
    assert len(got) == n and sum(got[i].n_links for i in got) >= 0.9999 * sum(map(len, links))
    assert all(got[i].n_links <= len(links[i]) for i in got) and all(got[500 + k].copy_of == 0 for k in range(40))


def test_substring_dedup_of_long_and_common_passages(spark):
    rng = random.Random(18)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    long = [word() for _ in range(30_000)]
    rows = [(i, " ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)])) for i in range(120)]
    rows += [(500, " ".join(long)), (501, " ".join(long[:20_000] + ["new"] + long[20_000:])), (501, " ".join(long[5:2000])), (None, " ".join(passage)), (502, " ".join(passage))]
    docs = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], "doc_id long, text string, key int, found string, REST string")
    out = substring_dedup(docs)
    assert set(out.columns) == {"doc_id", "text", "key", "found", "REST", "n_words", "n_removed", "kept_sha256", "kept_text"}
    got = {(r.doc_id, r.n_words): r.n_removed for r in out.collect()}
    assert got[0, 100] == 0 and {got[i, 100] for i in range(1, 120)} == {60}
    assert got[500, 30_000] == 0 and got[501, 30_001] == 30_000 and got[501, 1995] == 1995 and got[None, 60] == 0 and got[502, 60] == 60


@pytest.mark.parametrize("seed", [31, 32, 33])
def test_measured_recall_of_pairs_about_the_threshold(spark, monkeypatch, seed):
    """Small leaves, so that every pair has to survive the splitting: links found of those that brute force finds."""
    monkeypatch.setattr(J, "LEAF", 8)
    rng = random.Random(seed)
    docs = []
    for _ in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 200))]
        docs.append(base)
        for _ in range(4):
            near, n = list(base), len(base)
            for place in rng.sample(range(n), rng.randint(1, max(1, n // 45))):  # each changes five of the shingles
                near[place] = f"x{rng.randrange(10**6)}"
            docs.append(near)
    sets = [shingles(" ".join(d)) for d in docs]
    links = {(i, j) for i in range(len(docs)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    close = sum(len(sets[i] & sets[j]) < 0.85 * len(sets[i] | sets[j]) for i, j in links)
    assert len(links) > 150 and close > 20
    got = J.jaccard_join(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")).collect()
    found, wanted = sum(r.n_links for r in got), 2 * len(links)
    assert wanted - 2 * 1 <= found <= wanted, (found, wanted)
