"""The skip-chain field: exact marginals, learned ties, planted mentions, edges."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest

from verdancy.llm import pii_crf as P

WORDS = "the of and to in that was with for this erble anre thin reed onshen from hand".split()


def entity(kind, rng):
    if kind == 0:
        return f"{rng.choice(WORDS)}.{rng.choice(WORDS)}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
    if kind == 1:
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == 2:
        stem = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(stem + c for c in "0123456789" if P.luhn(stem + c))
    return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"


def document(rng, n=90):
    words = [rng.choice(WORDS) for _ in range(n)]
    for _ in range(rng.randint(1, 4)):
        words.insert(rng.randrange(len(words)), entity(rng.randrange(4), rng))
    for _ in range(rng.randint(0, 3)):
        words.insert(rng.randrange(len(words)), str(rng.choice([rng.randint(1900, 2030), rng.randint(100, 99_999_999)])))
    return " ".join(words)


def chain_graph(x, chain, tie):
    zero = np.zeros(len(x), dtype=np.int64)
    return P.Graph(x, zero, zero, zero, zero.copy(), np.array(chain, dtype=np.int64).reshape(-1, 2), np.array(tie, dtype=np.int64).reshape(-1, 3), [[]])


def exact(field, g):
    n, score = len(g.x), g.x @ field.unary
    i, j, psi = field.edges(g)
    total = np.zeros((n, P.N_LABELS))
    for labels in itertools.product(range(P.N_LABELS), repeat=n):
        if any(g.label[k] and labels[k] != g.label[k] for k in range(n)):
            continue
        weight = np.exp(sum(score[k, y] for k, y in enumerate(labels) if not g.label[k]) + sum(t[labels[a], labels[b]] for a, b, t in zip(i, j, psi)))
        for k, y in enumerate(labels):
            total[k, y] += weight
    return total / total.sum(axis=1, keepdims=True)


def random_field(rng):
    return P.Field(rng.normal(0, 1, (P.N_FEATURES, P.N_LABELS)), rng.normal(0, 1, (P.N_LABELS, P.N_LABELS)), np.abs(rng.normal(0, 1, len(P.TIES))))


def test_messages_give_the_exact_marginals_of_trees():
    rng = np.random.default_rng(1)
    for tie in ([[0, 2, 1]], [[1, 3, 4], [3, 4, 0]], []):
        x = rng.normal(0, 0.3, (5, P.N_FEATURES))
        g = chain_graph(x, [[0, 1]] if tie else [[0, 1], [1, 2], [2, 3]], tie)
        field = random_field(rng)
        assert field.posteriors(g, rounds=80) == pytest.approx(exact(field, g), abs=1e-6)
        g.label[0] = 2
        assert field.posteriors(g, rounds=80) == pytest.approx(exact(field, g), abs=1e-6)


def test_messages_are_near_the_exact_marginals_of_loops():
    rng = np.random.default_rng(2)
    for _ in range(10):
        g = chain_graph(rng.normal(0, 0.2, (5, P.N_FEATURES)), [[0, 1], [1, 2]], [[0, 2, 1], [2, 4, 2], [3, 4, 3], [0, 3, 0]])
        field = random_field(rng)
        assert np.abs(field.posteriors(g, rounds=200) - exact(field, g)).max() < 0.15


def test_weights_are_the_slopes_of_the_pseudo_likelihood():
    rng = random.Random(3)
    graphs = []
    for _ in range(40):
        text, spans = P.planted(document(rng), rng)
        g = P.graph(pa.array([text], pa.large_string()), [spans])
        graphs.append((g.x, g.label, g.chain, g.tie))
    # at the optimum of one tie's weight the mean of observed and expected agreement is equal up to the decay
    field = P.fit(graphs, steps=600)
    assert all(0 < w < 40 for w in field.tie[[1, 2, 4]])


def test_planted_mentions_are_found_and_decoys_left():
    rng = random.Random(4)
    graphs = []
    for _ in range(300):
        text, spans = P.planted(document(rng), rng)
        g = P.graph(pa.array([text], pa.large_string()), [spans])
        graphs.append((g.x, g.label, g.chain, g.tie))
    field = P.fit(graphs)
    hit = miss = wrong = 0
    for _ in range(200):
        text, spans = P.planted(document(rng), rng)
        texts = pa.array([text], pa.large_string())
        found = P.added_spans(P.graph(texts), field, texts)[0]
        touched = [any(a < y and b > x and kind == k for a, b, k in found) for x, y, kind in spans]
        hit, miss = hit + sum(touched), miss + len(spans) - sum(touched)
        wrong += sum(not any(a < y and b > x and kind == k for x, y, kind in spans) for a, b, k in found)
    assert hit / (hit + miss) > 0.8 and hit / (hit + wrong) > 0.95, (hit, miss, wrong)
    none = P.Field(field.unary, field.chain, np.zeros(len(P.TIES)))
    lost = P.added_spans(P.graph(texts), none, texts)[0]
    assert len(lost) <= len(found)


def test_ties_join_mentions_of_an_entity():
    text = "write to ann.lee9@mail.example.com or call +1 (377) 555-0271 about 4111111111111111 . ann.lee9 said 377-555-0271 or 5550271 and 4111.1111.1111.1111 end 1111 in 2024"
    g = P.graph(pa.array([text], pa.large_string()))
    named = lambda k: text[g.start[k] : g.end[k]]
    got = {(named(i), named(j), P.TIES[kind]) for i, j, kind in g.tie.tolist()}
    assert {("ann.lee9@mail.example.com", "ann.lee9", "local"), ("555-0271", "377-555-0271", "ending"), ("377-555-0271", "5550271", "ending")} <= got
    assert {("4111111111111111", "4111.1111.1111.1111", "alike"), ("4111.1111.1111.1111", "1111", "ending")} <= got
    assert not any("2024" in pair for pair in got)


def test_edges(spark):
    rng = random.Random(6)
    long = " ".join(document(rng) for _ in range(400))
    rows = [(1, document(rng)), (2, None), (3, ""), (None, "call +1 (377) 555-0271"), (4, long), (4, long), (5, "@ @@ a@b 12.34.56"), (6, "\x00 ann@b.co \x00")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, n_card int, MASKED string")
    field = P.train(docs)
    out = P.find_pii(docs, field)
    assert sorted(out.columns) == sorted(["doc_id", "text", *P.RESULT])
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id != 4}
    same = [r for r in got if r.doc_id == 4]
    assert same[0] == same[1] and same[0].n_email + same[0].n_ip + same[0].n_card + same[0].n_phone == len(P.base_spans(long))
    assert by[2].masked is None and by[3].masked == "" and by[2].spans == by[3].spans == by[5].spans == ""
    assert by[None].n_phone == 1 and by[6].masked == "\x00 [EMAIL] \x00"
    assert P.train(docs.limit(0)) is None and P.find_pii(docs.limit(0), None).count() == 0


def unseen(entity, kind, rng):
    """Mentions in shapes that no planting rule makes."""
    digits = re.sub(r"\D", "", entity)
    if kind == 0:
        local, domain = entity.split("@")[:2]
        return rng.choice([f"{local}{{at}}{domain}", f"{local}_AT_{domain}", f"mailto={local}", f"{local}#{domain}", f"{local}/{domain}"])
    if kind == 1:
        return entity.replace(".", rng.choice(["(dot)", "|", "~", "x"]))
    if kind == 2:
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice(["~".join(groups), "|".join(groups), ":".join(groups), "*" + digits[-4:], "ending:" + digits[-4:], "_".join([digits[:8], digits[8:]])])
    area, middle, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"{area}/{middle}/{last}", f"{area}_{middle}_{last}", f"{area}:{middle}{last}", f"0{area}{middle}{last}", f"{area}~{middle}~{last}"])


def test_mentions_in_shapes_that_training_never_makes(spark, monkeypatch):
    path = "/root/testdata/sf0.1/documents.parquet"
    field = P.train(spark.read.parquet(path).where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2"))
    swap = lambda c, kind, rng: str(rng.randrange(10)) if c.isdigit() else rng.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() and kind == 0 else c
    monkeypatch.setattr(P, "rewritten", unseen)
    monkeypatch.setattr(P, "decoy", lambda e, kind, rng: "".join(swap(c, kind, rng) for c in unseen(e, kind, rng)))
    found = total = false = 0
    for row in ds.dataset(path).to_table(columns=["doc_id", "text"]).to_pylist():
        text = row["text"] or ""
        if zlib.crc32(str(row["doc_id"]).encode()) % 4 != 2 or not P.base_spans(text) or len(text) > 20_000:
            continue
        new, spans = P.planted(text, random.Random(row["doc_id"]), 1.0)
        (added,) = P.added_spans(P.graph(pa.array([new], pa.large_string())), field, [pa.scalar(new)])
        hit = lambda x, y: x[0] < y[1] and x[1] > y[0] and x[2] == y[2]
        total += len(spans)
        found += sum(any(hit(s, a) for a in added) for s in spans)
        false += sum(not any(a[0] < s[1] and a[1] > s[0] for s in spans) for a in added)
    assert total > 150 and found > 0.7 * total and false < 0.1 * found, (found, total, false)
