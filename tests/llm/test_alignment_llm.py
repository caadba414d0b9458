"""Token alignment against both libraries and a plain walk over the tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from verdancy.llm import token_align as A

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", " \n", "\t", "a", "Word", "'s", "don't", "123", "é", "ß", "!", "...", "\x1c", "\x85", "日本", "🙂", "<|endoftext|>", "<|", "́", "​", "Ⅷ", "İ"]
PARTS += ["▁", "\0", "<s>", "</s>", "<0x0A>", "e.", ".e", "_a", "a\n", "\r\n", "﻿", "thing", " of", ", and"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 16))) for _ in range(n)]


@pytest.fixture(scope="module")
def units():
    return A.PairUnits(BYTE, PIECE)


def tokens(units, text):
    """(ids, bytes) of A and of B for a text, or None where they do not spell it."""
    a, b = units.sides
    found = []
    for side, ids in ((a, a.tokenizer.encode(" " + text, add_special_tokens=False).ids), (b, b.tokenizer.encode(text))):
        found.append((ids, [side.spelt[i] for i in ids]))
        if b"".join(found[-1][1]) != (" " + text).encode():
            return None
    return found


def groups(found):
    (a, words_a), (b, words_b) = found
    ends_a, ends_b = (np.cumsum([len(w) for w in words]).tolist() for words in (words_a, words_b))
    out, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = i, j
        while i < len(a) and ends_a[i] <= cut:
            i += 1
        while j < len(b) and ends_b[j] <= cut:
            j += 1
        out.append((a[x:i], b[y:j]))
    return out


def brute(units, rows):
    """The whole result by loops over all links."""
    docs = [groups(found) if text and (found := tokens(units, text)) else None for _, text in rows]
    links = [[(x, y) for a, b in d for x in a for y in b] if d else [] for d in docs]
    held = Counter(p for link in links for p in set(link))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (doc_id, _), d, link in zip(rows, docs, links):
        if d is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in d)
        counts = [sum(len(g[k]) for g in d) for k in (0, 1)]
        out.append((doc_id, *counts, len(d), len(link), sum(held[p] == most[p[0]] for p in link), sum(held[p] for p in link), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("cache", [A.CACHE_BYTES, 20_000])
def test_units_encode_as_both_libraries(units, monkeypatch, cache):
    monkeypatch.setattr(A, "CACHE_BYTES", cache)
    sample = texts(3000, 3) + ["word " * 3000, "x" * 20_000, "日" * 3000, "plain words, in lines.\nAnd more", " ", "  ", "\n"]
    for k in range(0, len(sample), 500):
        part = sample[k : k + 500]
        a, b, spelt = units.encode(pa.array(part, pa.large_string()))
        of_a, of_b = (np.split(s.ids, np.cumsum(s.counts)[:-1]) for s in (a, b))
        for text, x, y, right in zip(part, of_a, of_b, spelt):
            found = tokens(units, text)
            assert right == (found is not None)
            if right:
                assert (x.tolist(), y.tolist()) == (found[0][0], found[1][0])


@pytest.mark.parametrize("long", [0, 1, 6, 4096])
def test_pairs_of_long_groups_are_those_of_short_ones(units, monkeypatch, long):
    monkeypatch.setattr(A, "LONG_GROUP", long)
    sample = [t for t in texts(400, 5) if tokens(units, t)] + ["日本🙂" * 400, "Ⅷ" * 300]
    a, b, _ = units.encode(pa.array(sample, pa.large_string()))
    sizes = [np.array([len(w) for w in side.spelt]) for side in units.sides]
    cut = A.align(a, b, *sizes)
    pair, times, n_pairs = A.link_pairs(a, b, cut, (16, 15))
    at = np.concatenate([[0], np.cumsum(n_pairs)])
    for k, text in enumerate(sample):
        want = Counter((x << 15) | y for g in groups(tokens(units, text)) for x in g[0] for y in g[1])
        assert dict(zip(pair[at[k] : at[k + 1]].tolist(), times[at[k] : at[k + 1]].tolist())) == want
        assert cut.n_links[k] == sum(want.values())


def test_alignment_is_that_of_plain_loops(spark, units):
    rows = list(enumerate(texts(700, 8))) + [(5, "again"), (None, "no id"), (None, None), (7, ""), (9001, "日本🙂" * 500), (9002, "a" * 9000), (9003, "x▁y")]
    rows += [(10_000 + i, "the same words, of many") for i in range(40)]
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, block int, pair string")
    got = A.align_tokens(df, BYTE, PIECE, 4000)
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(units, rows), key=key)


def test_empty_table(spark):
    assert A.align_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).count() == 0
    one = A.align_tokens(spark.createDataFrame([(1, None)], "doc_id long, text string"), BYTE, PIECE).collect()
    assert [tuple(r) for r in one] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_no_saved_row_holds_a_block(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))) for i, n in enumerate([4000, 1500, 1, *[30] * 200])] + [(300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    saved = df.mapInArrow(A._blocks(BYTE, PIECE, A.BLOCK_BYTES), A.BLOCK_SCHEMA).toArrow()
    lists = [c for c in saved.schema.names if pa.types.is_list(saved.schema.field(c).type)]
    assert lists and max(pc.max(pc.list_value_length(saved.column(c))).as_py() or 0 for c in lists) <= 1024


def test_documents_of_several_rows(spark, units):
    rng = random.Random(12)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))) for i, n in enumerate([2500, 900, 40, 1, 2500])] + [(4, "again"), (None, None), (7, "")]
    rows += [(8, rows[0][1]), (9, rows[1][1] + " " + rows[1][1])]
    for block in (A.BLOCK_BYTES, 20_000):
        got = A.align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, PIECE, block)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(units, rows)))
