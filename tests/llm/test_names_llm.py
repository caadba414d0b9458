"""Edit-distance name join: descent, shards and totals against plain dynamic programming."""

import random
import zlib

import pytest

from verdancy.llm import name_join as N


def distance(a, b):
    """Unrestricted Damerau-Levenshtein distance by the full table."""
    last, table = {}, {(-1, -1): len(a) + len(b)}
    for i in range(len(a) + 1):
        table[i, -1], table[i, 0] = len(a) + len(b), i
    for j in range(len(b) + 1):
        table[-1, j], table[0, j] = len(a) + len(b), j
    for i, x in enumerate(a, 1):
        seen = 0
        for j, y in enumerate(b, 1):
            k, n = last.get(y, 0), seen
            if x == y:
                seen = j
            table[i, j] = min(table[i - 1, j - 1] + (x != y), table[i, j - 1] + 1, table[i - 1, j] + 1, table[k - 1, n - 1] + (i - k - 1) + 1 + (j - n - 1))
        last[x] = i
    return table[len(a), len(b)]


def words(n, seed, letters="abcé", longest=9):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("k", [1, 2, 3])
def test_descent_finds_what_the_full_table_finds(k):
    forms = words(500, k)
    root = N.trie_of(forms)
    for query in [*forms[::9], "ca", "a", "", "abc" * 5]:
        assert dict(N.descend(root, query, k)) == {i: d for i, f in enumerate(forms) if (d := distance(f, query)) <= k}


def test_exchanges_are_edited_again():
    root = N.trie_of(["ca"])
    assert dict(N.descend(root, "abc", 2)) == {0: 2}  # 3 if what was exchanged stayed untouched


@pytest.mark.parametrize("k", [1, 2])
def test_every_near_pair_shares_a_segment(k):
    forms = words(300, 7)
    for a in forms:
        for b in forms[::7]:
            if distance(a, b) <= k:
                assert N.first_segment(a, b, k) >= 0


@pytest.mark.parametrize("k", [1, 2])
def test_pairs_are_complete_and_come_once(spark, monkeypatch, k):
    monkeypatch.setattr(N, "CHUNK", 5)
    forms, queries = words(150, 11), words(80, 12)
    df = lambda rows: spark.createDataFrame([(w,) for w in rows], "form string")
    got = sorted(map(tuple, N.name_pairs(df([*forms, *forms[:5], ""]), df(queries), k).select("query", "form", "distance").collect()))
    assert got == sorted((q, f, d) for q in queries for f in forms if (d := distance(q, f)) <= k)


def misspelt(name, vendor_id):
    h = zlib.crc32(str(vendor_id).encode()) if vendor_id is not None else 1
    if h % 2 or len(name) < 2:
        return name
    p = h % (len(name) - 1)
    return name[:p] + name[p + 1] + name[p] + name[p + 2 :]


def normalised(name):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in name if c not in " \t\n\v\f\r")


def test_join_counts_every_row(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 8)
    rng = random.Random(3)
    base = [w.title() for w in words(60, 5, "abnöÉ", 7)]
    names = lambda n: [rng.choice([rng.choice(base), rng.choice(base).upper(), " " + rng.choice(base) + "\t", "Annabo", "", "  ", None, "x" * 3000, "İ", "a", "ab"]) for _ in range(n)]
    clients = [(rng.choice([i, i, 5, None]), w, "other") for i, w in enumerate(names(400))]
    vendors = [(rng.choice([i, i, 7, None]), w, 1) for i, w in enumerate(names(90))]
    got = N.name_join(
        spark.createDataFrame(clients, "client_id long, name string, form string"), spark.createDataFrame(vendors, "vendor_id long, name string, length int"),
        "client_id", "name", "vendor_id", N.misspelt("name", "vendor_id"),
    )
    want = []
    for vendor_id, name, _ in vendors:
        spelt = normalised(misspelt(name, vendor_id)) if name is not None else ""
        by = {}
        for client_id, other, _ in clients:
            form = normalised(other) if other is not None else ""
            if spelt and form and abs(len(spelt) - len(form)) <= 1 and (d := 0 if spelt == form else distance(spelt, form)) <= 1:
                by.setdefault(d, []).append(client_id)
        for d, ids in by.items():
            known = [i for i in ids if i is not None]
            want.append((vendor_id, d, len(ids), min(known, default=None), sum(zlib.crc32(str(i).encode()) for i in known)))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, name string")
    some = spark.createDataFrame([(1, "Ann")], "id long, name string")
    for left, right in ((none, some), (some, none)):
        assert N.name_join(left, right, "id", "name", "id", N.misspelt("name", "id")).count() == 0
