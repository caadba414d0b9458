"""Token files, trie BPE and packing."""

import hashlib
import itertools
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from verdancy.llm import packing, token_files, trie_bpe, unit_encoder
from verdancy.llm.unit_encoder import UnitEncoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = [" ", "  ", "\n", " \n", "\t", "a", "Word", "'s", "don't", "123", "é", "ß", "!", "...", " ", "\x1c", "\x85", "日本", "🙂", "<|endoftext|>", "<|", "́", "​", "Ⅷ", "İ", "Σ", "<|startoftext|>", "thing"]


def texts(n=400, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 16))) for _ in range(n)] + ["word " * 30_000]


def test_units_encode_as_the_library():
    own = UnitEncoder(BYTE)
    sample = texts(3000) + ["\0a \0a a", "a \0a", "plain words\nin lines", "x" * 5000 + " y"]
    ids, lengths = own.encode(pa.array(sample, pa.large_string()))
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in sample]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_forgetting_units_changes_no_result(monkeypatch):
    monkeypatch.setattr(unit_encoder, "CACHE_BYTES", 4000)
    own, sample = UnitEncoder(BYTE), texts(300, 8)
    for k in range(0, len(sample), 20):
        ids, _ = own.encode(pa.array(sample[k : k + 20], pa.large_string()))
        assert ids.tolist() == [i for t in sample[k : k + 20] for i in own.tokenizer.encode(t, add_special_tokens=False).ids]
        assert own.held < 4000 + 200 * 400 + 200_000


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 10_000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 70_000, n, dtype=np.uint32)
    assert (token_files.join_streams(token_files.block_streams(ids, planes), n, planes) == ids).all()


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_one_block_is_read_alone(monkeypatch, planes):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    ids = np.random.default_rng(4).integers(0, 50_000, 333, dtype=np.uint32)
    ids[64:128] = 3  # two planes, or one of bytes
    block_planes, sizes, data = token_files.write_blocks(ids, planes, zstandard.ZstdCompressor(level=1))
    assert len(block_planes) == 6 and block_planes[1] == (2 if planes == "bit" else 1) and sum(sizes) == len(data)
    row = {"block": 64, "n_ids": 333, "planes": planes, "block_planes": block_planes, "plane_bytes": sizes}
    for k in range(6):
        first = sum(block_planes[:k])
        a, b = sum(sizes[:first]), sum(sizes[: first + block_planes[k]])
        only = bytes(a) + data[a:b] + bytes(len(data) - b)  # every other frame blanked out
        assert (token_files.read_block(row, k, only) == ids[64 * k : 64 * k + 64]).all()


def test_token_files_round_trip(spark, tmp_path):
    rows = [(i * 7 % 401, t) for i, t in enumerate(texts(400))] + [(5000, None), (None, "null id"), (5000, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, BYTE)
    got = sorted(token_files.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(BYTE)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), ids))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    assert token_files.read_index(spark, path).count() >= 1


def test_trie_bpe_is_the_library(spark):
    rows = list(enumerate(texts(600, 5))) + [(None, "x"), (7, None)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, decoded string")
    tok = Tokenizer.from_file(WORD)
    out = trie_bpe.trie_bpe(df, WORD).collect()
    assert len(out) == len(rows)
    for r in out:
        e = tok.encode(r.text or "", add_special_tokens=False)
        assert r.ids == e.ids and r.decoded == tok.decode(e.ids, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest()


def test_pairs_hold_as_plain_merging_says():
    trie = trie_bpe.word_tokenizer(WORD).trie
    rng = random.Random(7)
    common = sorted(trie.made, key=lambda t: trie.made[t][0])[:3000]
    inner = [t for t in common if not t.endswith(trie.end)] + list("abetn")
    for _ in range(6000):
        a, b = rng.choice(inner), rng.choice(common)
        if trie._own(a) and trie._own(b):
            assert trie._holds(a, b) == (trie.merge(trie._symbols(a) + trie._symbols(b)) == [a, b])


def test_words_with_symbols_that_the_vocabulary_lacks():
    merges = [("a", "b"), ("ab", "a"), ("b", "a</w>"), ("a", "a"), ("aa", "a")]
    vocab = {t: k for k, t in enumerate(["a", "b", "a</w>", "b</w>", *[x + y for x, y in merges]])}
    trie = trie_bpe.TrieBpe(vocab, merges, "</w>")
    words = ["".join(p) for n in range(1, 7) for p in itertools.product("abx", repeat=n)]
    got = trie.encode(words)
    for w in words:
        assert got[w] == trie.merge([c for c in (*w[:-1], w[-1] + "</w>") if c in vocab])


def test_every_character_below_256_and_a_small_cache(monkeypatch):
    monkeypatch.setattr(trie_bpe, "CACHE_BYTES", 5000)
    monkeypatch.setattr(trie_bpe, "CACHE_PAIRS", 50)
    own = trie_bpe.WordTokenizer(WORD)
    rng = random.Random(9)
    for _ in range(30):
        sample = ["".join(chr(rng.randrange(256)) for _ in range(rng.randint(0, 40))) for _ in range(20)] + ["Don't we'LL. it's'S x" + chr(rng.randrange(0x100, 0x2100)) + ".y"]
        counts, ids, decoded = own.encode(pa.array(sample, pa.large_string()))
        for text, n, i, d in zip(sample, counts, ids.to_pylist(), decoded.to_pylist()):
            want = own.library.encode(text, add_special_tokens=False)
            assert (n, i, d) == (len(want.ids), " ".join(map(str, want.ids)), own.library.decode(want.ids, skip_special_tokens=False))


def test_cuts_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 9))
        longest = np.sort(rng.choice(100, n, replace=False)) + 1
        count = rng.integers(1, 9, n)
        total = longest * count

        def padding(cuts):
            first, cost = 0, 0
            for end in cuts:
                cost += (longest[end - 1] * count[first:end]).sum() - total[first:end].sum()
                first = end
            return cost

        import itertools

        best = min(padding([*c, n]) for k in range(min(3, n)) for c in itertools.combinations(range(1, n), k))
        assert padding(packing.best_cuts(longest.tolist(), count.tolist(), 3)) == best


def test_cuts_of_long_histograms_are_those_of_the_plain_programme():
    rng = np.random.default_rng(6)
    for n, buckets in ((60, 5), (90, 16), (40, 40), (5, 9)):
        longest = np.sort(rng.choice(30_000, n, replace=False)) + 1
        count = rng.integers(1, 900, n)
        c, s = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * longest)]
        cost = lambda i, j: longest[j - 1] * (c[j] - c[i]) - (s[j] - s[i])  # noqa: B023, E731
        best = [0] + [10**18] * n
        for _ in range(min(buckets, n)):
            best = [0] + [min(best[i] + cost(i, j) for i in range(j)) for j in range(1, n + 1)]
        cuts = packing.best_cuts(longest.tolist(), count.tolist(), buckets)
        assert cuts[-1] == n and len(cuts) <= buckets and sum(cost(a, b) for a, b in zip([0, *cuts], cuts)) == best[n]


def test_packing_rules(spark):
    rows = [(i % 390, 1 + (i * i) % 900) for i in range(400)] + [(1000, 100_000), (None, 3)]
    out = packing.pack(spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, n_tokens long, bucket string").drop("none"), 6, 4096).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in out) == sorted((a or -1, b) for a, b in rows)
    batches = {}
    for r in out:
        assert 0 <= r.n_padding == r.bucket_len - r.n_tokens
        batches.setdefault(r.batch_id, []).append(r)
    for b in batches.values():
        assert len({r.bucket for r in b}) == 1 and sorted(r.slot for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0].bucket_len <= 4096


def test_rows_without_an_id_are_dealt_to_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 64)
    rows = spark.createDataFrame([(None, 7)] * 2000 + [(5, 7)] * 1000, "doc_id long, n_tokens long")
    out = packing.pack(rows, 4, 70).collect()
    shards = {}
    for r in out:
        shards.setdefault(r.batch_id.split("-")[1], []).append(r)
    assert len(out) == 3000 and max(map(len, shards.values())) < 200 and {r.n_padding for r in out} == {0}


def test_rows_of_one_id_are_dealt_to_many_shards(spark, tmp_path):
    df = spark.createDataFrame([(None if k % 3 else 4, f"{k % 89} words here", 1) for k in range(600)], "doc_id long, text string, start long")
    token_files.write_tokens(df, str(tmp_path / "t"), BYTE)
    got = token_files.read_tokens(spark, str(tmp_path / "t"))
    assert got.count() == 600 and token_files.read_index(spark, str(tmp_path / "t")).select("shard").distinct().count() > 2
    assert [r.start for r in got.where("doc_id is null").orderBy("start").limit(1).collect()] == [0]


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(empty, str(tmp_path / "t"), BYTE)
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 0
    assert packing.pack_documents(empty, BYTE).count() == 0
    assert trie_bpe.trie_bpe(empty, WORD).count() == 0
