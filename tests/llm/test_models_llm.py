"""Language ID, personal data, quality models, quality rules and top-k search."""

import base64
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from verdancy.llm import language_id, mil_quality, pii_crf, quality_rules, textcore, topk_search

EN, DE = "the of and to in that was with for this", "der die und das nicht ein mit für ist wir"


def sentences(rng, words, n):
    return " ".join(rng.choice(words.split()) for _ in range(n))


def test_language_spans_and_edges(spark):
    rng = random.Random(1)
    rows = [(i, sentences(rng, EN if i % 2 else DE, 40), "en" if i % 2 else "de") for i in range(60)]
    model = language_id.train(spark.createDataFrame([*rows, (99, None, "en"), (98, "x", None)], "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"]
    mixed = f"{sentences(rng, EN, 12)}. {sentences(rng, DE, 30)}"
    tests = spark.createDataFrame([(1, mixed, 0.1), (2, None, 0.2), (3, "12 ... 3", 0.3), (None, "and the", 0.4), (5, "", None), (6, "Привет", 1.0)], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in language_id.identify(tests, model).collect()}
    spans = got[1].spans
    assert got[1].lang_pred == "de" and [s.lang for s in spans] == ["en", "de"] and mixed[spans[1].start : spans[1].end].split()[0] in DE.split()
    assert [(got[k].lang_pred, got[k].score) for k in (2, 3, 5)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "en" and (got[6].score, got[6].known_share) == (0, 0) and got[6].lang_pred == "de"
    none = language_id.train(tests.select("doc_id", "text", language_id.F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in language_id.identify(tests, none).collect()} == {"und"}


def test_viterbi_is_brute_force():
    import itertools

    rng = np.random.default_rng(2)
    for _ in range(20):
        n = int(rng.integers(1, 7))
        scores = rng.normal(0, 10, (n, 3)).astype(np.float32)
        model = language_id.LanguageModel(["a", "b", "c"], None, None, None)
        model.word_scores = lambda x: scores  # noqa: B023
        zero = np.zeros(n, dtype=np.int64)
        got = model.label(language_id.Letters(zero, zero, zero, zero, zero, zero, zero, zero, zero), 1)
        value = lambda p: sum(scores[t, s] for t, s in enumerate(p)) - language_id.PENALTY * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert value(got) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=n)), rel=1e-5)


def test_long_documents_are_labelled_as_by_one_pass(monkeypatch):
    rng = np.random.default_rng(13)
    count = np.array([3, 40, 41, 1, 17, 64])
    begin, doc = np.cumsum(count) - count, np.repeat(np.arange(6), count)
    scores = np.repeat(rng.normal(0, 6, (len(doc) // 3 + 1, 4)), 3, axis=0)[: len(doc)].astype(np.float32)
    want = np.zeros(len(doc), dtype=np.int32)
    free = np.full(6, -1, dtype=np.int32)
    language_id._viterbi(scores, begin, count, free, free, want)
    model = language_id.LanguageModel(list("abcd"), None, None, None)
    model.word_scores = lambda x: scores
    zero = np.zeros(len(doc), dtype=np.int64)
    for segment in (1, 2, 7, 16, 64):
        monkeypatch.setattr(language_id, "SEGMENT", segment)
        monkeypatch.setattr(language_id, "TRANSFER", 16 * segment)
        got = model.label(language_id.Letters(zero, zero, doc, zero, zero, zero, zero, zero, zero), 6)
        assert (got == want).all() and len(set(got)) == 4


def naive_words(text):
    """(word in lower case, trigrams) of the runs of letters and marks that hold a letter."""
    out = []
    for m in re.finditer(r"[^\W\d_](?:[^\W\d_])*", text):
        w = m[0].lower()
        out.append((w, [f"\0{w}\0"[k : k + 3] for k in range(len(w))]))
    return out


def test_language_counts_and_scores_are_by_hand(spark):
    rng = random.Random(14)
    rows = [(i, sentences(rng, EN if i % 2 else DE, 30) + " Ärger, été; OK", "en" if i % 2 else "de") for i in range(40)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    grams = {"en": {}, "de": {}}
    words = {"en": {}, "de": {}}
    for _, text, lang in rows:
        for w, g in naive_words(text):
            words[lang][w] = words[lang].get(w, 0) + 1
            for x in g:
                grams[lang][x] = grams[lang].get(x, 0) + 1
    size = 1 << language_id.BITS
    probe = "the wir Ärger unseen"
    got = model.word_scores(language_id.letters([probe]))
    for row, (w, g) in zip(got, naive_words(probe)):
        for value, lang in zip(row, model.langs):
            total = lambda table: sum(table[lang].values()) + 0.5 * size  # noqa: B023, E731
            want = math.log((words[lang].get(w, 0) + 0.5) / total(words)) + sum(math.log((grams[lang].get(x, 0) + 0.5) / total(grams)) for x in g)
            assert value == pytest.approx(want, rel=1e-4)


def test_scripts_narrow_the_candidates_and_held_out_rows_are_right(spark):
    rng = random.Random(15)
    vocab = {"en": EN, "de": DE, "ru": "это как так и в на не что он она они был мы вы по из", "uk": "це як так і в на не що він вона вони був ми ви по із є", "el": "και το να είναι στο με για από που δεν"}
    rows = [(i, sentences(rng, vocab[lang], 25), lang) for i in range(400) for lang in [sorted(vocab)[i % 5]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs.where("doc_id % 4 <> 2"))
    script = language_id.SCRIPT_NAMES.index
    allowed = {n: [lang for lang, ok in zip(model.langs, model.allowed[script(n)]) if ok] for n in ("latin", "cyrillic", "greek", "han")}
    assert allowed == {"latin": ["de", "en"], "cyrillic": ["ru", "uk"], "greek": ["el"], "han": []}
    got = language_id.identify(docs.where("doc_id % 4 = 2").withColumn("lang_pred", language_id.F.lit("x")), model).collect()
    assert len(got) == 100 and sum(r.lang_pred == r.lang for r in got) >= 98 and all(r.known_share == 1 for r in got)
    mixed = spark.createDataFrame([(1, "the and that 漢字漢字漢字 και το να"), (1, "the and that 漢字漢字漢字 και το να")], "doc_id long, text string")
    one, two = language_id.identify(mixed, model).collect()
    assert one == two and one.lang_pred == "en" and one.known_share == pytest.approx(17 / 23) and one.score == pytest.approx(10 / 23)
    assert language_id.identify(docs.limit(0), model).count() == 0 and language_id.train(docs.limit(0)).langs == []


def test_more_languages_than_a_byte_numbers(spark):
    rng = random.Random(16)
    names = [f"l{k:03d}" for k in range(150)]
    words = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(6)] for n in names}
    rows = [(i, " ".join(rng.choice(words[n]) for _ in range(12)), n) for i, n in enumerate(names * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify(docs, language_id.train(docs), with_spans=False).collect()
    assert all(r.lang_pred == r.lang for r in got)


def naive_pii(t):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and pii_crf.luhn(d):
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_are_the_plain_patterns():
    rng = random.Random(3)
    parts = ["a", "b1", "@", "@x.y", ".", "1", "12", "256", "4111111111111111", " ", "-", "+1", "(", "555", ")", "é", "%", "1.2.3.4", "007"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert pii_crf.base_spans(t) == naive_pii(t)


def test_skip_chain_carries_a_label_to_a_distant_repeat(spark):
    rng = random.Random(4)
    rows = [(i, f"{sentences(rng, EN, 20)} +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} {sentences(rng, EN, 5)} in {rng.randint(1900, 2030)} total 12345") for i in range(80)]
    rows += [(1000, "call +1 (377) 555-0271 now. " + sentences(rng, EN, 200) + " ask 555-0271 again in 2024"), (1001, None), (1002, ""), (None, "bob@a.com")]
    docs = spark.createDataFrame([(a, b, "s") for a, b in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii_crf.find_pii(docs, pii_crf.train(docs)).collect()}
    text = rows[80][1]
    found = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in got[1000].spans.split(",")]
    assert found == ["+1 (377) 555-0271", "555-0271"] and "[PHONE] again in 2024" in got[1000].masked
    assert got[1001].spans == got[1002].spans == "" and got[1001].masked is None
    assert got[None].masked == "[EMAIL]" and got[None].n_email == 1
    assert pii_crf.find_pii(docs.limit(0), None).count() == 0


def test_mil_gradient_and_learning(spark):
    rng = np.random.default_rng(5)
    bags = [rng.normal(0, 1, (int(rng.integers(1, 5)), mil_quality.N_FEATURES)).astype(np.float32) for _ in range(6)]
    labels = np.array([0, 1, 0, 1, 1, 0], dtype=float)
    model = mil_quality.fit(bags, labels)
    x, sizes = np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags])
    first = np.cumsum(sizes) - sizes
    model.parts["w"] = rng.normal(0, 0.1, model.parts["w"].shape)
    grad = model.gradient(x, first, labels)

    def loss():
        s = model.forward(x, first)["score"]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    for name, at in (("w", (3, 2)), ("v", (1, 1)), ("u", (2, 0)), ("a", (4,)), ("o", (5,))):
        keep = model.parts[name][at]
        model.parts[name][at] = keep + 1e-5
        up = loss()
        model.parts[name][at] = keep - 1e-5
        down = loss()
        model.parts[name][at] = keep
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)
    r = random.Random(6)
    rows = [(i, sentences(r, EN, 90) if i % 2 else "### $$$ " * 60) for i in range(120)] + [(500, None), (501, ""), (None, "x")]
    docs = spark.createDataFrame([(a, b, 0.5) for a, b in rows], "doc_id long, text string, score double")
    marks = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(0, None), (1, 1)], "doc_id long, label int")
    got = {x.doc_id: x for x in mil_quality.score(docs, mil_quality.train(docs, marks)).collect()}
    assert all((got[i].score > 0.5) == bool(i % 2) for i in range(100, 120))
    assert got[500].score == got[501].score and len(got[101].attention) == 2 and sum(got[101].attention) == pytest.approx(1)


def test_quality_rules_edges(spark):
    clean = sentences(random.Random(7), "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi", 70)
    rng = random.Random(8)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") + (" " if k % 9 == 8 else "") for k in range(3000))
    rows = [(1, None), (2, ""), (3, "a\n\na\n a\na"), (4, clean), (5, "same words here " * 400), (6, noise), (None, "\n\n x y z x y z \n"), (8, "é# |")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame([(a, b, True) for a, b in rows], "doc_id long, text string, kept boolean")).collect()}
    assert (got[1].n_words, got[1].base_failed, got[1].kept) == (0, True, False)
    assert (got[3].n_dup_lines, got[3].n_repeat_words, got[3].n_words) == (2, 4, 4)
    assert got[None].n_repeat_words == 6 and got[8].word_chars == 3 and got[8].n_symbols == 2
    assert not got[5].kept and got[5].reason == "repetitive" and not got[5].n_dup_lines
    assert got[6].base_failed is False


def test_encoded_text_of_every_band_is_rejected_and_prose_kept(spark):
    rng = random.Random(20)
    common = [*EN.split(), "and", "of", "the", "it", "is", "as", "on", "by"]
    some = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    prose, encoded = {}, {}
    for k, n in enumerate([256, 319, 383, 511, 767, 1023, 2047, 4095, 4096, 8192, 16383, 20_000, 140_000]):
        raw = base64.b64encode(rng.randbytes(n)).decode()
        for j in range(10 if n < 20_000 else 1):
            words = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n // 4))
            encoded |= {1000 * k + 3 * j: raw[j:][:n], 1000 * k + 3 * j + 1: "\n".join(raw[i : i + 76] for i in range(j, len(raw), 76))[:n], 1000 * k + 3 * j + 2: words[:n]}
            if n > 400:
                prose[1000 * k + 500 + j] = " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(some) for _ in range(n))[:n]
    df = spark.createDataFrame([*encoded.items(), *prose.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert {got[i].reason for i in encoded} == {"incompressible"} and not any(got[i].kept for i in encoded)
    assert [(i, got[i].ratio) for i in prose if not got[i].kept] == []


def test_chunk_rule_judges_every_byte(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(2000)]
    prose = lambda n: (" ".join(rng.choice(words) for _ in range(n)))[:n]
    again = ("the same sentence comes once more and then again. " * 200)[:3700]
    head = prose(4300)
    rows = [(1, head + again), (2, again + head), (3, prose(4096 + 255)), (4, prose(3000)), (5, prose(255)), (6, prose(2 * 4096 + 300)), (7, prose(4096) + again[:256])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert got[1].ratio < 4.5 and got[1].reason == got[2].reason == "chunks" and not got[1].kept
    assert got[1].bad_chunk_share == pytest.approx((8000 - 4096) / 8000)
    assert [got[k].bad_chunk_share for k in (3, 4, 5, 6)] == [0, 0, None, 0] and all(got[k].kept for k in (3, 4, 6))
    assert got[7].bad_chunk_share == pytest.approx(256 / 4352)


def test_quality_rules_counts_are_brute_force():
    rng = random.Random(9)
    docs = ["".join(rng.choice(["a", "b ", "\n", " ", "c d", "#", "é", "\x0b", " "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    got = quality_rules.base_counts(textcore.words(pa.array(docs, pa.large_string())))
    for k, t in enumerate(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        cover = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), t.count("#"), len(lines) - len(set(lines)), len(cover))
        assert tuple(int(got[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def best_by_hand(rows, every, k=10):
    """rows: (vec_id, vector); the k best of each query row divisible by every, in Python integers."""
    held = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in held if i % every == 0}:
        scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, x)))), j) for j, x in held if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 8])
def test_topk_is_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block)
    rng = np.random.default_rng(10)
    x = rng.normal(0, 0.3, (300, 6))
    x[50:120] = x[50]
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)] + [(400, None), (401, [float("nan")] * 6), (402, [1.0]), (None, [0.0] * 6), (403, [None] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, q string, cell int")
    got = sorted(map(tuple, topk_search.topk(df.where("vec_id % 50 = 0"), df).collect()))
    assert got == best_by_hand(rows, 50) and len(got) == 60


def test_topk_takes_vectors_of_every_length_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CELLS", 64)
    rng = np.random.default_rng(11)
    rows = [(int(i), [float(c) for c in rng.normal(0, 0.5, int(rng.integers(0, 9)))]) for i in range(150)]
    rows += [(10, [0.5, -0.25]), (10, [-0.5, 0.25, 2.0]), (20, rows[20][1]), (30, []), (500, [float(c) for c in rng.normal(0, 0.5, 3000)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_search.topk(df.where("vec_id % 10 = 0"), df).collect()))
    assert got == best_by_hand(rows, 10)


def test_topk_of_large_components(spark):
    rows = [(i, [3e6 * (i - 4), 1e4]) for i in range(9)] + [(i, [3e12 * (i - 12), 1e12]) for i in range(9, 17)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk_search.topk(df.where("vec_id % 8 = 0"), df, 3).collect())) == best_by_hand(rows, 8, 3)


def test_dot_products_of_sql(spark):
    import duckdb

    rng = np.random.default_rng(12)
    rows = [(int(i), [float(c) for c in rng.normal(0, 0.5, int(rng.integers(0, 5)))]) for i in range(201)] + [(100, [0.5]), (100, [0.5]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    embeddings = df.toArrow()  # noqa: F841  read by name
    want = sorted(duckdb.sql(topk_search.ORACLE).fetchall())
    assert sorted(map(tuple, topk_search.topk(df.where("vec_id % 100 = 0"), df).collect())) == want


def test_topk_of_nothing_and_of_few(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk_search.topk(few.where("vec_id = 0"), few).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk_search.topk(few.limit(0), few.limit(0)).count() == 0
