"""The pipeline against a brute-force version of its stages on a small fixture."""

import os
import random
import re
import subprocess
import sys
import tempfile

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def fixture():
    rng = random.Random(12)
    en, de = "the of and to in that was with for this".split(), "der die und das nicht ein mit ist wir auch".split()
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    text = lambda n, common: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    passage = text(70, en)
    docs = {}
    for i in range(24):
        docs[i] = text(rng.randint(60, 140), en if i % 2 else de)
    docs[30] = list(docs[3])
    docs[31] = docs[4][:40] + ["changed"] + docs[4][41:]
    docs[40] = text(30, en) + passage + text(20, en)
    docs[41] = text(25, en) + passage + text(90, en)
    docs[50] = text(40, en) + ["write", "to", "ann.lee@mail.example.com", "or", "10.1.2.3", "now"]
    rows = [(i, " ".join(w), "de" if i < 24 and i % 2 == 0 else "en") for i, w in docs.items()]
    return rows + [(60, "12345 ... 678", "en"), (61, None, None), (62, "", "en")]


def expected(rows):
    docs = {i: t for i, t, _ in rows if t and re.search(r"[^\W\d_]", t)}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in docs.items()}
    label = {i: i for i in docs}
    for _ in docs:
        label = {i: min(label[j] for j in docs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in docs}
    docs = {i: t for i, t in docs.items() if label[i] == i}
    first = {}
    for i in sorted(docs):
        w = docs[i].split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    out = {}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t in docs.items():
        w = t.split()
        gone = {j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        if len(gone) == len(w):
            continue
        parts = re.findall(r"\S+\s*", t)
        t = "".join(p for k, p in enumerate(parts) if k not in gone)
        t = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", t)
        t = re.sub(r"\b[0-9]+(\.[0-9]+){3}", "[IP]", t)
        out[i] = len(tok.encode(t, add_special_tokens=False).ids) + 1
    return out


def test_run_is_brute_force(spark, tmp_path):
    rows = fixture()
    df = spark.createDataFrame([(i, t, g, "s", len(t) if t is not None else None) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = expected(rows)
    assert got == want and 30 not in got and 31 not in got and 60 not in got
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(dict((i, t) for i, t, _ in rows)[41], add_special_tokens=False)
    assert want[41] < len(whole.ids) - 70 and docs.count() == len(rows)


def test_stages_keep_extra_columns_and_rows_without_an_id(spark):
    rng = random.Random(30)
    text = lambda n: " ".join(rng.choice(["the", "of", "and", "reed", "onshen", "thin", "erble", "anre"]) + rng.choice(["", "s", "ly", "er"]) for _ in range(n))
    one, two = text(120), text(90)
    rows = [(1, one, 0.5, "k1", "m"), (1, two, 0.6, "k2", "m"), (None, one, 0.7, "k3", None), (None, None, 0.8, "k4", "m"), (4, "漢字 漢字", 0.9, "k5", "m"), (5, "", 1.0, "k6", "m"), (6, one, 1.1, "k7", "m")]
    rows += [(10 + k, text(60) + f" call +1 (377) 555-{1000 + k}", 2.0, "x", "y") for k in range(12)]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), a, b, c) for i, t, a, b, c in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, kept_text string, masked string")
    extra = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and stage(spark, docs.limit(0), "").count() == 0
        extra[name] = {(r.doc_id, r.score, r.kept_text, r.masked) for r in out.collect()}
    every = {(i, a, b, c) for i, _, a, b, c in rows}
    assert all(x <= every for x in extra.values()) and extra["personal_data"] == every and len(every - extra["passages"]) <= 2
    assert {x[2] for x in every - extra["language"]} == {"k4", "k5", "k6"}
    assert {x[2] for x in every - extra["near_duplicates"]} == {"k7"}
    masked = corpus_pipeline.personal_data(spark, docs, "").where("doc_id = 10").first()
    assert masked.text.endswith("[PHONE]") and masked.n_chars == len(masked.text)
    packed = corpus_pipeline.packed(spark, docs, "")
    assert packed.count() == len(rows) and corpus_pipeline.packed(spark, docs.limit(0), "").count() == 0


def test_a_column_called_like_an_inner_one_stays(spark):
    text = "the reed and the thin reed of onshen were there for all the erble to see and hear "
    df = spark.createDataFrame([(1, text * 3, f"own {k}", 5) for k in range(2)] + [(2, text * 3 + "end", "two", 6), (3, "another text of other words that is not near any of them", "three", 7)], "doc_id long, text string, _text_hash string, th int")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted((r.doc_id, r._text_hash[:3]) for r in got.collect()) == [(1, "own"), (3, "thr")]


def test_scratch_folder_of_a_session_without_one():
    code = """
import os
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.conf.unset("spark.checkpoint.dir") if spark.conf.isModifiable("spark.checkpoint.dir") else None
from verdancy.llm import common, jaccard_join
assert not spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.checkpoint.dir")
df = spark.createDataFrame([(k, "one two three four five six seven " + "eight " * (k // 2)) for k in range(6)], "doc_id long, text string")
assert jaccard_join.grouped_rows(df).count() == 6
assert common.shared_dir(spark) == common.shared_dir(spark)
"""
    empty = tempfile.mkdtemp(prefix="spark-conf-", dir="/tmp")
    env = os.environ | {"SPARK_CONF_DIR": empty, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=300)
