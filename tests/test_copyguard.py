"""Shared runs of words against plain loops, and the row checks that use them."""

import random
import re
import time

from pyspark.sql import functions as F

from verdancy.functions import checks as C
from verdancy.operators import copyguard as G
from verdancy.operators import stages as S


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(text, n):
    t = tokens(text)
    return [" ".join(t[i : i + n]) for i in range(len(t) - n + 1)]


def corpus(seed, n, longest):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["Red", "blue", "été", "x1", "a-b", "the", "of", "_"]) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_first_copied_run_is_that_of_plain_loops(spark):
    reference = corpus(1, 12, 14) + [None, "", "one two three four"]
    texts = corpus(2, 120, 40) + [None, "", "ONE two, three-four", "one two three"]
    known = {r for t in reference for r in runs(t, 4)}
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    ref = spark.createDataFrame([(t,) for t in reference], "body string")
    got = {r.id: r.copied for r in G.with_copied(df, "body", ref, "body", "id", 4).collect()}
    assert got == {i: next((r for r in runs(t, 4) if r in known), None) for i, t in enumerate(texts)}
    hit = {r.id for r in G.contaminated(df, "body", ref, "body", "id", 4).collect()}
    assert hit == {i for i, r in got.items() if r is not None} and 0 < len(hit) < len(texts)


def test_a_full_filter_lets_nothing_wrong_through(spark, monkeypatch):
    monkeypatch.setattr(G, "MOST_BITS", 1 << 10)
    reference, texts = corpus(5, 300, 30), corpus(6, 60, 30)
    known = {r for t in reference for r in runs(t, 5)}
    ref = spark.createDataFrame([(t,) for t in reference], "body string")
    got = G.with_copied(spark.createDataFrame(list(enumerate(texts)), "id long, body string"), "body", ref, "body", "id", 5).collect()
    assert {r.id: r.copied for r in got} == {i: next((r for r in runs(t, 5) if r in known), None) for i, t in enumerate(texts)}


def test_an_empty_reference_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "id long, body string")
    none = df.where("false")
    assert [r.copied for r in G.with_copied(df, "body", none, "body", "id").collect()] == [None]
    assert G.with_copied(none, "body", df, "body", "id").count() == 0
    assert G.contaminated(df, "body", df, "body", "id").count() == 1


def test_long_texts_take_time_in_proportion(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, " ".join(f"w{i % 9973}x{i % 31}" for i in range(n)))], "id long, body string")
        began = time.time()
        assert G.contaminated(df, "body", df, "body", "id").count() == 1
        return time.time() - began

    seconds(1000)
    assert seconds(80_000) < 8 * max(seconds(20_000), 1)


def _row(spark, state, **more):
    option = lambda v: F.struct(F.lit(v).alias("value"), F.lit("what it means").alias("description"))
    ask = lambda field, text: F.struct(F.lit(field).alias("field"), F.lit("choice").alias("type"), F.lit(text).alias("instructions"), F.array(option("good"), option("bad")).alias("options"))
    questions = F.array(ask("a", "Is it good?"), ask("b", more.get("second", "Is it late?")))
    return spark.range(1).select(F.lit("r1").alias("id"), F.lit("en").alias("lang"), F.lit(state).alias("state"), F.lit("string").alias("state_kind"), questions.alias("questions"))


def test_validated_rows_copy_no_prompt(spark):
    prompts = spark.createDataFrame([("Write a state of one or two plain sentences here",)], "prompt string")
    clean = S.validated(_row(spark, "A parcel has been lost on its way."), prompts=(prompts, "prompt")).first()
    assert clean.reason is None and "copied" not in clean
    copied = S.validated(_row(spark, "A parcel. write a STATE, of one or two plain sentences."), prompts=(prompts, "prompt")).first()
    assert (copied.reason, copied.detail) == ("schema", "copies prompt text: 'write a state of one or two plain'")
    asked = S.validated(_row(spark, "A parcel has been lost.", second="Write a state of one or two plain sentences"), prompts=(prompts, "prompt")).first()
    assert asked.detail == "copies prompt text: 'write a state of one or two plain'"


def test_problems_come_in_order(spark):
    row = _row(spark, "<decision>")
    problems = lambda **k: row.select(C.row_problems(F.col("state"), F.col("state_kind"), F.col("questions"), **k)).first()[0]
    assert problems() == ["state too short", "reserved marker in text"]
    assert problems(least=3) == ["state too short", "need 3 to 6 questions"]
    fine = _row(spark, "A state of some length.")
    later = lambda **k: fine.select(C.row_problems(F.col("state"), F.col("state_kind"), F.col("questions"), **k)).first()[0]
    assert later(copied=F.lit("a b")) == ["copies prompt text: 'a b'"]
    assert later(denied=F.array(F.lit("some length")), copied=F.lit("a b")) == ["contains a denylisted name"]
    many = F.transform("questions", lambda q: q.withField("type", F.lit("noul")).withField("options", F.flatten(F.array_repeat(F.array(*[F.struct(F.lit(v).alias("value"), F.lit("d").alias("description")) for v in ("yes", "no")]), 32))))
    assert fine.select(C.row_problems(F.col("state"), F.col("state_kind"), many)).first()[0] == ["does not compile: question 'a' has too many options; the limit is 62"]
