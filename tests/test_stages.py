"""Stages, converters, picks and streams on small fixtures, some against brute force."""

import json
import random

import pytest
from pyspark.sql import functions as F

from verdancy.functions import text as X
from verdancy.operators import dedup as DD
from verdancy.operators import fixsets as FX
from verdancy.operators import rows as RW
from verdancy.operators import stages as S
from verdancy.sources import converters as CV
from verdancy.sources import records as RC
from verdancy.streaming import exact_dedup_stream, usage_stream

ROW = f"id string, lang string, source string, license string, split string, tags array<string>, state string, state_kind string, questions {RW.QUESTIONS}, targets {RW.TARGETS}, reasoning string"


def question(field="q", kind="noul", instructions="Is it so?", options=()):
    return (field, kind, instructions, [(v, d) for v, d in options])


def row(i, state, questions=None, targets=None, lang="en", tags=("group:g",), kind="string"):
    return (i, lang, "gen:x", "CC0-1.0", "train", list(tags), state, kind, questions or [question()], targets or [("q", "yes", ["no", "yes"], [0.1, 0.9])], None)


def keep_first(rows):
    """The order-dependent pass over (id, key, group, whole) by hand, bands from the library's own hashes."""
    kept, exact, whole, out = [], {}, {}, {}
    bands = DD.band_hashes([r[1] for r in rows]).tolist()
    for r, b in zip(rows, bands):
        i, key, group, same = r
        if same in whole:
            out[i] = (whole[same], "identical_row")
            continue
        whole[same] = i
        if key in exact and exact[key][1] != group:
            out[i] = (exact[key][0], "exact")
            continue
        near = [k for k, g, c in kept if g != group and any(x == y for x, y in zip(b, c))]
        if near:
            out[i] = (near[0], "minhash")
            continue
        exact.setdefault(key, (i, group))
        kept.append((i, group, b))
        out[i] = (None, None)
    return out


def texts(n, seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(["kunde", "meldet", "paket", "lieferung", "seit", "tagen", "nicht", "da", "rechnung", "hoch"]) for _ in range(30)) for _ in range(12)]
    out = []
    for _ in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(["neu", "alt", "x"])
        out.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
    return out


def test_dedup_is_the_sequential_pass(spark):
    rng = random.Random(2)
    rows = [(k, t, f"g{rng.randint(0, 4)}", str(rng.randint(0, 2))) for k, t in enumerate(texts(150, 1) + ["ab", "ab", "", ""])]
    df = spark.createDataFrame(rows, "ord long, state string, g string, q string")
    key = X.state_key(F.col("state"))
    got = {r.ord: (r.dup_of, r.kind) for r in DD.dedup(df, key, F.col("g"), X.canonical_sha(key, F.col("q")), "ord").collect()}
    plain = lambda t: " ".join(t.lower().split())
    want = keep_first([(k, plain(t), g, (plain(t), q)) for k, t, g, q in rows])
    assert got == want and {k for _, k in want.values()} == {None, "identical_row", "exact", "minhash"}


def test_band_hashes_of_a_batch_are_those_of_each_key():
    keys = ["abcdefgh", "", "abc", "x" * 50, "abcdefgh", "ünïcödé text"]
    together = DD.band_hashes(keys)
    assert (together == [DD.band_hashes([k])[0] for k in keys]).all() and (together[0] == together[4]).all()


def test_assemble_unions_gates_and_deduplicates(spark):
    states = texts(40, 5)
    rows = [row(f"r{k:02d}", t, tags=[f"group:g{k % 3}"], lang="fr" if k % 10 == 9 else "en") for k, t in enumerate(states)]
    bad = [row("z1", "short"), row("z2", "a state long enough", [question(kind="other")]), row("z3", "a state long enough here", targets=[("q", "no", ["no", "yes"], [0.1, 0.9])])]
    unknown = row("u1", "nobody can say from this text", targets=[("q", "unknown", ["no", "yes", "unknown"], [0.1, 0.1, 0.8])], tags=["group:u"])
    one, two = spark.createDataFrame([rows[k] for k in range(20)] + bad, ROW), spark.createDataFrame(rows[20:] + [unknown], ROW)
    traces = spark.createDataFrame([("r03", "because", "lab/m"), ("u1", "as", "lab/n")], "id string, trace string, model string")
    kept, drops = S.assembled([two, one], traces)
    got = {r.id: r for r in kept.collect()}
    gone = {r.id: (r.reason, r.detail) for r in drops.collect()}
    assert gone["z1"] == ("row_check", "state too short") and gone["z2"][1] == "q: unknown type" and gone["z3"][1] == "q: label is not the argmax"
    assert gone["r09"] == ("row_check", "bad lang") and got["u1"].abstain and got["u1"].reasoning == "as" and "reasoner:lab/n" in got["u1"].tags
    order = sorted([r for r in rows[20:] if r[1] == "en"] + [unknown], key=lambda r: r[0]) + sorted((r for r in rows[:20] if r[1] == "en"), key=lambda r: r[0])
    plain = lambda t: " ".join(t.lower().split())
    want = keep_first([(r[0], plain(r[6]), r[5][0][6:], (plain(r[6]), str(r[8:10]))) for r in order])
    for i, (dup, kind) in want.items():
        assert (i in got) if kind is None else gone[i] == (f"duplicate_{kind}", dup)


def test_salvage_folds_names_and_drops_malformed_questions(spark):
    questions = [question("Größe"), question("Groesse"), question("2x", "choice", "Which?", [("a", "x"), ("b", "y")]), question("ok", "score", "How?", [("0", "low"), ("1", "")])]
    df = spark.createDataFrame([row("a", "ein Zustand mit genug Text", questions, lang="de"), row("b", "mail max@firma.de now please", [question(), question("r")])], ROW)
    got = {r.id: r for r in S.validated(df, 2).collect()}
    assert [q.field for q in got["a"].questions] == ["Groesse_x", "Groesse", "q_2x"] and got["a"].reason is None
    assert got["a"].notes == ["renamed 'Größe'", "renamed '2x'", "dropped malformed question ok: empty score level"]
    assert got["b"].pii_replaced == 1 and "firma" not in got["b"].state and got["b"].reason is None
    few = S.validated(spark.createDataFrame([row("c", "a state long enough", questions[3:] + [question()])], ROW), 2).first()
    assert (few.reason, few.detail) == ("schema", "dropped malformed question ok: empty score level")


@pytest.mark.parametrize(
    "state, questions, problem",
    [
        ('{"a": "zwei neue Worte", "n": 7}', None, None),
        ('{"a": "zwei neue Worte", "n": "7"}', None, "state structure changed"),
        ('{"a": "zwei neue Worte", "n": 8}', None, "numbers in the state changed"),
        (None, None, "missing state or questions"),
        ('{"a": "x x x x x x x x x x", "n": 7}', None, "state length changed too much"),
        ('{"a": "zwei alte Worte", "n": 7}', [question("other"), question("s", "score", "How?", [("0", "a"), ("1", "b")])], "field names changed"),
        ('{"a": "zwei alte Worte", "n": 7}', [question("q", "score", "How?", [("0", "a"), ("1", "b")]), question("s", "score", "How?", [("0", "a"), ("1", "b")])], "q: type changed"),
        ('{"a": "zwei alte Worte", "n": 7}', [question("q"), question("s", "score", "How?", [("0", "a")])], "s: score levels changed"),
    ],
)
def test_edits(spark, state, questions, problem):
    old = [question("q"), question("s", "score", "How?", [("0", "a"), ("1", "b")])]
    rows = spark.createDataFrame([row("a", '{"a": "zwei alte Worte", "n": 7}', old, kind="json")], ROW)
    replies = spark.createDataFrame([("a", state, questions or old)], f"id string, state string, questions {RW.QUESTIONS}")
    got = S.edited(rows, replies).first()
    assert got.edit_problem == problem and got.edit == ("rejected" if problem else "changed")


def test_heads_become_records(spark):
    at = iter(range(100))
    head = lambda i, g, state, field, kind="choice", options=("one: first", "two"), target=(1.0, 3.0), lang="en", lic="CC0-1.0": (f"x:{i}", g, "src", state, "string", kind, "Which?", list(options), list(target), field, lang, lic, next(at), "f1")
    rows = [head(k, "g1", "the same long state", "f") for k in range(3)] + [head(9, "g1", "the same long state", "n", "noul", (), (0.25,), None)]
    rows += [head(20 + k, "g2", "another long state here", f"h{k}") for k in range(8)] + [head(40, "g1", "the same long state", "late")]
    rows += [head(50, "g3", "a state in another language", "t", lang="tr"), head(51, "g3", "a state without a licence", "t", lic="CC0-1.0 not verified")]
    df = spark.createDataFrame(rows, "id string, group_id string, source string, state string, state_kind string, kind string, question string, options array<string>, target array<double>, question_id string, language string, license string, ord int, file string")
    got = sorted((sorted(q.field for q in r.questions), r.state) for r in CV.grouped_heads(df, "en", "c", "file", "ord").collect())
    assert got == [(["f", "f_2", "f_2_2", "n"], "the same long state"), (["h0", "h1", "h2", "h3", "h4", "h5"], "another long state here"), (["h6", "h7"], "another long state here"), (["late"], "the same long state")]
    r = next(r for r in CV.grouped_heads(df, "en", "c", "file", "ord").collect() if len(r.questions) == 4)
    assert r.targets[0].label == "two" and r.targets[0].dist == pytest.approx([0.255, 0.745]) and r.questions[0].options[0].description == "first"
    assert r.targets[3].dist == pytest.approx([0.745, 0.255]) and r.id.startswith("en-p-openjev-") and "group:openjev-g1" in r.tags
    assert [x.tags[-1] for x in CV.grouped_heads(df, "tr", "c", "file", "ord").collect()] == ["qlang:en"]
    assert CV.grouped_heads(df, "en", "c", "file", "ord", limit=2).count() == 2


def test_typed_decisions_become_records(spark):
    q = {"good": {"type": "noul", "instructions": "Is it?"}, "team": {"type": "choice", "instructions": "Who?", "criteria": {"a": "x", "b": None}}, "mood": {"type": "score", "instructions": "How?", "criteria": ["low", "high"]}}
    gold = {"good": {"probabilities": {"true": 3, "false": 1}}, "team": {"probabilities": {"a": 0.2, "b": 0.8}}, "mood": {"probabilities": {"0": 0.5, "1": 0.5}}}
    none = {**gold, "team": {"probabilities": {"a": 0, "b": 0}}}
    rows = [(1, "a state with enough text", "w", json.dumps(q), json.dumps(gold)), (2, "a state with enough text", "w", json.dumps(q), json.dumps(none))]
    df = spark.createDataFrame(rows, "id long, state string, workflow string, questions string, gold string")
    (r,) = CV.typed_decisions(df).collect()
    assert [(t.field, t.label, t.dist) for t in r.targets] == [("good", "yes", [0.25, 0.75]), ("team", "b", [0.2, 0.8]), ("mood", "0", [0.5, 0.5])]
    assert [o.value for o in r.questions[1].options] == ["a", "b"] and r.questions[2].options[1].description == "high" and r.id == "en-p-typed-1"
    with pytest.raises(ValueError):
        CV.typed_decisions(df, "test")


def test_label_names_from_a_footer(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    meta = {b"huggingface": json.dumps({"info": {"features": {"intent": {"names": ["a_x", "b_y"]}}}}).encode()}
    pq.write_table(pa.table({"intent": [0, 1]}).replace_schema_metadata(meta), tmp_path / "x.parquet")
    assert CV.label_names(spark, str(tmp_path / "x.parquet"), "intent") == ["a_x", "b_y"]


def test_hash_samples_and_permutations(spark):
    df = spark.range(5000)
    assert DD.take(df, 7, 1, "id").count() == 7 and DD.take(df, 0, 1, "id").count() == 5000
    some = {r.id for r in DD.sampled(df, 0.2, 3, "id").collect()}
    assert 800 < len(some) < 1200 and some == {r.id for r in DD.sampled(df.repartition(7), 0.2, 3, "id").collect()}
    options = df.limit(50).withColumn("o", F.array(*[F.lit(c) for c in "abcd"]))
    got = FX.permutations(options, "o", "id", 5).collect()
    assert len(got) == 150 and all(sorted(r.o) == list("abcd") for r in got) and len({tuple(r.o) for r in got}) > 10


def test_stage_tables_logs_and_drops(spark, tmp_path):
    df = spark.createDataFrame([("a", "en", None), ("b", "de", "bad")], "id string, lang string, reason string")
    kept, drops = RC.split_kept(df, "reason", "qa")
    RC.write_stage(kept, str(tmp_path / "s"), "r1", "g")
    RC.write_stage(df.drop("reason"), str(tmp_path / "s"), "r2", "g")
    RC.write_stage(kept, str(tmp_path / "s"), "r1", "g")
    assert [r.id for r in RC.read_stage(spark, str(tmp_path / "s"), "r1", "g").collect()] == ["a"]
    assert [tuple(r) for r in drops.collect()] == [("qa", "b", "bad")]
    for k in range(2):
        RC.append_log(spark.createDataFrame([(k, "Bearer abc.def token")], "k int, msg string"), str(tmp_path / "log"), "msg")
    lines = spark.read.json(str(tmp_path / "log")).collect()
    assert len(lines) == 2 and all("[redacted]" in r.msg for r in lines)


def test_streams(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "A  b", "m", 1.0), ("2024-01-01 00:01:00", "a b", "m", 2.0), ("2024-01-01 02:00:00", "c", "n", 4.0)]
    df = spark.createDataFrame(rows, "t string, state string, model string, seconds double").withColumn("t", F.to_timestamp("t"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))

    def result(out, name, mode):
        query = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination(120)
        return spark.table(name).collect()

    assert sorted(r.state_key for r in result(exact_dedup_stream(stream, "t", "1 hour"), "firsts", "append")) == ["a b", "c"]
    assert sorted((r.model, r.calls, r.seconds) for r in result(usage_stream(stream, "t", "1 hour", "10 minutes"), "usage", "complete")) == [("m", 2, 3.0), ("n", 1, 4.0)]


def test_sets_fail_alone_and_rounds_top_up(spark):
    written = {}
    failed = S.fix_stage({"f1": lambda: spark.range(3), "f2": lambda: 1 / 0, "f3": lambda: spark.range(2)}, lambda name, df: written.update({name: df.count()}))
    assert written == {"f1": 3, "f3": 2} and failed == [("f2", "ZeroDivisionError: division by zero")]
    asked = []
    rows = S.topped_up(lambda k, missing: (asked.append(missing), spark.range(10 * k, 10 * k + 4))[1], 10)
    assert asked == [10, 6, 2] and rows.count() == 10


def test_command_line_runs_queries_and_answers_requests(spark, tmp_path, capsys):
    from verdancy.__main__ import main

    assert main(["list"]) == 0 and "dedup_split_report" in capsys.readouterr().out.split()
    assert main(["run", "word_counts", "/root/testdata/sf0.001", str(tmp_path / "out")]) == 0 and spark.read.parquet(str(tmp_path / "out")).count() == 200
    assert main(["run", "no_such", "x", "y"]) == 2
    field = {"id": "r1", "field": "team", "pos": 0, "kind": "choice", "lang": "en", "values": ["a", "b", "c"], "logits": [0.0, 2.0, 0.0], "reasoning": "off", "prompt_tokens": 7}
    lines = [field, {**field, "field": "urgent", "pos": 1, "kind": "noul", "values": ["no", "yes"], "logits": [0.0, 1.0]}]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, lines)))
    (tmp_path / "cal.json").write_text(json.dumps({"temperatures": {"choice:en": 2.0}, "auto_threshold": {"choice": 0.9}}))
    assert main(["predict", str(tmp_path / "in.jsonl"), str(tmp_path / "res"), "--calibration", str(tmp_path / "cal.json")]) == 0
    got = json.loads(next(p for p in (tmp_path / "res").glob("*.json") if p.read_text()).read_text())
    e = 2.718281828459045
    assert got["answers"]["team"]["choice"] == "b" and got["answers"]["team"]["probabilities"] == pytest.approx([1 / (2 + e), e / (2 + e), 1 / (2 + e)])
    assert got["answers"]["urgent"]["noul"] == pytest.approx(e / (1 + e)) and "score" not in got["answers"]["urgent"] and got["usage"] == {"input_tokens": 7, "output_tokens": 2}
    assert all(t.count() == 0 for t in RC.calibration(spark, "")) and RC.stage_path("r", "x", "de", "g") == "r/run=x/lang=de/stage=g"


def test_language_is_judged_on_the_state_as_it_came(spark):
    """The letters of the questions and of replaced contact data do not count."""
    ask = [question("a", instructions="Is it so, and if it is, why should it be so?"), question("b")]
    mail = "ein Paket von a@" + "b" * 100 + ".de "
    rows = [row("short", "Die Kiste kam heute hier an und war leer. " * 11 + "Nun.", ask, lang="de"), row("long", mail + "Die Kiste kam heute hier an. " * 14, ask, lang="de"), row("few", "zu 3 4 5 6 7 8 9 10 11 12", ask, lang="de")]
    df = spark.createDataFrame(rows, ROW).withColumn("detected", F.expr("struct(if(id = 'few', 'xx', 'de') as label, 0.9D as probability, array(struct(50 as n, 'de' as label)) as segments)"))
    got = {r.id: r.language for r in S.validated(df, 1).collect()}
    assert not got["short"].folded and got["short"].ok
    assert got["long"].folded and not got["long"].ok
    assert got["few"].ok and not got["few"].detected


def test_salvage_reads_its_questions_once(spark):
    """The steps of the salvage are not repeated inside the lambdas that read them, neither in the rows nor in a filter on the reason."""
    asked = F.from_json(F.col("state"), RW.QUESTIONS)
    df = spark.createDataFrame([row("a", "[]")], ROW).withColumn("questions", asked)
    drops = S.validated(df, 1).where("reason is not null").select("reason")
    assert len(drops._jdf.queryExecution().optimizedPlan().toString()) < 200_000
