import json
import random
import re

import pytest
from pyspark.sql import functions as F

from verdancy.functions import checks as C
from verdancy.functions import text as X
from verdancy.functions import contact as CT
from verdancy.functions import jsontext as J
from verdancy.functions import locale as LO
from verdancy.operators import stats as ST


def col(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def question(field="team", kind="choice", instructions="Which team?", options=(("billing", "Payments"), ("shipping", "Deliveries"))):
    opts = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(d).cast("string").alias("description")) for v, d in options]) if options else F.array().cast("array<struct<value:string,description:string>>")
    return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("type"), F.lit(instructions).alias("instructions"), opts.alias("options"))


@pytest.mark.parametrize(
    "q, problem",
    [
        (dict(), None),
        (dict(field="1x"), "bad field name"),
        (dict(instructions=" "), "empty instructions"),
        (dict(options=(("a", "x"),)), "choice needs 2 to 60 options"),
        (dict(options=(("a b", "x"), ("c", "y"))), "bad option label"),
        (dict(options=(("A", "x"), ("a", "y"))), "duplicate option labels"),
        (dict(options=(("unknown", "x"), ("a", "y"))), "option label 'unknown' is reserved"),
        (dict(kind="score", options=(("0", "low"), ("1", ""))), "empty score level"),
        (dict(kind="noul", options=(("yes", "x"),)), "noul criteria must describe yes and no"),
        (dict(kind="noul", options=()), None),
        (dict(kind="other"), "unknown type"),
    ],
)
def test_question_checks(spark, q, problem):
    assert col(spark, C.question_problems(question(**q))) == ([problem] if problem else [])


def test_row_and_target_checks(spark):
    ok = C.row_problems(F.lit("A state of some length."), F.lit("string"), F.array(question()))
    short = C.row_problems(F.lit("short"), F.lit("string"), F.array(question()))
    assert col(spark, ok) == [] and col(spark, short) == ["state too short"]
    vals = F.array(F.lit("a"), F.lit("b"))
    assert col(spark, C.target_problems(vals, F.array(F.lit(0.4), F.lit(0.6)), F.lit("b"))) == []
    assert col(spark, C.target_problems(vals, F.array(F.lit(0.4), F.lit(0.5)), F.lit("a"))) == ["dist does not sum to 1", "label is not the argmax"]


def test_folds_hints_and_tags(spark):
    assert col(spark, X.ascii_ident(F.lit("Größe der Tür"), "de")) == "Groesse_der_Tuer"
    assert col(spark, X.ascii_ident(F.lit("2 ürün"), "tr")) == "q_2_urun"
    assert col(spark, X.language_hint(F.lit("Bitte senden Sie mir die Rechnung und nicht mehr"))) == "de"
    assert col(spark, X.language_hint(F.lit("Sipariş gelmedi, lütfen yardım"))) == "tr"
    assert col(spark, X.tag(F.array(F.lit("a:1"), F.lit("group:g2"), F.lit("group:g3")), "group")) == "g2"
    assert col(spark, X.state_key(F.lit("  A  B\n"))) == "a b"
    assert col(spark, C.announces(F.lit("Die richtige Antwort ist A"))) and not col(spark, C.announces(F.lit("no hint")))


def test_scrub_replaces_and_is_stable(spark):
    text = "Mail max@firma.de, IBAN DE89 3704 0044 0532 0130 00, call (212) 555-7788, card 4111 1111 1111 1111, order 20250001234."
    once, n = CT.scrub_text(text, "en")
    assert n == 4 and "@example." in once and "DE00 3704" in once and "555-0188" in once and "order 20250001234" in once
    again = CT.scrub_text(once, "en")
    assert again[0] == once and again[1] <= 1  # a safe card number that still passes its check is found again
    nested, hits = CT.scrub_json_text('{"a": ["x@y.com", 3], "b@c.com": "no"}', "en")
    assert hits == 1 and '"b@c.com"' in nested and "x@example." in nested


MASK = re.compile("\x00(\\d+)\x00")


def masked_scrub(text, lang):
    """The same by numbered masks in the text."""
    held = []

    def step(pattern, safe):
        def one(m):
            new = safe(m, lang)
            held.append(m[0] if new is None else new)
            step.hits += new is not None
            return f"\x00{len(held) - 1}\x00"

        return pattern, one

    step.hits = 0
    for pattern, safe in CT.KINDS:
        compiled, one = step(pattern, safe)
        # masks are closed: look between them only
        text = "".join(part if k % 2 else compiled.sub(one, part) for k, part in enumerate(re.split("(\x00\\d+\x00)", text)))
    while MASK.search(text):
        text = MASK.sub(lambda m: held[int(m[1])], text)
    return text, step.hits


def test_scrub_is_the_masked_pass():
    rng = random.Random(3)
    parts = ["max@firma.de", "a@example.com", "DE89370400440532013000", "TC: ", "kimlik no ", "12345678901", "4111 1111 1111 1111", "4111111111111112", "+49 30 1234567", "0212 555 77 88", " ", ", ", "x", "20250001234", "(212) 555-7788", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))
        for lang in ("en", "tr"):
            assert CT.scrub_text(text, lang) == masked_scrub(text, lang)


def test_scrub_survives_any_text(spark):
    rows = [("a\x00b max@firma.de \x00", "en"), (None, "en"), ("", "de"), ('{"a": "max@firma.de"', "en"), ('{"a": ["max@firma.de", {"b": 1}], "max@firma.de": null}', "en")]
    df = spark.createDataFrame(rows, "t string, lang string")
    plain = [r.s for r in df.select(CT.scrub("t", "lang").alias("s")).collect()]
    assert plain[0].hits == 1 and plain[0].text.startswith("a\x00b max@example.") and plain[1].text is None and plain[2].text == ""
    found = [r.s for r in df.select(CT.scrub_json("t", "lang").alias("s")).collect()]
    assert found[3] == (None, None, "invalid JSON") and found[4].hits == 1 and json.loads(found[4].text)["max@firma.de"] is None


def python_bytes(df, metric):
    """What the Arrow UDFs of df have exchanged with Python, after df.collect()."""

    def walk(plan):
        metrics, below = plan.metrics(), plan.children()
        own = metrics.apply(metric).value() if "ArrowEvalPython" in plan.nodeName() else 0
        return own + sum(walk(below.apply(k)) for k in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_scrub_exchanges_only_what_may_change(spark):
    words = "plain words ă ß " * 300
    texts = [words if k % 50 else words + "max@firma.de" for k in range(1000)] + [words + "7", words + "٣", "", None]
    df = spark.createDataFrame([(t, "en") for t in texts], "t string, lang string").coalesce(1).select("t", "lang", CT.scrub("t", "lang").alias("s"))
    got = df.collect()
    assert all((r.s.text, r.s.hits) == (CT.scrub_text(r.t, "en") if r.t is not None else (None, 0)) and r.s.problem is None for r in got)
    assert sum(r.s.hits for r in got) == 20
    size = sum(len(t or "") for t in texts)
    assert 0 < python_bytes(df, "pythonDataSent") < size / 10 and 0 < python_bytes(df, "pythonDataReceived") < size / 10


def test_scrub_knows_every_digit_that_python_knows(spark):
    import sys
    import unicodedata

    digits = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    df = spark.createDataFrame([(d,) for d in digits], "d string").where(~F.col("d").rlike(CT.NEEDED_BY_ANY))
    assert len(digits) > 600 and df.count() == 0


def test_json_from_chatter(spark):
    df = spark.createDataFrame([('Sure: ```json\n{"a": 1}\n```',), ('{"a": [1, 2',), ("none",), (None,), ("```json\n3.5\n```",), ('[x] then {"b": [1]}',), ('{"a": {"b": 1}',)], "t string")
    assert [r.x for r in df.select(J.extract_json(F.col("t")).alias("x")).collect()] == ['{"a":1}', None, None, None, "3.5", '{"b":[1]}', '{"b":1}']


def test_cards_never_give_an_inner_object(spark):
    reply = '### card 1\n{"q": {"type": "choice"}, "n": 1}\n##Card 2\n{"a": {"q": 1}\n```\n### CARD 3\n{"a": [{"q": 1}, {]}\n### card 4\nnothing\n### card 5\n{"questions": {"q": {"type": "x"}, "writer_dist": {"q": 1}}\n'
    df = spark.createDataFrame([(reply,), (None,), ("no mark",)], "t string")
    got = [r.c for r in df.select(J.card_blocks("t").alias("c")).collect()]
    assert [tuple(c) for c in got[0]] == [
        (1, '{"q":{"type":"choice"},"n":1}', None), (2, '{"a":{"q":1}}', None), (3, None, "invalid JSON"), (4, None, "no JSON object"),
        (5, '{"questions":{"q":{"type":"x"}},"writer_dist":{"q":1}}', None),
    ]
    assert got[1] == got[2] == []


def test_values_shapes_and_pretty_text(spark):
    state = '{"b": ["Ein Satz hier", "id_4", 2, 2.5, null, true], "a": {"k:": "mehr \\"Text\\""}}'
    df = spark.createDataFrame([(state, "json"), ("plain words", "string"), ("{broken", "json"), (None, "string")], "t string, k string")
    assert [r.x for r in df.select(J.natural_text("t", "k").alias("x")).collect()] == [["Ein Satz hier", 'mehr "Text"'], ["plain words"], ["{broken"], []]
    assert [r.x for r in df.select(J.shape("t").alias("x")).collect()] == ['{"a": {"k:": str}, "b": [str, str, int, float, NoneType, bool]}', None, None, None]
    pretty = [r.x for r in df.select(J.pretty_json("t").alias("x")).collect()]
    assert json.loads(pretty[0]) == json.loads(state) and pretty[1:] == [None, None, None]


def test_deeply_nested_text_ends_no_job(spark):
    deep = '{"a":' * 20_000
    df = spark.createDataFrame([(deep,), ("[" * 20_000 + "1" + "]" * 20_000,)], "t string")
    out = df.select(J.shape("t").alias("s"), J.pretty_json("t").alias("p"), CT.scrub_json("t", F.lit("en")).alias("c"), J.card_blocks(F.concat(F.lit("### card 1\n"), "t")).alias("k")).collect()
    assert all(r.s is None and r.p is None and r.c.problem == "invalid JSON" for r in out) and out[0].k[0].row is None


def test_folds_of_letters(spark):
    assert col(spark, X.fold(F.lit("Ğül-İstanbul ĄŻ ñ é ﬀ Straße"))) == "gul istanbul az n e strasse"
    assert col(spark, X.ascii_ident(F.lit("Çağrı Ŝ"), "tr")) == "Cagri_S" and col(spark, X.ascii_ident(F.lit("漢字"))) == "field"
    assert col(spark, X.ascii_ident_of(F.lit("Größe"), F.lit("de"))) == "Groesse" and col(spark, X.ascii_ident_of(F.lit("Größe"), F.lit("en"))) == "Groe"


def test_slots_are_filled_once(spark):
    got = X.filled(F.lit("{a} and {b}, {c} {a}"), {"a": F.lit("{b}"), "b": F.lit("$1\\")})
    assert col(spark, got) == "{b} and $1\\, {c} {b}"
    raw = X.raw_filled(F.lit('{"n": "{n}", "t": "has {n}"}'), {"n": F.lit("[1, 2]")})
    assert col(spark, X.filled(raw, {"n": F.lit("x")})) == '{"n": [1, 2], "t": "has x"}'


def test_fixed_decimals_round_the_binary_value(spark):
    rng = random.Random(2)
    values = [0.25, 0.35, 0.05, 0.15, 12.25, 0.0625, 2.5, 0.5, 1.5, -0.25, -0.04, 0.0, -0.0, 9.995, 99.95, 1e-300, float("nan"), float("inf"), -float("inf")]
    values += [k / 16 for k in range(200)] + [k / 1000 + 0.0005 for k in range(1000)] + [rng.random() * 10 ** rng.randint(-3, 9) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2, 3):
        for r in df.select("x", X.fixed_text(F.col("x"), digits).alias("t")).collect():
            assert r.t == f"{r.x:.{digits}f}"


def test_texts_of_exact_ties(spark):
    x = F.col("x")
    row = spark.createDataFrame([(0.0625,)], "x double").select(
        X.percent(F.lit(49), F.lit(400)), LO.percent_text(x * 1.96), LO.points_text(x * 1.96), LO.decimal_text(x), ST.gold_position(F.lit(1), F.lit(5)), ST.share_text(F.lit(49), F.lit(400)), LO.decimal_text(F.lit(None).cast("double"))
    ).first()
    assert tuple(row) == ("12.2%", "12.2%", "12.2 pts", "0.062", "0.2", "49/400 (12.2%)", "-")
