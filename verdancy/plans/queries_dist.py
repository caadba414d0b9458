"""Queries over embeddings: slices of a vector stand for logits of options and of teachers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dist as D
from ..operators import compare as CP
from ..operators import decide as DC
from ..operators import fixsets as FX
from ..operators import labels as L
from ..operators import stats as ST
from .catalogue import query

VALUES = ("a", "b", "c", "unknown")
SOFTMAX = "list_transform({l}, lambda x: exp((x - list_max({l})) / {t}) / list_sum(list_transform({l}, lambda y: exp((y - list_max({l})) / {t}))))"


def _slice(k: int, width: int = 4):
    return F.transform(F.slice("embedding", 4 * k + 1, width), lambda x: x.cast("double"))


def _sql_slice(k: int, width: int = 4) -> str:
    return f"list_transform(embedding[{4 * k + 1}:{4 * k + width}], lambda x: x::DOUBLE)"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def values():
    return F.array(*[F.lit(v) for v in VALUES])


def teachers(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, field, teacher, dist): three teachers, two fields; some answers are missing."""
    fields = [F.struct(F.lit(f"q{q}").alias("field"), F.lit(t).alias("teacher"), D.softmax(_slice(3 * q + k), 0.2).alias("dist")) for q in range(2) for k, t in enumerate(("glm", "ds", "mistral"))]
    rows = vectors(spark, sf).select("vec_id", "label", F.explode(F.array(*fields)).alias("s")).select("vec_id", "label", "s.*")
    return rows.withColumn("dist", F.when((F.col("vec_id") % 7 == 0) & (F.col("teacher") == "ds"), None).otherwise(F.col("dist")))


def _teacher_sql() -> str:
    parts = []
    for q in range(2):
        for k, t in enumerate(("glm", "ds", "mistral")):
            d = SOFTMAX.format(l=_sql_slice(3 * q + k), t="0.2")
            parts.append(f"SELECT vec_id, label, 'q{q}' AS field, '{t}' AS teacher, CASE WHEN vec_id % 7 = 0 AND '{t}' = 'ds' THEN NULL ELSE {d} END AS d FROM embeddings")
    return f"t AS ({' UNION ALL '.join(parts)})"


MEAN = "[list_avg(list_transform(ds, lambda d: d[i])) for i in [1, 2, 3, 4]]"
TOPS = "flatten(list_transform(ds, lambda d: list_filter([1, 2, 3, 4], lambda i: d[i] >= list_max(d) - 1e-9)))"
AGGREGATE = f"""{_teacher_sql()},
g AS (SELECT vec_id, field, list(d ORDER BY teacher) FILTER (WHERE d IS NOT NULL) AS ds, count(*) AS asked FROM t GROUP BY vec_id, field),
m AS (SELECT *, {TOPS} AS tops, list_transform({MEAN}, lambda p: 0.98 * p + 0.02 / 4) AS gold FROM g),
v AS (SELECT *, list_filter(list_distinct(tops), lambda x: len(list_filter(tops, lambda y: y = x)) >= 2) AS major, list_position(gold, list_max(gold)) AS top FROM m),
r AS (SELECT *, CASE WHEN len(ds) < greatest(2, asked) THEN 'teacher_missing' WHEN len(major) = 0 THEN 'no_majority' WHEN NOT list_contains(major, top) THEN 'mean_disagrees_with_majority' END AS reason FROM v)"""


@query("softmax_readout", f"SELECT vec_id, {', '.join(f'round({SOFTMAX.format(l=_sql_slice(0), t=1.5)}[{i + 1}], 6) AS p{i}' for i in range(4))} FROM embeddings")
def softmax_readout(spark, sf):
    p = D.softmax(_slice(0), 1.5)
    return vectors(spark, sf).select("vec_id", *[F.round(F.get(p, F.lit(i)), 6).alias(f"p{i}") for i in range(4)])


@query("decision_answers", f"""
WITH e AS (SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN 'choice' WHEN 1 THEN 'score' ELSE 'noul' END AS kind, {SOFTMAX.format(l=_sql_slice(0), t=0.3)} AS p4, {SOFTMAX.format(l=_sql_slice(0, 2), t=0.3)} AS p2 FROM embeddings)
SELECT vec_id, kind, CASE WHEN kind = 'noul' THEN round(p2[2], 6) END AS noul,
CASE WHEN kind <> 'noul' THEN round(least(1, greatest(0, (4 * list_max(p4) - 1) / 3)), 6) END AS confidence,
CASE WHEN kind = 'choice' THEN ['a', 'b', 'c', 'unknown'][list_position(p4, list_max(p4))] END AS choice,
CASE WHEN kind = 'score' THEN round((p4[2] + 2 * p4[3]) / (p4[1] + p4[2] + p4[3]), 6) END AS score,
CASE WHEN kind <> 'noul' THEN round(p4[4], 6) END AS unknown FROM e""")
def decision_answers(spark, sf):
    kind = F.when(F.col("vec_id") % 3 == 0, "choice").when(F.col("vec_id") % 3 == 1, "score").otherwise("noul")
    noul = F.array(F.lit("no"), F.lit("yes"))
    rows = vectors(spark, sf).select("vec_id", kind.alias("kind"), F.when(kind == "noul", _slice(0, 2)).otherwise(_slice(0)).alias("logits"), F.when(kind == "noul", noul).otherwise(values()).alias("values"), F.lit(0.3).alias("temperature"))
    out = DC.answers(rows)
    return out.select("vec_id", "kind", *[F.round(c, 6).alias(c) if c != "choice" else F.col(c) for c in ("noul", "confidence", "choice", "score", "unknown")])


@query("temperature_fallback", """
SELECT vec_id, CASE WHEN vec_id % 3 = 0 AND vec_id % 2 = 0 THEN 2.0 WHEN vec_id % 3 = 0 THEN 1.5 ELSE 0.7 END::DOUBLE AS temperature FROM embeddings""")
def temperature_fallback(spark, sf):
    rows = vectors(spark, sf).select("vec_id", F.when(F.col("vec_id") % 3 == 0, "choice").otherwise("score").alias("kind"), F.when(F.col("vec_id") % 2 == 0, "en").otherwise("de").alias("lang"))
    table = spark.createDataFrame([("choice:en", 2.0), ("choice", 1.5), ("default", 0.7)], "key string, value double")
    return DC.with_fallback(rows, table, "temperature", 1.0).select("vec_id", "temperature")


@query("conformal_set", f"""
WITH e AS (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0), t=0.2)} AS p FROM embeddings),
x AS (SELECT vec_id, unnest(p) AS p, unnest([1, 2, 3, 4]) AS i, unnest(['a', 'b', 'c', 'unknown']) AS v FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS rn FROM x)
SELECT vec_id, array_to_string(list(v ORDER BY rn), ',') AS members FROM r WHERE 1.0 - p <= 0.65 OR rn = 1 GROUP BY vec_id""")
def conformal_set(spark, sf):
    levels = F.array(*[F.struct(F.lit(a).alias("level"), F.lit(q).alias("q")) for a, q in ((0.8, 0.5), (0.9, 0.65), (0.95, 0.9))])
    p = D.softmax(_slice(0), 0.2)
    q = D.conformal_level(levels, 0.85)["q"]
    return vectors(spark, sf).select("vec_id", F.array_join(D.conformal_set(p, values(), q), ",").alias("members"))


@query("uncertain_fields", f"WITH e AS (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0), t=0.1)} AS p FROM embeddings) SELECT vec_id, (4 * list_max(p) - 1) / 3 < 0.6 AS uncertain FROM e")
def uncertain_fields(spark, sf):
    return vectors(spark, sf).select("vec_id", D.uncertain(D.softmax(_slice(0), 0.1), F.lit("choice"), F.lit(None).cast("double")).alias("uncertain"))


@query("soft_label_aggregate", f"WITH {AGGREGATE} SELECT vec_id, field, reason, CASE WHEN reason IS NULL THEN (top - 1)::INTEGER END AS label_at, CASE WHEN reason IS NULL THEN round(gold[1], 6) END AS g0, CASE WHEN reason IS NULL THEN round(gold[4], 6) END AS g3 FROM r")
def soft_label_aggregate(spark, sf):
    out = L.aggregate_labels(teachers(spark, sf), ["vec_id", "field"])
    return out.select("vec_id", "field", "reason", "label_at", F.round(F.get("gold", F.lit(0)), 6).alias("g0"), F.round(F.get("gold", F.lit(3)), 6).alias("g3"))


@query("label_half_rule", f"WITH {AGGREGATE}, c AS (SELECT vec_id, count(*) AS n_asked, count_if(reason IS NULL) AS n_kept FROM r GROUP BY vec_id) SELECT vec_id, n_asked, n_kept, ((n_asked - n_kept) * 2 <= n_asked AND n_kept > 0) AS row_kept FROM c")
def label_half_rule(spark, sf):
    return L.half_rule(L.aggregate_labels(teachers(spark, sf), ["vec_id", "field"]), ["vec_id"], F.col("reason").isNull())


@query("drop_summary", f"WITH {AGGREGATE} SELECT concat('label: ', reason) AS reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1")
def drop_summary(spark, sf):
    drops = L.aggregate_labels(teachers(spark, sf), ["vec_id", "field"]).where("reason is not null").withColumn("stage", F.lit("label"))
    return ST.drop_summary(drops)


TOP = "list_position(d, list_max(d))"


@query("pair_agreement", f"WITH {_teacher_sql()} SELECT x.teacher AS a, y.teacher AS b, count(*) AS n, count_if({TOP.replace('d', 'x.d', 1).replace('(d)', '(x.d)')} = {TOP.replace('d', 'y.d', 1).replace('(d)', '(y.d)')}) AS agreed FROM t x JOIN t y ON x.vec_id = y.vec_id AND x.field = y.field AND x.teacher < y.teacher AND x.d IS NOT NULL AND y.d IS NOT NULL GROUP BY 1, 2".replace("list_positionx.(", "list_position("))
def pair_agreement(spark, sf):
    return L.pair_agreement(teachers(spark, sf), ["vec_id", "field"])


@query("agreement_stats", f"""WITH {_teacher_sql()}, a AS (SELECT vec_id, field, list({TOP}) AS tops, min(list_max(d)) AS low FROM t WHERE d IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
p AS (SELECT 0.5 * list_sum(list_transform([1, 2, 3, 4], lambda i: abs(x.d[i] - y.d[i]))) AS tv FROM t x JOIN t y ON x.vec_id = y.vec_id AND x.field = y.field AND x.teacher < y.teacher AND x.d IS NOT NULL AND y.d IS NOT NULL)
SELECT count(*) AS questions, count_if(len(list_distinct(tops)) = 1) AS unanimous, count_if(len(list_distinct(tops)) = 1 AND low >= 0.95) AS trivial, (SELECT round(avg(tv), 6) FROM p) AS mean_tv FROM a""")
def agreement_stats(spark, sf):
    return L.agreement(teachers(spark, sf), ["vec_id", "field"]).withColumn("mean_tv", F.round("mean_tv", 6))


@query("verified_sets", f"""WITH {_teacher_sql()}, e AS (SELECT vec_id, field, label % 2 AS s, count(*) AS n, count_if({TOP} - 1 = label % 4) AS hit FROM t WHERE d IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2)
SELECT s::INTEGER AS s, count(*) AS n, count_if(hit >= 2) AS agreed FROM e GROUP BY s""")
def verified_sets(spark, sf):
    t = teachers(spark, sf)
    gold = t.select("vec_id", "field", (F.col("label") % 2).alias("s"), (F.col("label") % 4).alias("gold_at")).distinct()
    return L.verified(t, gold, ["vec_id", "field"], "s")


@query("injection_flips", f"WITH {_teacher_sql()} SELECT count(*) AS total, count_if({TOP} - 1 <> label % 4) AS flips FROM t WHERE d IS NOT NULL")
def injection_flips(spark, sf):
    t = teachers(spark, sf)
    return L.flips(t, t.select("vec_id", "field", (F.col("label") % 4).alias("gold_at")).distinct(), ["vec_id", "field"])


@query("ordinal_rows", f"""WITH {_teacher_sql()}, a AS (SELECT vec_id, field, list(d ORDER BY teacher) AS ds, list_distinct(list({TOP})) AS tops FROM t WHERE d IS NOT NULL GROUP BY 1, 2),
m AS (SELECT vec_id, field, {MEAN} AS p FROM a WHERE len(tops) = 2 AND list_max(tops) - list_min(tops) = 1)
SELECT vec_id, field, round(0.98 * (p[1] * 0.9 + p[2] * 0.05) + 0.005, 6) AS d0, round(0.98 * (p[2] * 0.9 + p[1] * 0.1 + p[3] * 0.05) + 0.005, 6) AS d1 FROM m""")
def ordinal_rows(spark, sf):
    out = FX.ordinal_rows(teachers(spark, sf), ["vec_id", "field"])
    return out.select("vec_id", "field", F.round(F.get("dist", F.lit(0)), 6).alias("d0"), F.round(F.get("dist", F.lit(1)), 6).alias("d1"))


@query("negation_twins", f"WITH e AS (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0, 2), t=0.2)} AS p FROM embeddings) SELECT vec_id, 'plain' AS twin, round(p[2], 6) AS p_yes FROM e UNION ALL SELECT vec_id, 'negated', round(p[1], 6) FROM e")
def negation_twins(spark, sf):
    rows = vectors(spark, sf).select("vec_id", D.softmax(_slice(0, 2), 0.2).alias("p"))
    return FX.negation_twins(rows, F.get("p", F.lit(1))).select("vec_id", "twin", F.round(F.get("dist", F.lit(1)), 6).alias("p_yes"))


@query("choice_twins", f"WITH e AS (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0, 2), t=0.2)} AS p FROM embeddings) SELECT vec_id, 'noul' AS twin, round(p[2], 6) AS p_yes FROM e UNION ALL SELECT vec_id, 'choice', round(p[2], 6) FROM e")
def choice_twins(spark, sf):
    rows = vectors(spark, sf).select("vec_id", D.softmax(_slice(0, 2), 0.2).alias("p"))
    out = FX.choice_twins(rows, F.get("p", F.lit(1)), F.array(F.lit("reject"), F.lit("accept")), F.lit("accept"))
    return out.select("vec_id", "twin", F.round(F.get("dist", F.lit(1)), 6).alias("p_yes"))


@query("unknown_rows", f"""WITH e AS (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0, 3), t=0.2)} AS p FROM embeddings)
SELECT vec_id, 'removed' AS twin, round(0.02 / 4, 6) AS first, round(0.98 + 0.02 / 4, 6) AS last FROM e UNION ALL
SELECT vec_id, 'no_unknown', round(0.98 * p[1] + 0.02 / 3, 6), round(0.98 * p[3] + 0.02 / 3, 6) FROM e UNION ALL
SELECT vec_id, 'control', round(0.98 * p[1] + 0.02 / 4, 6), round(0.02 / 4, 6) FROM e""")
def unknown_rows(spark, sf):
    rows = vectors(spark, sf).select("vec_id", D.softmax(_slice(0, 3), 0.2).alias("p"))
    out = FX.unknown_rows(rows, F.col("p"), F.array(F.lit("a"), F.lit("b"), F.lit("c")))
    return out.select("vec_id", "twin", F.round(F.get("dist", F.lit(0)), 6).alias("first"), F.round(F.element_at("dist", -1), 6).alias("last"))


@query("brier_nll_accuracy", f"""WITH e AS (SELECT label % 4 + 1 AS g, {SOFTMAX.format(l=_sql_slice(0), t=0.2)} AS p FROM embeddings)
SELECT count(*) AS n, round(avg(CASE WHEN list_position(p, list_max(p)) = g THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
round(avg(list_sum(list_transform([1, 2, 3, 4], lambda i: (CASE WHEN i = g THEN 1 ELSE 0 END - p[i]) ** 2))), 6) AS brier, round(avg(-ln(p[g])), 6) AS nll FROM e""")
def brier_nll_accuracy(spark, sf):
    rows = vectors(spark, sf).select(F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: (i == F.col("label") % 4).cast("double")).alias("g"), D.softmax(_slice(0), 0.2).alias("p"))
    hit = (D.argmax(F.col("p")) == D.argmax(F.col("g"))).cast("double")
    return rows.agg(F.count("*").alias("n"), F.round(F.avg(hit), 6).alias("accuracy"), F.round(F.avg(D.brier(F.col("g"), F.col("p"))), 6).alias("brier"), F.round(F.avg(D.cross_entropy(F.col("g"), F.col("p"))), 6).alias("nll"))


@query("calibration_error", f"""WITH e AS (SELECT list_max(p) AS c, CASE WHEN list_position(p, list_max(p)) = label % 4 + 1 THEN 1.0 ELSE 0.0 END AS h FROM (SELECT label, {SOFTMAX.format(l=_sql_slice(0), t=0.1)} AS p FROM embeddings)),
b AS (SELECT least(floor(c * 10), 9) AS bin, count(*) AS n, avg(c) AS conf, avg(h) AS acc FROM e GROUP BY 1) SELECT sum(n)::BIGINT AS n, round(sum(n * abs(conf - acc)) / sum(n), 6) AS ece FROM b""")
def calibration_error(spark, sf):
    rows = vectors(spark, sf).select("label", D.softmax(_slice(0), 0.1).alias("p"))
    return ST.calibration(rows, F.array_max("p"), D.argmax(F.col("p")) == F.col("label") % 4).withColumn("ece", F.round("ece", 6))


@query("engine_parity", f"""WITH e AS (SELECT {SOFTMAX.format(l=_sql_slice(0), t=0.2)} AS a, {SOFTMAX.format(l=_sql_slice(1), t=0.2)} AS b FROM embeddings)
SELECT count(*) AS n, round(avg(CASE WHEN list_position(a, list_max(a)) = list_position(b, list_max(b)) THEN 1.0 ELSE 0.0 END), 6) AS argmax_agreement, round(max(list_max(list_transform([1, 2, 3, 4], lambda i: abs(a[i] - b[i])))), 6) AS max_prob_gap FROM e""")
def engine_parity(spark, sf):
    v = vectors(spark, sf)
    side = lambda k: v.select("vec_id", D.softmax(_slice(k), 0.2).alias("p"))
    return CP.parity(side(0), side(1), ["vec_id"], "p").select("n", F.round("argmax_agreement", 6).alias("argmax_agreement"), F.round("max_prob_gap", 6).alias("max_prob_gap"))


@query("parse_replies", """
WITH e AS (SELECT event_id, round(value - floor(value), 2) AS p, event_id % 6 AS k FROM events WHERE value IS NOT NULL)
SELECT event_id, CASE k WHEN 1 THEN 'unknown option' WHEN 2 THEN 'non-numeric probability' WHEN 3 THEN CASE WHEN abs(p * 2 - 1) > 0.02 THEN 'probabilities do not sum to 1' END WHEN 5 THEN 'no probabilities' END AS problem,
CASE k WHEN 0 THEN p WHEN 3 THEN CASE WHEN abs(p * 2 - 1) <= 0.02 THEN round(p / (p * 2), 6) END WHEN 4 THEN p END::DOUBLE AS p_yes FROM e""")
def parse_replies(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").where("value is not null")
    p = F.round(F.col("value") - F.floor("value"), 2)
    text, rest = F.format_string("%.2f", p), F.format_string("%.2f", 1 - p)
    reply = F.get(
        F.array(
            F.concat(F.lit('{"Yes": '), text, F.lit("}")),  # one of two options implies the other
            F.concat(F.lit('{"'), "event_type", F.lit('": '), text, F.lit("}")),
            F.concat(F.lit('{"yes": "'), "event_type", F.lit('", "no": '), text, F.lit("}")),
            F.concat(F.lit('{"yes": '), text, F.lit(', "no": '), text, F.lit("}")),
            F.concat(F.lit('{"`yes`": "'), text, F.lit('", " NO ": '), rest, F.lit("}")),
            F.concat(F.lit("{ "), "event_type"),
        ),
        (F.col("event_id") % 6).cast("int"),
    )
    rows = e.select("event_id", D.parse_reply(reply, F.array(F.lit("no"), F.lit("yes"))).alias("r"))
    return rows.select("event_id", F.col("r.problem").alias("problem"), F.round(F.get("r.dist", F.lit(1)), 6).alias("p_yes"))


@query("stable_half", """SELECT vec_id FROM embeddings WHERE cast(concat('0x', substr(sha256(concat('["', vec_id, '"]')), 1, 2)) AS INTEGER) % 2 = 0""")
def stable_half(spark, sf):
    return L.stable_half(vectors(spark, sf).select("vec_id"), ["vec_id"], 0, 10)
