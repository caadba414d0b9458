import math

import pytest
from pyspark.sql import functions as F

from verdancy.functions import dist as D


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def arr(*xs):
    return F.array(*[F.lit(x) for x in xs])


def test_softmax_confidence_and_ties(spark):
    r = one(spark, p=D.softmax(arr(1.0, 0.0, 0.0), 2.0), tie=D.argmax(arr(0.4, 0.4, 0.2)), sure=D.confidence(arr(1.0, 0.0)), flat=D.confidence(arr(0.25, 0.25, 0.25, 0.25)), single=D.confidence(arr(1.0)))
    e = math.exp(0.5)
    assert r.p == pytest.approx([e / (e + 2), 1 / (e + 2), 1 / (e + 2)])
    assert (r.tie, r.sure, r.flat, r.single) == (0, 1.0, 0.0, 1.0)


def test_ordinal_smooth_spills_inward(spark):
    r = one(spark, d=D.ordinal_smooth(arr(0.5, 0.5, 0.0)))
    plain = [0.5 * 0.9 + 0.5 * 0.05, 0.5 * 0.9 + 0.5 * 0.1, 0.5 * 0.05]
    assert r.d == pytest.approx([0.98 * x + 0.02 / 3 for x in plain])


def test_conformal_levels_and_fallback_to_top(spark):
    levels = F.array(*[F.struct(F.lit(a).alias("level"), F.lit(q).alias("q")) for a, q in ((0.8, 0.1), (0.9, 0.5))])
    d, v = arr(0.6, 0.3, 0.1), arr("a", "b", "c")
    r = one(spark, up=D.conformal_level(levels, 0.85)["q"], none=D.conformal_level(levels, 0.95), top=D.conformal_set(d, v, F.lit(0.1)), two=D.conformal_set(d, v, F.lit(0.7)))
    assert (r.up, r.none, r.top, r.two) == (0.5, None, ["a"], ["a", "b"])


@pytest.mark.parametrize(
    "raw, problem, p",
    [
        ('{"yes": 0.95}', None, 0.95),
        ('{"`YES`": 0.495, "no": 0.495}', None, 0.5),
        ('{"yes": 0.5, "no": 0.1}', "probabilities do not sum to 1", None),
        ('{"maybe": 1}', "unknown option", None),
        ('{"yes": "high"}', "non-numeric probability", None),
        ('{"yes": 1.5}', "probability out of range", None),
        ("{}", "no probabilities", None),
        (None, "no probabilities", None),
    ],
)
def test_parse_reply(spark, raw, problem, p):
    r = one(spark, r=D.parse_reply(F.lit(raw).cast("string"), arr("no", "yes"))).r
    assert r.problem == problem
    assert (r.dist[1] if r.dist else None) == (pytest.approx(p) if p is not None else None)


def test_normalize_without_mass_is_null(spark):
    assert one(spark, d=D.normalize(arr(0.0, 0.0))).d == [None, None]
