"""Probability distributions as arrays of doubles in option order.

Ties go to the earliest option, as option order is part of the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Fixed values of the label policy.
SMOOTHING = 0.02
TIE_TOLERANCE = 1e-9
TARGET_DIGITS = 6
TEACHER_DIGITS = 4
SUM_TOLERANCE = 0.02
DEFAULT_AUTO_THRESHOLD = 0.6
ORDINAL_SPILL = 0.1


def total(d: Column) -> Column:
    return F.aggregate(d, F.lit(0.0), lambda a, x: a + x)


def softmax(logits: Column, temperature: Column | float = 1.0) -> Column:
    """exp((x - max) / temperature), normalised."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    weights = lambda row: let(F.array_max(row), lambda top: F.transform(row, lambda x: F.exp((x - top) / t)))
    return normalize(let(logits, weights))


def normalize(d: Column) -> Column:
    """Divide by the sum; no mass gives null."""
    return let(d, lambda row: let(total(row), lambda mass: F.transform(row, lambda x: F.try_divide(x, mass))))


def smooth(d: Column, eps: float = SMOOTHING) -> Column:
    return let(d, lambda row: F.transform(row, lambda x: (1 - eps) * x + F.lit(eps) / F.size(row)))


def one_hot(label: Column, values: Column, eps: float = SMOOTHING) -> Column:
    return smooth(F.transform(values, lambda v: F.when(v == label, 1.0).otherwise(0.0)), eps)


def argmax(d: Column) -> Column:
    """0-based place of the first greatest entry."""
    return let(d, lambda row: (F.array_position(row, F.array_max(row)) - 1).cast("int"))


def argmax_set(d: Column, tolerance: float = TIE_TOLERANCE) -> Column:
    """0-based places within tolerance of the greatest entry."""
    return let(d, lambda row: let(F.array_max(row), lambda top: F.filter(F.sequence(F.lit(0), F.size(row) - 1), lambda i: F.get(row, i) >= top - tolerance)))


def label_of(d: Column, values: Column) -> Column:
    return F.get(values, argmax(d))


def rounded(d: Column, digits: int = TARGET_DIGITS) -> Column:
    return F.transform(d, lambda x: F.round(x, digits))


def target(d: Column, values: Column) -> Column:
    """The label, taken before rounding, and the rounded distribution."""
    return F.struct(label_of(d, values).alias("label"), rounded(d).alias("dist"))


def confidence(d: Column) -> Column:
    """1 with all mass on one option, 0 when flat; 1 for fewer than two options."""
    n = F.size(d)
    return F.when(n < 2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(n * F.array_max(d) - 1, n - 1))))


def uncertain(d: Column, kind: Column, threshold: Column) -> Column:
    """Confidence (for yes/no: distance from a coin flip) below the threshold."""
    return F.when(kind == "noul", F.abs(2 * F.get(d, F.lit(1)) - 1)).otherwise(confidence(d)) < F.coalesce(threshold, F.lit(DEFAULT_AUTO_THRESHOLD))


def total_variation(a: Column, b: Column) -> Column:
    return 0.5 * total(F.zip_with(a, b, lambda x, y: F.abs(F.coalesce(x, F.lit(0.0)) - F.coalesce(y, F.lit(0.0)))))


def mean(dists: Column) -> Column:
    """Mean of an array of distributions, place by place."""

    def places(rows: Column) -> Column:
        first = F.get(rows, F.lit(0))
        return F.transform(first, lambda _, i: F.aggregate(rows, F.lit(0.0), lambda a, d: a + F.coalesce(F.get(d, i), F.lit(0.0))) / F.size(rows))

    return let(dists, places)


def expected_level(d: Column, values: Column, unknown: str = "unknown") -> Column:
    """Expected 0-based position over the levels other than unknown."""
    levels = F.filter(F.arrays_zip(d.alias("p"), values.alias("v")), lambda s: s["v"] != unknown)
    mass = F.aggregate(levels, F.lit(0.0), lambda a, s: a + s["p"])
    weighted = F.aggregate(F.transform(levels, lambda s, i: s["p"] * i), F.lit(0.0), lambda a, x: a + x)
    return weighted / F.when(mass == 0, 1.0).otherwise(mass)


def conformal_level(levels: Column, coverage: Column | float) -> Column:
    """The smallest fitted (level, q) at or above the coverage; null if there is none."""
    want = coverage if isinstance(coverage, Column) else F.lit(float(coverage))
    return F.get(F.array_sort(F.filter(levels, lambda s: s["level"] >= want)), F.lit(0))


def conformal_set(d: Column, values: Column, q: Column) -> Column:
    """Options with 1 - p <= q from most to least likely, the top one at least."""
    ranked = F.array_sort(F.transform(d, lambda p, i: F.struct((-p).alias("k"), i.alias("i"), F.get(values, i).alias("v"))))
    members = F.filter(ranked, lambda s: 1.0 + s["k"] <= q)
    return F.transform(F.when(F.size(members) > 0, members).otherwise(F.slice(ranked, 1, 1)), lambda s: s["v"])


def complement(d: Column) -> Column:
    """A yes/no distribution with its mass swapped."""
    return F.reverse(d)


def choice_twin(p_yes: Column, options: Column, yes_option: Column) -> Column:
    """The two-option choice that asks the same as a yes/no question."""
    return F.transform(options, lambda o: F.when(o == yes_option, p_yes).otherwise(1 - p_yes))


def ordinal_smooth(d: Column, spill: float = ORDINAL_SPILL, eps: float = SMOOTHING) -> Column:
    """Move a share of each level's mass to its neighbours (inward at the ends), then smooth."""
    last = F.size(d) - 1

    def level(p, i):
        left = F.coalesce(F.get(d, i - 1), F.lit(0.0)) * F.when(i - 1 == 0, spill).otherwise(spill / 2)
        right = F.coalesce(F.get(d, i + 1), F.lit(0.0)) * F.when(i + 1 == last, spill).otherwise(spill / 2)
        return p * (1 - spill) + F.when(i > 0, left).otherwise(0.0) + F.when(i < last, right).otherwise(0.0)

    return smooth(F.transform(d, level), eps)


def cross_entropy(gold: Column, d: Column) -> Column:
    return -total(F.zip_with(gold, d, lambda g, p: g * F.ln(F.greatest(p, F.lit(1e-12)))))


def brier(gold: Column, d: Column) -> Column:
    return total(F.zip_with(gold, d, lambda g, p: (g - p) * (g - p)))


def aligned(keys: Column, probabilities: Column, values: Column) -> Column:
    """Probabilities given by key, in the order of values, missing ones 0."""
    given = F.map_from_arrays(keys, probabilities)
    return F.transform(values, lambda v: F.coalesce(F.try_element_at(given, v), F.lit(0.0)))


def _plain(text: Column) -> Column:
    return F.lower(F.trim(F.btrim(F.trim(text), F.lit("`"))))


def parse_reply(raw: Column, values: Column) -> Column:
    """A teacher's JSON reply {option: probability} as struct(dist, problem)."""
    entries = F.map_entries(F.from_json(raw, "map<string,string>"))
    named = F.transform(entries, lambda e: F.struct(F.array_position(F.transform(values, _plain), _plain(e["key"])).alias("at"), e["value"].try_cast("double").alias("p")))
    dist = F.transform(values, lambda v, i: F.aggregate(F.filter(named, lambda e: e["at"] == i + 1), F.lit(0.0), lambda a, e: a + e["p"]))
    mass = total(dist)
    implied = (F.size(values) == 2) & (F.size(named) == 1) & (mass <= 1)
    missing = F.array_position(dist, 0.0)
    whole = F.when(implied, F.transform(dist, lambda p, i: F.when(i + 1 == missing, 1 - mass).otherwise(p))).otherwise(dist)
    sum_now = F.when(implied, F.lit(1.0)).otherwise(mass)
    problem = (
        F.when(entries.isNull() | (F.size(entries) == 0), "no probabilities")
        .when(F.exists(named, lambda e: e["at"] == 0), "unknown option")
        .when(F.exists(named, lambda e: e["p"].isNull()), "non-numeric probability")
        .when(F.exists(named, lambda e: (e["p"] < 0) | (e["p"] > 1) | F.isnan(e["p"])), "probability out of range")
        .when(F.abs(sum_now - 1) > SUM_TOLERANCE, "probabilities do not sum to 1")
    )
    return F.struct(F.when(problem.isNull(), F.transform(whole, lambda p: p / sum_now)).alias("dist"), problem.alias("problem"))
