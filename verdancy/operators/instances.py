"""Samplers of the rules: facts drawn from a key's hashes around the rule's boundary, a state from a template, the exact answers.

A sampler gives, for rows with a text column key, the facts, the state in a
locale's wording, and the answers of its rule; half of the draws fall on the
side that the rule allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import locale as LO
from ..functions import text as X
from . import rules as R
from .generate import between, day_between, side

ISO = "yyyy-MM-dd"


def _date(c: str) -> Column:
    return LO.date_by(F.col(c), ISO, "en_US")


def _money(c: str) -> Column:
    return LO.money_text(F.col(c), "en_US")


def deadline(rows: DataFrame, k: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    facts = rows.withColumn("due", day_between(k, "due")).withColumn("came", F.date_add("due", side(k, "late").cast("int")))
    return facts, {"due": _date("due"), "came": _date("came")}, list(R.deadline(F.col("came"), F.col("due")))


def return_window(rows: DataFrame, k: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    facts = rows.withColumns({"got": day_between(k, "got"), "days": between(k, "days", 14, 60)}).withColumn("asked", F.date_add("got", F.col("days") + side(k, "asked", 14).cast("int")))
    return facts, {"got": _date("got"), "asked": _date("asked"), "days": F.col("days")}, list(R.return_window(F.col("got"), F.col("asked"), F.col("days")))


def age_limit(rows: DataFrame, k: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    facts = rows.withColumns({"day": day_between(k, "day"), "limit": between(k, "limit", 16, 21)})
    facts = facts.withColumn("birth", F.date_add(F.add_months("day", -12 * F.col("limit")), side(k, "birth").cast("int")))
    return facts, {"birth": _date("birth"), "day": _date("day"), "limit": F.col("limit")}, [R.age_limit(F.col("birth"), F.col("day"), F.col("limit"))]


def discount(rows: DataFrame, k: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    cents = between(k, "price", 1000, 90_000)
    facts = rows.withColumns({"price": (cents / 100).cast("decimal(18,2)"), "percent": between(k, "percent", 5, 60)})
    facts = facts.withColumn("budget", (R.discounted(F.col("price"), F.col("percent")) + side(k, "budget", 50)).cast("decimal(18,2)"))
    return facts, {"price": _money("price"), "percent": F.col("percent"), "budget": _money("budget")}, [R.discount(F.col("price"), F.col("percent"), F.col("budget"))]


def sum_limit(rows: DataFrame, k: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    amounts = F.array(*[(between(k, f"amount{i}", 500, 30_000) / 100).cast("decimal(18,2)") for i in range(4)])
    facts = rows.withColumn("amounts", amounts)
    total = F.aggregate("amounts", F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x).cast("decimal(38,2)"))
    facts = facts.withColumn("limit", (total + side(k, "limit", 40)).cast("decimal(18,2)"))
    items = F.array(*[F.lit(f"item {i + 1}") for i in range(4)])
    lines = F.array_join(F.transform("amounts", lambda a, i: F.concat(F.get(items, i), F.lit(": "), LO.money_text(a, "en_US"))), "; ")
    return facts, {"lines": lines, "limit": _money("limit")}, list(R.sum_limit(F.col("amounts"), items, F.col("limit")))


def average_pass(rows: DataFrame, k: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    facts = rows.withColumns({"scores": F.array(*[between(k, f"score{i}", 30, 100) for i in range(3)]), "mark": between(k, "mark", 50, 80)})
    return facts, {"scores": F.array_join("scores", ", "), "mark": F.col("mark")}, [R.average_pass(F.col("scores"), F.col("mark"))]


#: Rule -> (sampler, template, fields of its answers).
SAMPLERS: dict[str, tuple[Callable, str, tuple[str, ...]]] = {
    "deadline": (deadline, "The report was due on {due} and came on {came}.", ("on_time", "lateness")),
    "return_window": (return_window, "The parcel came on {got}; returns are taken for {days} days. The customer asked on {asked}.", ("within", "last_day")),
    "age_limit": (age_limit, "Born on {birth}, the applicant asks on {day}; the least age is {limit}.", ("old_enough",)),
    "discount": (discount, "The price is {price}, less {percent} percent. The budget is {budget}.", ("within",)),
    "sum_limit": (sum_limit, "Expenses: {lines}. The limit is {limit}.", ("over_limit", "top_item")),
    "average_pass": (average_pass, "Scores: {scores}. The mean must reach {mark}.", ("passes",)),
}


def instances(rows: DataFrame, key: str, rule: str) -> DataFrame:
    """rows(key) with rule, state and answers, an array of field and label."""
    sampler, template, fields = SAMPLERS[rule]
    facts, slots, answers = sampler(rows.select(key), F.col(key).cast("string"))
    labels = F.array(*[F.struct(F.lit(f).alias("field"), a.cast("string").alias("label")) for f, a in zip(fields, answers)])
    return facts.select(key, F.lit(rule).alias("rule"), X.filled(F.lit(template), slots).alias("state"), labels.alias("answers"))


def every_rule(rows: DataFrame, key: str) -> DataFrame:
    out = None
    for rule in SAMPLERS:
        part = instances(rows, key, rule)
        out = part if out is None else out.unionByName(part)
    return out
