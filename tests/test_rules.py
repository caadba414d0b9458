from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from verdancy.functions import dates as T
from verdancy.operators import rules as R


def test_calendar_against_brute_force(spark):
    start = date(2025, 1, 1)
    rows = [(start + timedelta(days=i), n) for i in range(14) for n in range(0, 16)]
    df = spark.createDataFrame(rows, "d date, n int").select("d", "n", T.add_business_days(F.col("d"), F.col("n")).alias("b"), T.working_days(F.col("d"), F.date_add("d", "n")).alias("w"))
    for r in df.collect():
        day, left = r.d, r.n
        while left:
            day += timedelta(days=1)
            left -= day.weekday() < 5
        assert r.b == day
        assert r.w == sum((r.d + timedelta(days=i)).weekday() < 5 for i in range(r.n + 1))


@pytest.mark.parametrize("birth, day, age", [("2000-05-10", "2018-05-09", 17), ("2000-05-10", "2018-05-10", 18), ("2000-02-29", "2018-02-28", 17)])
def test_age(spark, birth, day, age):
    assert spark.range(1).select(T.age_on(F.to_date(F.lit(birth)), F.to_date(F.lit(day))).alias("a")).first().a == age


def test_discount_rounds_half_up(spark):
    assert spark.range(1).select(R.discounted(F.lit("0.50").cast("decimal(18,2)"), F.lit(5)).alias("x")).first().x == Decimal("0.48")


def test_policies(spark):
    r = spark.range(1).select(
        R.return_policy(F.lit("hygiene"), F.lit(True), F.lit(False), F.lit(1), F.lit(14), F.lit(7))[0].alias("hygiene"),
        R.return_policy(F.lit("electronics"), F.lit(False), F.lit(True), F.lit(7), F.lit(14), F.lit(7))[0].alias("sale"),
        R.deadline(F.to_date(F.lit("2025-01-08")), F.to_date(F.lit("2025-01-01")))[1].alias("late"),
        R.sum_limit(F.array(F.lit(Decimal("1.50")), F.lit(Decimal("2.50"))), F.array(F.lit("a"), F.lit("b")), F.lit(Decimal("4.00")))[0].alias("over"),
    ).first()
    assert (r.hygiene, r.sale, r.late, r.over) == ("not_returnable", "store_credit", "late_1_7", "no")
