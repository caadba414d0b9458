"""Cases of rules: their tables stay in the row."""

import pytest
from pyspark.sql import functions as F

from verdancy.functions import text as X
from verdancy.operators import casebook as CB


@pytest.fixture(scope="module")
def pools(spark):
    names = [(p, f"{p} {i}") for p in ("people", "orgs", "products", "cities", "depots", "statuses") for i in range(4)]
    return CB.Pools(spark.createDataFrame(names, "pool string, name string"))


@pytest.mark.parametrize("rule", sorted(CB.CASES))
def test_no_line_of_a_case_is_shuffled(spark, pools, rule):
    found = CB.cases(spark.range(40).withColumnRenamed("id", "case"), "case", rule, pools)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(case#") == 1 and "SortMergeJoin" not in plan and "Generate" not in plan
    assert {r["case"] for r in found.collect()} == set(range(40))


def test_records_are_named_and_counted(spark, pools):
    for r in CB.cases(spark.range(60), "id", "count_records", pools).collect():
        listed, wanted, least = r.state.removeprefix("Records: ").rsplit(". How many are ", 1)[0], *r.state.removesuffix("?").rsplit(". How many are ", 1)[1].split(" with at least ")
        records = [line.rsplit(" ", 1) for line in listed.split("; ")]
        assert 4 <= len(records) <= 10 and int(r.answers[0].label) == sum(s == wanted and int(v) >= int(least) for s, v in records)


def test_a_template_known_beforehand_is_filled_alike(spark):
    slots = {"a": F.lit("{b}"), "b": F.lit("$1\\"), "n": F.lit(None).cast("int")}
    for template in ("{a} and {b}, {c} {a}", "{n}{a}", "none", "{a"):
        assert spark.range(1).select(X.filled_text(template, slots).alias("x")).first().x == spark.range(1).select(X.filled(F.lit(template), slots).alias("x")).first().x
