import pytest
from pyspark.sql import functions as F

from verdancy.operators import labels as L

SCHEMA = "id string, field string, teacher string, dist array<double>"


def gold(spark, *dists):
    rows = [("r", "f", f"t{k}", d) for k, d in enumerate(dists)]
    return L.aggregate_labels(spark.createDataFrame(rows, SCHEMA), ["id", "field"]).first()


def test_unanimous_gold_is_the_smoothed_mean(spark):
    r = gold(spark, [0.9, 0.1, 0.0], [0.8, 0.2, 0.0], [0.7, 0.3, 0.0])
    assert r.reason is None and r.label_at == 0
    assert r.gold == pytest.approx([0.98 * x + 0.02 / 3 for x in (0.8, 0.2, 0.0)])


@pytest.mark.parametrize(
    "dists, reason",
    [
        (([0.9, 0.1, 0.0], [0.9, 0.1, 0.0], [0.0, 0.1, 0.9]), None),
        (([1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]), "no_majority"),
        (([1.0, 0.0, 0.0], [1.0, 0.0, 0.0], None), "teacher_missing"),
        (([0.6, 0.4, 0.0], [0.6, 0.4, 0.0], [0.0, 1.0, 0.0]), "mean_disagrees_with_majority"),
        (([0.5, 0.5, 0.0], [0.4, 0.6, 0.0]), None),
    ],
)
def test_drop_reasons(spark, dists, reason):
    assert gold(spark, *dists).reason == reason


@pytest.mark.parametrize("kept, asked, stays", [(1, 3, False), (1, 2, True), (0, 1, False), (3, 3, True)])
def test_half_rule(spark, kept, asked, stays):
    rows = spark.range(asked).select(F.lit("r").alias("id"), (F.col("id") < kept).alias("ok"))
    assert L.half_rule(rows, ["id"], F.col("ok")).first().row_kept is stays
