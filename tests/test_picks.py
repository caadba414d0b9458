from verdancy.plans import catalogue


def test_islands_keep_rows_that_repeat_a_turn(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 1, "bot", "c"), (1, 1, "user", "b"), (1, 2, "user", "d"), (2, 0, "bot", "e")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = catalogue.queries()["gaps_islands_chunks"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, 0), (1, 1, 2, 0), (1, 1, 3, 0), (1, 1, 3, 0), (1, 2, 3, 0), (2, 0, 1, 0)]
