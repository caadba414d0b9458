import corpus_pipeline


def test_unrelated_texts_of_one_id_stay(spark):
    t = lambda name, a, b: " ".join(f"{name}{k}" for k in range(a, b))
    rows = [(1, t("a", 0, 100)), (5, t("a", 4, 104)), (5, t("b", 0, 100)), (5, t("c", 0, 100)), (5, t("c", 0, 100)), (7, t("b", 3, 103)), (None, t("a", 0, 100))]
    rows += [(9, t("d", 0, 100)), (9, t("d", 5, 105))]
    docs = spark.createDataFrame([(i, x, "en") for i, x in rows], "doc_id long, text string, lang string")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns and sum(i == 9 for i, _ in got) == 1
    assert sorted(((i, x) for i, x in got if i != 9), key=str) == sorted([rows[0], rows[2], rows[3], rows[6]], key=str)
