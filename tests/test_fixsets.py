import random

from verdancy.operators import fixsets as FX
from verdancy.plans import catalogue


def dominated():
    """(doc_id, text, lang): 98 % of one language, no text twice; ids repeat across languages, one text is null."""
    rng = random.Random(5)
    rows = [(i, f"{i} " + "x" * rng.randint(300, 1500), "en" if i % 50 else rng.choice(["de", "fr", None])) for i in range(3000)]
    return rows + [(7, "same id " + "y" * 700, "de"), (3001, None, "de"), (3002, "", "en")]


def test_padding_is_brute_force_with_a_dominant_domain(spark):
    rows = dominated()
    df = FX.numbered(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang", ["doc_id"])
    got = FX.padded(df, "doc_id", "text", "lang", "index", 7).collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((i, t or "") for i, t, _ in rows)
    of, index = {t: (i, g) for i, t, g in rows if t is not None}, {}
    for i, t, g in sorted(rows, key=lambda r: r[0]):
        index[i, g] = sum(1 for j, _, h in rows if h == g and j < i)
    used = {g: set() for g in ("en", "de", "fr", None)}
    for r in got:
        assert r.budget == FX.BUDGETS[index[r.doc_id, r.lang] % 3]
        assert len(set(r.others)) == len(r.others) > 0 and all(of[t][0] != r.doc_id and of[t][1] != r.lang for t in r.others)
        size = len(r.text or "") + sum(map(len, r.others))
        assert size >= 3.5 * r.budget and (len(r.others) == 1 or size - len(r.others[-1]) < 3.5 * r.budget)
        for t in r.others:
            used[of[t][1]].add(t)
    assert len(used["en"]) > 200 and all(used[g] == {t for i, t, h in rows if h == g and t is not None} for g in ("de", "fr", None))
    again = FX.padded(df.repartition(7), "doc_id", "text", "lang", "index", 7).collect()
    assert sorted((r.doc_id, r.text or "", r.others) for r in again) == sorted((r.doc_id, r.text or "", r.others) for r in got)


def test_padding_takes_all_other_rows_when_they_are_few(spark):
    rows = [(i, "a" * 10, "en") for i in range(40)] + [(100 + i, f"b{i}", "de") for i in range(5)]
    got = FX.padded(spark.createDataFrame([(*r, r[0]) for r in rows], "doc_id long, text string, lang string, index long"), "doc_id", "text", "lang", "index", 7).collect()
    assert all(sorted(r.others) == [f"b{i}" for i in range(5)] for r in got if r.lang == "en")
    assert all(r.others == ["a" * 10] * 40 for r in got if r.lang == "de")
    alone = spark.createDataFrame([(1, "a", "en", 0)], "doc_id long, text string, lang string, index long")
    assert FX.padded(alone, "doc_id", "text", "lang", "index", 7).first().others == []


def test_padding_query_fills_every_budget(spark, tmp_path):
    rows = [r for r in dominated() if r[1] is not None]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    size = {(i, len(t)) for i, t, _ in rows}
    got = catalogue.queries()["padding_rows"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars + max(n for i, n in size if i == r.doc_id) >= 3.5 * r.budget for r in got)


def most_read(spark, group):
    """Bytes that one task of a job group has read of shuffles, at most."""
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    most = 0
    for stage in {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}:
        tasks = store.taskList(stage, 0, 1000)
        for k in range(tasks.size()):
            m = tasks.apply(k).taskMetrics()
            if m.isDefined():
                r = m.get().shuffleReadMetrics()
                most = max(most, r.localBytesRead() + r.remoteBytesRead())
    return most


def test_padding_reads_no_domain_in_one_task(spark):
    rng = random.Random(6)
    rows = [(i, f"{rng.getrandbits(8000):x}", "en" if i % 50 else "de") for i in range(3000)]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = FX.numbered(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang", ["doc_id"]).checkpoint()
        spark.sparkContext.setJobGroup("padding", "")
        assert FX.padded(df, "doc_id", "text", "lang", "index", 7).count() == len(rows)
        most = most_read(spark, "padding")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < most < sum(len(t) for _, t, _ in rows) / 8
