"""Queries over the stages of a corpus run: documents as rows, embeddings as teachers' answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks as C
from ..functions import dist as D
from ..functions import jsontext as J
from ..functions import text as X
from ..operators import decide as DC
from ..operators import dedup as DD
from ..operators import labels as L
from ..operators import picks as P
from ..operators import rows as RW
from ..operators import stages as S
from ..operators import stats as ST
from ..sources import records as R
from .catalogue import query
from .queries_dist import AGGREGATE, MEAN, SOFTMAX, _slice, _sql_slice, teachers, values, vectors
from .queries_text import DOC_GROUP, KEY, SPLIT, docs, table


def _option(value: str, description: str | None):
    return F.struct(F.lit(value).alias("value"), F.lit(description).cast("string").alias("description"))


def _question(field, kind: str, instructions, options):
    return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("type"), instructions.alias("instructions"), options.alias("options"))


def document_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with three questions each; some have a bad label, an empty level or an announced answer."""
    d = docs(spark, sf)
    k = F.col("doc_id")
    topic = F.array(_option("billing", "money"), _option("shipping", "parcels"), _option("tech", "devices"))
    bad_topic = F.array(_option("bad label", "money"), _option("shipping", "parcels"), _option("tech", "devices"))
    mood = F.array(_option("0", "calm"), _option("1", "annoyed"), _option("2", "angry"))
    empty_mood = F.array(_option("0", "calm"), _option("1", ""), _option("2", "angry"))
    none = F.array().cast(f"array<{RW.OPTION}>")
    asks = F.when(k % 11 == 0, F.lit("Is it good? The answer is yes.")).otherwise(F.lit("Is it good?"))
    questions = F.array(
        _question("Qualität", "noul", asks, none),
        _question("topic", "choice", F.lit("Which team?"), F.when(k % 5 == 0, bad_topic).otherwise(topic)),
        _question("mood", "score", F.lit("How calm?"), F.when(k % 7 == 0, empty_mood).otherwise(mood)),
    )
    return d.select(
        k, k.cast("string").alias("id"), "lang", F.concat(F.lit("gen:"), "source").alias("source"), F.lit("CC0-1.0").alias("license"), F.lit("train").alias("split"),
        F.array(F.concat(F.lit("group:"), (k % 100).cast("string")), F.lit("domain:d")).alias("tags"), F.col("text").alias("state"), F.lit("string").alias("state_kind"), questions.alias("questions"),
    )


VALIDATED = """
v AS (SELECT doc_id, lang, text, 3 - (doc_id % 5 = 0)::INT - (doc_id % 7 = 0)::INT AS n_kept FROM documents),
r AS (SELECT doc_id, lang, n_kept, CASE WHEN n_kept < 2 THEN 'schema' WHEN length(trim(text)) < 15 OR contains(text, '<decision>') THEN 'schema' WHEN doc_id % 11 = 0 THEN 'leak' END AS reason,
CASE WHEN n_kept < 2 THEN 'dropped' WHEN length(trim(text)) < 15 THEN 'state too short' WHEN contains(text, '<decision>') THEN 'reserved marker in text'
  WHEN doc_id % 11 = 0 THEN CASE WHEN lang = 'de' THEN 'Qualitaet' ELSE 'Qualitat' END || ': instructions announce an answer' END AS detail FROM v)"""


@query("validate_rows", rf"""
WITH {VALIDATED},
w AS (SELECT doc_id, lang, CASE WHEN lang = 'de' THEN 'Qualitaet' ELSE 'Qualitat' END AS q, (length(text) % 7) / 10.0::DOUBLE AS a, length(regexp_replace(text, '\P{{L}}', '', 'g')) AS letters,
  length(regexp_replace(lower(text), '[^äöüß]', '', 'g')) AS special FROM documents),
marked AS (SELECT doc_id, concat_ws(',', concat(q, ':', CASE WHEN a > 1 - a THEN 'yes' ELSE 'no' END, ':', printf('%.3f', greatest(a, 1 - a))), CASE WHEN doc_id % 5 > 0 AND doc_id % 4 > 0 THEN 'topic:billing:0.667' END) AS writer,
  doc_id % 3 > 0 AND NOT (lang = 'de' AND letters >= 400 AND special = 0) AS lang_ok FROM w)
SELECT doc_id, n_kept::INTEGER AS n_kept, reason, detail, writer, lang_ok,
array_to_string(list_concat(list_concat([CASE WHEN lang = 'de' THEN 'Qualitaet' ELSE 'Qualitat' END], CASE WHEN doc_id % 5 = 0 THEN [] ELSE ['topic'] END), CASE WHEN doc_id % 7 = 0 THEN [] ELSE ['mood'] END), ',') AS fields FROM r JOIN marked USING (doc_id)""")
def validate_rows(spark, sf):
    """With the writer's distributions (one of a field that is not asked, one without mass) and a detector that doubts every third row."""
    k = F.col("doc_id")
    a = F.length("state") % 7 / F.lit(10.0)
    held = lambda field, keys, probabilities: F.struct(F.lit(field).alias("field"), F.array(*[F.lit(v) for v in keys]).alias("keys"), F.array(*probabilities).alias("probabilities"))
    topic = [F.when(k % 4 == 0, 0.0).otherwise(0.5), F.when(k % 4 == 0, 0.0).otherwise(0.25), F.lit(0.25)]
    writer = F.array(held("Qualität", ["yes", "no"], [a, 1 - a]), held("topic", ["billing", "shipping", "stray"], topic), held("colour", ["yes", "no"], [a, a]))
    segments = F.array(F.struct(F.lit(50).alias("n"), F.col("lang").alias("label")))
    detected = F.struct(F.when(k % 3 == 0, "xx").otherwise(F.col("lang")).alias("label"), F.lit(0.9).alias("probability"), segments.alias("segments"))
    done = S.validated(document_rows(spark, sf).withColumns({"writer_dist": writer, "detected": detected}))
    detail = F.when(F.col("n_kept") < 2, "dropped").otherwise(F.col("detail"))
    said = F.transform("writer_dist", lambda w: F.concat_ws(":", w["field"], w["label"], X.fixed_text(F.array_max(w["dist"]), 3)))
    fields = F.array_join(F.transform("questions", lambda q: q["field"]), ",")
    return done.select("doc_id", "n_kept", "reason", detail.alias("detail"), F.array_join(said, ",").alias("writer"), (F.col("language.detected") & ~F.col("language.folded")).alias("lang_ok"), fields.alias("fields"))


@query("validate_drops", f"WITH {VALIDATED} SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason")
def validate_drops(spark, sf):
    _, drops = R.split_kept(S.validated(document_rows(spark, sf)), "reason", "validate")
    return drops.groupBy("reason").agg(F.count("*").alias("n"))


@query("edit_acceptance", r"""
WITH e AS (SELECT doc_id, text, CASE doc_id % 6 WHEN 0 THEN text WHEN 1 THEN concat(text, ' 7') WHEN 2 THEN regexp_replace(concat(text, ' ', text), '\d+', '', 'g') WHEN 3 THEN concat(text, ' end') WHEN 4 THEN text END AS new FROM documents WHERE doc_id % 6 < 5),
n AS (SELECT *, list_sort(regexp_extract_all(text, '\d+')) AS a, list_sort(regexp_extract_all(new, '\d+')) AS b,
  (len(list_filter(regexp_split_to_array(new, '\s+'), lambda x: x <> '')) + 1) / (len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) + 1) AS ratio FROM e),
p AS (SELECT *, CASE WHEN a <> b THEN 'numbers in the state changed' WHEN doc_id % 6 = 4 THEN 'topic: option labels changed' WHEN NOT ratio BETWEEN 0.7 AND 1.4 THEN 'state length changed too much' END AS problem FROM n)
SELECT d.doc_id, CASE WHEN p.doc_id IS NULL THEN 'none' WHEN problem IS NOT NULL THEN 'rejected' WHEN p.text = p.new THEN 'same' ELSE 'changed' END AS edit, problem AS edit_problem,
  length(CASE WHEN p.doc_id IS NOT NULL AND problem IS NULL THEN p.new ELSE d.text END) AS n_chars FROM documents d LEFT JOIN p USING (doc_id)""")
def edit_acceptance(spark, sf):
    rows = document_rows(spark, sf)
    k, t = F.col("doc_id"), F.col("state")
    new = F.when(k % 6 == 0, t).when(k % 6 == 1, F.concat(t, F.lit(" 7"))).when(k % 6 == 2, F.regexp_replace(F.concat(t, F.lit(" "), t), r"\d+", "")).when(k % 6 == 3, F.concat(t, F.lit(" end"))).otherwise(t)
    other = F.transform("questions", lambda q: F.when((k % 6 == 4) & (q["field"] == "topic"), q.withField("options", F.slice(q["options"], 1, 2))).otherwise(q))
    replies = rows.where(k % 6 < 5).select("id", new.alias("state"), other.alias("questions"))
    return S.edited(rows, replies).select("doc_id", "edit", "edit_problem", F.length("state").alias("n_chars"))


@query("edit_sample", """
SELECT doc_id FROM documents WHERE lang = 'fr' OR cast(concat('0x', substr(md5(cast(doc_id AS VARCHAR)), 1, 4)) AS BIGINT) < 13107""")
def edit_sample(spark, sf):
    return S.edit_sample(docs(spark, sf).select("doc_id", "lang"), F.col("lang") != "fr", 0.2, "doc_id").select("doc_id")


def _label_stage(spark: SparkSession, sf: str):
    """Three teachers' answers on two fields; a missing answer is a missing row, and some rows have no free teachers."""
    answers = teachers(spark, sf).where("dist is not null").select(F.col("vec_id").alias("id"), "field", "teacher", "dist")
    free = F.when(F.col("vec_id") % 11 != 0, F.array(F.lit("glm"), F.lit("ds"), F.lit("mistral")))
    rows = vectors(spark, sf).select(F.col("vec_id").alias("id"), F.col("label").alias("domain"), F.array(F.lit("q0"), F.lit("q1")).alias("fields"), free.alias("teachers"))
    writer = vectors(spark, sf).select(F.col("vec_id").alias("id"), F.explode(F.array(*[F.struct(F.lit(f"q{q}").alias("field"), D.softmax(_slice(7 + q), 0.2).alias("dist")) for q in range(2)])).alias("s")).select("id", "s.*")
    return S.label_stage(rows, answers, writer, 60)


LABELLED = f"""{AGGREGATE},
a AS (SELECT r.*, e.vec_id % 11 = 0 AS pending FROM r JOIN embeddings e USING (vec_id)),
h AS (SELECT vec_id, count(*) AS n_asked, count_if(reason IS NULL) AS n_kept FROM a WHERE NOT pending GROUP BY vec_id),
k AS (SELECT a.* FROM a JOIN h USING (vec_id) WHERE reason IS NULL AND NOT pending AND n_kept > 0 AND (n_asked - n_kept) * 2 <= n_asked),
w AS (SELECT vec_id, 'q0' AS field, {SOFTMAX.format(l=_sql_slice(7), t="0.2")} AS w FROM embeddings UNION ALL SELECT vec_id, 'q1', {SOFTMAX.format(l=_sql_slice(8), t="0.2")} FROM embeddings),
s AS (SELECT k.*, list_position(w, list_max(w)) = top AS same FROM k JOIN w USING (vec_id, field)),
g2 AS (SELECT vec_id, count(*) AS n, count_if(same) AS keep FROM s GROUP BY vec_id),
able AS (SELECT vec_id, e.label FROM g2 JOIN embeddings e USING (vec_id) WHERE keep > 0 AND (n - keep) * 2 <= n),
turn AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(cast(vec_id AS VARCHAR)), vec_id) AS turn FROM able),
picked AS (SELECT vec_id FROM turn ORDER BY turn, label LIMIT 60)"""


@query("label_stage", f"WITH {LABELLED} SELECT vec_id AS id, field, (top - 1)::INTEGER AS label_at, round(list_max(gold), 6) AS p FROM s JOIN picked USING (vec_id) WHERE same")
def label_stage(spark, sf):
    kept, _ = _label_stage(spark, sf)
    return kept.select("id", "field", "label_at", F.round(F.array_max("gold"), 6).alias("p"))


@query("label_stage_drops", f"""
WITH {LABELLED}
SELECT vec_id AS id, NULL::VARCHAR AS field, 'no_independent_teacher' AS reason FROM embeddings WHERE vec_id % 11 = 0
UNION ALL SELECT vec_id, field, reason FROM a WHERE reason IS NOT NULL AND NOT pending
UNION ALL SELECT vec_id, NULL, 'row_lost_most_questions' FROM h WHERE NOT (n_kept > 0 AND (n_asked - n_kept) * 2 <= n_asked)
UNION ALL SELECT vec_id, field, 'writer_argmax_disagrees' FROM s WHERE NOT same
UNION ALL SELECT vec_id, NULL, 'row_lost_most_questions' FROM g2 WHERE NOT (keep > 0 AND (n - keep) * 2 <= n)
UNION ALL SELECT vec_id, NULL, 'over_target' FROM able WHERE vec_id NOT IN (SELECT vec_id FROM picked)""")
def label_stage_drops(spark, sf):
    return _label_stage(spark, sf)[1]


def _parts(spark: SparkSession, sf: str):
    """Three parts of documents with one target each, and traces for some."""
    rows = document_rows(spark, sf)
    k = F.col("doc_id")
    some = rows.withColumn("questions", F.transform(F.slice("questions", 1, 1), lambda q: q.withField("field", F.lit("quality"))))
    topic = F.array(F.lit("no"), F.lit("yes")), F.array(F.lit("no"), F.lit("yes"), F.lit("unknown"))
    dist = F.when(k % 4 == 1, F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5))).when(k % 13 == 0, F.array(F.lit(0.4), F.lit(0.4))).otherwise(F.array(F.lit(0.9), F.lit(0.1)))
    label = F.when(k % 4 == 1, "unknown").otherwise("no")
    target = F.struct(F.lit("quality").alias("field"), label.alias("label"), F.when(k % 4 == 1, topic[1]).otherwise(topic[0]).alias("values"), dist.alias("dist"))
    some = some.withColumns({"targets": F.array(target), "reasoning": F.lit(None).cast("string")})
    traces = docs(spark, sf).where("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("id"), F.lit("because").alias("trace"), F.lit("lab/m").alias("model"))
    return [some.where(k % 3 == 1), some.where(k % 3 == 0), some.where(k % 3 == 2)], traces


@query("assemble_gate", """
SELECT doc_id, CASE doc_id % 3 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END::INTEGER AS ord, CASE WHEN doc_id % 4 = 1 THEN true END AS abstain, doc_id % 3 = 0 AS traced,
CASE WHEN lang NOT IN ('en', 'de') THEN 'bad lang' WHEN length(trim(text)) < 15 THEN 'state too short' WHEN contains(text, '<decision>') THEN 'reserved marker in text'
  WHEN doc_id % 4 <> 1 AND doc_id % 13 = 0 THEN 'quality: dist does not sum to 1' END AS problem FROM documents""")
def assemble_gate(spark, sf):
    parts, traces = _parts(spark, sf)
    traced = F.exists("tags", lambda t: t == "reasoner:lab/m") & (F.col("reasoning") == "because")
    return S.gated(parts, traces).select("doc_id", "ord", "abstain", F.coalesce(traced, F.lit(False)).alias("traced"), "problem")


@query("assemble")
def assemble(spark, sf):
    parts, traces = _parts(spark, sf)
    kept, drops = S.assembled(parts, traces)
    return kept.select("id", F.lit("kept").alias("reason"), F.lit(None).cast("string").alias("detail")).unionByName(drops)


@query("corpus_gates", """
SELECT count(*) AS n, count_if(length(trim(text)) < 15 OR contains(text, '<decision>')) AS schema_fail, bool_and(true) AS argmax_ok, count_if(doc_id % 4 = 1) AS abstain_missing FROM documents""")
def corpus_gates(spark, sf):
    parts, _ = _parts(spark, sf)
    rows = R.union_in_order(parts).withColumn("abstain", F.lit(None).cast("boolean"))
    return S.gates(rows).select("n", "schema_fail", "argmax_ok", "abstain_missing")


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    """One row a question: documents have one to three, labels give the answers."""
    d = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    k = F.col("doc_id")
    name = F.when(k % 4 == 0, "P").when(k % 4 == 1, "F1").otherwise("G")
    noul = F.struct(F.lit("quality").alias("field"), F.lit("noul").alias("kind"), F.lit(2).alias("n_options"), F.lit(None).cast("int").alias("place"), F.when(F.col("quality") == 1, "yes").otherwise("no").alias("label"))
    choice = F.struct(F.lit("topic").alias("field"), F.lit("choice").alias("kind"), (2 + k % 40).cast("int").alias("n_options"), F.when(k % 9 != 0, (k % (2 + k % 40)).cast("int")).alias("place"), F.concat(F.lit("o"), (k % (2 + k % 40)).cast("string")).alias("label"))
    score = F.struct(F.lit("toxic").alias("field"), F.lit("score").alias("kind"), (2 + k % 4).cast("int").alias("n_options"), F.lit(None).cast("int").alias("place"), F.col("toxic").cast("string").alias("label"))
    several = F.when(k % 3 == 0, F.array(noul)).when(k % 3 == 1, F.array(noul, choice)).otherwise(F.array(noul, choice, score))
    return d.select(k.alias("id"), name.alias("set"), F.col("lang").alias("domain"), F.explode(several).alias("q")).select("id", "set", "domain", "q.*")


QUESTIONS = """
q AS (SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'F1' ELSE 'G' END AS set, lang AS domain, 'quality' AS field, 'noul' AS kind, 2 AS n_options, NULL AS place, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS label FROM documents JOIN labels USING (doc_id)
UNION ALL SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'F1' ELSE 'G' END, lang, 'topic', 'choice', 2 + doc_id % 40, CASE WHEN doc_id % 9 <> 0 THEN doc_id % (2 + doc_id % 40) END, concat('o', doc_id % (2 + doc_id % 40)) FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 > 0
UNION ALL SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'F1' ELSE 'G' END, lang, 'toxic', 'score', 2 + doc_id % 4, NULL, cast(toxic AS VARCHAR) FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 = 2)"""


@query("corpus_stats", f"""
WITH {QUESTIONS}, rows AS (SELECT id, set, count(*) AS c FROM q GROUP BY id, set)
SELECT 'by_set' AS section, set AS key, cast(count(*) AS VARCHAR) AS n FROM rows GROUP BY set
UNION ALL SELECT 'type', kind, cast(count(*) AS VARCHAR) FROM q GROUP BY kind
UNION ALL SELECT 'options', CASE WHEN n_options <= 8 THEN '2-8' WHEN n_options <= 30 THEN '9-30' ELSE '31-62' END, cast(count(*) AS VARCHAR) FROM q WHERE kind = 'choice' GROUP BY 2
UNION ALL SELECT 'levels', cast(n_options AS VARCHAR), cast(count(*) AS VARCHAR) FROM q WHERE kind = 'score' GROUP BY 2
UNION ALL SELECT 'questions', cast(c AS VARCHAR), cast(count(*) AS VARCHAR) FROM rows GROUP BY 2
UNION ALL SELECT 'noul_yes', domain, concat(count_if(label = 'yes'), '/', count(*)) FROM q WHERE kind = 'noul' GROUP BY domain
UNION ALL SELECT 'gold_place', concat(set, ' ', printf('%.1f', place / greatest(1, n_options - 1))), cast(count(*) AS VARCHAR) FROM q WHERE place IS NOT NULL GROUP BY 2""")
def corpus_stats(spark, sf):
    return ST.corpus_stats(_questions(spark, sf))


@query("domain_label_balance", f"""
WITH {QUESTIONS}, k AS (SELECT concat(domain, ' ', field) AS key, label FROM q UNION ALL SELECT concat(domain, ' noul'), label FROM q WHERE kind = 'noul'),
c AS (SELECT key, label, count(*) AS n FROM k GROUP BY key, label)
SELECT key, sum(n)::BIGINT AS total, max(n) AS top FROM c GROUP BY key HAVING sum(n) >= 5 AND max(n) > 0.6 * sum(n)""")
def domain_label_balance(spark, sf):
    return ST.domain_label_balance(_questions(spark, sf))


@query("mix_manifest", f"""
WITH r AS (SELECT d.doc_id, d.source, d.lang, {KEY} AS k, quality FROM documents d JOIN labels l USING (doc_id)),
f AS (SELECT k, min(quality) <> max(quality) AS differ, min(doc_id) AS first FROM r GROUP BY k),
v AS (SELECT r.*, CASE WHEN differ THEN 'conflict' WHEN doc_id = first THEN 'keep' ELSE 'duplicate' END AS verdict FROM r JOIN f USING (k)),
kept AS (SELECT source, lang, false AS perm FROM v WHERE verdict = 'keep' UNION ALL SELECT source, lang, true FROM v WHERE verdict = 'keep' AND doc_id % 4 = 0)
SELECT 'source' AS section, source AS key, count(*) AS n FROM kept GROUP BY source UNION ALL SELECT 'lang', lang, count(*) FROM kept GROUP BY lang
UNION ALL SELECT 'permuted', 'copies', count(*) FROM kept WHERE perm HAVING count(*) > 0 UNION ALL SELECT 'dropped', verdict, count(*) FROM v WHERE verdict <> 'keep' GROUP BY verdict""")
def mix_manifest(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    judged = DD.resolve_conflicts(rows, X.state_key(F.col("text")), F.col("quality"), ["doc_id"])
    named = judged.withColumn("id", F.col("doc_id").cast("string")).select("id", "doc_id", "source", "lang", "verdict")
    dropped = named.where("verdict <> 'keep'").select("id", "verdict")
    copies = named.where("doc_id % 4 = 0").withColumn("id", F.concat("id", F.lit("-perm")))
    return ST.mix_manifest(DD.followers(named.unionByName(copies), dropped).select("id", "source", "lang"), dropped)


@query("split_by_suffix", f"""
SELECT {SPLIT.format(g=DOC_GROUP)} AS split, CASE WHEN doc_id % 3 = 0 THEN source ELSE concat('gen:', source) END AS suffix, count(*) AS n FROM documents GROUP BY 1, 2""")
def split_by_suffix(spark, sf):
    source = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("fix:padding+"), "source")).otherwise(F.concat(F.lit("gen:"), "source"))
    group = F.concat(F.lit("group:"), (F.col("doc_id") % 100).cast("string"))
    return ST.split_report(docs(spark, sf).select(DD.split_name(group).alias("split"), source.alias("s")), F.col("s"))


@query("unknown_votes", f"""
WITH {AGGREGATE.split("m AS")[0].rstrip().rstrip(",")}
SELECT vec_id, field, len(list_filter(ds, lambda d: list_position(d, list_max(d)) = 4))::BIGINT AS votes FROM g WHERE len(list_filter(ds, lambda d: list_position(d, list_max(d)) = 4)) >= 2""")
def unknown_votes(spark, sf):
    return RW.unknown_votes(teachers(spark, sf).withColumn("values", values()), ["vec_id", "field"])


@query("single_questions", "SELECT concat(doc_id, '-', f) AS id, n_fields FROM (SELECT doc_id, unnest(['Qualität', 'topic', 'mood']) AS f, 1 AS n_fields FROM documents)")
def single_questions(spark, sf):
    one = RW.single_questions(document_rows(spark, sf))
    return one.select(F.concat_ws("-", "doc_id", "field").alias("id"), F.size("questions").alias("n_fields"))


@query("kept_fields", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'topic,mood' ELSE 'mood' END AS fields FROM documents")
def kept_fields(spark, sf):
    wanted = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("mood"), F.lit("topic"))).otherwise(F.array(F.lit("mood"), F.lit("other")))
    return RW.keep_fields(document_rows(spark, sf), wanted).select("doc_id", F.array_join(F.transform("questions", lambda q: q["field"]), ",").alias("fields"))


@query("derived_rows", "SELECT doc_id, concat('fix:f+gen:', source) AS source, concat('domain:d,fix:f,type:', CASE WHEN doc_id % 2 = 0 THEN 'noul' ELSE 'mixed' END) AS tags, lang AS head FROM documents")
def derived_rows(spark, sf):
    rows = document_rows(spark, sf).withColumn("questions", F.when(F.col("doc_id") % 2 == 0, F.slice("questions", 1, 1)).otherwise(F.col("questions")))
    rows = rows.withColumn("tags", F.array_except("tags", F.array(F.concat(F.lit("group:"), (F.col("doc_id") % 100).cast("string")))))
    done = RW.finished(RW.derived(rows, "f"), "f")
    return done.select("doc_id", "source", F.array_join("tags", ",").alias("tags"), F.substring_index("id", "-f-", 1).alias("head"))


@query("row_tags", """
SELECT doc_id, concat('domain:', lang, ',type:mixed,fmt:plain_text,len:', CASE WHEN n_chars < 150 THEN 'short' WHEN n_chars < 400 THEN 'medium' ELSE 'long' END, ',writer:', source) AS tags FROM documents""")
def row_tags(spark, sf):
    rows = document_rows(spark, sf).join(docs(spark, sf).select("doc_id", "n_chars", F.col("source").alias("w")), "doc_id")
    return rows.select("doc_id", F.array_join(RW.row_tags(F.col("lang"), F.col("questions"), F.lit("Plain text with marks"), F.col("n_chars"), F.col("w")), ",").alias("tags"))


@query("display_order", "SELECT doc_id, array_to_string(list_transform(list_sort([[md5(concat(doc_id, '|topic|ds|', 0)), 'billing'], [md5(concat(doc_id, '|topic|ds|', 1)), 'shipping'], [md5(concat(doc_id, '|topic|ds|', 2)), 'tech']]), lambda x: x[2]), ',') AS shown FROM documents")
def display_order(spark, sf):
    v = F.array(F.lit("billing"), F.lit("shipping"), F.lit("tech"))
    return docs(spark, sf).select("doc_id", F.array_join(RW.display_order(v, F.col("doc_id").cast("string"), F.lit("topic"), F.lit("ds")), ",").alias("shown"))


@query("teacher_blocks", "SELECT doc_id, md5(concat('State: ', text, chr(10), 'Qualität (noul): Is it good?', CASE WHEN doc_id % 11 = 0 THEN ' The answer is yes.' ELSE '' END, chr(10), '  options: yes, no')) AS digest FROM documents")
def teacher_blocks(spark, sf):
    rows = document_rows(spark, sf)
    return rows.select("doc_id", F.md5(RW.teacher_block(F.col("id"), F.col("state"), F.slice("questions", 1, 1), F.lit("ds"))).alias("digest"))


@query("labs_of_models", """
SELECT source, CASE WHEN doc_id % 4 = 0 THEN 'zhipu' WHEN doc_id % 4 = 1 THEN 'moonshot' WHEN doc_id % 4 = 2 THEN 'alibaba' ELSE '' END AS lab, count(*) AS n FROM documents GROUP BY 1, 2""")
def labs_of_models(spark, sf):
    k = F.col("doc_id")
    model = F.when(k % 4 == 0, "zai/GLM-5").when(k % 4 == 1, "ollama/kimi-k3").when(k % 4 == 2, "hf/Qwen3").otherwise("other")
    return docs(spark, sf).groupBy("source", RW.lab_of(model).alias("lab")).agg(F.count("*").alias("n"))


@query("length_filter", "SELECT doc_id, floor(length(text) / 3.5) <= 900 AND doc_id % 6 > 0 AS fits FROM documents")
def length_filter(spark, sf):
    dist = F.when(F.col("doc_id") % 6 == 0, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array(F.lit(0.4), F.lit(0.6)))
    return docs(spark, sf).select("doc_id", RW.fits(X.token_estimate(F.col("text")), 900, dist).alias("fits"))


@query("encoded_targets", """
SELECT doc_id, CASE WHEN quality IS NULL THEN NULL WHEN doc_id % 3 = 0 THEN (quality = 1)::INT::DOUBLE WHEN doc_id % 3 = 1 THEN 0.75::DOUBLE END AS p_yes FROM documents LEFT JOIN labels USING (doc_id)""")
def encoded_targets(spark, sf):
    d = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    k, q = F.col("doc_id"), F.col("quality")
    given = F.when(k % 3 == 1, F.array(F.lit(0.6), F.lit(0.2))).when(k % 3 == 2, F.array(F.lit(0.0), F.lit(0.0)))
    label = F.when(q == 1, "yes").when(q == 0, "no")
    dist = RW.encoded_target(F.array(F.lit("no"), F.lit("yes")), F.array(F.lit("yes"), F.lit("no")), given, label)
    return d.select("doc_id", F.when(q.isNotNull(), F.round(F.get(dist, F.lit(1)), 9)).alias("p_yes"))


@query("official_gold", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN CASE WHEN quality = 1 THEN 'true' ELSE 'false' END WHEN 1 THEN cast(toxic AS VARCHAR) ELSE 'tech' END AS gold FROM labels")
def official_gold(spark, sf):
    k = F.col("doc_id")
    kind = F.when(k % 3 == 0, "noul").when(k % 3 == 1, "score").otherwise("choice")
    options = F.array(F.lit("calm"), F.lit("angry"), F.lit("tech"))
    label = F.when(kind == "noul", F.when(F.col("quality") == 1, "yes").otherwise("no")).when(kind == "score", F.when(F.col("toxic") == 0, "calm").otherwise("angry")).otherwise("tech")
    return table(spark, sf, "labels").select("doc_id", RW.official_gold(kind, options, label).alias("gold"))


@query("examples", """
WITH s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'F1' WHEN 1 THEN 'F5' ELSE 'G' END AS set, doc_id % 5 = 0 AS traced FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY set ORDER BY CASE WHEN set = 'F5' AND traced THEN 0 ELSE 1 END, md5(cast(doc_id AS VARCHAR)), doc_id) AS rn FROM s)
SELECT doc_id, set, CASE set WHEN 'G' THEN [0, 1, 4][rn] WHEN 'F1' THEN 2 ELSE [3, 5][rn] END::INTEGER AS place FROM r WHERE rn <= CASE set WHEN 'G' THEN 3 WHEN 'F1' THEN 1 ELSE 2 END""")
def examples(spark, sf):
    k = F.col("doc_id")
    d = docs(spark, sf).select("doc_id", F.when(k % 4 == 0, "F1").when(k % 4 == 1, "F5").otherwise("G").alias("set"))
    return P.examples(d, "set", "doc_id", F.md5(k.cast("string")), ["G", "G", "F1", "F5", "G", "F5", "F12"], k % 5 == 0, ("F5",)).select("doc_id", "set", "place")


@query("diverse_pick", """
WITH r AS (SELECT doc_id, source, md5(cast(doc_id AS VARCHAR)) AS o, row_number() OVER (PARTITION BY source ORDER BY md5(cast(doc_id AS VARCHAR)), doc_id) AS rn FROM documents)
SELECT doc_id, source FROM r ORDER BY CASE WHEN rn = 1 THEN 0 ELSE 1 END, o, doc_id LIMIT 30""")
def diverse_pick(spark, sf):
    return P.diverse(docs(spark, sf).select("doc_id", "source"), "source", "doc_id", F.md5(F.col("doc_id").cast("string")), 30)


@query("most_common_types", "SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, event_type)::INTEGER AS rank FROM events GROUP BY event_type")
def most_common_types(spark, sf):
    return P.most_common(table(spark, sf, "events"), "event_type")


@query("props_shapes", """SELECT event_type, '{"k": int}' AS shape, count(*) AS n FROM events WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') GROUP BY event_type""")
def props_shapes(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", J.shape("props").alias("shape")).agg(F.count("*").alias("n"))


@query("reply_json", """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN concat('{"turn":', turn, ',"role":"', role, '"}') WHEN 1 THEN concat('[', turn, ',{"role":"', role, '"}]') END AS reply FROM conversations""")
def reply_json(spark, sf):
    t, role = F.col("turn").cast("string"), F.col("role")
    reply = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit('Sure {x}: ```json\n{"turn": '), t, F.lit(', "role": "'), role, F.lit('"}\n``` as asked')))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("```json\n["), t, F.lit(', {"role" : "'), role, F.lit('"}]\n```')))
        .otherwise(F.concat(F.lit('{"turn": '), t, F.lit(', "role": ')))
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", J.extract_json(reply).alias("reply"))


@query("card_blocks", """
SELECT conv_id, turn, 1 AS card, concat('{"state":', turn, ',"questions":{"q":1}}') AS row, NULL::VARCHAR AS problem FROM conversations
UNION ALL SELECT conv_id, turn, 2, concat('{"state":{"role":"', role, '"}}'), NULL FROM conversations
UNION ALL SELECT conv_id, turn, 3, NULL, 'invalid JSON' FROM conversations""")
def card_blocks(spark, sf):
    t, role = F.col("turn").cast("string"), F.col("role")
    reply = F.concat(F.lit('### card 1\n{"state": '), t, F.lit(', "questions": {"q": 1}}\n## Card 2\n{"state": {"role": "'), role, F.lit('"}\n```\n###card 3\n{"state": [{"q": 1}, {]}\n'))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.explode(J.card_blocks(reply)).alias("b")).select("conv_id", "turn", "b.*")


@query("usable_blocks", "SELECT conv_id, turn, turn % 3 < 2 AS usable FROM conversations")
def usable_blocks(spark, sf):
    one = lambda k, good: F.concat(F.lit(f"### card {k}\n"), F.when(good, '{"state": "s", "questions": {}}\n').otherwise('{"state": "s"}\n'))
    reply = F.concat(one(1, F.col("turn") % 3 == 0), one(2, F.col("turn") % 3 < 2), one(3, F.lit(False)), F.when(F.col("turn") % 3 == 0, one(4, F.lit(True))).otherwise(""))
    asked = F.when(F.col("turn") % 3 == 0, 4).when(F.col("turn") % 3 == 1, 2).otherwise(3)
    return table(spark, sf, "conversations").select("conv_id", "turn", RW.enough_blocks(J.card_blocks(reply), asked).alias("usable"))


@query("natural_strings", r"""
SELECT conv_id, turn, CASE WHEN length(regexp_replace(text, '\P{L}', '', 'g')) >= 3 AND NOT (regexp_full_match(text, '[\w.\-/@:#+]+') AND regexp_matches(text, '[_\d]')) THEN 2 ELSE 1 END AS n FROM conversations""")
def natural_strings(spark, sf):
    state = F.to_json(F.struct(F.lit("a plain sentence").alias("a"), F.lit("id_7").alias("b"), F.array("text").alias("c"), F.col("turn").alias("d")))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.size(J.natural_text(state, F.lit("json"))).alias("n"))


@query("compact_texts", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN replace(props, ' ', '') WHEN 1 THEN props ELSE '' END AS text FROM events""")
def compact_texts(spark, sf):
    k = F.col("event_id")
    value = F.when(k % 3 < 2, F.col("props"))
    return table(spark, sf, "events").select("event_id", RW.compact_text(value, F.when(k % 3 == 1, "string").otherwise("json")).alias("text"))


@query("predict", f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 0.2 ELSE 0.5 END AS t, CASE vec_id % 3 WHEN 0 THEN 'off' WHEN 1 THEN 'on' ELSE 'auto' END AS mode, embedding FROM embeddings),
p AS (SELECT vec_id, mode, f, {SOFTMAX.format(l="l1", t="t")} AS p1, {SOFTMAX.format(l="l2", t="t")} AS p2 FROM (
  SELECT vec_id, t, mode, 0 AS f, {_sql_slice(0)} AS l1, {_sql_slice(2)} AS l2 FROM e UNION ALL SELECT vec_id, t, mode, 1, {_sql_slice(1)}, {_sql_slice(3)} FROM e)),
c AS (SELECT *, mode = 'on' OR (mode = 'auto' AND (4 * list_max(p1) - 1) / 3 < 0.5) AS redo FROM p),
a AS (SELECT vec_id, mode, f, redo, CASE WHEN redo THEN p2 ELSE p1 END AS q FROM c)
SELECT vec_id AS id, array_to_string(list(['a', 'b', 'c', 'unknown'][list_position(q, list_max(q))] ORDER BY f), ',') AS choices, round(sum(q[4]), 6) AS unknown, (2 + 20 * max(redo::INT))::BIGINT AS output_tokens,
CASE WHEN mode <> 'off' THEN coalesce(array_to_string(list(concat('q', f) ORDER BY f) FILTER (WHERE redo), ','), '') END AS reasoned FROM a GROUP BY vec_id, mode""")
def predict(spark, sf):
    k = F.col("vec_id")
    mode = F.when(k % 3 == 0, "off").when(k % 3 == 1, "on").otherwise("auto")
    lang = F.when(k % 2 == 0, "en").otherwise("de")
    fields = F.array(*[F.struct(F.lit(f"q{q}").alias("field"), F.lit(q).alias("pos"), _slice(q).alias("logits")) for q in range(2)])
    requests = vectors(spark, sf).select(k.alias("id"), F.lit("choice").alias("kind"), lang.alias("lang"), values().alias("values"), mode.alias("reasoning"), F.lit(100).alias("prompt_tokens"), F.explode(fields).alias("f")).select("*", "f.*").drop("f")
    later = F.array(*[F.struct(F.lit(f"q{q}").alias("field"), _slice(2 + q).alias("logits")) for q in range(2)])
    second = vectors(spark, sf).select(k.alias("id"), F.explode(later).alias("f"), F.lit(20).cast("long").alias("trace_tokens")).select("id", "f.*", "trace_tokens")
    temperatures = spark.createDataFrame([("choice:en", 0.2), ("choice", 0.5)], "key string, value double")
    out = DC.predicted(requests, temperatures, spark.createDataFrame([("choice", 0.5)], "key string, value double"), second)
    unknown = F.aggregate("answers", F.lit(0.0), lambda a, x: a + x["unknown"])
    return out.select("id", F.array_join(F.transform("answers", lambda a: a["choice"]), ",").alias("choices"), F.round(unknown, 6).alias("unknown"), "output_tokens", F.array_join("reasoned_fields", ",").alias("reasoned"))


@query("writer_dists", "SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE round(abs(embedding[1]::DOUBLE) / (abs(embedding[1]::DOUBLE) + abs(embedding[2]::DOUBLE)), 6) END AS p FROM embeddings")
def writer_dists(spark, sf):
    a, b = (F.abs(F.get("embedding", F.lit(i)).cast("double")) for i in range(2))
    p = F.when(F.col("vec_id") % 5 == 0, F.array(F.lit(0.0), F.lit(0.0), F.lit(0.7))).otherwise(F.array(b, a, F.lit(0.7)))
    dist = RW.clean_writer_dist(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("y"), F.lit("x"), F.lit("stray")), p)
    return vectors(spark, sf).select("vec_id", F.round(F.get(dist, F.lit(0)), 6).alias("p"))


@query("writer_filter", f"""
WITH {AGGREGATE}, w AS (SELECT vec_id, 'q0' AS field, {SOFTMAX.format(l=_sql_slice(7), t="0.2")} AS w FROM embeddings)
SELECT vec_id, field FROM r JOIN w USING (vec_id, field) WHERE reason IS NULL AND list_position(w, list_max(w)) <> top""")
def writer_filter(spark, sf):
    labelled = L.aggregate_labels(teachers(spark, sf), ["vec_id", "field"]).where("reason is null")
    writer = vectors(spark, sf).select("vec_id", F.lit("q0").alias("field"), D.softmax(_slice(7), 0.2).alias("dist"))
    return L.writer_disagrees(labelled, writer, ["vec_id", "field"])


@query("teacher_mean", f"WITH {AGGREGATE} SELECT vec_id, field, CASE WHEN len(ds) >= 3 THEN round(({MEAN})[1], 6) END AS p FROM m")
def teacher_mean(spark, sf):
    out = L.all_must_answer(teachers(spark, sf), ["vec_id", "field"])
    return out.select("vec_id", "field", F.round(F.get("mean", F.lit(0)), 6).alias("p"))


@query("traced_rows", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'because' END AS reasoning, CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 2 END::INTEGER AS n_tags FROM documents")
def traced_rows(spark, sf):
    parts, traces = _parts(spark, sf)
    return R.with_traces(R.union_in_order(parts), traces).select("doc_id", "reasoning", F.size("tags").alias("n_tags"))


@query("reply_cache", "SELECT doc_id, doc_id % 3 = 0 AS cached FROM documents")
def reply_cache(spark, sf):
    asks = docs(spark, sf).select("doc_id", F.lit("p").alias("provider"), F.concat(F.lit("ask "), F.col("doc_id").cast("string")).alias("body"), F.lit(1).alias("attempt"))
    keyed = asks.withColumn("cache_key", F.sha2(F.to_json(F.array("provider", "body", F.col("attempt").cast("string"))), 256))
    known, rest = R.with_replies(asks, keyed.where("doc_id % 3 = 0").select("cache_key", F.lit("r").alias("reply")))
    return known.select("doc_id", F.lit(True).alias("cached")).unionByName(rest.select("doc_id", F.lit(False).alias("cached")))


@query("permuted_copies", "SELECT concat(doc_id, '-perm') AS id, 3 AS n, true AS moved FROM documents WHERE doc_id % 2 = 0")
def permuted_copies(spark, sf):
    options = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    d = docs(spark, sf).select(F.col("doc_id").cast("string").alias("id"), options.alias("o"))
    out = DD.permuted(d, "o", 3, "id")
    return out.select("id", F.size(F.array_intersect("o", F.array(F.lit("a"), F.lit("b"), F.lit("c")))).alias("n"), (F.array_join("o", "") != "abc").alias("moved"))


@query("language_verdicts", r"""
WITH l AS (SELECT doc_id, lang, length(regexp_replace(text, '\P{L}', '', 'g')) AS letters, length(regexp_replace(lower(text), '[^äöüß]', '', 'g')) AS special FROM documents)
SELECT doc_id, letters < 20 OR (doc_id % 10 >= 2 AND NOT (lang = 'de' AND letters >= 400 AND special = 0)) AS ok FROM l""")
def language_verdicts(spark, sf):
    k = F.col("doc_id")
    label = F.when(k % 10 == 0, "xx").when((F.col("lang") == "de") & (k % 3 == 0), "als").otherwise(F.col("lang"))
    letters = F.length(F.regexp_replace("text", r"\P{L}", ""))
    ok = C.language_passes(label, F.when(k % 10 == 1, 0.4).otherwise(0.9), F.lit(0.8), F.col("lang"), letters, F.col("text"))
    return docs(spark, sf).select("doc_id", ok.alias("ok"))
