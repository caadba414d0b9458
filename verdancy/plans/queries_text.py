"""Queries over documents, conversations, labels and benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks as C
from ..functions import contact as CT
from ..functions import text as X
from ..operators import copyguard as G
from ..operators import dedup as DD
from ..operators import fixsets as FX
from ..operators import picks as P
from ..operators import scans as SC
from ..operators import stats as ST
from .catalogue import query

KEY = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


HASH = "cast(concat('0x', substr(sha256(concat('splits-v1|', {g})), 1, 12)) AS BIGINT) / 281474976710656.0"
SPLIT = f"CASE WHEN {HASH} < 0.10 THEN 'test' WHEN {HASH} < 0.15000000000000002 THEN 'calib' WHEN {HASH} < 0.18000000000000002 THEN 'valid' ELSE 'train' END"
DOC_GROUP = "concat('group:', cast(doc_id % 100 AS VARCHAR))"


@query("exact_dedup", f"""
WITH k AS (SELECT doc_id, doc_id % 100 AS g, {KEY} AS k FROM documents),
f AS (SELECT k, min(doc_id) AS first, arg_min(g, doc_id) AS fg FROM k GROUP BY k)
SELECT doc_id, CASE WHEN fg <> g AND first < doc_id THEN first END AS dup_of, CASE WHEN fg <> g AND first < doc_id THEN 'exact' END AS kind FROM k JOIN f USING (k)""")
def exact_dedup(spark, sf):
    d = docs(spark, sf)
    return DD.exact_groups(d, X.state_key(F.col("text")), F.col("doc_id") % 100, "doc_id").select("doc_id", "dup_of", "kind")


@query("whole_row_dedup", """
SELECT doc_id, CASE WHEN min(doc_id) OVER (PARTITION BY text, lang) < doc_id THEN min(doc_id) OVER (PARTITION BY text, lang) END AS dup_of FROM documents""")
def whole_row_dedup(spark, sf):
    return DD.identical_rows(docs(spark, sf), [F.col("text"), F.col("lang")], "doc_id").select("doc_id", "dup_of")


@query("near_dedup")
def near_dedup(spark, sf):
    d = docs(spark, sf).select("doc_id", "text")
    key = X.state_key(F.col("text"))
    return DD.dedup(d, key, F.col("doc_id") % 100, X.canonical_sha(key), "doc_id").select("doc_id", "dup_of", "kind")


@query("first_id_wins", "SELECT source, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY source")
def first_id_wins(spark, sf):
    return DD.first_by(docs(spark, sf).select("source", "doc_id", "lang"), ["source"], ["doc_id"])


@query("hash_split", f"SELECT doc_id, {SPLIT.format(g=DOC_GROUP)} AS split FROM documents")
def hash_split(spark, sf):
    group = F.concat(F.lit("group:"), (F.col("doc_id") % 100).cast("string"))
    return docs(spark, sf).select("doc_id", DD.split_name(group).alias("split"))


@query("dedup_split_report", f"""
WITH k AS (SELECT doc_id, doc_id % 100 AS g, {KEY} AS k, {SPLIT.format(g=DOC_GROUP)} AS split FROM documents),
f AS (SELECT k, min(doc_id) AS first, arg_min(g, doc_id) AS fg FROM k GROUP BY k)
SELECT split, count(*) AS n, count_if(NOT (fg <> g AND first < doc_id)) AS kept, count_if(fg <> g AND first < doc_id) AS dropped FROM k JOIN f USING (k) GROUP BY split""")
def dedup_split_report(spark, sf):
    d = docs(spark, sf)
    marked = DD.exact_groups(d, X.state_key(F.col("text")), F.col("doc_id") % 100, "doc_id")
    group = F.concat(F.lit("group:"), (F.col("doc_id") % 100).cast("string"))
    return marked.groupBy(DD.split_name(group).alias("split")).agg(F.count("*").alias("n"), F.count_if(F.col("kind").isNull()).alias("kept"), F.count_if(F.col("kind").isNotNull()).alias("dropped"))


@query("mix_conflicts", f"""
WITH r AS (SELECT d.doc_id, {KEY} AS k, quality FROM documents d JOIN labels l USING (doc_id)),
f AS (SELECT k, min(quality) <> max(quality) AS differ, min(doc_id) AS first FROM r GROUP BY k)
SELECT doc_id, CASE WHEN differ THEN 'conflict' WHEN doc_id = first THEN 'keep' ELSE 'duplicate' END AS verdict FROM r JOIN f USING (k)""")
def mix_conflicts(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    return DD.resolve_conflicts(rows, X.state_key(F.col("text")), F.col("quality"), ["doc_id"]).select("doc_id", "verdict")


@query("mix_followers", "SELECT cast(doc_id AS VARCHAR) AS id FROM documents WHERE lang <> 'fr' UNION ALL SELECT concat(doc_id, '-perm') FROM documents WHERE lang = 'en'")
def mix_followers(spark, sf):
    d = docs(spark, sf)
    rows = d.select(F.col("doc_id").cast("string").alias("id"), "lang").unionByName(d.where("lang in ('en', 'fr')").select(F.concat(F.col("doc_id").cast("string"), F.lit("-perm")).alias("id"), "lang"))
    return DD.followers(rows, d.where("lang = 'fr'").select(F.col("doc_id").cast("string").alias("id"))).select("id")


@query("content_ids", """SELECT doc_id, concat(lang, '-g-', substr(sha256(concat('["', doc_id, '","', source, '"]')), 1, 10)) AS id FROM documents""")
def content_ids(spark, sf):
    sha = X.canonical_sha(F.col("doc_id"), F.col("source"))
    return docs(spark, sf).select("doc_id", X.content_id(F.concat("lang", F.lit("-g-")), sha).alias("id"))


@query("ngram_contamination", r"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
g AS (SELECT DISTINCT array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT w, unnest(range(1, len(w) - 6)) AS i FROM b)),
x AS (SELECT doc_id, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t))
SELECT DISTINCT doc_id FROM x WHERE gram IN (SELECT gram FROM g)""")
def ngram_contamination(spark, sf):
    return G.contaminated(docs(spark, sf).select("doc_id", "text"), "text", table(spark, sf, "benchmark"), "text", "doc_id").select("doc_id")


@query("state_decontamination", f"SELECT doc_id FROM documents WHERE {KEY} IN (SELECT {KEY} FROM benchmark)")
def state_decontamination(spark, sf):
    known = table(spark, sf, "benchmark").select(X.digest(X.state_key(F.col("text"))).alias("_k"))
    return docs(spark, sf).withColumn("_k", X.digest(X.state_key(F.col("text")))).join(known, "_k", "left_semi").select("doc_id")


@query("round_robin_pick", """
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, min(doc_id) OVER (PARTITION BY source) AS first FROM documents)
SELECT doc_id, source FROM r ORDER BY CASE WHEN source = 'src3' AND rn <= 10 THEN 0 ELSE 1 END,
CASE WHEN source = 'src3' AND rn > 10 THEN rn - 10 ELSE rn END, first LIMIT 100""")
def round_robin_pick(spark, sf):
    return P.round_robin(docs(spark, sf).select("doc_id", "source"), "source", "doc_id", 100, "src3", 10)


@query("stratified_sample", """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(cast(doc_id AS VARCHAR)), doc_id) AS rn FROM documents) WHERE rn <= 20""")
def stratified_sample(spark, sf):
    return P.stratified(docs(spark, sf).select("doc_id", "lang"), "lang", F.md5(F.col("doc_id").cast("string")), 20, "doc_id")


@query("domain_spread", """
WITH k AS (SELECT doc_id, lang, md5(cast(doc_id AS VARCHAR)) AS k FROM documents),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k, doc_id) AS turn FROM k)
SELECT doc_id, lang FROM t ORDER BY turn, lang LIMIT 30""")
def domain_spread(spark, sf):
    return P.spread(docs(spark, sf).select("doc_id", "lang"), "lang", "doc_id", F.md5(F.col("doc_id").cast("string")), 30)


@query("plan_and_fill", """
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn,
CASE lang WHEN 'en' THEN 5 WHEN 'fr' THEN 10 ELSE 2000000 END AS want, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS place FROM documents WHERE lang IN ('en', 'fr', 'de')),
p AS (SELECT *, CASE WHEN lang = 'de' THEN rn <= 15 ELSE rn <= want END AS planned FROM r)
SELECT doc_id, lang FROM p WHERE planned OR lang IN ('fr', 'de') ORDER BY CASE WHEN planned THEN 0 ELSE 1 END, place, rn LIMIT 30""")
def plan_and_fill(spark, sf):
    return P.plan_and_fill(docs(spark, sf).select("doc_id", "lang"), "lang", "doc_id", {"en": 5, "fr": 10, "de": 15}, ["fr", "de"])


@query("gaps_islands_chunks", """
WITH m AS (SELECT conv_id, turn, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id % 10 ORDER BY conv_id, turn)),
i AS (SELECT conv_id, turn, sum(new) OVER (PARTITION BY conv_id % 10 ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT conv_id, turn, island::BIGINT AS island, ((row_number() OVER (PARTITION BY conv_id % 10, island ORDER BY conv_id, turn) - 1) // 6)::BIGINT AS chunk FROM i""")
def gaps_islands_chunks(spark, sf):
    c = table(spark, sf, "conversations").withColumn("run", F.col("conv_id") % 10)
    return P.islands(c, "run", ["conv_id", "turn", "role", "text"], F.col("role")).select("conv_id", "turn", "island", "chunk")


@query("running_budget", """
WITH b AS (SELECT doc_id, source, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents)
SELECT doc_id, source FROM b WHERE before < 10500""")
def running_budget(spark, sf):
    return P.until_budget(docs(spark, sf).select("doc_id", "source", "n_chars"), "source", [F.col("doc_id")], F.col("n_chars"), F.lit(0), F.lit(10500)).select("doc_id", "source")


@query("fixed_batches", "SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 12)::BIGINT AS batch FROM documents")
def fixed_batches(spark, sf):
    return P.fixed_batches(docs(spark, sf).select("doc_id", "source"), "source", ["doc_id"], 12)


@query("token_bucket_batches", """
WITH RECURSIVE l AS (SELECT doc_id, floor(length(text) / 3.5)::BIGINT AS n_tokens, row_number() OVER (ORDER BY floor(length(text) / 3.5), doc_id) AS rn FROM documents),
r(rn, batch, n) AS (
  SELECT 1::BIGINT, 0::BIGINT, 1::BIGINT
  UNION ALL
  SELECT l.rn, CASE WHEN l.n_tokens * (r.n + 1) > 32768 THEN r.batch + 1 ELSE r.batch END, CASE WHEN l.n_tokens * (r.n + 1) > 32768 THEN 1 ELSE r.n + 1 END FROM r JOIN l ON l.rn = r.rn + 1
)
SELECT doc_id, n_tokens, batch FROM l JOIN r USING (rn)""")
def token_bucket_batches(spark, sf):
    d = docs(spark, sf).select("doc_id", X.token_estimate(F.col("text")).alias("n_tokens"))
    return P.token_batches(d, "n_tokens", "doc_id", 32_768)


@query("top_sources", """
WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source)
SELECT lang, source, n, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS rank FROM c) WHERE rank <= 4""")
def top_sources(spark, sf):
    return P.top_counts(docs(spark, sf), ["lang"], "source", 4)


@query("label_balance", """
WITH c AS (SELECT lang, quality, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY lang, quality)
SELECT lang, sum(n)::BIGINT AS total, max(n) AS top FROM c GROUP BY lang HAVING sum(n) >= 5 AND max(n) > 0.6 * sum(n)""")
def label_balance(spark, sf):
    return ST.label_balance(docs(spark, sf).join(table(spark, sf, "labels"), "doc_id"), "lang", "quality")


@query("describe_lengths", """
WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, count(*) AS n, round(avg(n_chars), 6) AS mean, median(n_chars)::DOUBLE AS median, max(CASE WHEN rn = least(n - 1, floor(0.9 * n)) + 1 THEN n_chars END) AS p90, max(n_chars) AS max FROM r GROUP BY lang""")
def describe_lengths(spark, sf):
    return ST.describe(docs(spark, sf), ["lang"], "n_chars").withColumn("mean", F.round("mean", 6))


@query("language_hint", r"""
WITH l AS (SELECT doc_id, lower(text) AS t FROM documents),
s AS (SELECT doc_id, 2 * len(regexp_extract_all(t, '[ğış]')) + len(list_filter(w, lambda x: x IN ('ve','bir','bu','için','icin','değil','degil','lütfen','lutfen','çok','cok','ama','gibi','ile','mi','mı','mu','mü','ben','biz','siz','istiyorum','gelmedi','yok','var'))) AS tr,
2 * len(regexp_extract_all(t, '[äß]')) + len(list_filter(w, lambda x: x IN ('und','nicht','der','die','das','ist','ich','sie','mit','für','auf','bitte','ein','eine','zu','wir','kein','keine','wurde'))) AS de
FROM (SELECT doc_id, t, regexp_extract_all(t, '[\p{L}\p{N}_]+') AS w FROM l))
SELECT doc_id, CASE WHEN tr > de THEN 'tr' WHEN de > tr THEN 'de' ELSE 'en' END AS hint FROM s""")
def language_hint(spark, sf):
    return docs(spark, sf).select("doc_id", X.language_hint(F.col("text")).alias("hint"))


@query("denylist_fold", """
SELECT doc_id, (contains(concat(' ', f, ' '), ' apache license ') OR contains(concat(' ', f, ' '), ' idiot ')) AS denied
FROM (SELECT doc_id, regexp_replace(strip_accents(replace(lower(text), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g') AS f FROM documents)""")
def denylist_fold(spark, sf):
    names = F.array(F.lit("Apache License"), F.lit("Idiot"))
    return docs(spark, sf).select("doc_id", C.denylisted(F.col("text"), names).alias("denied"))


@query("leak_phrases", r"""
SELECT conv_id, turn, regexp_matches(text, '(?i)\b(correct|right) (answer|option|choice)\b|\bthe answer is\b|\banswer:\s|\brichtige (antwort|option)\b|\bdie antwort (ist|lautet)\b|\bantwort:\s') AS leaks FROM conversations""")
def leak_phrases(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", C.announces(F.col("text")).alias("leaks"))


@query("trace_problems", r"""
SELECT conv_id, turn, CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty trace' ELSE concat_ws('; ',
  CASE WHEN len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) > 90 THEN 'too long' END,
  CASE WHEN regexp_matches(text, '(?i)\bas an ai\b|\bi am an ai\b|\blanguage model\b|\bprobabilit(y|ies)\b|\bteacher model\b|\bannotat|\bsprachmodell|\bwahrscheinlichkeit(en)?\b') THEN 'talks about itself or probabilities' END,
  CASE WHEN regexp_matches(text, '(?i)`|\b(option|answer|choice|cevap|antwort|auswahl)\s+[A-Za-z0-9]\b') THEN 'mentions an option symbol' END,
  CASE WHEN regexp_matches(text, '(?m)^\s*([-*•]|\d+[.)])\s') OR contains(text, '#') THEN 'list or markdown' END,
  CASE WHEN conv_id % 7 = 3 THEN 'language' END) END AS problems
FROM conversations""")
def trace_problems(spark, sf):
    c = table(spark, sf, "conversations")
    found = C.trace_problems(F.col("text"), F.col("conv_id") % 7 != 3)
    return c.select("conv_id", "turn", F.array_join(found, "; ").alias("problems"))


@query("word_counts", r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::INTEGER AS n_words, floor(length(text) / 3.5)::DOUBLE AS n_tokens FROM documents")
def word_counts(spark, sf):
    t = F.col("text")
    return docs(spark, sf).select("doc_id", X.word_count(t).alias("n_words"), X.token_estimate(t).cast("double").alias("n_tokens"))


@query("redaction", r"SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)bearer\s+[A-Za-z0-9._-]+', '[redacted]', 'g'), '\b(sk|hf|key)[-_][A-Za-z0-9_-]{8,}', '[redacted]', 'g') AS text FROM documents")
def redaction(spark, sf):
    return docs(spark, sf).select("doc_id", X.redacted(F.col("text")).alias("text"))


@query("scrub_counts")
def scrub_counts(spark, sf):
    done = docs(spark, sf).select("doc_id", "lang", CT.scrub("text", "lang").alias("s"))
    return done.groupBy("lang").agg(F.sum("s.hits").alias("hits"), F.count_if(F.col("s.hits") > 0).alias("rows"))


@query("padding_rows")
def padding_rows(spark, sf):
    rows = FX.numbered(docs(spark, sf).select("doc_id", "lang", "text"), "lang", ["doc_id"])
    out = FX.padded(rows, "doc_id", "text", "lang", "index", 7)
    return out.select("doc_id", "budget", F.size("others").alias("n_others"), F.length(F.array_join("others", "")).alias("n_chars"))


@query("injection_rows", r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l, CASE doc_id % 3 WHEN 0 THEN 'start' WHEN 1 THEN 'middle' ELSE 'end' END AS place FROM documents),
p AS (SELECT *, CASE place WHEN 'start' THEN 0 WHEN 'end' THEN len(l) ELSE len(l) // 2 END AS k FROM s)
SELECT doc_id, place, md5(array_to_string(list_concat(list_concat(l[1:k], ['INJECTED']), l[k + 1:len(l)]), chr(10))) AS digest FROM p""")
def injection_rows(spark, sf):
    place = P.cyclic(F.col("doc_id"), list(FX.PLACES))
    return docs(spark, sf).select("doc_id", place.alias("place"), F.md5(FX.injected(F.col("text"), F.lit("INJECTED"), place)).alias("digest"))


@query("row_checks", """
SELECT doc_id, length(trim(text)) < 15 AS short FROM documents""")
def row_checks(spark, sf):
    options = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(v).alias("description")) for v in ("good", "bad")])
    questions = F.array(F.struct(F.lit("quality").alias("field"), F.lit("choice").alias("type"), F.lit("Is it good?").alias("instructions"), options.alias("options")))
    problems = C.row_problems(F.col("text"), F.lit("string"), questions)
    return docs(spark, sf).select("doc_id", F.array_contains(problems, "state too short").alias("short"))


SETS = (
    "CASE doc_id % 16 WHEN 0 THEN 'G' WHEN 1 THEN 'P' WHEN 2 THEN 'F1' WHEN 3 THEN 'F2' WHEN 4 THEN 'F3' WHEN 5 THEN 'F4' WHEN 6 THEN 'F5' WHEN 7 THEN 'F6' WHEN 8 THEN 'F7' "
    "WHEN 9 THEN 'F8' WHEN 10 THEN 'F9' WHEN 11 THEN 'F10' WHEN 12 THEN 'F11' WHEN 13 THEN 'F12' WHEN 14 THEN source ELSE '?' END"
)


@query("set_labels", f"SELECT doc_id, {SETS} AS s FROM documents")
def set_labels(spark, sf):
    k = (F.col("doc_id") % 16).cast("int")
    origin = F.when(k == 0, F.concat(F.lit("gen:"), "source")).when(k == 1, F.concat(F.lit("pub:"), "source")).otherwise(F.concat(F.lit("fix:x+"), "source"))
    fix = F.when(k < 14, F.get(F.array(*[F.lit(name) for name, _ in ST.FIX_SETS]), F.greatest(k - 2, F.lit(0)))).when(k == 14, F.col("source"))
    tags = F.array(F.lit("domain:d"), F.concat(F.lit("fix:"), fix))
    return docs(spark, sf).select("doc_id", ST.set_of(origin, X.tag(F.array_compact(tags), "fix")).alias("s"))


@query("positional_join", """
WITH p AS (SELECT page_id, url, row_number() OVER (ORDER BY page_id) - 1 AS place FROM pages), d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS place FROM documents)
SELECT place, page_id, url, doc_id, lang FROM p JOIN d USING (place)""")
def positional_join(spark, sf):
    """Pages in their order, each with the document that is as far down by length."""
    pages, d = table(spark, sf, "pages").select("page_id", "url"), docs(spark, sf).select("doc_id", "lang", "n_chars")
    return SC.zipped(pages, d, [F.col("page_id")], [-F.col("n_chars"), F.col("doc_id")]).select("place", "page_id", "url", "doc_id", "lang")


@query("sales_running_totals", """
WITH s AS (SELECT sale_id, client_id, sold_at, total, priority, arrived_at, status FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL AND total IS NOT NULL),
r AS (SELECT *, row_number() OVER w AS rn, sum(cast(round(total * 100) AS BIGINT)) OVER w - cast(round(total * 100) AS BIGINT) AS before FROM s
  WINDOW w AS (PARTITION BY client_id ORDER BY sold_at, sale_id, total ROWS UNBOUNDED PRECEDING))
SELECT client_id, count(*) AS n, max(rn) - 1 AS last_place, sum(before)::BIGINT AS befores, count_if(before < 100000) AS in_budget FROM r GROUP BY client_id""")
def sales_running_totals(spark, sf):
    """What a client had bought before each sale, in cents: one client may hold a third of all sales."""
    s = table(spark, sf, "sales").select("sale_id", "client_id", "sold_at", "total").where("client_id is not null and sold_at is not null and total is not null")
    r = SC.running(s, ["client_id"], [F.col(c) for c in ("sold_at", "sale_id", "total")], {"before": F.round(F.col("total") * 100).cast("long")}, "place")
    return r.groupBy("client_id").agg(F.count("*").alias("n"), F.max("place").alias("last_place"), F.sum("before").alias("befores"), F.count_if(F.col("before") < 100_000).alias("in_budget"))
