"""Queries of single operators: templates, probes, prompts, votes, twins, picks, licences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import checks as C
from ..functions import dist as D
from ..functions import text as X
from ..operators import compare as CP
from ..operators import decide as DC
from ..operators import copyguard as G
from ..operators import dedup as DD
from ..operators import fixsets as FX
from ..operators import labels as L
from ..operators import picks as P
from ..operators import rows as RW
from ..operators import rules as R
from ..operators import stages as S
from ..operators import stats as ST
from ..sources import converters as CV
from ..sources import records as RC
from .catalogue import query
from .queries_dist import SOFTMAX, TOP, _slice, _sql_slice, _teacher_sql, teachers, values, vectors
from .queries_stages import _parts, document_rows
from .queries_text import HASH, docs, table


@query("placeholder_problems", r"""
WITH u AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(concat(text, ' {a} {b}'), '\{([a-z_0-9]+)\}', 1)) AS u FROM conversations)
SELECT conv_id, turn, array_to_string(list_sort(list_concat(['unused slot c'], list_transform(list_filter(u, lambda x: x <> 'a'), lambda x: concat('stray slot ', x)))), ',') AS problems FROM u""")
def placeholder_problems(spark, sf):
    found = C.placeholder_problems(F.concat("text", F.lit(" {a} {b}")), F.array(F.lit("a"), F.lit("c")))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(F.array_sort(found), ",").alias("problems"))


@query("character_shingles", "SELECT item_id, len(list_distinct(list_transform(range(1, greatest(1, length(text) - 4) + 1), lambda i: substr(text, i, 5))))::INTEGER AS n FROM benchmark")
def character_shingles(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.size(X.shingles(F.col("text"))).alias("n"))


@query("probe_list", """
WITH n AS (SELECT unnest(['en', 'fr', 'xx']) AS lang, unnest([0, 1, 2]) AS place), o AS (SELECT lang, count(*) AS ours FROM documents GROUP BY lang),
b AS (SELECT lang, count(*) AS base FROM documents JOIN labels USING (doc_id) GROUP BY lang)
SELECT lang, place::INTEGER AS place, ours, base FROM n LEFT JOIN o USING (lang) LEFT JOIN b USING (lang)""")
def probe_list(spark, sf):
    d = docs(spark, sf)
    ours = d.groupBy("lang").agg(F.count("*").alias("value"))
    base = d.join(table(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.count("*").alias("value"))
    return CP.listed(["en", "fr", "xx"], "lang", ours, base).select("lang", "place", "ours", "base")


@query("baseline_agreement", f"""
WITH e AS (SELECT vec_id, list_position(a, list_max(a)) AS a, list_position(b, list_max(b)) AS b FROM (SELECT vec_id, {_sql_slice(0)} AS a, {_sql_slice(1)} AS b FROM embeddings))
SELECT count(*) AS n, round(avg((a = b AND vec_id % 5 > 0)::INT), 6) AS agreement FROM e""")
def baseline_agreement(spark, sf):
    side = lambda k: vectors(spark, sf).select("vec_id", D.argmax(_slice(k)).alias("top"))
    return CP.agreement_with(side(0), side(1).where("vec_id % 5 > 0"), ["vec_id"], "top").withColumn("agreement", F.round("agreement", 6))


@query("unknown_options", """
SELECT doc_id, array_to_string(list_concat(['a', 'b'], CASE WHEN doc_id % 2 = 0 AND doc_id % 3 < 2 THEN ['unknown'] ELSE [] END), ',') AS options,
CASE WHEN doc_id % 2 = 0 AND doc_id % 3 < 2 THEN CASE lang WHEN 'de' THEN 'Der Zustand' ELSE 'The state d' END END AS text FROM documents""")
def unknown_options(spark, sf):
    k = F.col("doc_id")
    kind = F.when(k % 3 == 0, "choice").when(k % 3 == 1, "score").otherwise("noul")
    opts = F.array(*[F.struct(F.lit(v).alias("value"), F.lit("x").alias("description")) for v in "ab"])
    wide = DC.with_unknown(kind, opts, k % 2 == 0, F.col("lang"))
    extra = F.get(F.filter(wide, lambda o: o["value"] == DC.UNKNOWN), F.lit(0))["description"]
    return docs(spark, sf).select("doc_id", F.array_join(F.transform(wide, lambda o: o["value"]), ",").alias("options"), F.substring(extra, 1, 11).alias("text"))


@query("field_values", "SELECT doc_id, concat('quality=no,yes;topic=', CASE WHEN doc_id % 5 = 0 THEN 'bad label' ELSE 'billing' END, ',shipping,tech', CASE WHEN doc_id % 2 = 0 THEN ',unknown' ELSE '' END) AS fields FROM documents")
def field_values(spark, sf):
    two = F.transform(F.slice("questions", 1, 2), lambda q, i: q.withField("field", F.when(i == 0, "quality").otherwise("topic")))
    found = RW.field_values(two, F.col("doc_id") % 2 == 0)
    return document_rows(spark, sf).select("doc_id", F.array_join(F.transform(found, lambda f: F.concat(f["field"], F.lit("="), F.array_join(f["values"], ","))), ";").alias("fields"))


@query("row_texts", "SELECT doc_id, md5(concat(text, chr(10), CASE WHEN doc_id % 11 = 0 THEN 'Is it good? The answer is yes.' ELSE 'Is it good?' END, chr(10), 'Which team?', chr(10), 'How calm?')) AS digest FROM documents")
def row_texts(spark, sf):
    return document_rows(spark, sf).select("doc_id", F.md5(RW.texts_of(F.col("state"), F.col("questions"))).alias("digest"))


@query("rendered_chats", f"""
SELECT conv_id, turn, md5(concat('<|im_start|>system', chr(10), '{DC.SYSTEM_PROMPT}', '<|im_end|>', chr(10), '<|im_start|>user', chr(10), text, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), '<think>', chr(10), role, chr(10), '</think>', chr(10), chr(10), '{{}}', '<|im_end|>', chr(10))) AS digest FROM conversations""")
def rendered_chats(spark, sf):
    chat = DC.render(F.col("text"), F.lit("{}"), F.concat(F.lit("  "), "role", F.lit(" ")))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(chat).alias("digest"))


@query("second_pass", f"""
WITH e AS (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0), t=0.1)} AS a, {SOFTMAX.format(l=_sql_slice(1), t=0.1)} AS b FROM embeddings)
SELECT vec_id, round(CASE WHEN (4 * list_max(a) - 1) / 3 < 0.6 AND vec_id % 3 > 0 THEN list_max(b) ELSE list_max(a) END, 6) AS top, (4 * list_max(a) - 1) / 3 < 0.6 AND vec_id % 3 > 0 AS rescored FROM e""")
def second_pass(spark, sf):
    one, two = D.softmax(_slice(0), 0.1), D.softmax(_slice(1), 0.1)
    first = vectors(spark, sf).select("vec_id", F.array_max(one).alias("top"), D.uncertain(one, F.lit("choice"), F.lit(0.6)).alias("uncertain"))
    second = vectors(spark, sf).where("vec_id % 3 > 0").select("vec_id", F.array_max(two).alias("top"))
    return DC.rescored(first, second, ["vec_id"], ["top"]).select("vec_id", F.round("top", 6).alias("top"), "rescored")


@query("answers_as_options", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role ELSE concat(upper(role), '!') END AS option FROM conversations")
def answers_as_options(spark, sf):
    said = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" `"), F.upper("role"), F.lit("` "))).otherwise(F.concat(F.upper("role"), F.lit("!")))
    options = F.array(F.lit("user"), F.lit("assistant"), F.lit("system"))
    return table(spark, sf, "conversations").select("conv_id", "turn", DC.as_option(said, options).alias("option"))


@query("split_groups", f"SELECT doc_id, {HASH.format(g='g')} < 0.10 AS test FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('group:', doc_id % 50) ELSE concat('id:', doc_id) END AS g FROM documents)")
def split_groups(spark, sf):
    k = F.col("doc_id")
    tags = F.when(k % 2 == 0, F.array(F.lit("domain:x"), F.concat(F.lit("group:"), (k % 50).cast("string")))).otherwise(F.array(F.lit("domain:x")))
    return docs(spark, sf).select("doc_id", (DD.split_name(DD.split_group(tags, k.cast("string"))) == "test").alias("test"))


@query("negation_filter", f"""
WITH e AS (SELECT vec_id, a[2] AS a, b[2] AS b FROM (SELECT vec_id, {SOFTMAX.format(l=_sql_slice(0, 2), t=0.2)} AS a, {SOFTMAX.format(l=_sql_slice(1, 2), t=0.2)} AS b FROM embeddings))
SELECT vec_id, abs(b - (1 - a)) <= 0.25 AND (a > 0.5) <> (b > 0.5) AS negated, abs(b - a) <= 0.25 AND (a > 0.5) = (b > 0.5) AS twin FROM e""")
def negation_filter(spark, sf):
    a, b = (F.get(D.softmax(_slice(k, 2), 0.2), F.lit(1)) for k in range(2))
    return vectors(spark, sf).select("vec_id", FX.negation_holds(a, b).alias("negated"), FX.twin_holds(a, b).alias("twin"))


@query("injected_states", r"""
SELECT conv_id, turn, array_to_string(CASE turn % 3 WHEN 0 THEN list_concat(['X'], w) WHEN 2 THEN list_concat(w, ['X']) ELSE list_concat(list_concat(w[1:len(w) // 2], ['X']), w[len(w) // 2 + 1:len(w)]) END, '|') AS state
FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)""")
def injected_states(spark, sf):
    place = P.cyclic(F.col("turn"), list(FX.PLACES))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(FX.injected_array(F.split("text", " "), F.lit("X"), place), "|").alias("state"))


@query("wrong_answers", """
SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN CASE WHEN label % 4 >= 2 THEN 'a' ELSE 'unknown' END ELSE list_filter(['a', 'b', 'c', 'unknown'], lambda v: v <> ['a', 'b', 'c', 'unknown'][label % 4 + 1])[vec_id % 3 + 1] END AS wrong FROM embeddings""")
def wrong_answers(spark, sf):
    kind = F.when(F.col("vec_id") % 2 == 0, "score").otherwise("choice")
    return vectors(spark, sf).select("vec_id", FX.wrong_answer(kind, values(), F.col("label") % 4, F.col("vec_id")).alias("wrong"))


@query("disputed_templates", "SELECT source, count(*) AS n, count_if(quality = 1) AS agreed FROM documents JOIN labels USING (doc_id) GROUP BY source HAVING count(*) >= 2 AND count_if(quality = 1) * 2 < count(*)")
def disputed_templates(spark, sf):
    votes = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").select("source", (F.col("quality") == 1).alias("agree"))
    return L.disputed(votes, "source")


@query("rejected_templates", """
WITH v AS (SELECT source, quality, toxic FROM documents JOIN labels USING (doc_id)),
d AS (SELECT source FROM v GROUP BY source HAVING count(*) >= 2 AND count_if(quality = 1) * 2 < count(*)),
b AS (SELECT source FROM v WHERE toxic = 0 AND source <> 'src3' GROUP BY source HAVING count(*) >= 2 AND count_if(quality = 1) * 2 >= count(*))
SELECT doc_id FROM documents WHERE source NOT IN (SELECT source FROM d EXCEPT SELECT source FROM b)""")
def rejected_templates(spark, sf):
    votes = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").withColumn("agree", F.col("quality") == 1)
    second = votes.where("toxic = 0 and source <> 'src3'")
    gone = L.rejected(votes.select("source", "agree"), second.select("source", "agree"), "source")
    return docs(spark, sf).join(gone, "source", "left_anti").select("doc_id")


@query("clear_questions", f"""WITH {_teacher_sql()}, g AS (SELECT vec_id, field, count(DISTINCT {TOP}) AS tops, list(d ORDER BY teacher) AS ds FROM t WHERE d IS NOT NULL GROUP BY vec_id, field)
SELECT vec_id, field FROM g WHERE tops = 1 AND list_max(ds[1]) >= 0.5 AND field = 'q0'""")
def clear_questions(spark, sf):
    t = teachers(spark, sf)
    first = t.where("dist is not null").groupBy("vec_id", "field").agg(F.min_by("dist", "teacher").alias("gold"))
    return L.clear_questions(t, first, ["vec_id", "field"], 0.5, F.col("field") == "q0").select("vec_id", "field")


@query("teacher_pairs_of_rows", """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'qwen,gemma' WHEN 1 THEN 'ds,gemma' WHEN 2 THEN 'ds,qwen' WHEN 3 THEN NULL ELSE 'ds,qwen' END AS pair FROM documents""")
def teacher_pairs_of_rows(spark, sf):
    k = F.col("doc_id")
    touched = F.when(k % 5 == 0, F.array(F.lit("deepseek"))).when(k % 5 == 1, F.array(F.lit("alibaba"))).when(k % 5 == 2, F.array(F.lit("google"))).when(k % 5 == 3, F.array(F.lit("deepseek"), F.lit("google"))).otherwise(F.array().cast("array<string>"))
    pair = L.teacher_pair(F.array(F.lit("ds"), F.lit("qwen"), F.lit("gemma")), F.array(F.lit("deepseek"), F.lit("alibaba"), F.lit("google")), touched)
    return docs(spark, sf).select("doc_id", F.array_join(pair, ",").alias("pair"))


@query("silent_probes", f"""WITH {_teacher_sql()}, p AS (SELECT * FROM t WHERE vec_id % 7 = 0 AND teacher = 'ds'), q AS (SELECT vec_id, field FROM p GROUP BY 1, 2 HAVING count(d) = 0)
SELECT vec_id, field, teacher FROM p WHERE (vec_id, field) NOT IN (SELECT vec_id, field FROM q) UNION ALL SELECT vec_id, field, teacher FROM t WHERE teacher <> 'ds' AND (vec_id, field) IN (SELECT vec_id, field FROM q)""")
def silent_probes(spark, sf):
    t = teachers(spark, sf).select("vec_id", "field", "teacher", "dist")
    return L.filled_from(t.where("vec_id % 7 = 0 and teacher = 'ds'"), t.where("teacher <> 'ds'"), ["vec_id", "field"]).select("vec_id", "field", "teacher")


@query("needs_unknown", "SELECT vec_id, vec_id % 3 = 0 OR vec_id % 2 = 0 AS needed FROM embeddings")
def needs_unknown(spark, sf):
    dist = F.when(F.col("vec_id") % 2 == 0, F.array(*[F.lit(p) for p in (0.2, 0.2, 0.2, 0.4)])).otherwise(F.array(*[F.lit(p) for p in (0.5, 0.3, 0.2, 0.0)]))
    flag = F.when(F.col("vec_id") % 3 == 0, True)
    return vectors(spark, sf).select("vec_id", L.needs_unknown(flag, values(), dist).alias("needed"))


@query("weighted_choices", """
SELECT item, count(*) AS n FROM (SELECT CASE WHEN u < 0.5 THEN 'a' WHEN u < 0.8 THEN 'b' ELSE 'c' END AS item FROM (SELECT cast(concat('0x', substr(md5(cast(doc_id AS VARCHAR)), 1, 6)) AS BIGINT) / 16777216.0 AS u FROM documents)) GROUP BY item""")
def weighted_choices(spark, sf):
    u = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 6), 16, 10).cast("double") / 16777216.0
    return docs(spark, sf).groupBy(P.weighted_choice(u, [("a", 5), ("b", 3), ("c", 2)]).alias("item")).agg(F.count("*").alias("n"))


@query("rule_inverted", "SELECT o_orderkey, CASE WHEN o_totalprice::DECIMAL(18,2) <= 100000 THEN 'no' ELSE 'yes' END AS inverted FROM orders")
def rule_inverted(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", R.inverted(R.yes(F.col("o_totalprice").cast("decimal(18,2)") <= 100000)).alias("inverted"))


@query("rule_variants", """
WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders)
SELECT o_orderkey, i, ['deadline', 'discount', 'sum_limit'][i % 3 + 1] AS rule, (i // 3) % 4 AS variant FROM n""")
def rule_variants(spark, sf):
    """Orders in the order of their dates, rules and variants taking turns."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return FX.rule_rows(o, [F.col("o_orderdate"), F.col("o_orderkey")], ["deadline", "discount", "sum_limit"], 4).select("o_orderkey", "i", "rule", "variant")


@query("first_of_order", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def first_of_order(spark, sf):
    return P.first(docs(spark, sf).select("doc_id", "n_chars"), [F.desc("n_chars"), F.col("doc_id")], 25)


@query("post_check", """
SELECT doc_id, CASE WHEN length(trim(text)) < 15 THEN 'state too short' WHEN contains(text, '<decision>') THEN 'reserved marker in text' WHEN doc_id % 4 <> 1 AND doc_id % 13 = 0 THEN 'quality: dist does not sum to 1' END AS detail FROM documents""")
def post_check(spark, sf):
    parts, _ = _parts(spark, sf)
    done = S.post_checked(RC.union_in_order(parts))
    return done.select("doc_id", F.when(F.col("reason") == "post_check", F.col("detail")).alias("detail"))


@query("card_adherence", """
SELECT count_if(doc_id % 3 + 1 = CASE WHEN quality IS NULL THEN 1 ELSE 2 END) AS count_match, count_if(quality = 1) AS target_hit, count(quality) AS targets, round(avg(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) / 100.0), 6) AS length_ratio
FROM documents LEFT JOIN labels USING (doc_id)""")
def card_adherence(spark, sf):
    d = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    cards = d.select(
        (F.col("doc_id") % 3 + 1).alias("n_planned"), F.when(F.col("quality").isNull(), 1).otherwise(2).alias("n_made"), F.when(F.col("quality").isNotNull(), "yes").alias("target"),
        F.when(F.col("quality") == 1, "yes").otherwise("no").alias("label"), X.word_count(F.col("text")).alias("words"), F.lit(100).alias("planned_words"),
    )
    return ST.adherence(cards).withColumn("length_ratio", F.round("length_ratio", 6))


@query("share_texts", "SELECT lang, concat(count_if(n_chars > 1000), '/', count(*), ' (', printf('%.1f', 100.0 * count_if(n_chars > 1000) / count(*)), '%)') AS share FROM documents GROUP BY lang")
def share_texts(spark, sf):
    return docs(spark, sf).groupBy("lang").agg(ST.share_text(F.count_if(F.col("n_chars") > 1000), F.count("*")).alias("share"))


_LINE, _TEXT, _STRONG = (p.replace("'", "''") for p in (CV.LICENSE_LINE, CV.LICENSE_TEXT, CV.LICENSE_STRONG))


@query("license_lines", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
h AS (SELECT *, regexp_matches(line, '{_STRONG}') AS strong FROM l WHERE regexp_matches(line, '{_LINE}') AND NOT regexp_matches(line, '{_TEXT}'))
SELECT doc_id, rank::INTEGER AS rank, strong, trim(line) AS line FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY strong DESC, pos) AS rank FROM h) WHERE rank <= 3""")
def license_lines(spark, sf):
    return CV.license_lines(docs(spark, sf), "doc_id", "text")


@query("license_sections", r"""
WITH l AS (SELECT doc_id, string_split(replace(CASE WHEN doc_id % 2 = 0 THEN concat('intro', chr(10), '## Licensing', chr(10), text) ELSE text END, concat(chr(13), chr(10)), chr(10)), chr(10)) AS l FROM documents),
h AS (SELECT *, list_position(list_transform(l, lambda x: regexp_matches(x, '(?i)^\s*#.*licen[cs]')), true) AS h FROM l)
SELECT doc_id, CASE WHEN h > 0 THEN array_to_string(list_filter(list_transform(l[h + 1:h + 11], lambda x: trim(x)), lambda x: x <> '' AND x[1] <> '#' AND NOT starts_with(x, '```'))[1:3], '|') ELSE '' END AS section FROM h""")
def license_sections(spark, sf):
    """Every second document under a heading about licensing; others have a section where they hold such a heading."""
    d = docs(spark, sf)
    body = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("intro\n## Licensing\n"), "text")).otherwise(F.col("text"))
    return d.select("doc_id", F.array_join(CV.license_section(body), "|").alias("section"))


@query("clean_licenses", "SELECT doc_id, doc_id % 3 = 0 AS clean FROM documents")
def clean_licenses(spark, sf):
    k = F.col("doc_id")
    text = F.when(k % 3 == 0, "CC0-1.0 (card)").when(k % 3 == 1, "CC0-1.0, not verified")
    return docs(spark, sf).select("doc_id", CV.clean_license(text).alias("clean"))


@query("stripped_records", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'because' END AS reasoning, 11 AS n_columns FROM documents")
def stripped_records(spark, sf):
    d = document_rows(spark, sf)
    rows = d.withColumns({"questions": F.to_json("questions"), "targets": F.lit("{}"), "teachers": F.lit("{}"), "reasoning": F.when(F.col("doc_id") % 2 == 0, "because").otherwise(" ")})
    out = RC.stripped(rows)
    return out.select(F.col("id").cast("long").alias("doc_id"), "reasoning", F.lit(len(out.columns)).alias("n_columns"))


@query("row_problems", r"""
WITH n AS (SELECT doc_id, text, concat_ws('; ', CASE WHEN length(trim(text)) < 15 THEN 'state too short' END, CASE WHEN doc_id % 5 = 0 THEN 'topic: bad option label' END,
CASE WHEN doc_id % 7 = 0 THEN 'mood: empty score level' END, CASE WHEN contains(text, '<decision>') THEN 'reserved marker in text' END) AS problems FROM documents),
t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM n WHERE problems = ''),
b AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
g AS (SELECT DISTINCT array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT w, unnest(range(1, len(w) - 6)) AS i FROM b)),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)),
h AS (SELECT doc_id, arg_min(gram, i) AS copied FROM x SEMI JOIN g USING (gram) GROUP BY doc_id)
SELECT n.doc_id, CASE WHEN copied IS NOT NULL THEN concat('copies prompt text: ', chr(39), copied, chr(39)) ELSE problems END AS problems FROM n LEFT JOIN h ON h.doc_id = n.doc_id""")
def row_problems(spark, sf):
    """The benchmark stands for the prompts that no state may copy."""
    rows = document_rows(spark, sf).withColumn("questions", F.transform("questions", lambda q, i: q.withField("field", F.when(i == 0, "quality").otherwise(q["field"]))))
    rows = G.with_copied(rows, "state", table(spark, sf, "benchmark"), "text", "doc_id")
    return rows.select("doc_id", F.array_join(C.row_problems(F.col("state"), F.col("state_kind"), F.col("questions"), copied=F.col("copied")), "; ").alias("problems"))


@query("paraphrase_records", """
SELECT concat('en-p-pawsx-', a.doc_id) AS id, concat('A: ', trim(a.source), chr(10), 'B: ', trim(b.source)) AS state, CASE WHEN a.lang = b.lang THEN 'yes' ELSE 'no' END AS label, 0.99::DOUBLE AS p
FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 WHERE a.source <> b.source AND length(concat('A: ', trim(a.source), chr(10), 'B: ', trim(b.source))) >= 15""")
def paraphrase_records(spark, sf):
    d = docs(spark, sf)
    other = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("source").alias("sentence2"), F.col("lang").alias("other"))
    pairs = d.join(other, "doc_id").select(F.col("doc_id").alias("id"), F.col("source").alias("sentence1"), "sentence2", (F.col("lang") == F.col("other")).cast("int").alias("label"))
    out = CV.paraphrases(pairs, "en", ["Same?", "Do both say it?"], "A", "B")
    t = F.get("targets", F.lit(0))
    return out.select("id", "state", t["label"].alias("label"), F.array_max(t["dist"]).alias("p"))


@query("utterance_records", """
SELECT concat('en-p-massive-', event_id) AS id, event_type AS scenario, concat(event_type, '_', user_id % 3) AS intent, true AS has_intent, 5 AS n_scenarios FROM events WHERE length(props) >= 15 OR true""")
def utterance_records(spark, sf):
    e = table(spark, sf, "events")
    kinds = ["click", "error", "purchase", "signup", "view"]
    rows = e.select(F.col("event_id").alias("id"), F.concat(F.lit("an utterance with "), "props").alias("utt"), F.col("event_type").alias("scenario"), F.concat_ws("_", "event_type", (F.col("user_id") % 3).cast("string")).alias("intent"))
    intents = {f"{k}_{i}": f"{k} {i}" for k in kinds for i in range(3)}
    out = CV.utterances(rows, "en", {k: k for k in kinds}, intents, {"scenario": ["Which?", "What about?"], "intent": ["What for?"]})
    t = lambda i: F.get("targets", F.lit(i))
    return out.select("id", t(0)["label"].alias("scenario"), t(1)["label"].alias("intent"), F.array_contains(t(1)["values"], t(1)["label"]).alias("has_intent"), F.size(t(0)["values"]).alias("n_scenarios"))


@query("mix_specs", "SELECT lang, CASE lang WHEN 'en' THEN least(count(*), 30) WHEN 'fr' THEN least(count(*), 5) ELSE count(*) END AS n FROM documents WHERE lang IN ('en', 'fr', 'de') GROUP BY lang")
def mix_specs(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang")
    mixed = DD.mixed([(d.where("lang = 'en'"), 30), (d.where("lang = 'fr'"), 5), (d.where("lang = 'de'"), 0)], 11, "doc_id")
    return mixed.groupBy("lang").agg(F.count("*").alias("n"))


@query("sorted_manifest", """
SELECT count(*) AS n, sha256(string_agg(l, chr(10) ORDER BY l)) AS digest FROM (SELECT concat('{"doc_id":', doc_id, ',"source":"', source, '"}') AS l FROM documents)""")
def sorted_manifest(spark, sf):
    return RC.manifest(docs(spark, sf), "doc_id", "source")


@query("variant_checks", """
WITH b AS (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
g AS (SELECT DISTINCT array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT w, unnest(range(1, len(w) - 6)) AS i FROM b)),
t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
h AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)) SEMI JOIN g USING (gram))
SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'placeholders missing' WHEN 1 THEN 'unknown placeholders' WHEN 2 THEN 'currency beside price' WHEN 3 THEN 'unit beside weight' ELSE CASE WHEN doc_id IN (SELECT doc_id FROM h) THEN 'copies the brief' WHEN doc_id % 10 = 4 THEN 'questions repeat case facts' WHEN n_words < 200 THEN 'too short' ELSE CASE doc_id % 10 WHEN 6 THEN 'outcome letters' WHEN 7 THEN 'duplicate field names' WHEN 8 THEN 'bad labels' END END END AS problem
FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) + 3 + CASE WHEN doc_id % 10 = 0 THEN -1 WHEN doc_id % 10 IN (1, 2, 3) THEN 1 ELSE 0 END AS n_words FROM documents)""")
def variant_checks(spark, sf):
    k = F.col("doc_id") % 10
    d = docs(spark, sf)
    slots = F.when(k == 0, " {price}").when(k == 1, " {price} {weight} {other}").when(k == 2, " {price} EUR {weight}").when(k == 3, " {price} {weight} kg").otherwise(" {price} {weight}")
    state = F.concat("text", F.lit(" end"), slots)
    asks = F.when(k == 4, "Is {weight} fine?").when(k == 6, "Say A = yes").otherwise("Is it within {price}?")
    option = lambda v: F.struct(F.lit(v).alias("value"), F.lit("what it means").alias("description"))
    options = F.when(k == 8, F.array(option("same"), option("Same"))).otherwise(F.array(option("yes_it_is"), option("no_it_is_not")))
    one = lambda field: F.struct(field.alias("field"), F.lit("choice").alias("type"), asks.alias("instructions"), options.alias("options"))
    questions = F.array(one(F.lit("first")), one(F.when(k == 7, "first").otherwise("second")))
    rows = d.select("doc_id", state.alias("state"), questions.alias("questions"), F.regexp_replace(state, C.SLOT, " ").alias("words"))
    rows = G.with_copied(rows, "words", table(spark, sf, "benchmark"), "text", "doc_id")
    problem = C.variant_problem(F.col("state"), F.col("questions"), ["price", "weight"], ["price"], money=["price"], units=["weight"], min_words=200, copied=F.col("copied"))
    return rows.select("doc_id", problem.alias("problem"))


@query("language_summary", r"""
WITH l AS (SELECT doc_id, lang, n_chars, length(regexp_replace(text, '\P{L}', '', 'g')) AS letters, length(regexp_replace(lower(text), '[^äöüß]', '', 'g')) AS special FROM documents),
v AS (SELECT *, lang = 'de' AND letters >= 400 AND special = 0 AS folded, CASE WHEN doc_id % 4 = 0 THEN 50.0 / (50 + 30) ELSE 30.0 / (50 + 30) END AS share FROM l)
SELECT count(*) AS checked, count_if(letters < 20 OR (share >= 0.6 AND NOT folded)) AS passed, count_if(folded) AS folded, 0.9::DOUBLE AS min_prob FROM v""")
def language_summary(spark, sf):
    k = F.col("doc_id")
    part = lambda n, label: F.struct(F.lit(n).alias("n"), label.alias("label"))
    segments = F.array(part(50, F.when(k % 4 == 0, F.col("lang")).otherwise("xx")), part(30, F.when(k % 4 == 0, "xx").otherwise(F.col("lang"))), part(5, F.lit("xx")))
    verdict = C.language_verdict(F.col("lang"), F.col("text"), F.col("lang"), F.lit(0.9), segments)
    return ST.language_summary(docs(spark, sf).select(verdict.alias("v")).select("v.ok", "v.folded", F.lit(0.9).alias("prob")))


@query("mix_valid_first", """
WITH r AS (SELECT d.doc_id, concat(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), '|', doc_id % 2 = 0) AS k, toxic, doc_id % 5 = 0 AS valid FROM documents d JOIN labels l USING (doc_id)),
f AS (SELECT k, min(toxic) <> max(toxic) AS differ, arg_min(doc_id, (NOT valid, doc_id)) AS first FROM r GROUP BY k)
SELECT doc_id, CASE WHEN differ THEN 'conflict' WHEN doc_id = first THEN 'keep' ELSE 'duplicate' END AS verdict FROM r JOIN f USING (k)""")
def mix_valid_first(spark, sf):
    """Valid rows win over train rows; rows that show the unknown option are other rows than those that do not."""
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").withColumn("part", F.when(F.col("doc_id") % 5 == 0, 0).otherwise(1))
    key = F.concat_ws("|", X.state_key(F.col("text")), (F.col("doc_id") % 2 == 0).cast("string"))
    return DD.resolve_conflicts(rows, key, F.col("toxic"), ["part", "doc_id"]).select("doc_id", "verdict")
