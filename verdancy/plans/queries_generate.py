"""Queries of plans, locale formats, traces and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import checks as C
from ..functions import locale as LO
from ..operators import dedup as DD
from ..operators import generate as G
from ..operators import labels as L
from ..operators import rules as R
from ..sources import records as RC
from .catalogue import query
from .queries_dist import _teacher_sql, teachers
from .queries_rules import orders
from .queries_stages import _parts
from .queries_text import docs, table

UNIT = "cast(concat('0x', substr(md5(concat_ws('|', '{salt}', {key})), 1, 8)) AS BIGINT) / 4294967296.0"


def _unit(salt: str, key: str) -> str:
    return UNIT.format(salt=salt, key=key)


@query("locale_dates", """
WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 5 AS k,
  ['Januar','Februar','März','April','Mai','Juni','Juli','August','September','Oktober','November','Dezember'][month(o_orderdate)] AS m,
  ['Montag','Dienstag','Mittwoch','Donnerstag','Freitag','Samstag','Sonntag'][isodow(o_orderdate)] AS w FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN strftime(d, '%d.%m.%Y') WHEN 1 THEN concat(day(d), '. ', m, ' ', year(d)) WHEN 2 THEN concat(w, ', ', day(d), '. ', m, ' ', year(d)) WHEN 3 THEN concat(day(d), '.', month(d), '.', year(d)) ELSE strftime(d, '%Y-%m-%d') END AS de,
CASE WHEN k = 0 AND day(d) > 12 THEN strftime(d, '%m/%d/%Y') WHEN k IN (0, 1) THEN strftime(d, '%B %-d, %Y') WHEN k = 2 THEN strftime(d, '%b %-d, %Y') WHEN k = 3 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%A, %B %-d, %Y') END AS en FROM x""")
def locale_dates(spark, sf):
    k = F.col("o_orderkey")
    return orders(spark, sf).select("o_orderkey", LO.date_text(F.col("d"), "de_DE", k).alias("de"), LO.date_text(F.col("d"), "en_US", k).alias("en"))


@query("locale_money", """
SELECT o_orderkey, concat('$', format('{:,.2f}', o_totalprice::DECIMAL(18,2)::DOUBLE)) AS en, concat(translate(format('{:,.2f}', o_totalprice::DECIMAL(18,2)::DOUBLE), ',.', '.,'), chr(160), '€') AS de, concat(translate(format('{:,.2f}', o_totalprice::DECIMAL(18,2)::DOUBLE), ',.', '.,'), ' TL') AS tr FROM orders""")
def locale_money(spark, sf):
    p = F.col("price")
    return orders(spark, sf).select("o_orderkey", LO.money_text(p, "en_US").alias("en"), LO.money_text(p, "de_DE").alias("de"), LO.money_text(p, "tr_TR", spelt=True).alias("tr"))


@query("locale_weekdays", """
SELECT o_orderkey, ['pazartesi','sali','carsamba','persembe','cuma','cumartesi','pazar'][isodow(o_orderdate)] AS tr, ['montag','dienstag','mittwoch','donnerstag','freitag','samstag','sonntag'][isodow(o_orderdate)] AS de FROM orders""")
def locale_weekdays(spark, sf):
    return orders(spark, sf).select("o_orderkey", LO.weekday_label(F.col("d"), "tr").alias("tr"), LO.weekday_label(F.col("d"), "de").alias("de"))


@query("display_numbers", """
SELECT lang, printf('%.1f%%', 100 * avg(quality)) AS pct, printf('%.1f pts', 100 * avg(toxic)) AS pts, printf('%.3f', avg(quality)) AS dec, CASE WHEN count(quality) = 0 THEN '' ELSE '-' END AS none FROM documents JOIN labels USING (doc_id) GROUP BY lang""")
def display_numbers(spark, sf):
    d = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.avg("quality").alias("q"), F.avg("toxic").alias("t"))
    return d.select("lang", LO.percent_text(F.col("q")).alias("pct"), LO.points_text(F.col("t")).alias("pts"), LO.decimal_text(F.col("q")).alias("dec"), LO.decimal_text(F.lit(None).cast("double")).alias("none"))


@query("ascii_labels", "SELECT n_nationkey, trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g'), '_') AS label FROM nation")
def ascii_labels(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", LO.ascii_label(F.col("n_name")).alias("label"))


@query("card_plan", f"""
WITH d AS (SELECT doc_id, cast(doc_id AS VARCHAR) AS k, (doc_id % 20)::INTEGER AS place FROM documents),
u AS (SELECT *, {_unit('length', 'k')} AS ul, {_unit('words', 'k')} AS uw, {_unit('count', 'k')} AS uc FROM d),
p AS (SELECT *, CASE WHEN place < 5 THEN 'game_npc' ELSE ['a', 'b', 'c'][(place - 5) % 3 + 1] END AS domain,
  CASE WHEN ul < 0.5 THEN [40, 150] WHEN ul < 0.8 THEN [150, 400] WHEN ul < 0.95 THEN [400, 800] ELSE [800, 1500] END AS r,
  CASE WHEN uc < 0.2 THEN 2 WHEN uc < 0.5 THEN 3 WHEN uc < 0.75 THEN 4 WHEN uc < 0.9 THEN 5 ELSE 6 END AS n FROM u),
q AS (SELECT doc_id, unnest(range(1, n + 1)) AS i, k FROM p),
t AS (SELECT doc_id, i, CASE WHEN {_unit('kind', "concat(k, '#', i)")} < 0.45 THEN 'choice' WHEN {_unit('kind', "concat(k, '#', i)")} < 0.75 THEN 'noul' ELSE 'score' END AS kind, {_unit('ambiguous', "concat(k, '#', i)")} < 0.2 AS unclear FROM q),
a AS (SELECT doc_id, array_to_string(list(kind ORDER BY i), ',') AS kinds, count_if(unclear) AS unclear FROM t GROUP BY doc_id)
SELECT doc_id, domain, (round((r[1] + floor(uw * (r[2] - r[1] + 1))) / 10) * 10)::INTEGER AS length, kinds, unclear FROM p JOIN a USING (doc_id)""")
def card_plan(spark, sf):
    cards = docs(spark, sf).select("doc_id", (F.col("doc_id") % 20).cast("int").alias("place"), F.lit(20).alias("n_rows"))
    plan = G.card_plan(cards, "doc_id", ["a", "b", "c"], ["plain text", "email"])
    unclear = F.size(F.filter("questions", lambda q: q["target"] == "ambiguous")).cast("long")
    return plan.select("doc_id", "domain", "length", F.array_join(F.transform("questions", lambda q: q["type"]), ",").alias("kinds"), unclear.alias("unclear"))


@query("boundary_offsets", f"""
WITH u AS (SELECT o_orderkey AS k, {_unit('s', 'cast(o_orderkey AS VARCHAR)')} AS u, 2 + floor({_unit('s:far', 'cast(o_orderkey AS VARCHAR)')} * 19) AS far, floor({_unit('s:low', 'cast(o_orderkey AS VARCHAR)')} * 4) AS lo, floor({_unit('s:high', 'cast(o_orderkey AS VARCHAR)')} * 3) AS hi FROM orders)
SELECT k AS o_orderkey, (CASE WHEN u < 0.5 THEN CASE lo WHEN 2 THEN -1 WHEN 3 THEN -far ELSE 0 END ELSE CASE hi WHEN 2 THEN far ELSE 1 END END)::INTEGER AS off FROM u""")
def boundary_offsets(spark, sf):
    return orders(spark, sf).select("o_orderkey", G.side(F.col("o_orderkey").cast("string"), "s").cast("int").alias("off"))


@query("deadline_instances", f"""
WITH x AS (SELECT o_orderkey, cast(o_orderkey AS VARCHAR) AS k FROM orders),
u AS (SELECT *, (DATE '2024-01-01' + floor({_unit('due', 'k')} * 1461)::INTEGER) AS due, {_unit('late', 'k')} AS u, 2 + floor({_unit('late:far', 'k')} * 19) AS far, floor({_unit('late:low', 'k')} * 4) AS lo, floor({_unit('late:high', 'k')} * 3) AS hi FROM x),
o AS (SELECT *, (CASE WHEN u < 0.5 THEN CASE lo WHEN 2 THEN -1 WHEN 3 THEN -far ELSE 0 END ELSE CASE hi WHEN 2 THEN far ELSE 1 END END)::INTEGER AS off FROM u)
SELECT o_orderkey, due, concat('due ', strftime(due, '%Y-%m-%d'), ', came ', strftime(due + off, '%Y-%m-%d')) AS state, CASE WHEN off <= 0 THEN 'yes' ELSE 'no' END AS on_time, CASE WHEN off <= 0 THEN 'on_time' WHEN off <= 7 THEN 'late_1_7' ELSE 'late_8_plus' END AS lateness FROM o""")
def deadline_instances(spark, sf):
    """A sampler of one rule: facts from hashes, the state from a template, the answers from the rule."""
    from ..functions import text as X

    k = F.col("o_orderkey").cast("string")
    facts = orders(spark, sf).select("o_orderkey", G.day_between(k, "due").alias("due"), G.side(k, "late").cast("int").alias("off")).withColumn("came", F.date_add("due", "off"))
    state = X.filled(F.lit("due {due}, came {came}"), {c: LO.date_by(F.col(c), "yyyy-MM-dd", "en_US") for c in ("due", "came")})
    on_time, lateness = R.deadline(F.col("came"), F.col("due"))
    return facts.select("o_orderkey", "due", state.alias("state"), on_time.alias("on_time"), lateness.alias("lateness"))


@query("locale_alpine", r"""
SELECT o_orderkey, concat(day(o_orderdate), '. ', ['Jänner','Februar','März','April','Mai','Juni','Juli','August','September','Oktober','November','Dezember'][month(o_orderdate)], ' ', year(o_orderdate)) AS austrian,
strftime(o_orderdate, '%d.%m.%Y') AS swiss, concat('€', chr(160), translate(format('{:,.2f}', o_totalprice), ',.', '.,')) AS euros, concat('CHF', chr(160), translate(format('{:,.2f}', o_totalprice), ',', '’')) AS francs,
translate(format('{:,d}', o_orderkey * 1000), ',', chr(160)) AS number FROM orders""")
def locale_alpine(spark, sf):
    day, price = F.to_date("o_orderdate"), F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", LO.date_by(day, LO.DATE_PATTERNS["de_AT"][1], "de_AT").alias("austrian"), LO.date_by(day, LO.DATE_PATTERNS["de_CH"][0], "de_CH").alias("swiss"),
        LO.money_text(price, "de_AT").alias("euros"), LO.money_text(price, "de_CH").alias("francs"), LO.number_text(F.col("o_orderkey") * 1000, "de_AT").alias("number"),
    )


@query("word_lists", """
SELECT doc_id, CASE doc_id % 7 WHEN 1 THEN 'bad strings' WHEN 3 THEN 'bad labeled' WHEN 5 THEN 'bad priced' WHEN 6 THEN 'bad groups' END AS problem FROM documents""")
def word_lists(spark, sf):
    k = F.col("doc_id") % 7
    kind = F.get(F.array(*[F.lit(x) for x in ("strings", "strings", "labeled", "labeled", "priced", "priced", "groups")]), k.cast("int"))
    value = F.get(
        F.array(
            F.lit('["a", "b"]'), F.lit('["a", " "]'), F.lit('[{"label": "a_1", "name": "A"}, {"label": "b", "name": "B"}]'), F.lit('[{"label": "a", "name": "A"}, {"label": "a", "name": "B"}]'),
            F.lit('[{"label": "a", "name": "A", "price_min": 1, "price_max": 2.5}, {"label": "b", "name": "B", "price_min": 1, "price_max": 1}]'),
            F.lit('[{"label": "a", "name": "A", "price_min": 3, "price_max": 2.5}, {"label": "b", "name": "B", "price_min": 1, "price_max": 1}]'), F.lit('{"electronics": ["a", "b"], "hygiene": ["c"], "other": ["d", "e"]}'),
        ),
        k.cast("int"),
    )
    return docs(spark, sf).select("doc_id", G.word_list_problem(kind, value, F.lit(2)).alias("problem"))


@query("trace_writers", """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ds' WHEN 1 THEN 'glmt' WHEN 2 THEN CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'mistral' END ELSE 'ds' END AS writer FROM documents""")
def trace_writers(spark, sf):
    k = F.col("doc_id")
    labs = F.when(k % 4 == 0, F.array(F.lit("zhipu"))).when(k % 4 == 1, F.array(F.lit("deepseek"))).when(k % 4 == 2, F.array(F.lit("deepseek"), F.lit("zhipu"))).otherwise(F.array().cast("array<string>"))
    up = F.when(k % 3 == 0, F.array(F.lit("hf"))).otherwise(F.array(F.lit("hf"), F.lit("ollama")))
    order = [("ds", "deepseek", "hf"), ("glmt", "zhipu", "hf"), ("mistral", "mistral", "ollama")]
    return docs(spark, sf).select("doc_id", G.trace_writer(order, labs, up).alias("writer"))


@query("accepted_traces", "SELECT conv_id, turn, trim(coalesce(text, '')) <> '' AND turn % 3 > 0 AND NOT contains(text, '#') AND len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) <= 90 AND NOT regexp_matches(text, '(?m)^\\s*([-*•]|\\d+[.)])\\s') AND NOT regexp_matches(text, '`') AS accepted FROM conversations")
def accepted_traces(spark, sf):
    one = lambda label: F.array(F.struct(F.lit("q").alias("field"), label.alias("label")))
    said = one(F.when(F.col("turn") % 3 > 0, "yes").otherwise("no"))
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", G.trace_accepted(said, one(F.lit("yes")), C.trace_problems(F.col("text"), F.lit(True))).alias("accepted"))


@query("untraced_rows", "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0")
def untraced_rows(spark, sf):
    parts, traces = _parts(spark, sf)
    return RC.union_in_order(parts).join(traces.select("id"), "id", "left_anti").select("doc_id")


@query("three_passes", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('a', doc_id) WHEN doc_id % 3 = 0 THEN concat('b', doc_id) ELSE concat('c', doc_id) END AS reply, CASE WHEN doc_id % 2 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END::INTEGER AS pass FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0 OR doc_id % 5 = 0")
def three_passes(spark, sf):
    d = docs(spark, sf).select("doc_id")
    one = lambda name, n: d.select("doc_id", F.when(F.col("doc_id") % n == 0, F.concat(F.lit(name), F.col("doc_id").cast("string"))).alias("reply"))
    return G.first_answered([one("a", 2), one("b", 3), one("c", 5)], ["doc_id"], "reply").select("doc_id", "reply", F.col("pass").cast("int").alias("pass"))


@query("teacher_requests", """
WITH e AS (SELECT doc_id AS id, unnest(CASE WHEN doc_id % 2 = 0 THEN ['ds', 'glm'] ELSE ['glm'] END) AS teacher FROM documents),
b AS (SELECT *, ((row_number() OVER (PARTITION BY teacher ORDER BY id) - 1) // 12)::BIGINT AS batch FROM e) SELECT teacher, batch, array_to_string(list(id ORDER BY id), ',') AS ids FROM b GROUP BY teacher, batch""")
def teacher_requests(spark, sf):
    rows = docs(spark, sf).select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("ds"), F.lit("glm"))).otherwise(F.array(F.lit("glm"))).alias("t"))
    return G.teacher_requests(rows, "t", 12).select("teacher", "batch", F.array_join("ids", ",").alias("ids"))


@query("gold_teachers", "SELECT doc_id, concat('gold ', 'gen:', source, ' quality ', CASE WHEN doc_id % 4 = 1 THEN 3 ELSE 2 END) AS teacher FROM documents")
def gold_teachers(spark, sf):
    parts, _ = _parts(spark, sf)
    t = F.get("teachers", F.lit(0))
    out = G.gold_teachers(RC.union_in_order(parts))
    return out.select("doc_id", F.concat_ws(" ", t["teacher"], t["model"], t["field"], F.size(t["dist"]).cast("string")).alias("teacher"))


@query("example_pages", """
SELECT doc_id, md5(concat_ws(chr(10), concat('### Example ', doc_id, ': `', doc_id, '`'), '', concat('source `gen:', source, '` · license `CC0-1.0`'), '', '```', text, '```', '', concat('**`quality`** (noul): Is it good?', CASE WHEN doc_id % 11 = 0 THEN ' The answer is yes.' ELSE '' END), '', '| option | gold |', '|---|---|',
  CASE WHEN doc_id % 4 = 1 THEN concat('| `no` | 0.200 |', chr(10), '| `yes` | 0.300 |', chr(10), '| `unknown` **←** | 0.500 |') WHEN doc_id % 13 = 0 THEN concat('| `no` **←** | 0.400 |', chr(10), '| `yes` | 0.400 |') ELSE concat('| `no` **←** | 0.900 |', chr(10), '| `yes` | 0.100 |') END)) AS digest FROM documents""")
def example_pages(spark, sf):
    parts, _ = _parts(spark, sf)
    rows = RC.union_in_order(parts)
    return G.example_lines(rows, F.col("doc_id")).select(F.col("id").cast("long").alias("doc_id"), F.md5("text").alias("digest"))


@query("report_table", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT unnest([0, 1]) AS place, unnest(['| lang | n |', '|---|---|']) AS line UNION ALL SELECT row_number() OVER (ORDER BY lang) + 1, concat('| ', lang, ' | ', n, ' |') FROM c""")
def report_table(spark, sf):
    return G.table_lines(docs(spark, sf).groupBy("lang").agg(F.count("*").alias("n")), ["lang", "n"], [F.col("lang")])


_SECTION = "SELECT {i} AS section, place, line FROM (SELECT unnest([0, 1, 2, 3, 4611686018427387904]) AS place, unnest(['## {title}', '', '| key | n |', '|---|---|', '']) AS line UNION ALL SELECT row_number() OVER (ORDER BY n DESC, key NULLS FIRST) + 3, concat('| ', coalesce(key, '-'), ' | ', n, ' |') FROM (SELECT {key} AS key, count(*) AS n FROM {table} GROUP BY 1))"


@query("written_report", f"""
WITH l AS (SELECT 0 AS section, 0 AS place, '# Corpus' AS line UNION ALL SELECT 0, 1, ''
UNION ALL {_SECTION.format(i=1, title='Languages', key='lang', table='documents')}
UNION ALL {_SECTION.format(i=2, title='Sources', key='source', table='documents')}
UNION ALL {_SECTION.format(i=3, title='Sizes', key="CASE WHEN n_chars < 1000 THEN 'short' WHEN n_chars < 5000 THEN 'middle' ELSE 'long' END", table='documents')}
UNION ALL {_SECTION.format(i=4, title='Statuses', key='status', table='sales')})
SELECT row_number() OVER (ORDER BY section, place) - 1 AS place, line AS value FROM l""")
def written_report(spark, sf):
    """A report of four sections (three of them counted in one pass), written in order and read back in the order of its files."""
    size = F.when(F.col("n_chars") < 1000, "short").when(F.col("n_chars") < 5000, "middle").otherwise("long")
    found = G.counted(docs(spark, sf), {"Languages": F.col("lang"), "Sources": F.col("source"), "Sizes": size})
    found["Statuses"] = table(spark, sf, "sales").groupBy(F.col("status").alias("key")).agg(F.count("*").alias("n"))
    lines = G.report("Corpus", [(name, df, ["key", "n"], [-F.col("n"), F.col("key")]) for name, df in found.items()])
    path = f"{DD.require_shared_dir(lines)}/verdancy/report-{uuid.uuid4().hex}"
    RC.write_ordered(lines, [F.col("section"), F.col("place")], "line", path)
    return RC.read_ordered(spark, path)


@query("agreement_sets", f"""
WITH {_teacher_sql()}, g AS (SELECT vec_id, field, string_agg(teacher, '+' ORDER BY teacher) AS teachers FROM t WHERE d IS NOT NULL GROUP BY vec_id, field) SELECT teachers, count(*) AS n FROM g GROUP BY teachers""")
def agreement_sets(spark, sf):
    return L.teacher_sets(teachers(spark, sf), ["vec_id", "field"])


@query("name_pools", """
SELECT source, CASE WHEN count(DISTINCT lang) < 3 THEN 'bad people' WHEN count(DISTINCT doc_id) < 3 THEN 'bad orgs' WHEN source = 'src3' THEN 'bad villagers' END AS problem FROM documents GROUP BY source""")
def name_pools(spark, sf):
    pools = docs(spark, sf).groupBy("source").agg(F.collect_set("lang").alias("p"), F.collect_set(F.col("doc_id").cast("string")).alias("o"))
    villagers = F.when(F.col("source") == "src3", F.array(F.lit("a"), F.lit(" "), F.lit("c"))).otherwise(F.array(F.lit("a"), F.lit("b"), F.lit("c")))
    return pools.select("source", G.pool_problem(F.col("p"), F.col("o"), villagers, 3).alias("problem"))


@query("snippet_pools", """
SELECT conv_id, count_if(turn % 3 = 0) AS n FROM conversations GROUP BY conv_id HAVING count_if(turn % 3 = 0) >= 1""")
def snippet_pools(spark, sf):
    both = F.concat(F.lit("say {answer} to {field}: "), "text")
    snippet = F.when(F.col("turn") % 3 == 0, both).when(F.col("turn") % 3 == 1, F.replace(both, F.lit("{field}"), F.lit("it"))).otherwise(F.col("role"))
    pools = table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(snippet).alias("s"))
    good = pools.select("conv_id", G.usable_snippets(F.col("s"), ("answer", "field"), 1).alias("g")).where("g is not null")
    return good.select("conv_id", F.size("g").cast("long").alias("n"))


def _draw(salt: str, low: str, high: str) -> str:
    return f"({low} + floor({_unit(salt, 'k')} * ({high} - {low} + 1)))::INTEGER"


def _offset(salt: str, span: int = 20) -> str:
    far, low, high = _draw(f"{salt}:far", "2", str(span)), _draw(f"{salt}:low", "0", "3"), _draw(f"{salt}:high", "0", "2")
    return f"(CASE WHEN {_unit(salt, 'k')} < 0.5 THEN CASE {low} WHEN 2 THEN -1 WHEN 3 THEN -{far} ELSE 0 END ELSE CASE {high} WHEN 2 THEN {far} ELSE 1 END END)::INTEGER"


@query("rule_instances", f"""
WITH x AS (SELECT o_orderkey, cast(o_orderkey AS VARCHAR) AS k FROM orders),
f AS (SELECT o_orderkey, {_offset('late')} AS late, {_offset('asked', 14)} AS asked, {_offset('budget', 50)} AS budget, {_offset('limit', 40)} AS lim,
  DATE '2024-01-01' + {_draw('got', '0', '1460')} + {_draw('days', '14', '60')} AS last_day, DATE '2024-01-01' + {_draw('day', '0', '1460')} AS day, {_draw('limit', '16', '21')} AS age, {_offset('birth')} AS born,
  [{', '.join(_draw(f'amount{i}', '500', '30000') for i in range(4))}] AS amounts, [{', '.join(_draw(f'score{i}', '30', '100') for i in range(3))}] AS scores, {_draw('mark', '50', '80')} AS mark FROM x),
b AS (SELECT *, (day - to_years(age))::DATE + born AS birth FROM f)
SELECT o_orderkey, 'deadline' AS rule, concat(CASE WHEN late <= 0 THEN 'yes' ELSE 'no' END, ',', CASE WHEN late <= 0 THEN 'on_time' WHEN late <= 7 THEN 'late_1_7' ELSE 'late_8_plus' END) AS answers FROM f
UNION ALL SELECT o_orderkey, 'return_window', concat(CASE WHEN asked <= 0 THEN 'yes' ELSE 'no' END, ',', ['monday','tuesday','wednesday','thursday','friday','saturday','sunday'][isodow(last_day)]) FROM f
UNION ALL SELECT o_orderkey, 'age_limit', CASE WHEN year(day) - year(birth) - CASE WHEN (month(day), dayofmonth(day)) < (month(birth), dayofmonth(birth)) THEN 1 ELSE 0 END >= age THEN 'yes' ELSE 'no' END FROM b
UNION ALL SELECT o_orderkey, 'discount', CASE WHEN budget >= 0 THEN 'yes' ELSE 'no' END FROM f
UNION ALL SELECT o_orderkey, 'sum_limit', concat(CASE WHEN lim < 0 THEN 'yes' ELSE 'no' END, ',item ', list_position(amounts, list_max(amounts))) FROM f
UNION ALL SELECT o_orderkey, 'average_pass', CASE WHEN list_sum(scores) >= 3 * mark THEN 'yes' ELSE 'no' END FROM f""")
def rule_instances(spark, sf):
    from ..operators import instances as I

    out = I.every_rule(orders(spark, sf), "o_orderkey")
    return out.select("o_orderkey", "rule", F.array_join(F.transform("answers", lambda a: a["label"]), ",").alias("answers"))
