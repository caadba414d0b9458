"""Queries of rule cases: facts in several tables, names from pools, answers by joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import casebook as CB
from ..operators import dedup as DD
from ..sources import converters as CV
from .catalogue import query
from .queries_generate import UNIT
from .queries_text import table

WEEKDAY = "['monday','tuesday','wednesday','thursday','friday','saturday','sunday'][isodow({d})]"


def _unit(salt: str, key: str = "k") -> str:
    return UNIT.format(salt=salt, key=key)


def _draw(salt: str, low, high, key: str = "k") -> str:
    return f"(({low}) + floor({_unit(salt, key)} * (({high}) - ({low}) + 1)))::INTEGER"


def _one(salt: str, values: list, key: str = "k") -> str:
    return f"[{', '.join(map(str, values))}][{_draw(salt, 0, len(values) - 1, key)} + 1]"


def _side(salt: str, span="20") -> str:
    far, low, high = _draw(f"{salt}:far", 2, span), _draw(f"{salt}:low", 0, 3), _draw(f"{salt}:high", 0, 2)
    return f"(CASE WHEN {_unit(salt)} < 0.5 THEN CASE {low} WHEN 2 THEN -1 WHEN 3 THEN -{far} ELSE 0 END ELSE CASE {high} WHEN 2 THEN {far} ELSE 1 END END)::INTEGER"


def _often(salt: str, share: float = 0.5) -> str:
    return f"({_unit(salt)} < {share})"


def _yes(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'yes' ELSE 'no' END"


def _weekend(day: str) -> str:
    """The day, or the Monday after a weekend."""
    return f"({day} + CASE isodow({day}) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END)"


_LINE = "concat(k, '.', i)"
_OTHER = "concat(k, '.', two)"

ORACLE = f"""
WITH x AS (SELECT o_orderkey, cast(o_orderkey AS VARCHAR) AS k FROM orders),
ns AS (SELECT count(DISTINCT o_orderpriority) AS n FROM orders), nr AS (SELECT list_sort(list(DISTINCT r_name)) AS names FROM region),
bd AS (SELECT *, {_weekend('d')} AS ordered FROM (SELECT *, DATE '2024-01-01' + {_draw('bd:ordered', 0, 1460)} AS d, {_draw('bd:n', 1, 15)} AS n, {_side('bd:side', 6)} AS s FROM x)),
bd2 AS (SELECT *, ordered + (n + 2 * ((isodow(ordered) - 1 + n) // 5))::INTEGER AS ready FROM bd),
rd AS (SELECT *, datediff('day', today, last_day(today)) AS days_left FROM (SELECT *, DATE '2024-01-01' + {_draw('rd:today', 0, 1449)} AS today FROM x)),
rd2 AS (SELECT *, today + CASE WHEN {_often('rd:same')} AND days_left >= 2 THEN {_draw('rd:near', 2, 'days_left')} ELSE {_draw('rd:far', 'greatest(2, days_left + 1)', 'days_left + 45')} END AS day FROM rd),
eo AS (SELECT *, {_one('eo:apart', [1, -1, _draw('eo:after', 2, 90), '-' + _draw('eo:before', 2, 90)])} AS apart FROM x),
cr AS (SELECT *, {_draw('cr:wanted', 0, '(SELECT n FROM ns) - 1')} AS wanted, unnest(range(0, {_draw('cr:n', 4, 10)})) AS i FROM x),
cr2 AS (SELECT o_orderkey, count_if({_draw('cr:status', 0, '(SELECT n FROM ns) - 1', _LINE)} = wanted AND {_one('cr:near', [0, 1, -1, _draw('cr:over', 2, 40, _LINE), '-' + _draw('cr:under', 2, 9, _LINE)], _LINE)} >= 0) AS n FROM cr GROUP BY o_orderkey),
ul AS (SELECT *, {_one('ul:limit', [1, 2, 5, 10, 15, 20, 25, 30])} * [1000, 1000, 100, 10][{_draw('ul:unit', 0, 3)} + 1] / {_one('ul:part', [1, 2, 4])}::DOUBLE AS exact FROM x),
ul2 AS (SELECT *, greatest(1, trunc(exact)::INTEGER + {_side('ul:side', 'floor(exact / 3)::INTEGER + 2')}) AS amount FROM ul),
rp AS (SELECT *, {_one('rp:standard', [14, 15, 30])} AS standard, {_one('rp:category', ["'electronics'", "'hygiene'", "'other'"])} AS category, {_often('rp:opened')} AS opened, {_often('rp:sale', 0.4)} AS on_sale, {_one('rp:electronics', [7, 10, 21])} AS electronics FROM x),
rp2 AS (SELECT *, CASE WHEN category = 'electronics' THEN electronics ELSE standard END AS win FROM rp), rp3 AS (SELECT *, greatest(0, win + {_side('rp:side', 10)}) AS days FROM rp2),
ic AS (SELECT *, {_one('ic:deductible', [100, 150, 250, 500])} * 100 AS deductible, {_one('ic:sublimit', [1000, 1500, 2000, 2500])} * 100 AS sublimit, {_one('ic:most', [4000, 5000, 7500, 10000])} * 100 AS most,
  CASE WHEN {_often('ic:over')} THEN {_draw('ic:more', 5000, 150000)} ELSE -CASE WHEN {_often('ic:equal')} THEN 0 ELSE {_draw('ic:less', 5000, 90000)} END END AS over FROM x),
ic2 AS (SELECT *, least(most, greatest(0, least(sublimit + over, sublimit) + CASE WHEN {_often('ic:declared')} THEN {_draw('ic:jewels', 20000, 250000)} ELSE 0 END + {_draw('ic:other', 0, 300000)} - deductible)) AS payout FROM ic),
ic3 AS (SELECT *, round((payout + {_one('ic:step', [4000, 30000])} * CASE WHEN {_often('ic:up')} THEN 1 ELSE -1 END) / 1000.0::DOUBLE) * 1000 AS threshold FROM ic2),
lp AS (SELECT *, {_one('lp:annual', [20, 24, 26, 30])} AS annual, {_one('lp:carry', [5, 10])} AS carry, {_draw('lp:unused', 0, 15)} AS unused, DATE '2025-01-06' + {_draw('lp:start', 0, 1058)} AS d FROM x),
lp2 AS (SELECT *, {_weekend('d')} AS first_day, annual + least(unused, carry) - {_draw('lp:taken', 0, 'annual')} AS available FROM lp),
lp3 AS (SELECT *, greatest(1, available + {_side('lp:side', 8)}) AS want FROM lp2),
lp4 AS (SELECT *, (want - 1 + 2 * ((isodow(first_day) - 1 + want - 1) // 5))::INTEGER AS span, {_draw('lp:length', 3, 14)} AS len,
  CASE WHEN {_often('lp:director')} THEN greatest(1, want - {_one('lp:few', [1, 1, _draw('lp:fewer', 2, 5)])}) ELSE want + {_one('lp:many', [0, 0, _draw('lp:more', 1, 5)])} END AS director FROM lp3),
lp5 AS (SELECT *, CASE WHEN {_often('lp:touch')} THEN CASE WHEN {_often('lp:in')} THEN {_draw('lp:at', 0, 'span')} ELSE -{_draw('lp:ahead', 0, 'len')} END
  ELSE CASE WHEN {_often('lp:late')} THEN span + {_draw('lp:gap', 1, 20)} ELSE -(len + {_draw('lp:before', 1, 20)}) END END AS shift FROM lp4),
dl AS (SELECT *, {_draw('dl:cities', 4, 6)} AS n_city, {_draw('dl:customers', 4, 6)} AS n_customer, {_draw('dl:orders', 5, 8)} AS n_order, {_draw('dl:depot', 0, 'len((SELECT names FROM nr)) - 1')} AS shift FROM x),
dl_customers AS (SELECT o_orderkey, i AS customer_no, {_draw('dl:lives', 0, 'n_city - 1', _LINE)} AS city_no FROM (SELECT *, unnest(range(0, n_customer)) AS i FROM dl)),
dl_orders AS (SELECT o_orderkey, i AS order_no, {_draw('dl:buys', 0, 'n_customer - 1', _LINE)} AS customer_no FROM (SELECT *, unnest(range(0, n_order)) AS i FROM dl)),
dl_at AS (SELECT o.o_orderkey, order_no, (SELECT names FROM nr)[(shift + city_no) % len((SELECT names FROM nr)) + 1] AS depot FROM dl_orders o JOIN dl_customers USING (o_orderkey, customer_no) JOIN dl ON dl.o_orderkey = o.o_orderkey),
dl_first AS (SELECT dl.o_orderkey, k, {_often('dl:same')} AS want, order_no AS one, depot AS first_depot FROM dl JOIN dl_at USING (o_orderkey) WHERE order_no = {_draw('dl:first', 0, 'n_order - 1')}),
dl_others AS (SELECT f.*, order_no AS two, depot AS second_depot FROM dl_first f JOIN dl_at a ON a.o_orderkey = f.o_orderkey AND order_no <> one),
dl2 AS (SELECT o_orderkey, first_depot, second_depot FROM dl_others QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY (second_depot = first_depot) <> want, {_unit('dl:pick', _OTHER)}, two) = 1)
SELECT o_orderkey, 'business_days' AS rule, concat_ws(',', {_yes('s <= 0')}, {WEEKDAY.format(d='ready')}) AS answers FROM bd2
UNION ALL SELECT o_orderkey, 'relative_date', concat_ws(',', {WEEKDAY.format(d='day')}, {_yes("date_trunc('month', day) = date_trunc('month', today)")}) FROM rd2
UNION ALL SELECT o_orderkey, 'event_order', {_yes('apart > 0')} FROM eo
UNION ALL SELECT o_orderkey, 'count_records', cast(n AS VARCHAR) FROM cr2
UNION ALL SELECT o_orderkey, 'unit_limit', {_yes('amount <= exact')} FROM ul2
UNION ALL SELECT o_orderkey, 'expense_policy', concat_ws(',', {_yes(_often('ep:hotel'))}, {_yes(_often('ep:food'))}, {_yes(_often('ep:holds'))}) FROM x
UNION ALL SELECT o_orderkey, 'return_policy', concat_ws(',', CASE WHEN (category = 'hygiene' AND opened) OR days > win THEN 'not_returnable' WHEN on_sale THEN 'store_credit' ELSE 'full_refund' END, {_yes('days <= win')}) FROM rp3
UNION ALL SELECT o_orderkey, 'insurance_claim', concat_ws(',', {_yes('over > 0')}, {_yes('payout > threshold')}) FROM ic3
UNION ALL SELECT o_orderkey, 'leave_policy', concat_ws(',', {_yes('want <= available')}, {_yes('want > director')}, {_yes('shift <= span AND shift + len >= 0')}) FROM lp5
UNION ALL SELECT o_orderkey, 'depot_lookup', concat_ws(',', first_depot, {_yes('first_depot = second_depot')}) FROM dl2"""


def pools(spark, sf: str) -> CB.Pools:
    """Pools out of the given tables: people, firms, goods, cities, depots and states of a record."""
    named = lambda pool, name, column: table(spark, sf, name).select(F.lit(pool).alias("pool"), F.col(column).cast("string").alias("name"))
    parts = [("people", "clients", "name"), ("orgs", "vendors", "name"), ("products", "items", "name"), ("cities", "nation", "n_name"), ("depots", "region", "r_name"), ("statuses", "orders", "o_orderpriority")]
    out = None
    for part in parts:
        out = named(*part) if out is None else out.union(named(*part))
    return CB.Pools(out)


@query("rule_cases", ORACLE)
def rule_cases(spark, sf):
    """A case of each of ten rules for each order; the answers come from joins and sums over the drawn tables."""
    found = CB.every_case(table(spark, sf, "orders"), "o_orderkey", pools(spark, sf))
    return found.select("o_orderkey", "rule", F.array_join(F.transform("answers", lambda a: a["label"]), ",").alias("answers"))


@query("pool_names", f"""
WITH p AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS place FROM (SELECT DISTINCT name FROM clients WHERE name IS NOT NULL)),
v AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS place FROM (SELECT DISTINCT name FROM vendors WHERE name IS NOT NULL)),
x AS (SELECT o_orderkey, cast(o_orderkey AS VARCHAR) AS k FROM orders),
d AS (SELECT *, {_draw('lp:person', 0, '(SELECT count(*) FROM p) - 1')} AS a, {_draw('ic:org', 0, '(SELECT count(*) FROM v) - 1')} AS b FROM x)
SELECT o_orderkey, p.name AS person, v.name AS org FROM d JOIN p ON p.place = a JOIN v ON v.place = b""")
def pool_names(spark, sf):
    """The person and the firm that the cases of an order name, read back out of their states."""
    own, rows = pools(spark, sf), table(spark, sf, "orders")
    person = CB.cases(rows, "o_orderkey", "leave_policy", own).select("o_orderkey", F.regexp_extract("state", r"^(.*?) asks for", 1).alias("person"))
    org = CB.cases(rows, "o_orderkey", "insurance_claim", own).select("o_orderkey", F.regexp_extract("state", r"^(.*?): devices", 1).alias("org"))
    return person.join(org, "o_orderkey")


HEAD = "id string, group_id string, source string, state string, state_kind string, kind string, question string, options array<string>, target array<double>, question_id string, language string, license string"


@query("grouped_heads", """
WITH t AS (SELECT conv_id % 4 AS run, conv_id // 8 AS grp, conv_id, turn, role, row_number() OVER (PARTITION BY conv_id % 4, conv_id // 8 ORDER BY conv_id, turn, role, text) - 1 AS rn FROM conversations WHERE conv_id % 5 <> 0),
c AS (SELECT run, grp, rn // 6 AS chunk, count(*) AS n, string_agg(CASE WHEN role = 'user' THEN 'asks' ELSE 'answers' END, ',' ORDER BY rn) AS labels FROM t GROUP BY ALL)
SELECT concat('a conversation of group ', grp) AS state, n, array_to_string(list_transform(range(0, n), lambda i: concat('speaker', repeat('_2', i))), ',') AS fields, labels FROM c""")
def grouped_heads(spark, sf):
    """Turns as decision heads, written to four gzipped files of JSON lines and read back in the order of their lines."""
    c = table(spark, sf, "conversations")
    asks = F.col("role") == "user"
    heads = c.select(
        (F.col("conv_id") % 4).alias("run"), "conv_id", "turn", "role", "text", F.concat_ws(":", "conv_id", "turn").alias("id"), F.floor(F.col("conv_id") / 8).cast("string").alias("group_id"), F.lit("talks").alias("source"),
        F.concat(F.lit("a conversation of group "), F.floor(F.col("conv_id") / 8).cast("string")).alias("state"), F.lit("string").alias("state_kind"), F.lit("choice").alias("kind"), F.lit("Who speaks?").alias("question"),
        F.array(F.lit("asks: wants to know"), F.lit("answers: knows")).alias("options"), F.when(asks, F.array(F.lit(0.9), F.lit(0.1))).otherwise(F.array(F.lit(0.2), F.lit(0.8))).alias("target"),
        F.lit("speaker").alias("question_id"), F.when(F.col("conv_id") % 5 == 0, "de").otherwise("en").alias("language"), F.lit("CC0-1.0").alias("license"),
    )
    path = f"{DD.require_shared_dir(c)}/verdancy/heads-{uuid.uuid4().hex}"
    ordered = heads.repartitionByRange(4, "run").sortWithinPartitions("run", "conv_id", "turn", "role", "text")
    ordered.drop("conv_id", "turn", "role", "text").write.option("compression", "gzip").partitionBy("run").json(path)
    out = CV.grouped_heads(CV.head_files(spark, f"{path}/*/*.json.gz", HEAD), "en", "talks", "file", "line")
    said = lambda c, f: F.array_join(F.transform(c, lambda x: x[f]), ",")
    return out.select("state", F.size("questions").cast("long").alias("n"), said("questions", "field").alias("fields"), said("targets", "label").alias("labels"))


@query("typed_decisions", """
SELECT concat('en-p-typed-', doc_id) AS id, CASE WHEN p > 1 - p THEN 'yes' ELSE 'no' END AS good, round(greatest(p, 1 - p), 4) AS sure, CASE WHEN q >= 0.5 THEN 'short' ELSE 'long' END AS size
FROM (SELECT doc_id, text, CASE quality WHEN 1 THEN 0.8 ELSE 0.3 END AS p, (n_chars % 11) / 10.0 AS q FROM documents JOIN labels USING (doc_id)) WHERE length(trim(text)) >= 15 AND NOT contains(text, '<decision>')""")
def typed_decisions(spark, sf):
    """Labelled documents as rows with JSON questions and JSON probabilities."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    p, q = F.when(F.col("quality") == 1, 0.8).otherwise(0.3), F.col("n_chars") % 11 / F.lit(10.0)
    questions = F.lit('{"good": {"type": "noul", "instructions": "Is it good?"}, "size": {"type": "choice", "instructions": "How long?", "criteria": {"short": "a few words", "long": "many words"}}}')
    share = lambda *held: F.to_json(F.struct(F.struct(*[v.alias(k) for k, v in held]).alias("probabilities")))
    gold = F.concat(F.lit('{"good": '), share(("true", p), ("false", 1 - p)), F.lit(', "size": '), share(("short", q), ("long", 1 - q)), F.lit("}"))
    rows = d.select(F.col("doc_id").alias("id"), F.col("text").alias("state"), F.col("source").alias("workflow"), questions.alias("questions"), gold.alias("gold"))
    t = F.col("targets")
    out = CV.typed_decisions(rows)
    return out.select("id", t[0]["label"].alias("good"), F.round(F.array_max(t[0]["dist"]), 4).alias("sure"), t[1]["label"].alias("size"))
