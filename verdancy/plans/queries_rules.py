"""Queries of the rule engine and comparison tables over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as T
from ..functions import text as X
from ..operators import compare as CP
from ..operators import decide as DC
from ..operators import rules as R
from ..operators import stats as ST
from .catalogue import query

DAY = "['monday','tuesday','wednesday','thursday','friday','saturday','sunday']"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def lines(spark, sf):
    """Rows of lineitem with a key of their own order and number."""
    return table(spark, sf, "lineitem")


@query("rule_deadline", """
WITH x AS (SELECT o_orderkey, date_diff('day', (o_orderdate::DATE + 10), (l_shipdate::DATE)) AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CASE WHEN late <= 0 THEN 'yes' ELSE 'no' END AS on_time, CASE WHEN late <= 0 THEN 'on_time' WHEN late <= 7 THEN 'late_1_7' ELSE 'late_8_plus' END AS lateness, count(*) AS n FROM x GROUP BY 1, 2""")
def rule_deadline(spark, sf):
    rows = lines(spark, sf).join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    on_time, lateness = R.deadline(F.to_date("l_shipdate"), F.date_add("d", 10))
    return rows.groupBy(on_time.alias("on_time"), lateness.alias("lateness")).agg(F.count("*").alias("n"))


@query("rule_return_window", f"""
SELECT o_orderkey, CASE WHEN o_orderdate::DATE + (o_orderkey % 20)::INTEGER <= o_orderdate::DATE + 14 THEN 'yes' ELSE 'no' END AS within, {DAY}[isodow(o_orderdate::DATE + 14)] AS last_day FROM orders""")
def rule_return_window(spark, sf):
    o = orders(spark, sf)
    within, day = R.return_window(F.col("d"), F.date_add("d", (F.col("o_orderkey") % 20).cast("int")), F.lit(14))
    return o.select("o_orderkey", within.alias("within"), day.alias("last_day"))


@query("rule_business_days", f"""
WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS d, (1 + o_orderkey % 15)::INTEGER AS n FROM orders),
r AS (SELECT *, list_filter(list_transform(range(1, 40), lambda i: d + i::INTEGER), lambda q: isodow(q) < 6)[n] AS ready FROM x)
SELECT o_orderkey, ready, {DAY}[isodow(ready)] AS weekday, CASE WHEN ready <= d + 10 THEN 'yes' ELSE 'no' END AS in_time FROM r""")
def rule_business_days(spark, sf):
    n = (1 + F.col("o_orderkey") % 15).cast("int")
    in_time, day = R.business_days(F.col("d"), n, F.date_add("d", 10))
    return orders(spark, sf).select("o_orderkey", T.add_business_days(F.col("d"), n).alias("ready"), day.alias("weekday"), in_time.alias("in_time"))


@query("rule_relative_date", f"""
SELECT o_orderkey, {DAY}[isodow(o_orderdate::DATE + (o_orderkey % 45)::INTEGER)] AS weekday, CASE WHEN date_trunc('month', o_orderdate::DATE + (o_orderkey % 45)::INTEGER) = date_trunc('month', o_orderdate::DATE) THEN 'yes' ELSE 'no' END AS same_month FROM orders""")
def rule_relative_date(spark, sf):
    day, same = R.relative_date(F.col("d"), (F.col("o_orderkey") % 45).cast("int"))
    return orders(spark, sf).select("o_orderkey", day.alias("weekday"), same.alias("same_month"))


@query("rule_age_limit", """
WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS birth, DATE '2015-03-15' AS e FROM orders)
SELECT o_orderkey, CASE WHEN year(e) - year(birth) - CASE WHEN (month(e), day(e)) < (month(birth), day(birth)) THEN 1 ELSE 0 END >= 18 THEN 'yes' ELSE 'no' END AS old_enough FROM x""")
def rule_age_limit(spark, sf):
    return orders(spark, sf).select("o_orderkey", R.age_limit(F.col("d"), F.to_date(F.lit("2015-03-15")), F.lit(18)).alias("old_enough"))


@query("rule_event_order", "SELECT event_type, count_if(ts < TIMESTAMP '2024-01-15') AS before, count(*) AS n FROM events GROUP BY event_type")
def rule_event_order(spark, sf):
    a = R.event_order(F.col("ts"), F.to_timestamp(F.lit("2024-01-15")))
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(a == "yes").alias("before"), F.count("*").alias("n"))


@query("rule_sum_limit", """
WITH s AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2)) AS total, arg_max(l_linenumber, (l_extendedprice::DECIMAL(18,2), -l_linenumber)) AS top_item FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN total > 150000 THEN 'yes' ELSE 'no' END AS over_limit, top_item FROM s""")
def rule_sum_limit(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines(spark, sf).groupBy("l_orderkey").agg(*R.sum_limit_over(price, F.col("l_linenumber"), F.col("l_linenumber"), F.lit(150000)))


@query("rule_discount", """
SELECT o_orderkey, round(o_totalprice::DECIMAL(18,2) * (100 - o_orderkey % 50)::DECIMAL(5,0) * 0.01::DECIMAL(3,2), 2)::DECIMAL(18,2)::DOUBLE AS final,
CASE WHEN round(o_totalprice::DECIMAL(18,2) * (100 - o_orderkey % 50)::DECIMAL(5,0) * 0.01::DECIMAL(3,2), 2)::DECIMAL(18,2) <= 100000 THEN 'yes' ELSE 'no' END AS within FROM orders""")
def rule_discount(spark, sf):
    percent = F.col("o_orderkey") % 50
    return orders(spark, sf).select("o_orderkey", R.discounted(F.col("price"), percent).cast("double").alias("final"), R.discount(F.col("price"), percent, F.lit(100000)).alias("within"))


@query("rule_count_records", "SELECT l_orderkey, count_if(l_returnflag = 'R' AND l_quantity >= 20)::INTEGER AS n FROM lineitem GROUP BY l_orderkey")
def rule_count_records(spark, sf):
    n = R.count_records_over(F.col("l_returnflag"), F.lit("R"), F.col("l_quantity"), F.lit(20))
    return lines(spark, sf).groupBy("l_orderkey").agg(n.cast("int").alias("n"))


@query("rule_unit_limit", """
SELECT p_partkey, CASE WHEN (p_retailprice * 10)::DECIMAL(18,4) <= p_size::DECIMAL(18,4) * CASE p_partkey % 2 WHEN 0 THEN 1000 ELSE 100 END THEN 'yes' ELSE 'no' END AS within FROM part""")
def rule_unit_limit(spark, sf):
    unit = F.when(F.col("p_partkey") % 2 == 0, "g").otherwise("cm")
    return table(spark, sf, "part").select("p_partkey", R.unit_limit(F.col("p_retailprice") * 10, unit, F.col("p_size")).alias("within"))


@query("rule_average_pass", "SELECT l_orderkey, CASE WHEN sum(l_quantity) >= 25 * count(*) THEN 'yes' ELSE 'no' END AS passes FROM lineitem GROUP BY l_orderkey")
def rule_average_pass(spark, sf):
    return lines(spark, sf).groupBy("l_orderkey").agg(R.average_pass_over(F.col("l_quantity"), F.lit(25)).alias("passes"))


@query("rule_expense_policy", """
WITH x AS (SELECT o_orderkey, o_totalprice::DECIMAL(18,2) AS p, o_orderkey % 6 + 1 AS nights FROM orders)
SELECT o_orderkey, CASE WHEN p <= CASE WHEN o_orderkey % 2 = 0 THEN 40000 ELSE 30000 END * nights THEN 'yes' ELSE 'no' END AS hotel,
CASE WHEN p <= 25000 * (nights + 1) THEN 'yes' ELSE 'no' END AS meals, CASE WHEN p <= 100000 OR o_orderkey % 3 = 0 THEN 'yes' ELSE 'no' END AS receipt FROM x""")
def rule_expense_policy(spark, sf):
    k, p = F.col("o_orderkey"), F.col("price")
    hotel, meals, receipt = R.expense_policy(p, F.lit(30000), F.lit(40000), k % 2 == 0, k % 6 + 1, p, F.lit(25000), F.lit(100000), p, k % 3 == 0)
    return orders(spark, sf).select("o_orderkey", hotel.alias("hotel"), meals.alias("meals"), receipt.alias("receipt"))


@query("rule_return_policy", """
WITH x AS (SELECT o_orderkey, ['electronics','hygiene','other'][o_orderkey % 3 + 1] AS c, o_orderkey % 2 = 0 AS opened, o_orderkey % 5 < 2 AS sale, o_orderkey % 25 AS days FROM orders),
w AS (SELECT *, CASE WHEN c = 'electronics' THEN 7 ELSE 14 END AS win FROM x)
SELECT o_orderkey, CASE WHEN (c = 'hygiene' AND opened) OR days > win THEN 'not_returnable' WHEN sale THEN 'store_credit' ELSE 'full_refund' END AS outcome, CASE WHEN days <= win THEN 'yes' ELSE 'no' END AS within FROM w""")
def rule_return_policy(spark, sf):
    k = F.col("o_orderkey")
    category = F.get(F.array(F.lit("electronics"), F.lit("hygiene"), F.lit("other")), (k % 3).cast("int"))
    outcome, within = R.return_policy(category, k % 2 == 0, k % 5 < 2, k % 25, F.lit(14), F.lit(7))
    return orders(spark, sf).select("o_orderkey", outcome.alias("outcome"), within.alias("within"))


@query("rule_insurance_claim", """
WITH x AS (SELECT o_orderkey, (o_orderkey % 3000)::DECIMAL(18,2) AS el, (o_orderkey % 700)::DECIMAL(18,2) AS jw, (o_orderkey % 1100)::DECIMAL(18,2) AS ot, o_orderkey % 2 = 0 AS dec FROM orders),
p AS (SELECT *, least(4000::DECIMAL(18,2), greatest(0::DECIMAL(18,2), least(el, 1500::DECIMAL(18,2)) + CASE WHEN dec THEN jw ELSE 0::DECIMAL(18,2) END + ot - 250)) AS pay FROM x)
SELECT o_orderkey, CASE WHEN el > 1500 THEN 'yes' ELSE 'no' END AS capped, CASE WHEN pay > 1000 THEN 'yes' ELSE 'no' END AS over, pay::DOUBLE AS payout FROM p""")
def rule_insurance_claim(spark, sf):
    k = F.col("o_orderkey")
    money = lambda n: (k % n).cast("decimal(18,2)")
    pay = R.insurance_payout(money(3000), F.lit(1500), money(700), k % 2 == 0, money(1100), F.lit(250), F.lit(4000))
    capped, over = R.insurance_claim(money(3000), F.lit(1500), pay, F.lit(1000))
    return orders(spark, sf).select("o_orderkey", capped.alias("capped"), over.alias("over"), pay.cast("double").alias("payout"))


@query("rule_leave_policy", """
WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS s, o_orderdate::DATE + (o_orderkey % 30)::INTEGER AS e, (o_orderkey % 15)::INTEGER AS unused, (o_orderkey % 26)::INTEGER AS taken FROM orders),
w AS (SELECT *, len(list_filter(list_transform(range(0, date_diff('day', s, e) + 1), lambda i: s + i::INTEGER), lambda q: isodow(q) < 6)) AS wd FROM x)
SELECT o_orderkey, wd::INTEGER AS wanted, CASE WHEN wd <= 26 + least(unused, 5) - taken THEN 'yes' ELSE 'no' END AS enough, CASE WHEN wd > 10 THEN 'yes' ELSE 'no' END AS director,
CASE WHEN NOT (e < s + 5 OR s > s + 9) THEN 'yes' ELSE 'no' END AS blackout FROM w""")
def rule_leave_policy(spark, sf):
    k, s = F.col("o_orderkey"), F.col("d")
    e = F.date_add(s, (k % 30).cast("int"))
    enough, director, blackout = R.leave_policy(F.lit(26), F.lit(5), k % 15, k % 26, s, e, F.lit(10), F.date_add(s, 5), F.date_add(s, 9))
    return orders(spark, sf).select("o_orderkey", T.working_days(s, e).alias("wanted"), enough.alias("enough"), director.alias("director"), blackout.alias("blackout"))


@query("rule_depot_lookup", """
SELECT o_orderkey, r_name AS depot FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def rule_depot_lookup(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    cities = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("depot"))
    return R.depot_lookup(orders(spark, sf), customers, cities, "o_orderkey", "o_custkey", "n_nationkey")


@query("rule_same_depot", """
WITH d AS (SELECT o_orderkey, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT o_orderkey AS a, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders)
SELECT a, b, CASE WHEN x.n_regionkey = y.n_regionkey THEN 'yes' ELSE 'no' END AS same FROM p JOIN d x ON a = x.o_orderkey JOIN d y ON b = y.o_orderkey""")
def rule_same_depot(spark, sf):
    pairs = orders(spark, sf).select(F.col("o_orderkey").alias("a"), F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("b")).where("b is not null")
    return R.same_depot(pairs, rule_depot_lookup(spark, sf), "a", "b", "o_orderkey")


@query("luhn_checks", "SELECT c_custkey, list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 0 THEN d[i] ELSE CASE WHEN 2 * d[i] > 9 THEN 2 * d[i] - 9 ELSE 2 * d[i] END END)) % 10 = 0 AS ok FROM (SELECT c_custkey, list_transform(string_split(lpad((c_custkey * 7919 * 104729)::VARCHAR, 16, '4'), ''), lambda x: x::INTEGER) AS d FROM customer)")
def luhn_checks(spark, sf):
    number = F.lpad((F.col("c_custkey") * 7919 * 104729).cast("string"), 16, "4")
    return table(spark, sf, "customer").select("c_custkey", X.luhn_ok(number).alias("ok"))


@query("api_usage", "SELECT concat('p', user_id % 3, '/', event_type) AS model, count(*) AS calls, sum(coalesce(CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 100 END, 0))::BIGINT AS prompt_tokens, sum(event_id % 10)::BIGINT AS completion_tokens, round(sum(coalesce(value, 0)), 4) AS seconds FROM events GROUP BY 1")
def api_usage(spark, sf):
    e = table(spark, sf, "events")
    calls = e.select(F.concat(F.lit("p"), F.col("user_id") % 3).alias("provider"), F.col("event_type").alias("model"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 100).alias("prompt_tokens"), (F.col("event_id") % 10).alias("completion_tokens"), F.col("value").alias("latency_s"))
    return ST.usage(calls).withColumn("seconds", F.round("seconds", 4))


@query("quota_events", "SELECT concat('p', user_id % 3, ':', event_type, ':', CASE WHEN event_id % 2 = 0 THEN '429' ELSE 'None' END) AS event, count(*) AS n FROM events GROUP BY 1")
def quota_events(spark, sf):
    log = table(spark, sf, "events").select(F.concat(F.lit("p"), F.col("user_id") % 3).alias("provider"), F.col("event_type").alias("event"), F.when(F.col("event_id") % 2 == 0, 429).alias("status"))
    return ST.events(log)


@query("describe_nearest_rank", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, max(CASE WHEN rn = least(n - 1, floor(0.9 * n)) + 1 THEN value END) AS p90, max(value) AS max FROM r GROUP BY event_type""")
def describe_nearest_rank(spark, sf):
    return ST.describe(table(spark, sf, "events"), ["event_type"], "value").withColumns({"mean": F.round("mean", 6), "median": F.round("median", 6)})


MANY = [f"o{k}" for k in range(DC.MAX_OPTIONS + 1)]


@query("compile_prompt", r"""
WITH p AS (SELECT *, CASE WHEN p_partkey % 50 = 0 THEN concat(p_name, ' <decision>') ELSE p_name END AS name FROM part),
u AS (SELECT p_partkey, concat('Return one answer for every field using the supplied answer symbols.', chr(10), chr(10), '## State', chr(10), '"', name, '"', chr(10), '## Decision schema', chr(10),
'size: How big?', chr(10), '    A = small: ', p_type, chr(10), '    B = big', CASE WHEN p_partkey % 3 > 0 THEN concat(chr(10), 'brand: Which?', chr(10), '    A = ', p_brand, chr(10), '    B = other: any other', chr(10), '    C = unknown: none') ELSE '' END) AS prompt FROM p)
SELECT p_partkey, CASE WHEN p_partkey % 49 = 0 THEN 'too many options' WHEN p_partkey % 50 = 0 THEN 'reserved marker in text' END AS problem,
CASE WHEN p_partkey % 49 > 0 AND p_partkey % 50 > 0 THEN prompt END AS prompt,
CASE WHEN p_partkey % 49 > 0 AND p_partkey % 50 > 0 THEN concat('{', chr(10), '    "size": "<decision>"', CASE WHEN p_partkey % 3 > 0 THEN concat(',', chr(10), '    "brand": "<decision>"') ELSE '' END, chr(10), '}') END AS skeleton FROM u""")
def compile_prompt(spark, sf):
    k = F.col("p_partkey")
    option = lambda v, d: F.struct(F.lit(v).alias("value") if isinstance(v, str) else v.alias("value"), F.lit(d).alias("description") if isinstance(d, str) else d.alias("description"))
    size = F.when(k % 49 == 0, F.array(*[option(v, "") for v in MANY])).otherwise(F.array(option("small", F.col("p_type")), option("big", "")))
    brand = F.array(option(F.col("p_brand"), ""), option("other", "any other"), option("unknown", "none"))
    asked = F.array(
        F.struct(F.lit(0).alias("pos"), F.lit("size").alias("field"), F.lit("How big?").alias("instructions"), size.alias("opts")),
        F.when(k % 3 > 0, F.struct(F.lit(1).alias("pos"), F.lit("brand").alias("field"), F.lit("Which?").alias("instructions"), brand.alias("opts"))),
    )
    state = F.concat(F.lit('"'), "p_name", F.when(k % 50 == 0, " <decision>").otherwise(""), F.lit('"'))
    rows = table(spark, sf, "part").select("p_partkey", state.alias("state"), F.explode(F.array_compact(asked)).alias("q")).select("p_partkey", "state", "q.*")
    return DC.compile_prompt(rows, "p_partkey", "state").withColumnRenamed("user", "prompt")


@query("results_delta", """
WITH a AS (SELECT s_nationkey AS k, round(avg(s_acctbal), 4) AS m FROM supplier GROUP BY 1), b AS (SELECT c_nationkey AS k, round(avg(c_acctbal), 4) AS m FROM customer GROUP BY 1)
SELECT k, a.m AS m_ours, b.m AS m_base, round(a.m - b.m, 4) AS m_delta FROM a JOIN b USING (k)""")
def results_delta(spark, sf):
    a = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.round(F.avg("s_acctbal"), 4).alias("m"))
    b = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.round(F.avg("c_acctbal"), 4).alias("m"))
    return CP.deltas(a, b, ["k"], ["m"]).withColumn("m_delta", F.round("m_delta", 4))


PIVOT = "SELECT l_linenumber AS k, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS A, max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS N, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS R FROM (SELECT l_linenumber, l_returnflag, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) GROUP BY 1"


def _pivot(spark, sf):
    sums = lines(spark, sf).groupBy(F.col("l_linenumber").alias("k"), "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return CP.side_by_side(sums, "k", "l_returnflag", "q", ["A", "N", "R"])


@query("best_in_row", f"SELECT k, A, N, R, abs(A - greatest(A, N, R)) < 1e-9 AS best_A, abs(N - greatest(A, N, R)) < 1e-9 AS best_N, abs(R - greatest(A, N, R)) < 1e-9 AS best_R FROM ({PIVOT}) WHERE A IS NOT NULL AND N IS NOT NULL AND R IS NOT NULL")
def best_in_row(spark, sf):
    return _pivot(spark, sf).select("*", *CP.best_in_row(["A", "N", "R"]))


@query("win_counts", f"WITH t AS (SELECT * FROM ({PIVOT}) WHERE A IS NOT NULL AND N IS NOT NULL AND R IS NOT NULL) SELECT 'N' AS rival, count_if(A - N > 1e-9) AS ahead, count_if(A - N < -1e-9) AS behind FROM t UNION ALL SELECT 'R', count_if(A - R > 1e-9), count_if(A - R < -1e-9) FROM t")
def win_counts(spark, sf):
    return CP.wins(_pivot(spark, sf), "A", ["N", "R"], F.lit(True))


@query("rating_winner", """
WITH m AS (SELECT l_returnflag AS item, l_linestatus AS rater, avg(l_discount) AS m FROM lineitem GROUP BY ALL), x AS (SELECT item, round(avg(m), 9) AS mean, count(*) AS raters FROM m GROUP BY item)
SELECT item, mean, raters, item = (SELECT min(item) FROM x WHERE mean = (SELECT max(mean) FROM x)) AS winner FROM x""")
def rating_winner(spark, sf):
    return ST.mean_of_means(lines(spark, sf).select(F.col("l_returnflag").alias("item"), F.col("l_linestatus").alias("rater"), "l_discount"), "item", "rater", "l_discount")
