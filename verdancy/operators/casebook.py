"""Samplers of the rules whose facts lie in several tables, with names from pools.

A case is a row's key.  Its facts are drawn from the key's hashes (so they hang on
no order and no partition) and laid out as a user would find them: nights and
meals of a trip, records of a list, leave taken, orders of customers in cities of
depots.  The answers come out of those tables by lookups and sums and the rules of
:mod:`rules`; nothing of the draw reaches them by another way.

A case's tables have at most ten lines and are held as arrays in its row, so that
no line is shuffled to be joined with lines that were drawn beside it.

Names come from pools, tables of any size: a case is dealt a place of its pool by
a hash, and the name is joined by that place, with a broadcast only while the
pool's bytes, which are checked, are few.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as T
from ..functions import text as X
from . import rules as R
from . import scans as SC
from .generate import between, day_between, side, unit

#: A pool is broadcast up to so many bytes of names.
BROADCAST_BYTES = 4 << 20
EMPTY = "-"


class Pools:
    """Named pools of distinct texts, in order; an empty pool gives the text '-'."""

    def __init__(self, names: DataFrame):
        """names(pool, name)"""
        each = names.where("name is not null").distinct()
        self.table = SC.numbered(each, ["pool"], [F.col("name")], "place").checkpoint()
        facts = self.table.groupBy("pool").agg(F.count("*").alias("n"), F.sum(F.octet_length("name")).alias("size")).collect()  # a line a pool
        self.sizes = {r["pool"]: r["n"] for r in facts}
        self.bytes = {r["pool"]: r["size"] for r in facts}

    def dealt(self, rows: DataFrame, pool: str, place: Column, column: str) -> DataFrame:
        """rows with the pool's name of a place in column."""
        own = self.table.where(F.col("pool") == pool).select(F.col("place").alias("_place"), F.col("name").alias(column))
        own = F.broadcast(own) if self.bytes.get(pool, 0) <= BROADCAST_BYTES else own
        return rows.withColumn("_place", place.cast("long")).join(own, "_place", "left").withColumn(column, F.coalesce(column, F.lit(EMPTY))).drop("_place")

    def dealt_each(self, rows: DataFrame, pool: str, places: Column, most: int, column: str) -> DataFrame:
        """rows with the pool's names of an array of at most so many places in column."""
        named = [f"_name{i}" for i in range(most)]
        out = rows.withColumn("_places", places)
        for i, c in enumerate(named):
            out = self.dealt(out, pool, F.get("_places", F.lit(i)), c)
        return out.withColumn(column, F.slice(F.array(*named), F.lit(1), F.size("_places"))).drop("_places", *named)

    def place(self, key: Column, salt: str, pool: str) -> Column:
        return between(key, salt, 0, max(self.sizes.get(pool, 0) - 1, 0))

    def picked(self, rows: DataFrame, key: Column, salt: str, pool: str, column: str) -> DataFrame:
        return self.dealt(rows, pool, self.place(key, salt, pool), column)


def one_of(key: Column, salt: str, values: list) -> Column:
    """One of the values; those that are columns are only worked out when they are the one."""
    at = between(key, salt, 0, len(values) - 1)
    plain = F.array(*[F.lit(None if isinstance(v, Column) else v) for v in values])
    drawn = [(i, v) for i, v in enumerate(values) if isinstance(v, Column)]
    if not drawn:
        return F.get(plain, at)
    return X.let(at, lambda place: F.coalesce(F.get(plain, place), *[F.when(place == i, v) for i, v in drawn]))


def often(key: Column, salt: str, share: float = 0.5) -> Column:
    return unit(key, salt) < share


def _case(facts: DataFrame, key: str, rule: str, template: str, slots: dict[str, Column], answers: dict[str, Column]) -> DataFrame:
    labels = F.array(*[F.struct(F.lit(f).alias("field"), a.cast("string").alias("label")) for f, a in answers.items()])
    return facts.select(key, F.lit(rule).alias("rule"), X.filled_text(template, slots).alias("state"), labels.alias("answers"))


def _lines(count: Column, line: Callable[[Column], Column]) -> Column:
    """A table of the case: line(i) for each of count numbers from 0."""
    return F.transform(F.sequence(F.lit(0), count - 1), line)


def _total(amounts: Column) -> Column:
    return F.aggregate(amounts, F.lit(0).cast("long"), lambda a, x: a + x)


def business_days(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    day = day_between(k, "bd:ordered")
    facts = pools.picked(rows, k, "bd:org", "orgs", "org").withColumns({"ordered": F.date_add(day, F.when(F.weekday(day) > 4, 7 - F.weekday(day)).otherwise(0)), "n": between(k, "bd:n", 1, 15)})
    facts = facts.withColumn("promised", F.date_sub(T.add_business_days(F.col("ordered"), F.col("n")), side(k, "bd:side", 6).cast("int")))
    in_time, weekday = R.business_days(F.col("ordered"), F.col("n"), F.col("promised"))
    slots = {c: F.col(c) for c in ("org", "ordered", "n", "promised")}
    return _case(facts, key, "business_days", "{org} took the order on {ordered}, needs {n} business days and promised {promised}.", slots, {"in_time": in_time, "ready_on": weekday})


def relative_date(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    facts = pools.picked(rows, k, "rd:person", "people", "person").withColumn("today", day_between(k, "rd:today", last="2027-12-20"))
    left = F.datediff(F.last_day("today"), F.col("today"))
    n = F.when(often(k, "rd:same") & (left >= 2), between(k, "rd:near", F.lit(2), left)).otherwise(between(k, "rd:far", F.greatest(F.lit(2), left + 1), left + 45))
    facts = facts.withColumn("n", n)
    weekday, same = R.relative_date(F.col("today"), F.col("n"))
    return _case(facts, key, "relative_date", "On {today} {person} asks for a date in {n} days.", {c: F.col(c) for c in ("today", "person", "n")}, {"weekday": weekday, "same_month": same})


def event_order(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    apart = one_of(k, "eo:apart", [1, -1, between(k, "eo:after", 2, 90), -between(k, "eo:before", 2, 90)])
    facts = pools.picked(rows, k, "eo:org", "orgs", "org").withColumn("a", day_between(k, "eo:a")).withColumn("b", F.date_add("a", apart))
    return _case(facts, key, "event_order", "{org} opened on {a} and moved on {b}.", {c: F.col(c) for c in ("org", "a", "b")}, {"a_first": R.event_order(F.col("a"), F.col("b"))})


def count_records(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    """Records with the place of their status; names of a pool are distinct, so equal places are equal statuses."""
    heads = rows.withColumns({"wanted_at": pools.place(k, "cr:wanted", "statuses"), "least": between(k, "cr:least", 10, 90), "n": between(k, "cr:n", 4, 10)})

    def record(i: Column) -> Column:
        line = F.concat_ws(".", k, i.cast("string"))
        near = one_of(line, "cr:near", [0, 1, -1, between(line, "cr:over", 2, 40), -between(line, "cr:under", 2, 9)])
        return F.struct(pools.place(line, "cr:status", "statuses").alias("status"), (F.col("least") + near).alias("value"))

    records = heads.withColumn("lines", _lines(F.col("n"), record))
    counted = F.size(F.filter("lines", lambda r: (r["status"] == F.col("wanted_at")) & (r["value"] >= F.col("least")))).cast("long")
    found = pools.dealt(records.withColumn("count", counted), "statuses", F.col("wanted_at"), "wanted")
    found = pools.dealt_each(found, "statuses", F.col("lines.status"), 10, "statuses")
    said = F.array_join(F.zip_with("statuses", "lines", lambda status, r: F.concat_ws(" ", status, r["value"].cast("string"))), "; ")
    return _case(found, key, "count_records", "Records: {records}. How many are {wanted} with at least {least}?", {"records": said, "wanted": F.col("wanted"), "least": F.col("least")}, {"count": F.col("count")})


def unit_limit(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    kind = between(k, "ul:unit", 0, len(R.UNITS) - 1)
    at = lambda j: F.get(F.array(*[F.lit(u[j]) for u in R.UNITS]), kind)
    facts = pools.picked(rows, k, "ul:item", "products", "item").withColumns({"small": at(0), "big": at(1), "factor": at(2)})
    facts = facts.withColumn("limit", one_of(k, "ul:limit", [1, 2, 5, 10, 15, 20, 25, 30]).cast("decimal(18,4)") / one_of(k, "ul:part", [1, 2, 4]).cast("decimal(18,0)"))
    exact = F.col("limit").cast("decimal(18,4)") * F.col("factor")
    facts = facts.withColumn("amount", F.greatest(F.lit(1), exact.cast("int") + side(k, "ul:side", F.floor(exact / 3).cast("int") + 2)))
    slots = {"item": F.col("item"), "amount": F.concat_ws(" ", F.col("amount").cast("string"), "small"), "limit": F.concat_ws(" ", F.col("limit").cast("double").cast("string"), "big")}
    return _case(facts, key, "unit_limit", "{item}: {amount}, the limit is {limit}.", slots, {"within": R.unit_limit(F.col("amount"), F.col("small"), F.col("limit").cast("decimal(18,4)"))})


def expense_policy(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    """Trips, with a line for each night and each day's meals; the policy has a line for dear and one for other cities."""
    trips = rows.withColumns({"dear": often(k, "ep:dear"), "nights": between(k, "ep:nights", 1, 6), "cap": between(k, "ep:cap", 80, 180) * 100, "meal_cap": between(k, "ep:meals", 25, 60) * 100, "receipt": one_of(k, "ep:receipt", [25, 50, 75, 100]) * 100})
    trips = trips.withColumn("dear_cap", F.col("cap") + between(k, "ep:more", 30, 90) * 100)
    trips = pools.dealt(trips, "cities", F.when(F.col("dear"), pools.place(k, "ep:dear_city", "cities")).otherwise(pools.place(k, "ep:city", "cities")), "city")
    money_side = lambda salt, most: F.when(often(k, salt), F.when(often(k, salt + ":zero"), 0).otherwise(-between(k, salt + ":low", 100, most))).otherwise(between(k, salt + ":high", 100, most))
    policy = F.array(F.struct(F.lit(True).alias("dear"), F.col("dear_cap").alias("night_cap")), F.struct(F.lit(False).alias("dear"), F.col("cap").alias("night_cap")))
    trips = trips.withColumn("night_cap", F.get(F.filter(policy, lambda p: p["dear"] == F.col("dear")), F.lit(0))["night_cap"])
    first_and = lambda off, line, n: F.concat(F.array(line + off), F.array_repeat(line, n - 1))
    hotel = _total(first_and(money_side("ep:hotel", 6000), F.col("night_cap"), F.col("nights")))
    meals = _total(first_and(money_side("ep:food", 3000), F.col("meal_cap"), F.col("nights") + 1))
    holds, small = often(k, "ep:holds"), often(k, "ep:small")
    below = F.when(often(k, "ep:below", 0.7), between(k, "ep:less", 100, 2000)).otherwise(0)
    above = between(k, "ep:over", 100, 8000)
    facts = trips.withColumns({"hotel": hotel, "meals": meals, "big": F.col("receipt") + F.when(holds & small, -below).otherwise(above), "attached": F.when(holds, ~small | often(k, "ep:attached")).otherwise(False)})
    answers = R.expense_policy(*[F.col(c) for c in ("hotel", "cap", "dear_cap", "dear", "nights", "meals", "meal_cap", "receipt", "big", "attached")])
    slots = {c: F.col(c) for c in ("city", "nights", "hotel", "meals", "big")} | {"status": F.when(F.col("attached"), "attached").otherwise("missing")}
    return _case(facts, key, "expense_policy", "{nights} nights in {city}: hotel {hotel}, meals {meals}, one item of {big} (receipt {status}).", slots, dict(zip(("hotel_ok", "meals_ok", "receipt_ok"), answers)))


def return_policy(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    facts = rows.withColumns({"standard": one_of(k, "rp:standard", [14, 15, 30]), "category": one_of(k, "rp:category", ["electronics", "hygiene", "other"]), "opened": often(k, "rp:opened"), "on_sale": often(k, "rp:sale", 0.4)})
    facts = pools.picked(facts, k, "rp:product", "products", "product").withColumn("electronics", one_of(k, "rp:electronics", [7, 10, 21]))
    window = F.when(F.col("category") == "electronics", F.col("electronics")).otherwise(F.col("standard"))
    facts = facts.withColumn("days", F.greatest(F.lit(0), window + side(k, "rp:side", 10)))
    outcome, within = R.return_policy(*[F.col(c) for c in ("category", "opened", "on_sale", "days", "standard", "electronics")])
    slots = {c: F.col(c) for c in ("product", "category", "days")} | {"state": F.when(F.col("opened"), "opened").otherwise("unopened"), "sale": F.when(F.col("on_sale"), "on sale").otherwise("at full price")}
    return _case(facts, key, "return_policy", "{product} ({category}), bought {sale}, {state}, sent back after {days} days.", slots, {"outcome": outcome, "within": within})


def insurance_claim(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    """Damaged things as lines with their class; the payout is what the lines add up to under the policy."""
    policy = pools.picked(rows, k, "ic:org", "orgs", "org").withColumns(
        {"deductible": one_of(k, "ic:deductible", [100, 150, 250, 500]) * 100, "sublimit": one_of(k, "ic:sublimit", [1000, 1500, 2000, 2500]) * 100, "most": one_of(k, "ic:most", [4000, 5000, 7500, 10_000]) * 100, "declared": often(k, "ic:declared")}
    )
    over = F.when(often(k, "ic:over"), between(k, "ic:more", 5000, 150_000)).otherwise(-F.when(often(k, "ic:equal"), 0).otherwise(between(k, "ic:less", 5000, 90_000)))
    amounts = F.array(F.col("sublimit") + over, between(k, "ic:jewels", 20_000, 250_000), between(k, "ic:other", 0, 300_000))
    lines = F.transform(amounts, lambda amount, kind: F.struct(kind.alias("kind"), amount.alias("amount")))
    of_kind = lambda i: _total(F.transform(F.filter("lines", lambda line: line["kind"] == i), lambda line: line["amount"]))
    facts = policy.withColumn("lines", lines).withColumns({c: of_kind(i) for i, c in enumerate(("devices", "jewels", "rest"))})
    facts = facts.withColumn("payout", R.insurance_payout(*[F.col(c) for c in ("devices", "sublimit", "jewels", "declared", "rest", "deductible", "most")]))
    facts = facts.withColumn("threshold", F.round((F.col("payout") + one_of(k, "ic:step", [4000, 30_000]) * F.when(often(k, "ic:up"), 1).otherwise(-1)) / 1000).cast("long") * 1000)
    capped, above = R.insurance_claim(*[F.col(c) for c in ("devices", "sublimit", "payout", "threshold")])
    slots = {c: F.col(c) for c in ("org", "devices", "jewels", "rest", "threshold")} | {"status": F.when(F.col("declared"), "declared").otherwise("not declared")}
    return _case(facts, key, "insurance_claim", "{org}: devices {devices}, jewellery {jewels} ({status}), other things {rest}. Is the payout over {threshold}?", slots, {"capped": capped, "over": above})


def leave_policy(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    """Employees, the leave they have taken (a list of entries), requests and blackouts."""
    staff = pools.picked(rows, k, "lp:person", "people", "person").withColumns({"annual": one_of(k, "lp:annual", [20, 24, 26, 30]), "carry": one_of(k, "lp:carry", [5, 10]), "unused": between(k, "lp:unused", 0, 15)})
    staff = staff.withColumn("all_taken", between(k, "lp:taken", F.lit(0), F.col("annual")))
    part = lambda i: F.floor((F.col("all_taken") + i) / 3).cast("int")
    staff = staff.withColumn("taken", _total(F.array(part(0), part(1), part(2))).cast("int")).drop("all_taken")
    day = day_between(k, "lp:start", "2025-01-06", "2027-11-30")
    available = F.col("annual") + F.least("unused", "carry") - F.col("taken")
    asked = staff.withColumns({"start": F.date_add(day, F.when(F.weekday(day) > 4, 7 - F.weekday(day)).otherwise(0)), "want": F.greatest(F.lit(1), available + side(k, "lp:side", 8))})
    asked = asked.withColumn("end", T.add_business_days(F.col("start"), F.col("want") - 1))
    few = F.greatest(F.lit(1), F.col("want") - one_of(k, "lp:few", [1, 1, between(k, "lp:fewer", 2, 5)]))
    asked = asked.withColumns({"director": F.when(often(k, "lp:director"), few).otherwise(F.col("want") + one_of(k, "lp:many", [0, 0, between(k, "lp:more", 1, 5)])), "length": between(k, "lp:length", 3, 14)})
    inside = F.when(often(k, "lp:in"), between(k, "lp:at", F.lit(0), F.datediff("end", "start"))).otherwise(-between(k, "lp:ahead", F.lit(0), F.col("length")))
    outside = F.when(often(k, "lp:late"), F.datediff("end", "start") + between(k, "lp:gap", 1, 20)).otherwise(-(F.col("length") + between(k, "lp:before", 1, 20)))
    asked = asked.withColumn("b_start", F.date_add("start", F.when(often(k, "lp:touch"), inside).otherwise(outside)))
    asked = asked.withColumn("b_end", F.date_add("b_start", F.col("length")))
    answers = R.leave_policy(*[F.col(c) for c in ("annual", "carry", "unused", "taken", "start", "end", "director", "b_start", "b_end")])
    slots = {c: F.col(c) for c in ("person", "start", "end", "annual", "unused", "taken", "b_start", "b_end")}
    return _case(asked, key, "leave_policy", "{person} asks for {start} to {end}; {annual} days a year, {unused} left over, {taken} taken. No leave from {b_start} to {b_end}.", slots, dict(zip(("enough", "director", "blackout"), answers)))


def depot_lookup(rows: DataFrame, key: str, k: Column, pools: Pools) -> DataFrame:
    """Customers, orders and the depots of cities as three tables; both questions are answered by lookups from one to the other.

    Cities and depots are known by their places in the pools, where names are distinct; only the named ones get their names.
    """
    line = lambda i: F.concat_ws(".", k, i.cast("string"))
    n_depots, n_cities = max(pools.sizes.get("depots", 0), 1), max(pools.sizes.get("cities", 0), 1)
    counts = F.struct(*[between(k, f"dl:{c}", low, high).alias(c) for c, low, high in (("cities", 4, 6), ("customers", 4, 6), ("orders", 5, 8))], pools.place(k, "dl:depot", "depots").alias("shift"))

    def tables(n: Column) -> Column:
        return F.struct(
            _lines(n["cities"], lambda i: F.pmod(n["shift"] + i, F.lit(n_depots))).alias("cities"),
            _lines(n["customers"], lambda i: between(line(i), "dl:lives", F.lit(0), n["cities"] - 1)).alias("customers"),
            _lines(n["orders"], lambda i: between(line(i), "dl:buys", F.lit(0), n["customers"] - 1)).alias("orders"),
            between(k, "dl:first", F.lit(0), n["orders"] - 1).alias("one"),
            often(k, "dl:same").alias("want"),
        )

    def served(t: Column) -> Column:
        """The city and the depot of each order."""
        to = F.transform(t["orders"], lambda customer: F.get(t["customers"], customer))
        by = F.transform(t["orders"], lambda customer: F.get(t["cities"], F.get(t["customers"], customer)))
        return F.struct(t["one"].alias("one"), t["want"].alias("want"), F.get(to, t["one"]).alias("city_at"), F.get(by, t["one"]).alias("first_at"), by.alias("by"))

    def asked(s: Column) -> Column:
        other = lambda at, i: F.struct(((at == s["first_at"]) != s["want"]).alias("_other"), unit(line(i), "dl:pick").alias("_pick"), i.alias("two"), at.alias("second_at"))
        second = F.array_min(F.filter(F.transform(s["by"], other), lambda o: o["two"] != s["one"]))
        return F.struct(s["one"].alias("one"), s["first_at"].alias("first_at"), s["city_at"].alias("city_at"), second.alias("p"))

    # every table is bound (let), or Catalyst would draw it again for each line that looks into it
    found = X.let(counts, lambda n: X.let(tables(n), lambda t: X.let(served(t), asked)))
    chosen = rows.select(key, k.alias("_k"), found.alias("f")).select(key, "_k", "f.one", "f.first_at", "f.city_at", "f.p.two", "f.p.second_at")
    facts = pools.dealt(chosen, "depots", F.col("first_at"), "depot")
    facts = pools.dealt(facts, "cities", F.pmod(pools.place(F.col("_k"), "dl:city", "cities") + F.col("city_at"), F.lit(n_cities)), "city")
    slots = {"one": F.col("one"), "two": F.col("two"), "city": F.col("city")}
    return _case(facts, key, "depot_lookup", "Which depot serves order {one} (to {city}), and does it serve order {two}?", slots, {"depot": F.col("depot"), "same": R.yes(F.col("second_at") == F.col("first_at"))})


CASES = {f.__name__: f for f in (business_days, relative_date, event_order, count_records, unit_limit, expense_policy, return_policy, insurance_claim, leave_policy, depot_lookup)}


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """The keys alone, dealt over the shuffle partitions: a case is much work for few bytes, and a file of keys may be one task."""
    return rows.select(key).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def cases(rows: DataFrame, key: str, rule: str, pools: Pools) -> DataFrame:
    """rows(key), unique, with rule, state and answers, an array of field and label."""
    return CASES[rule](_dealt(rows, key), key, F.col(key).cast("string"), pools)


def every_case(rows: DataFrame, key: str, pools: Pools) -> DataFrame:
    out = None
    for rule in CASES:
        part = cases(rows, key, rule, pools)
        out = part if out is None else out.unionByName(part)
    return out
