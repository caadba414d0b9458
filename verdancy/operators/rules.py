"""Rules with exact answers: facts in, gold labels out, as column expressions.

Money is DECIMAL; quotients are rounded half up to cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dates as T

#: Fixed values: (small unit, big unit, small units in a big one).
UNITS = (("g", "kg", 1000), ("ml", "l", 1000), ("cm", "m", 100), ("mm", "cm", 10))


def yes(condition: Column) -> Column:
    return F.when(condition, "yes").otherwise("no")


def deadline(submitted: Column, due: Column) -> tuple[Column, Column]:
    """on_time and lateness."""
    late = F.datediff(submitted, due)
    return yes(late <= 0), F.when(late <= 0, "on_time").when(late <= 7, "late_1_7").otherwise("late_8_plus")


def return_window(delivered: Column, requested: Column, window: Column) -> tuple[Column, Column]:
    """within and the weekday of the last day."""
    last = F.date_add(delivered, window)
    return yes(requested <= last), T.weekday_label(last)


def business_days(ordered: Column, n: Column, promised: Column) -> tuple[Column, Column]:
    """ready in time and the weekday on which it is ready."""
    ready = T.add_business_days(ordered, n)
    return yes(ready <= promised), T.weekday_label(ready)


def relative_date(today: Column, n: Column) -> tuple[Column, Column]:
    """the weekday n days on, and whether it is in the same month."""
    day = F.date_add(today, n)
    return T.weekday_label(day), yes(T.same_month(day, today))


def age_limit(birth: Column, event: Column, least: Column) -> Column:
    return yes(T.age_on(birth, event) >= least)


def event_order(a: Column, b: Column) -> Column:
    return yes(a < b)


def sum_limit(amounts: Column, labels: Column, limit: Column) -> tuple[Column, Column]:
    """over the limit (equal is not over), and the label of the first greatest amount."""
    total = F.aggregate(amounts, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x).cast("decimal(38,2)"))
    return yes(total > limit), F.get(labels, (F.array_position(amounts, F.array_max(amounts)) - 1).cast("int"))


def sum_limit_over(amount: Column, item: Column, place: Column, limit: Column) -> list[Column]:
    """sum_limit of a long table, for agg(): over the limit, and the item of the greatest amount, the first by place on ties."""
    total = F.sum(amount.cast("decimal(38,2)"))
    return [yes(total > limit).alias("over_limit"), F.max_by(item, F.struct(amount, -place)).alias("top_item")]


def discounted(price: Column, percent: Column) -> Column:
    """The price less a percentage, half up to cents."""
    return F.round(price.cast("decimal(18,2)") * (100 - percent).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)"), 2).cast("decimal(18,2)")


def discount(price: Column, percent: Column, budget: Column) -> Column:
    return yes(discounted(price, percent) <= budget)


def count_records(records: Column, status: Column, least: Column) -> Column:
    """Records struct(status, value) of a status at or above a value."""
    return F.size(F.filter(records, lambda r: (r["status"] == status) & (r["value"] >= least)))


def count_records_over(status: Column, wanted: Column, value: Column, least: Column) -> Column:
    """count_records of a long table, for agg()."""
    return F.count_if((status == wanted) & (value >= least))


def unit_limit(amount: Column, unit: Column, limit: Column) -> Column:
    """An amount in the small unit against a limit in the big one."""
    factor = F.coalesce(*[F.when(unit == small, F.lit(n)) for small, _, n in UNITS])
    return yes(amount.cast("decimal(18,4)") <= limit.cast("decimal(18,4)") * factor)


def average_pass(scores: Column, mark: Column) -> Column:
    """Mean against the mark, without a quotient."""
    return yes(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) >= mark * F.size(scores))


def average_pass_over(score: Column, mark: Column) -> Column:
    """average_pass of a long table, for agg(): without a quotient."""
    return yes(F.sum(score) >= mark * F.count(score))


def expense_policy(hotel_total: Column, hotel_cap: Column, expensive_cap: Column, expensive: Column, nights: Column, meal_total: Column, meal_cap: Column, receipt_min: Column, big_amount: Column, attached: Column) -> tuple[Column, Column, Column]:
    """hotel, meals and receipt rules; meals count one day more than nights."""
    cap = F.when(expensive, expensive_cap).otherwise(hotel_cap)
    return yes(hotel_total <= cap * nights), yes(meal_total <= meal_cap * (nights + 1)), yes((big_amount <= receipt_min) | attached)


def return_policy(category: Column, opened: Column, on_sale: Column, days: Column, standard: Column, electronics: Column) -> tuple[Column, Column]:
    """outcome and whether the window holds."""
    window = F.when(category == "electronics", electronics).otherwise(standard)
    refused = ((category == "hygiene") & opened) | (days > window)
    return F.when(refused, "not_returnable").when(on_sale, "store_credit").otherwise("full_refund"), yes(days <= window)


def insurance_payout(electronics: Column, sublimit: Column, jewellery: Column, declared: Column, other: Column, deductible: Column, most: Column) -> Column:
    covered = F.least(electronics, sublimit) + F.when(declared, jewellery).otherwise(F.lit(0)) + other - deductible
    return F.least(most, F.greatest(F.lit(0), covered))


def insurance_claim(electronics: Column, sublimit: Column, payout: Column, threshold: Column) -> tuple[Column, Column]:
    """capped and payout over the threshold."""
    return yes(electronics > sublimit), yes(payout > threshold)


def leave_policy(annual: Column, carry_max: Column, unused: Column, taken: Column, start: Column, end: Column, director: Column, b_start: Column, b_end: Column) -> tuple[Column, Column, Column]:
    """enough days, director approval needed, blackout touched."""
    wanted = T.working_days(start, end)
    available = annual + F.least(unused, carry_max) - taken
    return yes(wanted <= available), yes(wanted > director), yes(T.overlaps(start, end, b_start, b_end))


def depot_lookup(orders, customers, cities, order_id: str, customer_id: str, city: str):
    """order -> customer -> city -> depot."""
    return orders.join(customers, customer_id).join(cities, city).select(order_id, "depot")


def same_depot(pairs, depots, a: str, b: str, order_id: str):
    """pairs with whether both orders have one depot."""
    first = depots.select(F.col(order_id).alias(a), F.col("depot").alias("_da"))
    second = depots.select(F.col(order_id).alias(b), F.col("depot").alias("_db"))
    return pairs.join(first, a).join(second, b).select(*pairs.columns, yes(F.col("_da") == F.col("_db")).alias("same"))


def inverted(label: Column) -> Column:
    """The answer when the yes and no criteria change places."""
    return F.when(label == "yes", "no").when(label == "no", "yes").otherwise(label)
