"""Plans of generated rows: card plans, word lists, offsets from a boundary, trace writers, reports.

Random draws are numbers from an MD5 hash of the row and a salt, so a plan does
not depend on partitions and SQL can follow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import locale as LO
from . import scans as SC
from .dedup import require_shared_dir
from .picks import weighted_choice

#: Weights of the card plan.
KINDS = [("choice", 45), ("noul", 30), ("score", 25)]
QUESTION_COUNTS = [(2, 20), (3, 30), (4, 25), (5, 15), (6, 10)]
LENGTHS = [((40, 150), 50), ((150, 400), 30), ((400, 800), 15), ((800, 1500), 5)]
PHRASINGS = [("direct", 50), ("criteria-heavy", 30), ("structured", 20)]
AMBIGUOUS = 0.2
NPC_SHARE, NPC_DOMAIN = 0.25, "game_npc"
SNAKE = "^[a-z0-9_]{1,40}$"
PRODUCT_GROUPS = ("electronics", "hygiene", "other")


def unit(key: Column, salt: str) -> Column:
    """A number from 0 to below 1 that hangs on key and salt alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(salt), key)), 1, 8), 16, 10).cast("double") / float(1 << 32)


def between(key: Column, salt: str, low: Column | int, high: Column | int) -> Column:
    """A whole number from low to high."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return (low + F.floor(unit(key, salt) * (high - low + 1))).cast("int")


def side(key: Column, salt: str, span: int = 20) -> Column:
    """An offset from a boundary, at or below it half of the time, mostly on it or one off."""
    near = between(key, salt + ":far", 2, span)
    # get() past the end is null, so the far offset is only drawn where it is taken
    low = F.coalesce(F.get(F.array(F.lit(0), F.lit(0), F.lit(-1)), between(key, salt + ":low", 0, 3)), -near)
    high = F.coalesce(F.get(F.array(F.lit(1), F.lit(1)), between(key, salt + ":high", 0, 2)), near)
    return F.when(unit(key, salt) < 0.5, low).otherwise(high)


def day_between(key: Column, salt: str, first: str = "2024-01-01", last: str = "2027-12-31") -> Column:
    days = F.datediff(F.to_date(F.lit(last)), F.to_date(F.lit(first)))
    return F.date_add(F.to_date(F.lit(first)), between(key, salt, F.lit(0), days))


def card_plan(cards: DataFrame, key: str, domains: list[str], formats: list[str]) -> DataFrame:
    """cards(key, place, n_rows) with domain, length, format and questions (type, phrasing, target).

    The first quarter of a plan's places goes to the game domain, the others take turns.
    """
    k = F.col(key).cast("string")
    n_npc = F.ceil(F.col("n_rows") * NPC_SHARE)
    turn = F.get(F.array(*[F.lit(d) for d in domains]), F.pmod(F.col("place") - n_npc, F.lit(len(domains))).cast("int"))
    low_high = weighted_choice(unit(k, "length"), [(f"{a}-{b}", w) for (a, b), w in LENGTHS])
    low, high = F.substring_index(low_high, "-", 1).cast("int"), F.substring_index(low_high, "-", -1).cast("int")
    length = (F.round(between(k, "words", low, high) / 10) * 10).cast("int")
    count = weighted_choice(unit(k, "count"), QUESTION_COUNTS)

    def question(i: Column) -> Column:
        at = F.concat_ws("#", k, i.cast("string"))
        kind = weighted_choice(unit(at, "kind"), KINDS)
        options = F.when(kind == "choice", between(at, "options", 2, 8)).when(kind == "score", between(at, "levels", 2, 10))
        target = F.when(kind == "choice", F.concat(F.lit("position "), between(at, "target", F.lit(1), F.greatest(options, F.lit(1))).cast("string")))
        target = target.when(kind == "score", F.concat(F.lit("level "), between(at, "target", F.lit(0), F.greatest(options - 1, F.lit(0))).cast("string")))
        target = target.otherwise(F.when(unit(at, "target") < 0.5, "answer: yes").otherwise("answer: no"))
        target = F.when(unit(at, "ambiguous") < AMBIGUOUS, "ambiguous").otherwise(target)
        return F.struct(kind.alias("type"), weighted_choice(unit(at, "phrasing"), PHRASINGS).alias("phrasing"), options.alias("n_options"), target.alias("target"))

    npc = F.col("place") < n_npc
    planned = cards.withColumns({"domain": F.when(npc, NPC_DOMAIN).otherwise(turn), "length": length, "n_questions": count})
    fmt = F.when(npc, F.when(unit(k, "format") < 0.85, "JSON record").otherwise("table-like text")).otherwise(F.get(F.array(*[F.lit(f) for f in formats]), between(k, "format", 0, len(formats) - 1)))
    return planned.withColumns({"format": fmt, "questions": F.transform(F.sequence(F.lit(1), F.col("n_questions")), question)})


def word_list_problem(kind: Column, value: Column, least: Column) -> Column:
    """Why a word list (JSON text) has not the declared shape, or null: text, strings, labeled, priced or groups."""
    listed = F.from_json(value, "array<struct<label:string,name:string,price_min:double,price_max:double>>")
    strings = F.from_json(value, "array<string>")
    labels = F.transform(listed, lambda x: x["label"])
    named = (F.size(listed) >= least) & F.forall(listed, lambda x: F.coalesce(x["label"].rlike(SNAKE) & (F.trim(x["name"]) != ""), F.lit(False))) & (F.size(F.array_distinct(labels)) == F.size(labels))
    priced = named & F.forall(listed, lambda x: F.coalesce((x["price_min"] > 0) & (x["price_min"] <= x["price_max"]), F.lit(False)))
    groups = F.from_json(value, "map<string,array<string>>")
    sound = (
        F.when(kind == "text", F.coalesce(F.trim(F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")) != "", F.lit(False)))
        .when(kind == "strings", (F.size(strings) >= least) & F.forall(strings, lambda s: F.coalesce(F.trim(s) != "", F.lit(False))))
        .when(kind == "labeled", named)
        .when(kind == "priced", priced)
        .otherwise(F.coalesce(F.least(*[F.size(F.try_element_at(groups, F.lit(g))) for g in PRODUCT_GROUPS]) >= 2, F.lit(False)))
    )
    return F.when(~F.coalesce(sound, F.lit(False)), F.concat(F.lit("bad "), kind))


def pool_problem(people: Column, orgs: Column, villagers: Column, least: int = 10) -> Column:
    """Why a pool of names is too small or holds a blank one, or null."""
    ok = lambda names: (F.size(F.array_distinct(names)) >= least) & F.forall(names, lambda n: F.trim(n) != "")
    return F.coalesce(*[F.when(~F.coalesce(ok(c), F.lit(False)), f"bad {name}") for name, c in (("people", people), ("orgs", orgs), ("villagers", villagers))])


def usable_snippets(snippets: Column, placeholders: tuple[str, ...], least: int = 12) -> Column:
    """The snippets that hold every placeholder, null if they are too few."""
    good = F.filter(snippets, lambda s: F.coalesce(*[F.when(~s.contains("{" + p + "}"), F.lit(False)) for p in placeholders], F.lit(True)))
    return F.when(F.size(good) >= least, good)


def trace_writer(order: list[tuple[str, str, str]], labs: Column, up: Column) -> Column:
    """The first trace writer (name, lab, provider) whose lab did not label the row and whose provider is up."""
    return F.coalesce(*[F.when(~F.array_contains(labs, lab) & F.array_contains(up, provider), F.lit(name)) for name, lab, provider in order])


def trace_accepted(answers: Column, gold: Column, problems: Column) -> Column:
    """Whether a trace is taken: every field's answer is the gold one, and the trace has no problem."""
    right = F.forall(gold, lambda g: F.exists(answers, lambda a: (a["field"] == g["field"]) & (a["label"] == g["label"])))
    return right & (F.size(problems) == 0)


def first_answered(passes: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """One value a key: that of the first pass that has one."""
    out = None
    for k, part in enumerate(passes):
        some = part.where(F.col(value).isNotNull()).select(*keys, F.lit(k).alias("_pass"), value)
        out = some if out is None else out.unionByName(some)
    return out.groupBy(*keys).agg(F.min_by(value, "_pass").alias(value), F.min("_pass").alias("pass"))


def teacher_requests(rows: DataFrame, teachers: str, size: int) -> DataFrame:
    """One row a teacher and batch: every teacher's rows in order of id, size a request."""
    from pyspark.sql import Window

    each = rows.select("id", F.explode(teachers).alias("teacher"))
    place = F.row_number().over(Window.partitionBy("teacher").orderBy("id")) - 1
    batched = each.withColumn("batch", F.floor(place / size))
    return batched.groupBy("teacher", "batch").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def gold_teachers(rows: DataFrame) -> DataFrame:
    """Public rows with their own targets as the answers of one teacher named gold."""
    teacher = lambda t: F.struct(F.lit("gold").alias("teacher"), F.col("source").alias("model"), t["field"].alias("field"), t["dist"].alias("dist"))
    return rows.withColumn("teachers", F.transform("targets", teacher))


def example_lines(rows: DataFrame, number: Column) -> DataFrame:
    """(id, text): a row as markdown, a table of options for each question with its gold and its probability."""

    def block(q: Column, t: Column) -> Column:
        line = lambda v, i: F.concat(F.lit("| `"), v, F.lit("`"), F.when(v == t["label"], " **←**").otherwise(""), F.lit(" | "), LO.decimal_text(F.get(t["dist"], i)), F.lit(" |"))
        head = F.concat(F.lit("**`"), q["field"], F.lit("`** ("), q["type"], F.lit("): "), q["instructions"])
        return F.concat_ws("\n", head, F.lit(""), F.lit("| option | gold |"), F.lit("|---|---|"), F.array_join(F.transform(t["values"], line), "\n"))

    title = F.concat(F.lit("### Example "), number.cast("string"), F.lit(": `"), F.col("id"), F.lit("`"))
    facts = F.concat(F.lit("source `"), F.col("source"), F.lit("` · license `"), F.col("license"), F.lit("`"))
    tables = F.array_join(F.transform(F.arrays_zip(F.col("questions").alias("q"), F.col("targets").alias("t")), lambda z: block(z["q"], z["t"])), "\n\n")
    return rows.select("id", F.concat_ws("\n", title, F.lit(""), facts, F.lit(""), F.lit("```"), F.col("state"), F.lit("```"), F.lit(""), tables).alias("text"))


def _cells(df: DataFrame, columns: list[str]) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]), " | "), F.lit(" |"))


def table_lines(df: DataFrame, columns: list[str], order: list[Column], title: str | None = None) -> DataFrame:
    """(place, line): a table as markdown, its rows in order; with a title a section of a report, which ends in an empty line.

    Rows are numbered in ranges, so a table of any length is laid out by many tasks.
    """
    head = [] if title is None else [f"## {title}", ""]
    head += [f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}"]
    fixed = [(i, line) for i, line in enumerate(head)] + ([] if title is None else [(1 << 62, "")])
    rows = SC.numbered(df, [], order, "place").select((F.col("place") + len(head)).alias("place"), _cells(df, columns).alias("line"))
    return df.sparkSession.createDataFrame(fixed, "place long, line string").unionByName(rows)


def counted(rows: DataFrame, keys: dict[str, Column]) -> dict[str, DataFrame]:
    """name -> (key, n): rows counted by each key, all in one pass over them (grouping sets)."""
    require_shared_dir(rows)
    named = {f"_g{i}": k.cast("string") for i, k in enumerate(keys.values())}
    flat = rows.select(*[k.alias(c) for c, k in named.items()])
    sets = flat.groupingSets([[c] for c in named], *named).agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"{c}_off") for c in named]).checkpoint()
    return {name: sets.where(F.col(f"{c}_off") == 0).select(F.col(c).alias("key"), "n") for name, c in zip(keys, named)}


def report(title: str, sections: list[tuple[str, DataFrame, list[str], list[Column]]]) -> DataFrame:
    """(section, place, line) of a report with a title and a table for each section (title, rows, columns, order)."""
    out = None
    for i, (name, df, columns, order) in enumerate(sections):
        if out is None:
            out = df.sparkSession.createDataFrame([(0, 0, f"# {title}"), (0, 1, "")], "section int, place long, line string")
        out = out.unionByName(table_lines(df, columns, order, name).withColumn("section", F.lit(i + 1)))
    return out
