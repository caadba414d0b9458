"""Typed rows: projections of questions and targets, tags, derived rows, texts.

A row has id, lang, source, license, split, tags, state, state_kind and
``questions`` (array of field, type, instructions, options), and, once labelled,
``targets`` (array of field, label, values, dist) and ``teachers`` (array of
teacher, model, field, dist).  Arrays keep the order of the prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist as D
from ..functions import text as X
from .fixsets import base_tags

OPTION = "struct<value:string,description:string>"
QUESTIONS = f"array<struct<field:string,type:string,instructions:string,options:array<{OPTION}>>>"
TARGETS = "array<struct<field:string,label:string,values:array<string>,dist:array<double>>>"
UNKNOWN = "unknown"

#: The lab behind a part of a model's name, first match first.
LABS = (("deepseek", "deepseek"), ("glm", "zhipu"), ("kimi", "moonshot"), ("k3", "moonshot"), ("mistral", "mistral"), ("minimax", "minimax"), ("gemma", "google"), ("qwen", "alibaba"))
SHORT, MEDIUM = 150, 400


def keep_fields(rows: DataFrame, fields: Column) -> DataFrame:
    """Rows with only these fields in questions, targets and teachers, as far as they have them."""
    named = [c for c in ("questions", "targets", "teachers") if c in rows.columns]
    return rows.withColumns({c: F.filter(c, lambda s: F.array_contains(fields, s["field"])) for c in named})


def single_questions(rows: DataFrame) -> DataFrame:
    """One row a question, without targets, teachers and reasoning."""
    plain = rows.drop("targets", "teachers", "reasoning")
    return plain.withColumn("_q", F.explode("questions")).withColumn("questions", F.array("_q")).withColumn("field", F.col("_q.field")).drop("_q")


def derived(rows: DataFrame, fset: str, extra: Column | None = None) -> DataFrame:
    """The base of derived rows: inherited tags with fix:<set>, source fix:<set>+<source>, license kept."""
    tags = F.array_append(base_tags(F.col("tags")), F.lit(f"fix:{fset}"))
    return rows.withColumns({"tags": F.concat(tags, extra) if extra is not None else tags, "source": F.concat(F.lit(f"fix:{fset}+"), "source")})


def finished(rows: DataFrame, fset: str) -> DataFrame:
    """Derived rows with their id (language, set, ten digits of a hash of the content) and their type tag, mixed for several."""
    kinds = F.array_distinct(F.transform("questions", lambda q: q["type"]))
    kind = F.when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).otherwise("mixed")
    tagged = rows.withColumn("tags", F.array_append(F.filter("tags", lambda t: ~t.startswith("type:")), F.concat(F.lit("type:"), kind)))
    content = [F.col("state"), F.to_json("questions"), F.to_json("targets") if "targets" in rows.columns else F.lit(None), F.to_json("tags")]
    return tagged.withColumn("id", X.content_id(F.concat("lang", F.lit(f"-{fset}-")), X.canonical_sha(*content)))


def values_of(question: Column, abstain: Column) -> Column:
    """Option values of a question in prompt order; unknown comes last where the row may abstain."""
    values = F.when(question["type"] == "noul", F.array(F.lit("no"), F.lit("yes"))).otherwise(F.transform(question["options"], lambda o: o["value"]))
    add = abstain & (question["type"] != "noul") & ~F.array_contains(values, UNKNOWN)
    return F.when(add, F.array_append(values, F.lit(UNKNOWN))).otherwise(values)


def field_values(questions: Column, abstain: Column) -> Column:
    """array<struct<field, values>> of a row."""
    return F.transform(questions, lambda q: F.struct(q["field"].alias("field"), values_of(q, abstain).alias("values")))


def display_order(values: Column, row_id: Column, field: Column, teacher: Column) -> Column:
    """The options in a hash order of their own for every row, field and teacher."""
    keyed = F.transform(values, lambda v, i: F.struct(F.md5(F.concat_ws("|", row_id, field, teacher, i.cast("string"))).alias("k"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def teacher_block(row_id: Column, state: Column, questions: Column, teacher: Column) -> Column:
    """The text that asks a teacher about a row: state, then each question with its options in display order."""

    def lines(q: Column) -> Column:
        shown = F.when(q["type"] == "noul", F.array(F.lit("yes"), F.lit("no"))).otherwise(display_order(F.transform(q["options"], lambda o: o["value"]), row_id, q["field"], teacher))
        return F.concat(q["field"], F.lit(" ("), q["type"], F.lit("): "), q["instructions"], F.lit("\n  options: "), F.array_join(shown, ", "))

    return F.concat(F.lit("State: "), state, F.lit("\n"), F.array_join(F.transform(questions, lines), "\n"))


def row_tags(domain: Column, questions: Column, fmt: Column, length: Column, writer: Column) -> Column:
    """domain, type, format, length and writer tags of a generated row; the length is that of its plan."""
    kinds = F.array_distinct(F.transform(questions, lambda q: q["type"]))
    slug = F.btrim(F.regexp_replace(F.lower(F.substring_index(fmt, " with", 1)), "[^a-z]+", "_"), F.lit("_"))
    size = F.when(length < SHORT, "short").when(length < MEDIUM, "medium").otherwise("long")
    kind = F.when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).otherwise("mixed")
    return F.array(*[F.concat(F.lit(f"{n}:"), c) for n, c in (("domain", domain), ("type", kind), ("fmt", slug), ("len", size), ("writer", writer))])


def lab_of(model: Column) -> Column:
    """The lab behind a model's name, empty for an unknown one."""
    out = None
    for part, lab in LABS:
        hit = F.lower(model).contains(part)
        out = F.when(hit, lab) if out is None else out.when(hit, lab)
    return out.otherwise("")


def texts_of(state: Column, questions: Column) -> Column:
    """The state and the instructions of a row, one a line."""
    return F.concat_ws("\n", state, F.array_join(F.transform(questions, lambda q: q["instructions"]), "\n"))


def compact_text(value: Column, kind: Column) -> Column:
    """A text as it is, null as nothing, any other JSON value compact."""
    return F.when(value.isNull(), "").when(kind == "string", value).otherwise(F.to_json(F.try_parse_json(value)))


def clean_writer_dist(values: Column, keys: Column, probabilities: Column) -> Column:
    """A writer's probabilities over the real options, renormalised; null if one is no number or there is no mass."""
    given = D.aligned(keys, F.transform(probabilities, lambda p: F.coalesce(p, F.lit(0.0))), values)
    return F.when(F.exists(given, F.isnan), None).otherwise(F.when(D.total(given) > 0, D.normalize(given)))


def encoded_target(values: Column, keys: Column, probabilities: Column, label: Column) -> Column:
    """A target aligned to the options and renormalised, one-hot for a label alone, null without mass."""
    aligned = D.aligned(keys, probabilities, values)
    hot = F.transform(values, lambda v: F.when(v == label, 1.0).otherwise(0.0))
    chosen = F.when(probabilities.isNull(), hot).otherwise(aligned)
    return F.when(D.total(chosen) > 0, D.normalize(chosen))


def official_gold(kind: Column, values: Column, label: Column) -> Column:
    """A gold label as the official request shape has it: true or false, the level's place, or the option."""
    place = F.array_position(values, label) - 1
    return F.when(kind == "noul", F.when(label == "yes", "true").otherwise("false")).when(kind == "score", place.cast("string")).otherwise(label)


def unknown_votes(answers: DataFrame, keys: list[str], values: str = "values") -> DataFrame:
    """keys on which two teachers or more put their top option on unknown."""
    hit = D.label_of(F.col("dist"), F.col(values)) == UNKNOWN
    return answers.where("dist is not null").groupBy(*keys).agg(F.count_if(hit).alias("votes")).where("votes >= 2")


def enough_blocks(blocks: Column, asked: Column) -> Column:
    """Whether at least half of the asked cards came back with a state and questions."""
    usable = F.size(F.filter(blocks, lambda b: F.get_json_object(b["row"], "$.state").isNotNull() & F.get_json_object(b["row"], "$.questions").startswith("{")))
    return usable >= F.greatest(F.lit(1), F.ceil(asked / 2))


def fits(length: Column, most: int, dist: Column | None = None) -> Column:
    """Whether a row is short enough to train on and, where a target is given, has mass."""
    short = length <= most
    return short & F.coalesce(D.total(dist) > 0, F.lit(False)) if dist is not None else short
