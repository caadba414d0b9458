"""Decision requests: options, prompts, and calibrated read-outs of logits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import dist as D

#: Fixed values of the prompt format.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
MAX_OPTIONS = len(SYMBOLS)
UNKNOWN = "unknown"
UNKNOWN_TEXT = {
    "en": "The state does not contain enough information to decide.",
    "tr": "Durum, karar vermek için yeterli bilgiyi içermiyor.",
    "de": "Der Zustand enthält nicht genügend Informationen, um zu entscheiden.",
}
NOUL_YES = "The answer is yes (affirmative, or align with the claim)."
NOUL_NO = "The answer is no (negative, or disagree with the claim)."
MARKER = "<decision>"
SYSTEM_PROMPT = "You are a careful decision assistant. Use the state and decision schema in the user message to make the requested decisions. For every field, choose exactly one answer symbol (e.g. A, B, C, ...) from its listed options and return one valid JSON object mapping each field name to its chosen symbol. Use the field names and symbols exactly as given. Do not include explanations, Markdown, or extra text."
USER_HEAD = "Return one answer for every field using the supplied answer symbols.\n\n## State\n"

OPTION = "struct<value:string,description:string>"

#: A line of a request file: one field with the logits of its options.
REQUEST = ST.StructType(
    [ST.StructField(c, ST.StringType()) for c in ("id", "field", "kind", "lang", "reasoning")]
    + [ST.StructField("pos", ST.IntegerType()), ST.StructField("prompt_tokens", ST.LongType())]
    + [ST.StructField("values", ST.ArrayType(ST.StringType())), ST.StructField("logits", ST.ArrayType(ST.DoubleType()))]
)


def options(kind: Column, criteria: Column, criteria_kind: Column) -> Column:
    """Ordered array<struct<value, description>> of a question's criteria JSON.

    Maps keep their order, lists are numbered, and a yes/no question always
    comes as no, yes with default texts.
    """
    pairs = F.transform(F.map_entries(F.from_json(criteria, "map<string,string>")), lambda e: F.struct(e["key"].alias("value"), F.coalesce(e["value"], F.lit("")).alias("description")))
    listed = F.transform(F.from_json(criteria, "array<string>"), lambda v, i: F.struct(i.cast("string").alias("value"), F.coalesce(v, F.lit("")).alias("description")))
    given = F.when(criteria_kind == "array", listed).when(criteria_kind == "object", pairs)
    side = lambda keys, default: F.coalesce(F.get(F.filter(given, lambda o: F.lower(o["value"]).isin(*keys)), F.lit(0))["description"], F.lit(default))
    noul = F.array(F.struct(F.lit("no").alias("value"), side(("no", "false", "0"), NOUL_NO).alias("description")), F.struct(F.lit("yes").alias("value"), side(("yes", "true", "1"), NOUL_YES).alias("description")))
    return F.when(kind == "noul", noul).otherwise(given)


def with_unknown(kind: Column, opts: Column, abstain: Column, lang: Column) -> Column:
    """Options with the unknown one added to abstaining choice and score questions."""
    text = F.coalesce(F.when(lang == "tr", UNKNOWN_TEXT["tr"]), F.when(lang == "de", UNKNOWN_TEXT["de"]), F.lit(UNKNOWN_TEXT["en"]))
    needed = abstain & kind.isin("choice", "score") & ~F.exists(opts, lambda o: o["value"] == UNKNOWN)
    return F.when(needed, F.array_append(opts, F.struct(F.lit(UNKNOWN).alias("value"), text.alias("description")))).otherwise(opts)


def symbols(opts: Column) -> Column:
    return F.slice(F.split(F.lit(SYMBOLS), ""), 1, F.size(opts))


def field_lines(field: Column, instructions: Column, opts: Column) -> Column:
    """The prompt's block of one question; null beyond 62 options."""
    lines = F.transform(opts, lambda o, i: F.concat(F.lit("    "), F.substr(F.lit(SYMBOLS), i + 1, F.lit(1)), F.lit(" = "), o["value"], F.when(o["description"] != "", F.concat(F.lit(": "), o["description"])).otherwise("")))
    return F.when(F.size(opts) <= len(SYMBOLS), F.concat_ws("\n", F.concat(field, F.lit(": "), F.coalesce(instructions, F.lit(""))), lines))


def compile_prompt(questions: DataFrame, row_id: str, state: str) -> DataFrame:
    """(row_id, user, skeleton, problem) from rows (row_id, state JSON, pos, field, instructions, opts).

    A request that holds the marker or has a question of over 62 options has a problem, and no prompt.
    """
    each = questions.select(row_id, state, "pos", "field", field_lines(F.col("field"), F.col("instructions"), F.col("opts")).alias("_l"))
    grouped = each.groupBy(row_id).agg(F.first(state).alias("_s"), F.array_sort(F.collect_list(F.struct("pos", "_l", "field"))).alias("_q"))
    user = F.concat(F.lit(USER_HEAD), F.col("_s"), F.lit("\n## Decision schema\n"), F.array_join(F.transform("_q", lambda q: q["_l"]), "\n"))
    skeleton = F.concat(F.lit("{\n"), F.array_join(F.transform("_q", lambda q: F.concat(F.lit('    "'), q["field"], F.lit(f'": "{MARKER}"'))), ",\n"), F.lit("\n}"))
    problem = F.when(F.exists("_q", lambda q: q["_l"].isNull()), "too many options").when(user.contains(MARKER), "reserved marker in text")
    made = grouped.select(row_id, user.alias("_user"), skeleton.alias("_skeleton"), problem.alias("problem"))
    return made.select(row_id, *[F.when(F.col("problem").isNull(), F.col(f"_{c}")).alias(c) for c in ("user", "skeleton")], "problem")


def render(user: Column, skeleton: Column, reasoning: Column | None = None) -> Column:
    """The chat text with a closed thinking block."""
    trace = F.trim(reasoning) if reasoning is not None else F.lit("")
    return F.concat(F.lit(f"<|im_start|>system\n{SYSTEM_PROMPT}<|im_end|>\n<|im_start|>user\n"), user, F.lit("<|im_end|>\n<|im_start|>assistant\n<think>\n"), trace, F.lit("\n</think>\n\n"), skeleton, F.lit("<|im_end|>\n"))


def with_fallback(df: DataFrame, table: DataFrame, value: str, default=None) -> DataFrame:
    """df(kind, lang) with value from table(key, value): kind:lang, then kind, then default."""
    out = df
    for name, key in (("a", F.concat_ws(":", "kind", "lang")), ("b", F.col("kind")), ("c", F.lit("default"))):
        small = table.select(F.col("key").alias(f"_{name}"), F.col("value").alias(f"_v{name}"))
        out = out.join(small, key == F.col(f"_{name}"), "left").drop(f"_{name}")
    found = F.coalesce("_va", "_vb", "_vc", *([F.lit(default)] if default is not None else []))
    return out.withColumn(value, found).drop("_va", "_vb", "_vc")


def answers(df: DataFrame) -> DataFrame:
    """Read-outs of (kind, values, logits, temperature): probabilities, confidence, choice, score, noul, unknown."""
    scored = df.withColumn("probabilities", D.softmax(F.col("logits"), F.col("temperature")))
    p, v, kind = F.col("probabilities"), F.col("values"), F.col("kind")
    return (
        scored.withColumn("noul", F.when(kind == "noul", F.get(p, (F.array_position(v, "yes") - 1).cast("int"))))
        .withColumn("confidence", F.when(kind != "noul", D.confidence(p)))
        .withColumn("choice", F.when(kind == "choice", D.label_of(p, v)))
        .withColumn("score", F.when(kind == "score", D.expected_level(p, v)))
        .withColumn("unknown", F.when(kind != "noul", F.get(p, (F.nullif(F.array_position(v, UNKNOWN), F.lit(0)) - 1).cast("int"))))
    )


def rescored(first: DataFrame, second: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """First-pass answers, with those of the second pass where the first was uncertain."""
    again = second.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    both = first.join(again, keys, "left")
    use = F.col("uncertain") & F.col(f"_{columns[0]}").isNotNull()
    return both.select(*keys, *[F.when(use, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns], use.alias("rescored"))


def as_option(answer: Column, values: Column) -> Column:
    """The option that a free answer names, case and backticks aside, else the answer."""
    plain = F.trim(F.btrim(F.trim(answer), F.lit("`")))
    return F.coalesce(F.get(F.filter(values, lambda v: F.lower(v) == F.lower(plain)), F.lit(0)), plain)


def predicted(requests: DataFrame, temperatures: DataFrame, thresholds: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """One row a request with its answers and usage, from one row a field.

    requests(id, field, pos, kind, lang, values, logits, reasoning, prompt_tokens): reasoning is off, on or auto.
    temperatures and thresholds(key, value) fall back from kind:lang to kind to default.
    second(id, field, logits, trace_tokens): logits after a reasoning trace; they replace the first ones of every field if
    reasoning is on and of uncertain fields if it is auto.
    """
    rows = with_fallback(requests, temperatures, "temperature", 1.0)
    rows = with_fallback(rows, thresholds, "threshold", D.DEFAULT_AUTO_THRESHOLD)
    first = answers(rows).withColumn("uncertain", D.uncertain(F.col("probabilities"), F.col("kind"), F.col("threshold")))
    redo = (F.col("reasoning") == "on") | ((F.col("reasoning") == "auto") & F.col("uncertain"))
    first = first.withColumn("redo", redo)
    shown = ["probabilities", "noul", "confidence", "choice", "score", "unknown"]
    if second is not None:
        again = first.where("redo").drop("logits", *shown).join(second, ["id", "field"])
        again = answers(again).select("id", "field", "trace_tokens", *[F.col(c).alias(f"_{c}") for c in shown])
        first = first.join(again, ["id", "field"], "left")
        used = F.col("_probabilities").isNotNull()
        first = first.withColumns({c: F.when(used, F.col(f"_{c}")).otherwise(F.col(c)) for c in shown} | {"redo": used})
    else:
        first = first.withColumns({"redo": F.lit(False), "trace_tokens": F.lit(None).cast("long")})
    answer = F.struct("pos", "field", F.col("kind").alias("type"), *shown, "redo")
    listed = F.array_sort(F.collect_list(answer))
    out = first.groupBy("id").agg(
        listed.alias("answers"),
        F.max("prompt_tokens").alias("input_tokens"),
        (F.count("*") + F.coalesce(F.max(F.when(F.col("redo"), F.col("trace_tokens"))), F.lit(0))).alias("output_tokens"),
        F.max("reasoning").alias("reasoning_mode"),
    )
    redone = F.transform(F.filter("answers", lambda a: a["redo"]), lambda a: a["field"])
    return out.withColumn("reasoned_fields", F.when(F.col("reasoning_mode") != "off", redone))


def responses(predictions: DataFrame) -> DataFrame:
    """(id, answers, usage) as a response has them: answers keyed by field, parts that a kind has not left out."""

    def one(a: Column) -> Column:
        return F.struct(a["type"].alias("type"), a["probabilities"].alias("probabilities"), a["confidence"].alias("confidence"), a["choice"].alias("choice"), a["score"].alias("score"), a["noul"].alias("noul"), a["unknown"].alias("unknown"))

    answers_by_field = F.map_from_arrays(F.transform("answers", lambda a: a["field"]), F.transform("answers", one))
    usage = F.struct("input_tokens", "output_tokens").alias("usage")
    return predictions.select("id", answers_by_field.alias("answers"), usage, "reasoning_mode", "reasoned_fields")
