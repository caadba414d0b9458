"""JSON held as text: values found in chatter, repaired, walked and compared, as Arrow-batched pandas UDFs.

Values are walked over the tokens of the text (strings, numbers, words), not
over a tree: a string that a colon follows is a key, any other is a value.
Text that is not JSON never fails a job: it gives null, or a problem beside it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as ST

STRING = r'"(?:[^"\\]|\\.)*"'
_STRING = re.compile(rf"({STRING})(\s*:)?", re.S)  # with its colon, a key
_TOKEN = re.compile(rf"(?P<key>{STRING}(?=\s*:))|(?P<str>{STRING})|(?P<float>-?\d+(?:\.\d+(?:[eE][+-]?\d+)?|[eE][+-]?\d+))|(?P<int>-?\d+)|(?P<bool>true|false)|(?P<NoneType>null)", re.S)
_SIGNS = re.compile(rf'{STRING}|"(?:[^"\\]|\\.)*\Z|[{{}}\[\]]', re.S)
_CLOSER = {"{": "}", "[": "]"}
_DECODER = json.JSONDecoder()
#: What the parser raises for text that is not JSON, or nested too deeply to be held.
NOT_JSON = (ValueError, RecursionError)

# The mark before a card's reply, and values that name things rather than say them.
CARD_MARK = r"(?im)^\s*#{2,}\s*card\s*(\d+)\s*$"
IDENTIFIER = re.compile(r"^[\w.\-/@:#+]+$")
LEAST_LETTERS = 3

CARDS = ST.ArrayType(ST.StructType([ST.StructField("card", ST.IntegerType()), ST.StructField("row", ST.StringType()), ST.StructField("problem", ST.StringType())]))


def compact(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def map_values(text: str, change: Callable[[str], str]) -> str:
    """JSON text with every string value changed; raises ValueError for what is not JSON."""
    json.loads(text)

    def one(m: re.Match) -> str:
        if m[2]:
            return m[0]
        value = json.loads(m[1]) if "\\" in m[1] else m[1][1:-1]
        new = change(value)
        return m[0] if new == value else json.dumps(new, ensure_ascii=False)

    return _STRING.sub(one, text)


def string_values(text: str) -> list[str]:
    """The string values of JSON text, in order; raises ValueError for what is not JSON."""
    json.loads(text)
    return [json.loads(s) for s, key in _STRING.findall(text) if not key]


def closers(text: str) -> str:
    """The signs that close what is open at the end of JSON text."""
    pending = []
    for sign in _SIGNS.findall(text):
        if sign in _CLOSER:
            pending.append(_CLOSER[sign])
        elif sign in ("}", "]") and pending:
            pending.pop()
    return "".join(reversed(pending))


def first_object(chunk: str) -> dict:
    """The object at the first brace, its brackets closed where they stay open; never an object inside a broken one."""
    start = chunk.find("{")
    if start < 0:
        raise ValueError("no JSON object")
    body = chunk[start:]
    try:
        return _DECODER.raw_decode(body)[0]
    except NOT_JSON:
        body = re.sub(r"\s*(```)?\s*\Z", "", body)
        return json.loads(body + closers(body))


def unnested(row):
    """A row whose writer_dist slipped into its questions, with it moved back out."""
    questions = row.get("questions")
    if "writer_dist" in row or not isinstance(questions, dict):
        return row
    stray = questions.get("writer_dist")
    if not isinstance(stray, dict) or "type" in stray:
        return row
    return row | {"questions": {k: q for k, q in questions.items() if k != "writer_dist"}, "writer_dist": stray}


def cards_of(text: str) -> list[tuple[int, str | None, str | None]]:
    """(card, row, problem) of each block after a card mark, the last of a number."""
    parts = re.split(CARD_MARK, text)
    found = {}
    for number, body in zip(parts[1::2], parts[2::2]):
        try:
            found[int(number)] = (compact(unnested(first_object(body))), None)
        except NOT_JSON as e:
            found[int(number)] = (None, "no JSON object" if "no JSON object" in str(e) else "invalid JSON")
    return [(number, *got) for number, got in found.items()]


@F.pandas_udf(CARDS)
def card_blocks(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [] if t is None else cards_of(t))


def json_in(text: str) -> str | None:
    """The JSON value of a reply as compact text: the whole without fences, else the first bracket that a value begins at."""
    bare = re.sub(r"(?m)^```(?:json)?\s*|\s*```$", "", text.strip())
    try:
        return compact(json.loads(bare))
    except NOT_JSON:
        pass
    for m in re.finditer(r"[{\[]", text):
        try:
            return compact(_DECODER.raw_decode(text, m.start())[0])
        except NOT_JSON:
            continue
    return None


@F.pandas_udf(ST.StringType())
def _json_in(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else json_in(t))


def extract_json(text: Column) -> Column:
    """The JSON value in a reply's chatter as compact text, or null."""
    return _json_in(text)


def says_something(value: str) -> bool:
    """Three letters or more, and not an identifier with a digit or an underscore."""
    named = IDENTIFIER.match(value) and re.search(r"_|\d", value)
    return not named and sum(map(str.isalpha, value)) >= LEAST_LETTERS


def speaks(value: Column) -> Column:
    """says_something as an expression."""
    named = value.rlike("(?U)" + IDENTIFIER.pattern) & value.rlike(r"_|\d")
    return F.coalesce(~named & (F.length(F.regexp_replace(value, r"\P{L}", "")) >= LEAST_LETTERS), F.lit(False))


@F.pandas_udf(ST.ArrayType(ST.StringType()))
def natural_text(text: pd.Series, kind: pd.Series) -> pd.Series:
    """The natural-language strings of a state or of questions: of its string values if kind is json, else of the text itself."""

    def one(t: str | None, k: str) -> list[str]:
        try:
            values = [] if t is None else string_values(t) if k == "json" else [t]
        except NOT_JSON:
            values = [t]
        return [v for v in values if says_something(v)]

    return pd.Series([one(t, k) for t, k in zip(text, kind)])


def shape_of(text: str) -> str:
    """JSON with every value replaced by the name of its type, keys in order."""
    ordered = json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False)
    return _TOKEN.sub(lambda m: m[0] if m.lastgroup == "key" else m.lastgroup, ordered)


def _or_null(change: Callable[[str], str]):
    def one(t: str | None) -> str | None:
        try:
            return None if t is None else change(t)
        except NOT_JSON:
            return None

    return one


@F.pandas_udf(ST.StringType())
def shape(text: pd.Series) -> pd.Series:
    """The structure of a JSON value: keys, list lengths and leaf types; null for what is not JSON."""
    return text.map(_or_null(shape_of))


@F.pandas_udf(ST.StringType())
def pretty_json(text: pd.Series) -> pd.Series:
    """JSON with two-space indentation, non-ASCII kept; null for what is not JSON."""
    return text.map(_or_null(lambda t: json.dumps(json.loads(t), ensure_ascii=False, indent=2)))
