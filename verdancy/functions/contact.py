"""Contact data replaced by plainly fake values, as an Arrow UDF.

A text is held as pieces, open or settled.  Every kind of contact data, in a
fixed order, looks into the open pieces alone and settles what it matches,
changed or not, so no later kind can match inside it or across its border.
A worker holds its batch as Arrow gives it and one text of it at a time: plain
texts without what every kind needs are not sent to it, and it sends back
changed texts only.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from .jsontext import NOT_JSON, map_values

SCRUBBED = ST.StructType([ST.StructField("text", ST.StringType()), ST.StructField("hits", ST.IntegerType()), ST.StructField("problem", ST.StringType())])

# The patterns and safe replacements of contact data.
EMAIL = r"(?<![\w.+-])([\w.+-]+)@((?:[\w-]+\.)+[A-Za-z]{2,})\b"
IBAN = r"\b([A-Z]{2})(\d{2})((?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?)\b"
TURKISH_ID = r"(?i)(t\.?\s?c\.?|kimlik)[^0-9\n]{0,25}(\d{11})\b"
CARD = r"(?<!\d)(?:\d[ \-]?){12,18}\d(?!\d)"
PHONE = (
    r"(?<![\w+.,/])(?:\+\d{1,3}[\s.\-]?\(?\d{1,4}\)?(?:[\s.\-]?\d){5,10}|\(?0\d{2,4}\)?[\s.\-/]\d(?:[\s.\-]?\d){4,8}"
    r"|05\d{9}|01[5-7]\d{7,9}|\(?[2-9]\d{2}\)?[\s.\-]\d{3}[\s.\-]\d{4})(?!\w|[.,/\-]\d)"
)
SAFE_DOMAINS = ("example.com", "example.org", "example.net")
SAFE_ENDINGS = (".example", ".test", ".invalid", ".localhost", ".example.com", ".example.org", ".example.net")
FICTION = {"en": "55501"}  # the five digits before a phone number's last two
OTHER_FICTION = "00000"

_DOUBLED = str.maketrans("0123456789", "0246813579")


def digits_of(text: str) -> str:
    return re.sub(r"\D", "", text)


def luhn(digits: str) -> bool:
    last_first = digits[::-1]
    return sum(map(int, last_first[::2] + last_first[1::2].translate(_DOUBLED))) % 10 == 0


def with_digits(shape: str, digits: str) -> str:
    """The digits, one after the other, in the places of shape's digits."""
    return re.sub(r"\d", "{}", shape.replace("{", "{{").replace("}", "}}")).format(*digits)


def _email(m: re.Match, lang: str) -> str | None:
    host = m[2].lower()
    if host in SAFE_DOMAINS or host.endswith(SAFE_ENDINGS):
        return None
    first_byte = hashlib.sha256(json.dumps(host, ensure_ascii=False).encode()).digest()[0]
    return f"{m[1]}@{SAFE_DOMAINS[first_byte % len(SAFE_DOMAINS)]}"


def _iban(m: re.Match, lang: str) -> str | None:
    return None if m[2] == "00" else f"{m[1]}00{m[3]}"


def _turkish_id(m: re.Match, lang: str) -> str | None:
    fake = f"{m[2][0]}00000000{m[2][-2:]}"
    return None if fake == m[2] else m[0].removesuffix(m[2]) + fake


def _card(m: re.Match, lang: str) -> str | None:
    number = digits_of(m[0])
    if len(number) not in range(13, 20) or not luhn(number):
        return None
    return with_digits(m[0], number[:4].ljust(len(number) - 2, "0") + number[-2:])


def _phone(m: re.Match, lang: str) -> str | None:
    number = digits_of(m[0])
    fiction = FICTION.get(lang, OTHER_FICTION)
    if len(number) < 9 or number[-7:-2] == fiction:
        return None
    return with_digits(m[0], number[:-7] + fiction + number[-2:])


#: In this order; a function gives the replacement, or None for a match that is no contact data or already safe.
KINDS: tuple[tuple[re.Pattern, Callable[[re.Match, str], str | None]], ...] = (
    (re.compile(EMAIL), _email),
    (re.compile(IBAN), _iban),
    (re.compile(TURKISH_ID), _turkish_id),
    (re.compile(CARD), _card),
    (re.compile(PHONE), _phone),
)
#: What a match of each kind holds; it is looked for first, as most texts have none of it.
NEEDED = (re.compile("@"), *[re.compile(r"\d")] * 4)
#: The same for any kind, as the JVM finds it; what it does not know yet may be a digit in Python's newer tables.
NEEDED_BY_ANY = r"[@\p{Nd}\p{Cn}]"
SHORTEST = 6  # characters of the shortest match of any kind, a@b.cc


def scrub_text(text: str, lang: str) -> tuple[str, int]:
    """The text without contact data, and how much was replaced."""
    if len(text) < SHORTEST:
        return text, 0
    pieces, hits = [(text, True)], 0
    for (pattern, safe), needed in zip(KINDS, NEEDED):
        after = []
        for piece, is_open in pieces:
            at = 0
            for m in pattern.finditer(piece) if is_open and needed.search(piece) else ():
                new = safe(m, lang)
                hits += new is not None
                after += [(piece[at : m.start()], True), (m[0] if new is None else new, False)]
                at = m.end()
            after.append((piece[at:], is_open))
        pieces = after
    return "".join(piece for piece, _ in pieces) if hits else text, hits


def scrub_json_text(text: str, lang: str) -> tuple[str, int]:
    """JSON text with every string value scrubbed; keys and layout stay."""
    total = 0

    def one(value: str) -> str:
        nonlocal total
        new, hits = scrub_text(value, lang)
        total += hits
        return new

    return map_values(text, one), total


def _changed(text: pa.Array, lang: pa.Array, scrubbed: Callable[[str, str], tuple[str, int]]) -> pa.Array:
    """(text, hits, problem) of each text, the text null where nothing was replaced."""
    texts, hits, problems = [], [], []
    for t, g in zip(text, lang):
        new, n, problem = None, 0, None
        if t.is_valid:
            old = t.as_py()
            try:
                new, n = scrubbed(old, g.as_py())
            except NOT_JSON:
                new, n, problem = None, None, "invalid JSON"
            if new == old:
                new = None
        texts.append(new)
        hits.append(n)
        problems.append(problem)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(hits, pa.int32()), pa.array(problems, pa.string())], SCRUBBED.names)


@F.arrow_udf(SCRUBBED)
def _scrub(text: pa.Array, lang: pa.Array) -> pa.Array:
    return _changed(text, lang, scrub_text)


@F.arrow_udf(SCRUBBED)
def _scrub_json(text: pa.Array, lang: pa.Array) -> pa.Array:
    return _changed(text, lang, scrub_json_text)


def _whole(found: Column, text: Column) -> Column:
    """found with the unchanged texts put back."""
    kept = F.when(found["problem"].isNull(), F.coalesce(found["text"], text))
    return F.struct(kept.alias("text"), found["hits"].alias("hits"), found["problem"].alias("problem"))


def scrub(text: Column | str, lang: Column | str) -> Column:
    """(text, hits, problem) of plain texts; null stays null."""
    text = F.col(text) if isinstance(text, str) else text
    return _whole(_scrub(F.when(text.rlike(NEEDED_BY_ANY), text), lang), text)


def scrub_json(text: Column | str, lang: Column | str) -> Column:
    """(text, hits, problem) of JSON texts; what is not JSON gives null and a problem."""
    text = F.col(text) if isinstance(text, str) else text
    return _whole(_scrub_json(text, lang), text)
