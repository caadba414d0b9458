"""Text columns: keys, counts, hints, redaction, tags and folds."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words and letters of the language hint.
TURKISH_WORDS = (
    "ve", "bir", "bu", "için", "icin", "değil", "degil", "lütfen", "lutfen", "çok", "cok", "ama", "gibi", "ile", "mi", "mı", "mu", "mü", "ben", "biz", "siz", "istiyorum", "gelmedi", "yok", "var",
)
GERMAN_WORDS = ("und", "nicht", "der", "die", "das", "ist", "ich", "sie", "mit", "für", "auf", "bitte", "ein", "eine", "zu", "wir", "kein", "keine", "wurde")
TURKISH_LETTERS = "ğış"
GERMAN_LETTERS = "äß"
CHARS_PER_TOKEN = 3.5


def let(value: Column, body) -> Column:
    """body(value) with value worked out once: inside a lambda, an expression would be worked out for every element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def stripped(text: Column) -> Column:
    """Without the spaces of any kind (category Zs) at both ends; tabs and line ends stay."""
    return F.regexp_replace(text, r"^\p{Zs}+|\p{Zs}+\z", "")


def state_key(state: Column) -> Column:
    """Lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(state), r"(?U)\s+", " "))


def json_state_key(state: Column) -> Column:
    """state_key of a JSON state whose object keys are put in order first."""
    return state_key(F.to_json(F.try_parse_json(state)))


def group_key(tags: Column, row_id: Column) -> Column:
    """The row's group tag, or its id."""
    return F.coalesce(tag(tags, "group"), row_id)


def tag(tags: Column, name: str) -> Column:
    """Value of the first name:value tag; a bare tag of that name gives the empty text."""
    hit = F.get(F.filter(tags, lambda t: (t == name) | t.startswith(f"{name}:")), F.lit(0))
    return F.when(hit == name, "").otherwise(F.substring(hit, len(name) + 2, 1 << 30))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def word_tokens(text: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)[^\W_]+"), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """Distinct runs of n tokens, joined by spaces."""

    def runs(t: Column) -> Column:
        places = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(t, i, n), " ")))

    return let(tokens, runs)


def shingles(text: Column, n: int = 5) -> Column:
    """Distinct character n-grams; a shorter text is one gram."""

    def grams(t: Column) -> Column:
        last = F.greatest(F.lit(1), F.length(t) - n + 1)
        return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(t, i, F.lit(n))))

    return let(text, grams)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / CHARS_PER_TOKEN)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def language_hint(text: Column) -> Column:
    """tr, de or en by special letters (counted twice) and stop words."""
    low = F.lower(text)
    score = lambda letters, stops: 2 * _count(low, f"[{letters}]") + _count(low, rf"(?U)\b({'|'.join(stops)})\b")
    tr, de = score(TURKISH_LETTERS, TURKISH_WORDS), score(GERMAN_LETTERS, GERMAN_WORDS)
    return F.when(tr > de, "tr").when(de > tr, "de").otherwise("en")


def ascii_folded(text: Column, lang: Column) -> Column:
    """Long text of a language that should hold special letters and does not."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    special = lambda marks: F.length(F.regexp_replace(F.lower(text), f"[^{marks}]+", ""))
    return F.when((lang == "tr") & (letters >= 150), special("çğıöşü") < 0.02 * letters).when((lang == "de") & (letters >= 400), special("äöüß") == 0).otherwise(False)


def _plain_letters() -> dict[str, str]:
    """The characters of the basic plane whose compatibility decomposition leaves one ASCII character, and that character."""
    found = {}
    for code in range(0x80, 0x10000):
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            found[chr(code)] = plain
    return found


_PLAIN = _plain_letters()


def ascii_letters(text: Column) -> Column:
    """Letters without their marks; what has no ASCII letter goes. Ligatures and other signs of several letters go too."""
    return F.regexp_replace(F.translate(text, "".join(_PLAIN), "".join(_PLAIN.values())), r"[^\x00-\x7F]", "")


def fold(text: Column) -> Column:
    """ASCII letters and digits in lower case, everything else one space."""
    plain = F.regexp_replace(F.translate(text, "ıİ", "ii"), "ß", "ss")
    return F.regexp_replace(F.lower(ascii_letters(plain)), "[^a-z0-9]+", " ")


#: How a developer writes the letters of a language in identifiers.
IDENT_LETTERS = {
    "de": {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"},
    "tr": {"ç": "c", "ğ": "g", "ı": "i", "ö": "o", "ş": "s", "ü": "u", "Ç": "C", "Ğ": "G", "İ": "I", "Ö": "O", "Ş": "S", "Ü": "U"},
}


def ascii_ident(name: Column, lang: str = "en") -> Column:
    """A field name of ASCII letters, digits and underscores, as a developer of the language writes it."""
    for letter, written in IDENT_LETTERS.get(lang, {}).items():
        name = F.replace(name, F.lit(letter), F.lit(written))
    plain = F.btrim(F.regexp_replace(ascii_letters(name), r"\W+", "_"), F.lit("_"))
    sound = lambda n: F.when(n == "", "field").when(n.rlike("^[A-Za-z_]"), n).otherwise(F.concat(F.lit("q_"), n))
    return let(plain, sound)


def ascii_ident_of(name: Column, lang: Column) -> Column:
    """ascii_ident by a language column."""
    out = ascii_ident(name)
    for code in IDENT_LETTERS:
        out = F.when(lang == code, ascii_ident(name, code)).otherwise(out)
    return out


def digest(key: Column) -> Column:
    """128 bits that stand for a long key in joins and groups."""
    return F.unhex(F.md5(key.cast("string")))


def redacted(text: Column) -> Column:
    """Bearer tokens and secret keys replaced."""
    return F.regexp_replace(F.regexp_replace(text, r"(?i)bearer\s+[A-Za-z0-9._-]+", "[redacted]"), r"\b(sk|hf|key)[-_][A-Za-z0-9_-]{8,}", "[redacted]")


def luhn_ok(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def filled(template: Column, slots: dict[str, Column]) -> Column:
    """A template with each {name} replaced once; braces inside a value stay as they are."""
    if not slots:
        return template
    values = F.create_map(*[x for name, value in slots.items() for x in (F.lit(name), value.cast("string"))])
    names = "|".join(slots)
    # cut before and after every slot: pieces that are a slot take its value
    pieces = F.split(F.regexp_replace(template, r"\{(" + names + r")\}", "\u0001{$1}\u0001"), "\u0001")
    one = lambda piece: F.when(piece.rlike(r"^\{(" + names + r")\}$"), F.coalesce(F.try_element_at(values, F.regexp_extract(piece, r"^\{(.*)\}$", 1)), piece)).otherwise(piece)
    return F.array_join(F.transform(pieces, one), "")


def filled_text(template: str, slots: dict[str, Column]) -> Column:
    """filled for a template that is known when the plan is made: its pieces joined, a null slot left as it is written."""
    pieces = re.split(r"\{(" + "|".join(map(re.escape, slots)) + r")\}", template) if slots else [template]
    one = lambda i, piece: F.lit(piece) if i % 2 == 0 else F.coalesce(slots[piece].cast("string"), F.lit("{" + piece + "}"))
    return F.concat(*[one(i, piece) for i, piece in enumerate(pieces) if piece])


def raw_filled(template: Column, slots: dict[str, Column]) -> Column:
    """A JSON template: a string that is exactly one "{name}" takes the slot's JSON value, then the rest is filled."""
    for name, value in slots.items():
        template = F.replace(template, F.lit('"{' + name + '}"'), value)
    return template


def canonical_sha(*parts: Column) -> Column:
    """SHA-256 over the parts as a compact JSON array of texts."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def content_id(prefix: Column, sha: Column) -> Column:
    return F.concat(prefix, F.substring(sha, 1, 10))


def fixed_text(value: Column, digits: int) -> Column:
    """A double with so many decimals, rounded by its exact binary value, ties to even (as printf does).

    value * 10**digits is worked out as product and exact error of the product
    (the value is split into two halves, whose products with a power of ten
    below 2**26 are exact), so no tie is made or missed by rounding on the way.
    Where value * 10**digits is beyond 2**52, the shortest text is rounded.
    """
    scale = 10.0**digits
    if not 0 <= digits <= 7:
        raise ValueError("0 to 7 decimals")

    def text(x: Column) -> Column:
        size = F.abs(x)
        wide = size * 134217729.0
        high = wide - (wide - size)
        product = size * scale
        error = (high * scale - product) + (size - high) * scale
        below = F.floor(product)
        beyond = (product - below.cast("double")) - 0.5  # exact, as both lie within a unit of each other
        up = (beyond > -error) | ((beyond == -error) & (below % 2 == 1))
        units = below + F.when(up, 1).otherwise(0)
        rest = F.pmod(units, F.lit(int(scale)))
        whole = F.floor((units - rest) / int(scale))
        shown = F.concat(whole.cast("string"), F.lit("."), F.lpad(rest.cast("string"), digits, "0")) if digits else units.cast("string")
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        return F.when(F.isnan(x), "nan").when(size > 1.7976931348623157e308, F.concat(sign, F.lit("inf"))).when(size * scale < 2.0**52, F.concat(sign, shown)).otherwise(F.format_string(f"%.{digits}f", x))

    return let(value.cast("double"), text)


def percent(a: Column, b: Column) -> Column:
    """One digit, or n/a for nothing of nothing."""
    return F.when(b == 0, "n/a").otherwise(F.concat(fixed_text(F.try_divide(100.0 * a, b), 1), F.lit("%")))
