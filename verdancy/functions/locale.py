"""Dates, numbers and money as a locale writes them, and weekday names; expressions over fixed tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# Names of months and weekdays, Monday first, by language.
MONTHS = {
    "en": ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"),
    "tr": ("Ocak", "Şubat", "Mart", "Nisan", "Mayıs", "Haziran", "Temmuz", "Ağustos", "Eylül", "Ekim", "Kasım", "Aralık"),
    "de": ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"),
}
MONTHS["de_AT"] = ("Jänner", *MONTHS["de"][1:])
SHORT_MONTHS = {"en": ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")}
DAYS = {
    "en": ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    "tr": ("Pazartesi", "Salı", "Çarşamba", "Perşembe", "Cuma", "Cumartesi", "Pazar"),
    "de": ("Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"),
}
# The date patterns of a locale, the second being the one that cannot be misread.
DATE_PATTERNS = {
    "en_US": ("MM/dd/yyyy", "MMMM d, y", "MMM d, y", "yyyy-MM-dd", "EEEE, MMMM d, y"),
    "en_GB": ("dd/MM/yyyy", "d MMMM y", "d MMM y", "yyyy-MM-dd", "EEEE d MMMM y"),
    "tr_TR": ("dd.MM.yyyy", "d MMMM y", "d MMMM y EEEE", "dd/MM/yyyy", "yyyy-MM-dd"),
    "de_DE": ("dd.MM.yyyy", "d. MMMM y", "EEEE, d. MMMM y", "d.M.yyyy", "yyyy-MM-dd"),
}
DATE_PATTERNS["de_AT"] = DATE_PATTERNS["de_CH"] = DATE_PATTERNS["de_DE"]
# Thousands sign, decimal sign, and money before or after the number; Austrian money has other thousands than its numbers.
SIGNS = {"en_US": (",", "."), "en_GB": (",", "."), "tr_TR": (".", ","), "de_DE": (".", ","), "de_AT": ("\u00a0", ","), "de_CH": ("’", ".")}
MONEY_SIGNS = {"de_AT": (".", ",")}
MONEY = {"de_AT": "€\u00a0{}", "de_CH": "CHF\u00a0{}", "en_US": "${}", "en_GB": "£{}", "tr_TR": "₺{}", "de_DE": "{} €"}
UNAMBIGUOUS_DAY = 12


def _name(names: tuple[str, ...], place: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), place)


def _parts(day: Column, locale: str) -> dict[str, Column]:
    month, lang = F.month(day) - 1, locale[:2]
    months = MONTHS.get(locale, MONTHS[lang])
    return {
        "yyyy": F.lpad(F.year(day).cast("string"), 4, "0"), "y": F.year(day).cast("string"),
        "MMMM": _name(months, month), "MMM": _name(SHORT_MONTHS.get(lang, months), month), "MM": F.lpad(F.month(day).cast("string"), 2, "0"), "M": F.month(day).cast("string"),
        "dd": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"), "d": F.dayofmonth(day).cast("string"), "EEEE": _name(DAYS[lang], F.weekday(day)),
    }


def date_by(day: Column, pattern: str, locale: str) -> Column:
    """A date by one pattern."""
    parts, out, at = _parts(day, locale), [], 0
    while at < len(pattern):
        run = pattern[at]
        while at + len(run) < len(pattern) and pattern[at + len(run)] == run[0]:
            run += run[0]
        out.append(parts[run] if run in parts else F.lit(run))
        at += len(run)
    return F.concat(*out)


def date_text(day: Column, locale: str, place: Column) -> Column:
    """A date by the place-th pattern of the locale; one with slashes only where the day cannot be a month."""
    patterns = DATE_PATTERNS[locale]
    texts = [F.when(F.dayofmonth(day) <= UNAMBIGUOUS_DAY, date_by(day, patterns[1], locale)).otherwise(date_by(day, p, locale)) if "/" in p else date_by(day, p, locale) for p in patterns]
    return F.get(F.array(*texts), F.pmod(place, F.lit(len(patterns))).cast("int"))


def number_text(value: Column, locale: str, digits: int = 0, signs: tuple[str, str] | None = None) -> Column:
    """A number with the locale's signs."""
    thousands, decimal = signs or SIGNS[locale]
    return F.translate(F.format_number(value, digits), ",.", thousands + decimal)


def money_text(value: Column, locale: str, spelt: bool = False) -> Column:
    """An amount with cents in the locale's currency; Turkish amounts also with TL after them."""
    amount = number_text(value, locale, 2, MONEY_SIGNS.get(locale))
    if spelt and locale == "tr_TR":
        return F.concat(amount, F.lit(" TL"))
    before, after = MONEY[locale].split("{}")
    return F.concat(F.lit(before), amount, F.lit(after))


def weekday_names(lang: str) -> list[tuple[str, str]]:
    """(label, name) from Monday on; labels are ASCII."""
    from unicodedata import normalize

    plain = lambda n: normalize("NFKD", n.replace("ı", "i").replace("ß", "ss")).encode("ascii", "ignore").decode().lower()
    return [(plain(name), name) for name in DAYS[lang]]


def weekday_label(day: Column, lang: str) -> Column:
    return _name(tuple(label for label, _ in weekday_names(lang)), F.weekday(day))


def ascii_label(name: Column) -> Column:
    """A label of ASCII letters, digits and single underscores."""
    return F.btrim(F.regexp_replace(F.btrim(X.fold(name)), " ", "_"), F.lit("_"))


def percent_text(value: Column) -> Column:
    return F.when(value.isNull(), "-").otherwise(F.concat(X.fixed_text(value * 100, 1), F.lit("%")))


def points_text(value: Column) -> Column:
    return F.when(value.isNull(), "-").otherwise(F.concat(X.fixed_text(value * 100, 1), F.lit(" pts")))


def decimal_text(value: Column, digits: int = 3) -> Column:
    return F.when(value.isNull(), "-").otherwise(X.fixed_text(value, digits))
