"""Personal data: patterns propose spans, checksums confirm them, words near them adjust the score.

Base kinds (email, ip, card, phone) stay whatever their score. Added kinds: ``iban``, confirmed by its
mod-97 checksum, unbroken or in groups with single blanks or hyphens, and ``ssn``, which has no checksum and
counts only with a context word before or after it.
All work is done by built-in expressions on the row that holds the text: no shuffle, no Python.

Null text counts as empty and has no spans; repeated rows have equal results; an empty table gives no
rows; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmstead.llm import spans
from ohmstead.operators.keyed import sealed

BASE = ["email", "ip", "card", "phone"]
ADDED = ["iban", "ssn"]

#: Account number lengths by country, fixed by the IBAN registry; they tell where a number printed in groups ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_GROUPED = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:[\\x20-]?+[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

# Fixed patterns. A match starts at the head of its run or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:(?:{_GROUPED})(?![A-Za-z0-9])|[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}+(?![A-Za-z0-9]))",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Fixed words, before or after a span, that speak for its kind, and the score of a confirmed span without them.
CONTEXT = {
    "email": ("(?i)mail|contact|write", 0.9), "ip": ("(?i)\\bip\\b|address|host|server", 0.6), "card": ("(?i)card|visa|master|pay", 0.8),
    "phone": ("(?i)phone|call|tel|mobile|fax", 0.7), "iban": ("(?i)iban|bank|account|transfer", 0.9), "ssn": ("(?i)ssn|social|security", 0.3),
}
LEAST_SCORE = 0.5
NEAR = 60


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a string of digits, from the right."""
    one = lambda i: F.reverse(digits).substr(i, F.lit(1)).cast("int")
    twice = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 0, twice(one(i))).otherwise(one(i)))
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """The account number checksum: the first four characters go last, letters count from 10, remainder 1."""
    turned = F.concat(value.substr(F.lit(5), F.length(value)), value.substr(1, 4))
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _confirmed(kind: str, s: Column) -> Column:
    value = s["value"]
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(value, r"[\x20-]", ""))
    if kind == "ssn":
        return ~value.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _hint(kind: str, text: Column) -> Column | None:
    mark = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}.get(kind)
    return text.contains(mark) if mark else None


def _scored(kind: str, text: Column) -> Column:
    """Confirmed spans of a kind with a score from 0 to 1."""
    good = F.filter(spans.found(text, PATTERNS[kind], kind, _hint(kind, text)), lambda s: _confirmed(kind, s))
    words, plain = CONTEXT[kind]

    def score(s: Column) -> Column:
        near = F.greatest(s["start"] - NEAR, F.lit(0))
        before = text.substr(near + 1, s["start"] - near)
        after = text.substr(s["end"] + 1, F.lit(NEAR))
        value = F.when(before.rlike(words) | after.rlike(words), F.lit(min(1.0, plain + 0.4))).otherwise(F.lit(plain))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), value.alias("score"))

    scored = F.transform(good, score)
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)


def detect(docs: DataFrame, text: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """(row, text, one span array per kind): ``row`` holds the chosen columns of the document."""
    columns = docs.columns if columns is None else columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return sealed(whole.select("row", "text", *[_scored(k, F.col("text")).alias(k) for k in BASE + ADDED]))


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; null texts stay null.

    The column named by ``length``, if there, follows the new text.
    """
    every = F.concat(*[F.col(k) for k in BASE + ADDED])
    done = sealed(detect(docs, text).select("row", F.when(F.col(f"row.{text}").isNotNull(), spans.masked(F.col("text"), every)).alias("_clean")))
    own = {text: F.col("_clean")}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        own[length] = F.when(F.col("_clean").isNotNull() & F.col(f"row.{length}").isNotNull(), F.length("_clean")).cast(kind)
    return done.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
