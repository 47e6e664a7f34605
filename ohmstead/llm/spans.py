"""Positions of all matches of a pattern, as column expressions.

Spark gives the matches of a pattern and the pieces between them; folding both gives every match's
place in code points. Patterns use possessive repeats where giving back could not help, so a long
run of characters is walked once and deep repeats need no stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def found(text: Column, pattern: str, kind: str, hint: Column | None = None) -> Column:
    """Spans of the leftmost non-overlapping matches, with their text; ``hint`` may rule a text out first."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["h"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["h"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    # the last piece, after the last match, has no match beside it
    both = F.filter(F.arrays_zip(hits.alias("h"), pieces.alias("p")), lambda x: x["h"].isNotNull())
    spans = F.aggregate(both, first, step, lambda acc: acc["out"])
    some = text.rlike(pattern) if hint is None else hint & text.rlike(pattern)
    return F.when(some, spans).otherwise(F.array().cast(SPAN))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then kind as listed."""
    listed = F.array(*[F.lit(k) for k in kinds])
    place = lambda s: F.struct(s["start"].alias("s"), F.array_position(listed, s["kind"]).alias("k"), s["end"].alias("e"), s.alias("span"))
    return F.transform(F.array_sort(F.transform(spans, place)), lambda x: x["span"])


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become the first one's."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.upper(s["kind"]).alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, first, step, whole)).otherwise(text)
