"""Secret scans through a trigram inverted index.

Each rule's pattern gives a Boolean query: a list of alternatives, each a set of trigrams that any
match must contain, upper and lower case alike. The index holds postings (trigram, document) for the
trigrams that occur in some query. Intersecting the postings of an alternative gives its candidates,
and only these are searched with the rule's pattern. A rule with an alternative without trigrams
searches every text.

Null text counts as empty; repeated rows have equal results; an empty table gives no rows; other
columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmstead.llm import common, spans
from ohmstead.operators.keyed import sealed


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Least length of this group of a match; shorter ones are dropped, without another try.
    group: int = 0
    least: int = 1


BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]++", 0, 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
]
ADDED = [
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
]
RULES = BASE + ADDED
MOST_ALTERNATIVES = 64


def _runs(node) -> list[list[str]]:
    """Alternatives of a pattern, each a list of literal runs with gaps between them."""
    out: list[list[str]] = [[""]]
    for op, arg in node:
        if op is sre.LITERAL:
            more = [[chr(arg)]]
        elif op is sre.SUBPATTERN:
            more = _runs(arg[-1])
        elif op is sre.ATOMIC_GROUP:
            more = _runs(arg)
        elif op is sre.BRANCH:
            more = [x for branch in arg[1] for x in _runs(branch)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, body = arg
            inner = _runs(body)
            if (least, most) == (0, 1):
                more = [[""], *inner]
            elif least:
                more = [[*x, ""] if most > 1 else x for x in inner]
            else:
                more = [["", ""]]
        elif op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL and chr(c).isalnum() for o, c in arg):
            more = [[chr(c)] for _, c in arg]
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            continue
        else:
            more = [["", ""]]
        joined = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in out for b in more]
        # too many alternatives: a gap is always right, it only asks for less
        out = joined if len(joined) <= MOST_ALTERNATIVES else [[*a, ""] for a in out]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of folded trigrams of which a match contains at least one whole set; None asks for a full scan."""
    found = set()
    for runs in _runs(parser.parse(pattern)):
        grams = frozenset(r[i : i + 3].lower() for r in runs for i in range(len(r) - 2) if r[i : i + 3].isascii())
        if not grams:
            return None
        found.add(grams)
    # a set that contains another one adds nothing
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


def postings(texts: DataFrame, grams: Sequence[str]) -> DataFrame:
    """The inverted index (gram, key) of the texts (key, text), by place in ``grams``, written in order of gram."""
    low = texts.select("key", F.lower("text").alias("low"))
    here = F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("key", F.explode(here).alias("gram")).distinct()


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]], grams: Sequence[str]) -> DataFrame:
    """(key, kinds): postings intersected per alternative. A key has at most one posting per gram."""
    place = {g: i for i, g in enumerate(grams)}
    # a bit per gram, in words of 62 bits: a set of grams is intersected by comparing words
    words = range((len(grams) + 61) // 62)
    bit = lambda w: F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("gram") % 62)).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
    held = index.groupBy("key").agg(*[bit(w) for w in words])

    def meets(alternative: frozenset[str]) -> Column:
        masks = [sum(1 << (place[g] % 62) for g in alternative if place[g] // 62 == w) for w in words]
        out = F.lit(True)
        for w, m in zip(words, masks, strict=True):
            if m:
                out = out & (F.col(f"w{w}").bitwiseAND(F.lit(m)) == F.lit(m))
        return out

    def any_of(alternatives: list[frozenset[str]]) -> Column:
        out = F.lit(False)
        for a in alternatives:
            out = out | meets(a)
        return out

    kinds = F.array_compact(F.array(*[F.when(any_of(q), F.lit(kind)) for kind, q in queries.items()]))
    return held.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def scan(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = tuple(RULES), columns: Sequence[str] | None = None) -> DataFrame:
    """(row, one span array per kind): ``row`` holds the chosen columns of the document.

    A document's key is a hash of its text. Should two texts share one, both are searched, so the
    result does not depend on the hash.
    """
    columns = docs.columns if columns is None else columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {k: q for k, q in queries.items() if q}
    grams = sorted({g for q in asked.values() for a in q for g in a})
    index = common.stored(postings(whole, grams), "postings")
    chosen = common.lookup(common.stored(candidates(index, asked, grams), "candidates"), most_rows=100_000)
    joined = whole.join(chosen, "key", "left")

    def hits(r: Rule) -> Column:
        hint = None if queries[r.kind] is None else F.coalesce(F.array_contains("kinds", r.kind), F.lit(False))
        all_hits = spans.found(F.col("text"), r.pattern, r.kind, hint)
        if r.least <= 1:
            return all_hits
        return F.filter(all_hits, lambda s: F.length(F.regexp_extract(s["value"], f"^(?:{r.pattern})$", r.group)) >= r.least)

    return sealed(joined.select("row", *[hits(r).alias(r.kind) for r in rules]))

