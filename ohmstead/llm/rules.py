"""Quality rules with verdicts by host.

Each document is measured once. Hard rules fail a document by itself. Soft rules are only hints: their
failures are summed per host, the host's rate is shrunk towards all hosts by a beta prior fitted to
the rates by moments, and a document that breaks a soft rule is rejected when its host's shrunk rate
is above ``bad_rate``. A document without any failure is kept, whatever its host.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ohmstead.llm import common

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Odd 64-bit multipliers that tell the places in a window apart.
_PLACES = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(64)], np.uint64)


def repeated_words(words: Sequence[bytes], width: int = 8) -> int:
    """Words inside a window of ``width`` words that occurs twice or more, first occurrences included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.uint64, len(words))
    ids = (ids + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    ids ^= ids >> np.uint64(32)
    window = np.zeros(n, np.uint64)
    for i in range(width):
        window += ids[i : i + n] * _PLACES[i]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measured(text: str | None, width: int = 8) -> tuple[int, int, int, int, int]:
    """The ``MEASURES`` of a whole text; a null text counts as empty."""
    text = text or ""
    words = common.split_words(text)
    lines = [x for x in text.split("\n") if x.strip(common.BLANKS)]
    return len(words), len(text) - sum(map(text.count, common.BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words, width)


def measure(docs: DataFrame, text: str = "text", width: int = 8) -> DataFrame:
    """``docs`` with the measures as a struct ``_m``."""
    struct = pa.struct([(c, pa.int64()) for c in MEASURES])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [dict(zip(MEASURES, measured(x, width), strict=True)) for x in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, struct)], [*b.schema.names, "_m"])

    found = T.StructType([T.StructField(c, T.LongType()) for c in MEASURES])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_m", found)]))


def hard(n_words: Column, n_repeat_words: Column, least_words: int = 20, repeat_pct: int = 30) -> Column:
    return (n_words < least_words) | (n_repeat_words * 100 > n_words * repeat_pct)


def soft(m: Column, symbol_pct: int = 10, dup_lines: int = 3, dup_word_pct: int = 30) -> Column:
    """Many symbols, several repeated lines, or words of an odd mean length."""
    n = m["n_words"]
    return (m["n_symbols"] * 100 > n * symbol_pct) | ((m["n_dup_lines"] >= dup_lines) & (m["n_repeat_words"] * 100 > n * (dup_word_pct // 3))) | (m["word_chars"] > n * 14) | (m["word_chars"] < n * 2)


def host_verdicts(judged: DataFrame, bad_rate: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, rate, host_bad) from rows of (host, failed).

    With host rates of mean m and variance v, the prior has strength m(1-m)/v - 1, at least 1; without
    spread between hosts it is the number of documents of a mean host. A null host is one host.
    """
    hosts = common.stored(judged.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")), "host-counts")
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n"), F.avg("n_docs").alias("k"), F.avg(rate * rate).alias("s"), F.avg(rate).alias("m")).first()
    mean = (total["f"] / total["n"]) if total["n"] else 0.0
    spread = max(0.0, total["s"] - total["m"] ** 2) if total["n"] else 0.0
    strength = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else float(total["k"] or 1)
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", shrunk).withColumn("host_bad", F.col("rate") > bad_rate)


def judge(docs: DataFrame, text: str = "text", host: str = "source", bad_rate: float = 0.5, columns: Sequence[str] | None = None) -> DataFrame:
    """(row, the measures, base_failed, kept) for every document; ``row`` holds the chosen columns.

    The measured rows are written once, so a text is read and measured once. Only hosts above
    ``bad_rate`` take part in the join back. Null or empty text has no words and fails; repeated rows are
    judged alike; an empty table gives no rows; other columns may have any names.
    """
    columns = docs.columns if columns is None else columns
    lean = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(host).alias("host"), F.col(text).alias("_text"))
    found = measure(lean, "_text").drop("_text")
    found = common.stored(found.withColumn("base_failed", hard(F.col("_m.n_words"), F.col("_m.n_repeat_words"))), "measured")
    found = found.withColumn("_soft", soft(F.col("_m")) & ~F.col("base_failed"))
    verdicts = host_verdicts(found.select("host", (F.col("base_failed") | F.col("_soft")).alias("failed")), bad_rate)
    bad = common.lookup(common.stored(verdicts.where("host_bad").select(F.col("host").alias("_host"), F.lit(True).alias("_bad")), "bad-hosts"))
    # documents that need no verdict have no key in this join, so a hot host does not gather them
    key = F.when(F.col("_soft"), F.coalesce(F.concat(F.lit("h"), "host"), F.lit("n")))
    joined = found.withColumn("_key", key).join(bad.withColumn("_bkey", F.coalesce(F.concat(F.lit("h"), "_host"), F.lit("n"))), F.col("_key") == F.col("_bkey"), "left")
    kept = ~F.col("base_failed") & ~(F.col("_soft") & F.coalesce("_bad", F.lit(False)))
    return joined.select("row", *[F.col(f"_m.{c}").alias(c) for c in MEASURES], "base_failed", kept.alias("kept"))
