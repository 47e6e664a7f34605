"""Mixing sources to target weights.

Tokens (or words) are summed per source, a repetition rate per source follows from its target, and
each document is emitted floor(rate) times plus one more copy with the remaining fraction as
probability, drawn from a hash of its id and a seed. The hot source costs one row per task: sizes
are summed before the shuffle and the rates come back through a lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.llm import common

WEIGHTS = (5, 2, 1)


def rates(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size).

    Sources by code point, null last, take the weights in turn. Together they get ``share`` times all
    sizes; a target stops at ``most`` times its source's size and the excess goes to the others by
    weight until none is above. That fixed point is min(cap, weight * level): with sources ordered by
    cap / weight, the level is the largest of (total - caps before) / (weights not before).
    A source without words gets target and rate 0. The windows run over one row per source.
    """
    if share > most:
        raise ValueError("the targets cannot reach the share")
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(most)
    ordered = Window.orderBy(cap / F.col("_w"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) * float(share) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    levelled = by_source.withColumn("_w", given).withColumn("_level", level).withColumn("_level", F.max("_level").over(all_rows))
    target = F.least(cap, F.col("_w") * F.greatest("_level", F.lit(0.0)))
    return levelled.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def copies(rate: Column, chance: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(chance < rate - whole, 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix-1",
        weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, carry: bool = True) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies, taken): every document with its number of copies.

    ``row`` holds the document's own columns, whatever their names; without ``carry`` it is left out,
    and the sizes are written once, so that the texts are read once. Null or empty text: size 0. Null
    source: a source of its own. Null id: the text stands for it in the draw. Repeated rows draw alike.
    An empty table gives no rows.
    """
    chance = common.unit_hash(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    sized = docs.select(*[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * carry, F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                        common.word_count(F.col(text)).alias("size"), chance.alias("_chance"))
    if not carry:
        sized = common.stored(sized, "mix-sizes")
    table = common.lookup(common.stored(rates(sized.select("source", "size"), weights, share, most), "mix-rates")).withColumnRenamed("source", "_s")
    joined = sized.join(table, F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", copies(F.col("rate"), F.col("_chance")))
    return joined.select(*["row"] * carry, "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy."""
    mixed = mix(docs, **options).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("row.*")
