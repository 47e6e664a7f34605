"""Near-repeat removal over groups of any size.

The greedy choice (lines in order, each kept unless it overlaps one kept before) is the lexicographically
first independent set of the graph whose edges join overlapping lines. Its edges come from a token prefix
index, and it is found in rounds in which every line without an earlier live neighbour is kept at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.functions import text as tx
from ohmstead.operators.keyed import small_side
from ohmstead.session import cut_lineage

#: Lines of a group in the first batch; each further batch ends ``GROWTH`` times as far on.
BATCH = 512
GROWTH = 4


def placed(df: DataFrame, group: str, order: Sequence[str], place: str) -> DataFrame:
    """``df`` with each row's place in its group, from 0; ``order`` must tell the rows of a group apart.

    Places are counted in sorted ranges, and ranges by group, so no group is sorted or numbered by one task.
    """
    ranges = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = cut_lineage(ranges.select("*", F.spark_partition_id().alias("_range"), row.alias("_row")))
    counts = rows.groupBy(group, "_range").agg(F.min("_row").alias("_start"), F.count("*").alias("_count"))
    before = F.coalesce(F.sum("_count").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(group, "_range", (before - F.col("_start")).alias("_shift"))
    return rows.join(small_side(counts), [group, "_range"]).withColumn(place, F.col("_row") + F.col("_shift")).drop("_range", "_row", "_shift")


def _index(nodes: DataFrame, threshold: float) -> DataFrame:
    """(id, group, token, n, lead) per token of a line; ``lead`` marks the prefix of its rarest tokens.

    A line whose tokens are the fewer of two shares at least ceil(threshold n) of them, so one of any
    n - ceil(threshold n) + 1 is in the other line.
    """
    toks = nodes.select("_id", "_g", F.size("_t").alias("_n"), F.explode("_t").alias("_w"))
    often = toks.groupBy("_g", "_w").agg(F.count("*").alias("_df"))
    rarest = F.row_number().over(Window.partitionBy("_id").orderBy("_df", "_w"))
    need = F.ceil(F.col("_n") * threshold - 1e-9)
    return toks.join(often, ["_g", "_w"]).withColumn("_lead", rarest <= F.col("_n") - need + 1).drop("_df")


def _overlaps(index: DataFrame, nodes: DataFrame, left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with a from ``left`` and b from ``right``, both (_id), that overlap."""
    ours, theirs = index.join(left, "_id", "left_semi"), index.join(right, "_id", "left_semi")

    def meeting(small: DataFrame, large: DataFrame, a: str, b: str) -> DataFrame:
        x = small.where("_lead").select("_g", "_w", F.col("_id").alias("_s"), F.col("_n").alias("_sn"))
        y = large.select("_g", "_w", F.col("_id").alias("_l"), F.col("_n").alias("_ln"))
        return x.join(y, ["_g", "_w"]).where("_sn <= _ln AND _s <> _l").select(F.col("_s").alias(a), F.col("_l").alias(b))

    found = meeting(ours, theirs, "a", "b").unionByName(meeting(theirs, ours, "b", "a")).distinct()
    side = lambda c: nodes.select(F.col("_id").alias(c), F.col("_t").alias(f"_t{c}"))
    return found.join(side("a"), "a").join(side("b"), "b").where(tx.overlap(F.col("_ta"), F.col("_tb")) >= threshold).select("a", "b")


def _lost(edges: DataFrame) -> DataFrame | None:
    """Lines (_id) that the greedy choice drops, from all pairs (u, v) of overlapping lines with u before v."""
    gone = None
    while not edges.isEmpty():
        wins = edges.select("u").distinct().join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_anti")
        now = cut_lineage(edges.join(wins, "u", "left_semi").select(F.col("v").alias("_id")).distinct())
        gone = now if gone is None else gone.unionByName(now)
        rest = edges.join(wins, "u", "left_anti")
        for end in ("u", "v"):
            rest = rest.join(now.select(F.col("_id").alias(end)), end, "left_anti")
        edges = cut_lineage(rest.select("u", "v"))
    return gone


def greedy_by_rounds(lines: DataFrame, keys: Sequence[str], order: Sequence[str], line: str, threshold: float, max_keep: int | None = None, batch: int = BATCH) -> DataFrame:
    """(keys, rank, line): greedy distinct lines over whole groups, the first ``max_keep`` of each group if given.

    Equal token sets collapse first; lines without tokens overlap nothing and all stay. A group's lines
    come in growing batches: first what overlaps a line kept before goes, then the rounds decide within
    the batch, so a family of like lines has edges within its first batch only. Rounds grow with the
    longest chain of lines that each depend on the one before, not with the lines kept. Null keys are a
    group of their own, an empty table gives no rows. ``order`` must be unique in a group.
    """
    keys = list(keys)
    x = lines.select(F.struct(*keys).alias("_g"), F.sort_array(tx.tokens(F.coalesce(F.col(line), F.lit("")))).alias("_t"), F.struct(*order).alias("_o"), F.col(line).alias("_line"))
    alone = F.when(F.size("_t") == 0, F.col("_o"))
    uniq = x.groupBy("_g", "_t", alone.alias("_b")).agg(F.min("_o").alias("_o"), F.min_by("_line", "_o").alias("_line")).drop("_b")
    nodes = cut_lineage(placed(uniq, "_g", ["_o"], "_r").withColumn("_id", F.monotonically_increasing_id()))
    index = cut_lineage(_index(nodes, threshold))
    last = nodes.agg(F.max("_r")).first()[0]
    kept, lo, hi = None, 0, batch
    while last is not None and lo <= last:
        live = nodes.where((F.col("_r") >= lo) & (F.col("_r") < hi)).select("_id")
        if kept is not None:
            live = cut_lineage(live.join(_overlaps(index, nodes, live, kept, threshold).select(F.col("a").alias("_id")), "_id", "left_anti"))
        rank = lambda c: nodes.select(F.col("_id").alias(c), F.col("_r").alias(f"_r{c}"))
        pairs = _overlaps(index, nodes, live, live, threshold).join(rank("a"), "a").join(rank("b"), "b")
        first = F.col("_ra") < F.col("_rb")
        edges = pairs.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("v"))
        lost = _lost(cut_lineage(edges.distinct()))
        stay = live if lost is None else cut_lineage(live.join(lost, "_id", "left_anti"))
        kept = stay if kept is None else kept.unionByName(stay)
        lo, hi = hi, hi * GROWTH
    if kept is None:
        return lines.select(*keys, F.lit(0).alias("rank"), line).limit(0)
    ranked = placed(nodes.join(kept, "_id", "left_semi").select("_g", "_o", "_line"), "_g", ["_o"], "_k")
    out = ranked.select(*[F.col(f"_g.{k}").alias(k) for k in keys], (F.col("_k") + 1).cast("int").alias("rank"), F.col("_line").alias(line))
    return out if max_keep is None else out.where(F.col("rank") <= max_keep)
