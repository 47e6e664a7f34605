"""Keyed reductions that combine before the shuffle, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.session import cut_lineage


def sealed(df: DataFrame) -> DataFrame:
    """The same rows, one generated row each.

    A later filter or explode on a costly column is then applied to the finished value; without
    the generator Spark would push it down and evaluate the whole column expression again.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def small_side(df: DataFrame, most_bytes: int = 8 << 20) -> DataFrame:
    """A per-key table for a join: written out once, and broadcast only when its bytes are seen to be few.

    Beyond ``most_bytes`` it stays an ordinary side, for Spark to shuffle and to split where skewed.
    """
    done = cut_lineage(df)
    size = done.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16)).first()[0] if done.columns else 0
    return F.broadcast(done) if (size or 0) <= most_bytes else done


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """First (or last) row per key in a stated order, as a partial aggregate rather than a ranking."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_known(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """First non-null value of every column per key."""
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    )


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None, rank: str = "rank") -> DataFrame:
    """Top-n report per key, of all rows when ``n`` is None; the rank filter is also applied before the shuffle by Spark."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(w))
    return ranked if n is None else ranked.where(F.col(rank) <= n)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], side: int = 32) -> DataFrame:
    """Interpolated exact quantiles for few, very large groups, such as one per target.

    Equal values collapse to (value, count) first; a mergeable
    sketch then gives ``side`` squared bins, bin counts locate the wanted ranks, and only the bins
    holding one of them are sorted. No group is ever held whole by a task.
    """
    keys = list(keys)
    bins = side * side
    one = F.lit(1).alias("_one")
    vals = cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c")))
    grid = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = vals.groupBy(*keys, one).agg(
        F.percentile_approx("_v", grid, bins * 20).alias("_cuts"), F.sum("_c").alias("_n")
    )
    # two steps of ``side`` comparisons find the bin: first among every side-th cut, then between two
    fine = F.filter(F.slice("_cuts", F.col("_big") * side + 1, F.lit(side - 1)), lambda c: c < F.col("_v"))
    binned = (
        vals.withColumn("_one", F.lit(1))
        .join(small_side(cuts), [*keys, "_one"])
        .withColumn("_big", F.size(F.filter(F.transform(F.sequence(F.lit(1), F.lit(side - 1)), lambda k: F.get("_cuts", k * side - 1)), lambda c: c < F.col("_v"))))
        .withColumn("_bin", F.col("_big") * side + F.size(fine))
        .select(*keys, "_one", "_bin", "_v", "_c")
    )
    wk = Window.partitionBy(*keys, "_one")
    before = F.coalesce(F.sum("_bc").over(wk.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = (
        binned.groupBy(*keys, "_one", "_bin").agg(F.sum("_c").alias("_bc"))
        .withColumn("_before", before)
        .withColumn("_n", F.sum("_bc").over(wk))
    )

    def rank(p: float, up: bool) -> Column:
        pos = F.lit(p) * (F.col("_n") - 1)
        return (F.ceil(pos) if up else F.floor(pos)).cast("long")

    inside = F.lit(False)
    for p in probs.values():
        for up in (False, True):
            r = rank(p, up)
            inside = inside | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_bc")))
    wanted = counts.where(inside).select(*keys, "_one", "_bin", "_before", "_n")
    wb = Window.partitionBy(*keys, "_one", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        binned.join(small_side(wanted), [*keys, "_one", "_bin"])
        .withColumn("_hi", F.sum("_c").over(wb) + F.col("_before"))
        .withColumn("_lo", F.col("_hi") - F.col("_c"))
    )

    def at(p: float, up: bool) -> Column:
        r = rank(p, up)
        return F.max(F.when((r >= F.col("_lo")) & (r < F.col("_hi")), F.col("_v")))

    out = []
    for name, p in probs.items():
        frac = F.max(F.lit(p) * (F.col("_n") - 1) - rank(p, False))
        lo, hi = at(p, False), at(p, True)
        out.append((lo + (hi - lo) * frac).alias(name))
    return ranked.groupBy(*keys, "_one").agg(*out).drop("_one")
