"""Sets of grid cells as intervals along rows: (keys, y, s, e), both ends included.

A row of cells becomes a few intervals, and the set operations are sweeps over their ends in one ordered
pass per line. Growing a set widens its intervals and counts coverage from the lines around; shrinking it
asks for full coverage. No operation lists the cells of a square.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ohmstead.session import cut_lineage, wide_side

#: Columns of a bucket in which intervals of two lines meet.
BUCKET = 64
#: Lines of a strip whose intervals are first connected in one task; a strip holds at most its share of a picture.
STRIP = 256


#: Rows that one task sorts. Ends repeated over lines are so much alike that the bytes of a shuffle say little about them.
TASK_ROWS = 1 << 21


#: Rows that are worth a task of their own while cores are idle.
LEAST_ROWS = 1 << 16


def tasks_for(df: DataFrame, rows: int | None) -> int:
    """Tasks for so many rows: none gets more than ``TASK_ROWS`` on average, and all cores have work where it pays."""
    rows = rows or 0
    return max(1, -(-rows // TASK_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, rows // LEAST_ROWS))


def tasks(iv: DataFrame, lines: int = 1) -> int:
    """Tasks for the ends of written intervals, each repeated on that many lines."""
    return tasks_for(iv, iv.count() * 2 * lines)


def cell_tasks(iv: DataFrame) -> int:
    """Tasks for the cells of written intervals."""
    return tasks_for(iv, iv.agg(F.sum((F.col("e") - F.col("s") + 1) * 2)).first()[0])


def _dealt(x: DataFrame, keys: Sequence[str], parts: int | None) -> DataFrame:
    """Whole lines dealt to a stated number of tasks, which the sweeps keep."""
    return x if parts is None else x.repartition(parts, *keys, "y")


def of_cells(cells: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Maximal runs of cells along rows; repeated cells count once."""
    w = Window.partitionBy(*keys, "y").orderBy("x")
    x = _dealt(cells.select(*keys, "y", "x"), keys, parts).withColumn("_run", F.col("x") - F.dense_rank().over(w))
    return x.groupBy(*keys, "y", "_run").agg(F.min("x").alias("s"), F.max("x").alias("e")).drop("_run")


def cells_of(iv: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    return iv.select(*keys, *more, F.explode(F.sequence("s", "e")).alias("x"), "y")


def turned(iv: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """The same cells with rows and columns swapped."""
    return of_cells(cells_of(iv, keys).select(*keys, F.col("y").alias("x"), F.col("x").alias("y")), keys, parts)


def _segments(ends: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Between neighbouring ends ``p`` of a line: (s, e) and the running sums of the given columns."""
    w = Window.partitionBy(*keys, "y").orderBy("p")
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    x = ends.select(*keys, "y", F.col("p").alias("s"), (F.lead("p").over(w) - 1).alias("e"), *[F.sum(c).over(upto).alias(c) for c in sums])
    return x.where("e >= s")


def _ends(iv: DataFrame, keys: Sequence[str], y: Column, **weights: Column) -> DataFrame:
    """Both ends of every interval, with weights that its end takes back."""
    at = F.array(*[F.struct(p.alias("p"), *[(w * sign).alias(c) for c, w in weights.items()]) for p, sign in ((F.col("s"), 1), (F.col("e") + 1, -1))])
    return iv.select(*keys, y.alias("y"), F.explode(at).alias("_e")).select(*keys, "y", "_e.*")


def coverage(iv: DataFrame, keys: Sequence[str], ry: int = 0, parts: int | None = None) -> DataFrame:
    """Segments with ``c``, how often the intervals of the lines within ``ry`` cover them.

    For disjoint intervals that is the number of set cells of a column within ``ry`` rows. ``parts`` is the
    number of tasks, for large sets that of ``tasks``.
    """
    x = _ends(iv, keys, F.col("y"), c=F.lit(1))
    if ry:
        x = x.withColumn("y", F.explode(F.sequence(F.col("y") - ry, F.col("y") + ry)))
    return _segments(_dealt(x, keys, parts), keys, ["c"]).where("c > 0")


def fused(iv: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disjoint intervals that touch become one."""
    w = Window.partitionBy(*keys, "y").orderBy("s")
    x = iv.select(*keys, "y", "s", "e", F.coalesce((F.col("s") > F.lag("e").over(w) + 1).cast("int"), F.lit(0)).alias("_new"))
    x = x.withColumn("_run", F.sum("_new").over(w))
    return x.groupBy(*keys, "y", "_run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_run")


def merged(iv: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Maximal intervals of what any interval covers."""
    w = Window.partitionBy(*keys, "y").orderBy("s")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = _dealt(iv.select(*keys, "y", "s", "e"), keys, parts).withColumn("_new", F.coalesce((F.col("s") > before + 1).cast("int"), F.lit(0)))
    x = x.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return x.groupBy(*keys, "y", "_run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_run")


def union(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Cells of any part."""
    x = parts[0].select(*keys, "y", "s", "e")
    for p in parts[1:]:
        x = x.unionByName(p.select(*keys, "y", "s", "e"))
    return fused(coverage(x, keys), keys)


def _both(a: DataFrame, b: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    one, none = F.lit(1), F.lit(0)
    x = _ends(a, keys, F.col("y"), a=one, b=none).unionByName(_ends(b, keys, F.col("y"), a=none, b=one))
    return _segments(_dealt(x, keys, parts), keys, ["a", "b"])


def minus(a: DataFrame, b: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    return fused(_both(a, b, keys, parts).where("a > 0 AND b = 0"), keys)


def common(a: DataFrame, b: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    return fused(_both(a, b, keys, parts).where("a > 0 AND b > 0"), keys)


def clipped(iv: DataFrame, w: Column, h: Column) -> DataFrame:
    """What lies in a picture of ``w`` columns and ``h`` rows."""
    x = iv.where((F.col("y") >= 0) & (F.col("y") < h) & (F.col("e") >= 0) & (F.col("s") < w))
    return x.withColumns({"s": F.greatest(F.col("s"), F.lit(0)), "e": F.least(F.col("e"), w - 1)})


def dilated(iv: DataFrame, keys: Sequence[str], rx: int, ry: int, parts: int | None = None) -> DataFrame:
    """Cells within ``rx`` columns and ``ry`` rows of a set one."""
    wide = iv.withColumns({"s": F.col("s") - rx, "e": F.col("e") + rx}) if rx else iv
    return fused(coverage(wide, keys, ry, parts), keys) if rx or ry else iv.select(*keys, "y", "s", "e")


def eroded(iv: DataFrame, keys: Sequence[str], r: int, w: Column | None = None, h: Column | None = None, parts: int | None = None) -> DataFrame:
    """Cells whose whole square is set; with a picture of ``w`` by ``h``, what lies outside counts as set.

    ``iv`` holds maximal intervals, and ``w`` and ``h`` are literals or among the keys. Along a line an interval
    loses its ends; across lines all that are in the picture must cover a cell.
    """
    if r <= 0:
        return iv.select(*keys, "y", "s", "e")
    first, last, need = F.col("s") + r, F.col("e") - r, F.lit(2 * r + 1)
    if w is not None:
        first, last = F.when(F.col("s") <= 0, F.col("s")).otherwise(first), F.when(F.col("e") >= w - 1, F.col("e")).otherwise(last)
        need = F.least(F.col("y") + r, h - 1) - F.greatest(F.col("y") - r, F.lit(0)) + 1
    short = iv.select(*keys, "y", first.alias("s"), last.alias("e")).where("s <= e")
    held = coverage(short, keys, r, parts)
    return fused((held if h is None else held.where((F.col("y") >= 0) & (F.col("y") < h))).where(F.col("c") == need), keys)


def _bucket(x: Column) -> Column:
    return F.floor(x / BUCKET).cast("long")


def meeting(a: DataFrame, b: DataFrame, keys: Sequence[str], of_a: Sequence[str], of_b: Sequence[str], shift: int = 0, reach: int = 0) -> DataFrame:
    """Columns of pairs of written intervals, ``b`` on the line ``shift`` below, that overlap or lie within ``reach``.

    Intervals meet in buckets of columns; a pair is given in the first bucket it shares. A wide interval is
    in many buckets, so these are counted for the number of tasks.
    """
    left = a.select(*keys, (F.col("y") + shift).alias("y"), (F.col("s") - reach).alias("_s"), (F.col("e") + reach).alias("_e"), *of_a)
    right = b.select(*keys, "y", F.col("s").alias("_t"), F.col("e").alias("_f"), *of_b)
    sides = [(left, F.col("_s"), F.col("_e")), (right, F.col("_t"), F.col("_f"))]
    parts = tasks_for(a, sum(x.agg(F.sum(_bucket(q) - _bucket(p) + 1)).first()[0] or 0 for x, p, q in sides))
    left, right = (x.withColumn("_b", F.explode(F.sequence(_bucket(p), _bucket(q)))).repartition(parts, *keys, "y", "_b") for x, p, q in sides)
    met = left.join(wide_side(right), [*keys, "y", "_b"])
    first = F.greatest("_s", "_t")
    return met.where((F.col("_s") <= F.col("_f")) & (F.col("_t") <= F.col("_e")) & (F.col("_b") == _bucket(first))).select(*keys, "y", *of_a, *of_b)


def sums_over(iv: DataFrame, keys: Sequence[str], ry: int, spans: DataFrame, of: Sequence[str], parts: int | None = None) -> DataFrame:
    """(keys, y, of, n): set cells in columns ``p0`` to ``p1``, exclusive, of the lines within ``ry``, for every span.

    The covered columns before p are the sum of (p - q) over starts q less that over ends, so two running
    sums along the line answer both sides of any span, overlapping ones too.
    """
    of = [c for c in of if c not in (*keys, "y")]
    ends = _ends(iv, keys, F.col("y"), d=F.lit(1))
    if ry:
        ends = ends.withColumn("y", F.explode(F.sequence(F.col("y") - ry, F.col("y") + ry)))
    ends = ends.select(*keys, "y", "p", "d", F.lit(None).cast("int").alias("_side"), *[F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in of])
    sides = F.array(*[F.struct(F.col(c).alias("p"), F.lit(side).alias("_side")) for c, side in (("p0", -1), ("p1", 1))])
    asked = spans.select(*keys, "y", *of, F.explode(sides).alias("_a")).select(*keys, "y", "_a.p", F.lit(0).alias("d"), "_a._side", *of)
    upto = Window.partitionBy(*keys, "y").orderBy("p").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("p") * F.sum("d").over(upto) - F.sum(F.col("d") * F.col("p")).over(upto)
    x = _dealt(ends.unionByName(asked), keys, parts).withColumn("_n", before).where("_side IS NOT NULL")
    return x.groupBy(*keys, "y", *of).agg(F.sum(F.col("_n") * F.col("_side")).alias("n"))


def _strip_roots(schema: T.StructType, reach: int):
    """Smallest connected node of every interval of a strip, by union-find over lines next to each other."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("y", "ascending"), ("s", "ascending")])
        y, s, e, node = (table.column(c).to_pylist() for c in ("y", "s", "e", "node"))
        up = list(range(len(y)))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = i = up[up[i]]
            return i

        # nodes grow with the order, so the smaller place is the smaller node
        edges = [0, *(i for i in range(1, len(y)) if y[i] != y[i - 1]), len(y)]
        for a, b, c in zip(edges, edges[1:], edges[2:]):
            if y[b] != y[a] + 1:
                continue
            i, j = a, b
            while i < b and j < c:
                if s[i] - reach <= e[j] and s[j] <= e[i] + reach:
                    p, q = root(i), root(j)
                    up[max(p, q)] = min(p, q)
                if e[i] <= e[j]:
                    i += 1
                else:
                    j += 1
        found = pa.array([node[root(i)] for i in range(len(y))], pa.int64())
        return table.append_column("comp", found).select(schema.names)

    return run


def contracted(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, node, root): the smallest connected node of every node in ``links`` (keys, u, v).

    Alternating large-star and small-star steps, each a keyed minimum and a keyed join.
    """
    keys = list(keys)
    links = cut_lineage(links.select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while not links.isEmpty():
        both = links.unionByName(links.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(wide_side(low), [*keys, "u"]).where("v > u").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        low2 = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        tied = large.join(wide_side(low2), [*keys, "u"])
        small = tied.where("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select(*keys, "u", F.col("m").alias("v")))
        links = cut_lineage(small.distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return links.select(*keys, F.col("u").alias("node"), F.col("v").alias("root"))


def components(iv: DataFrame, keys: Sequence[str], connectivity: int = 8) -> DataFrame:
    """Written maximal intervals with ``comp``, the smallest node of their component; a node is line and start.

    Intervals of ``STRIP`` lines are connected in one task; only links between strips, met along their
    borders, are contracted by joins.
    """
    keys = list(keys)
    reach = 1 if connectivity == 8 else 0
    node = (F.col("y").cast("long") + (1 << 30)) * F.lit(1 << 32) + F.col("s").cast("long") + (1 << 30)
    own = cut_lineage(iv.select(*keys, *[F.col(c).cast("long").alias(c) for c in ("y", "s", "e")], node.alias("node"), F.floor(F.col("y") / STRIP).cast("long").alias("_strip")))
    parts = tasks(own)
    schema = T.StructType([*[own.schema[c] for c in (*keys, "y", "s", "e")], T.StructField("comp", T.LongType())])
    local = cut_lineage(own.repartition(parts, *keys, "_strip").groupBy(*keys, "_strip").applyInArrow(_strip_roots(schema, reach), schema))
    place = F.pmod("y", F.lit(STRIP))
    border = meeting(local.where(place == STRIP - 1).withColumnRenamed("comp", "u"), local.where(place == 0).withColumnRenamed("comp", "v"), keys, ["u"], ["v"], 1, reach)
    roots = contracted(border, keys)
    if roots.isEmpty():
        return local
    named = local.repartition(parts, *keys, "comp").join(wide_side(roots.withColumnRenamed("node", "comp")), [*keys, "comp"], "left")
    return cut_lineage(named.select(*keys, "y", "s", "e", F.coalesce("root", "comp").alias("comp")))


def of_components(comps: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Written intervals whose component is among the wanted ones."""
    return comps.repartition(tasks(comps), *keys, "comp").join(wide_side(wanted), [*keys, "comp"], "left_semi")


def boxes(comps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area and bounding box of every component, from written intervals."""
    return comps.repartition(tasks(comps), *keys, "comp").groupBy(*keys, "comp").agg(
        F.sum(F.col("e") - F.col("s") + 1).alias("area"), F.min("s").alias("x0"), F.min("y").alias("y0"), F.max("e").alias("x1"), F.max("y").alias("y1"))
