"""Grid cells and their connected components, as joins and aggregates over cell tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ohmstead.operators import intervals as iv

#: Side of the tiles in which squares are counted.
TILE = 256


def square(r: int) -> Column:
    """All offsets of a square of radius ``r``."""
    return F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-r, r + 1) for dy in range(-r, r + 1)])


def box_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bounding box per key."""
    return df.groupBy(*keys).agg(
        F.min("bbox_min_x").alias("x0"), F.min("bbox_min_y").alias("y0"), F.max("bbox_max_x").alias("x1"), F.max("bbox_max_y").alias("y1"))


def entity_cells(entities: DataFrame, keys: Sequence[str], grid: int, dilate: int) -> DataFrame:
    """Cells each entity touches on the plan's grid; the centre stands for an entity without points."""
    b = box_of(entities, keys)
    sx = (grid - 1) / F.greatest(F.col("x1") - F.col("x0"), F.lit(1.0))
    sy = (grid - 1) / F.greatest(F.col("y1") - F.col("y0"), F.lit(1.0))
    centre = F.array(F.struct(((F.col("bbox_min_x") + F.col("bbox_max_x")) / 2).alias("x"), ((F.col("bbox_min_y") + F.col("bbox_max_y")) / 2).alias("y")))
    pts = F.when(F.size("points") >= 2, F.col("points")).otherwise(centre)
    x = entities.join(b, list(keys)).select(*keys, "row_id", "x0", "y0", sx.alias("sx"), sy.alias("sy"), F.explode(pts).alias("p"))

    def place(v: Column, lo: str, scale: str) -> Column:
        return F.greatest(F.least(((v - F.col(lo)) * F.col(scale)).cast("int"), F.lit(grid - 1)), F.lit(0))

    cells = x.select(*keys, "row_id", place(F.col("p.x"), "x0", "sx").alias("x"), place(F.col("p.y"), "y0", "sy").alias("y")).distinct()
    return dilated(cells, [*keys, "row_id"], dilate, grid) if dilate else cells


def dilated(cells: DataFrame, keys: Sequence[str], r: int, grid: int | None = None) -> DataFrame:
    """Cells within a square of radius ``r`` around a set one, on a grid of that side."""
    x = iv.dilated(iv.of_cells(cells, keys), keys, max(r, 0), max(r, 0))
    return iv.cells_of(x if grid is None or r <= 0 else iv.clipped(x, F.lit(grid), F.lit(grid)), keys)


def eroded(cells: DataFrame, keys: Sequence[str], r: int, size: DataFrame | None = None) -> DataFrame:
    """Cells whose whole square is set; outside the picture (``size``: w, h) counts as set."""
    x = iv.of_cells(cells, keys)
    if size is None:
        return iv.cells_of(iv.eroded(x, keys, r), keys)
    wide = [*keys, "w", "h"]
    return iv.cells_of(iv.eroded(x.join(size, list(keys)), wide, r, F.col("w"), F.col("h")), keys)


def runs(cells: DataFrame, keys: Sequence[str], axis: str = "h", parts: int | None = None) -> DataFrame:
    """Cells with the start and length of their unbroken run along rows, columns or diagonals."""
    line, step = {
        "h": (F.col("y"), F.col("x")), "v": (F.col("x"), F.col("y")), "d": (F.col("y") - F.col("x"), F.col("x")), "a": (F.col("y") + F.col("x"), F.col("x")),
    }[axis]
    w = Window.partitionBy(*keys, "_line").orderBy("_step")
    x = cells.withColumn("_line", line).withColumn("_step", step)
    x = (x if parts is None else x.repartition(parts, *keys, "_line")).withColumn("_island", F.col("_step") - F.row_number().over(w))
    r = Window.partitionBy(*keys, "_line", "_island")
    return x.withColumn("run_start", F.min("_step").over(r)).withColumn("run_length", F.count("*").over(r)).withColumnRenamed("_line", "run_line").drop("_step", "_island")


def components(cells: DataFrame, keys: Sequence[str], connectivity: int = 8) -> DataFrame:
    """Cells with ``comp``, the smallest node of their component; nodes are unbroken row runs."""
    return iv.cells_of(iv.components(iv.of_cells(cells, keys), keys, connectivity), keys, "comp").select(*keys, "x", "y", "comp")


def component_boxes(comps: DataFrame, keys: Sequence[str]) -> DataFrame:
    return comps.groupBy(*keys, "comp").agg(
        F.count("*").alias("area"), F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


def largest(boxes: DataFrame, keys: Sequence[str], size: str = "area") -> DataFrame:
    """Biggest component per key, the smallest label among equals."""
    best = boxes.groupBy(*keys).agg(F.max_by("comp", F.struct(size, -F.col("comp"))).alias("comp"))
    return best


def box_counts(cells: DataFrame, keys: Sequence[str], r: int, parts: int | None = None) -> DataFrame:
    """Set cells within the square of radius ``r`` around each set cell.

    Cells go to the tile they lie in and to those whose margin of ``r`` they touch, four at most. A tile
    sums its cells along both axes, and four places of that table give the count of a square. ``parts`` is
    the number of tasks.
    """
    side = max(TILE, 4 * r)
    tiles = lambda c: F.sequence(F.floor((F.col(c) - r) / side), F.floor((F.col(c) + r) / side))
    sent = cells.select(*keys, F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.explode(tiles("x")).alias("_tx")).withColumn("_ty", F.explode(tiles("y")))
    schema = T.StructType([*[cells.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in ("x", "y", "n")]])
    n_keys = len(keys)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x0, y0 = (key[n_keys + i].as_py() * side - r for i in (0, 1))
        width = side + 2 * r
        x, y = table.column("x").to_numpy() - x0, table.column("y").to_numpy() - y0
        flat = np.zeros((width, width), bool)
        flat[y, x] = True
        sums = np.zeros((width + 1, width + 1), np.int64)
        np.cumsum(np.cumsum(flat, axis=0, dtype=np.int64), axis=1, out=sums[1:, 1:])
        y, x = np.nonzero(flat[r : r + side, r : r + side])
        d = 2 * r + 1
        n = sums[y + d, x + d] - sums[y, x + d] - sums[y + d, x] + sums[y, x]
        own = [pa.repeat(k, len(n)) for k in key[:n_keys]]
        return pa.Table.from_arrays([*own, pa.array(x + x0 + r), pa.array(y + y0 + r), pa.array(n)], names=schema.names)

    sent = sent if parts is None else sent.repartition(parts, *keys, "_tx", "_ty")
    return sent.groupBy(*keys, "_tx", "_ty").applyInArrow(run, schema)


def to_pixel(v: Column, lo: Column, span: Column, size: Column, flip: bool = False) -> Column:
    """Pixel of a world coordinate; halves round to even, results stay inside."""
    share = (v - lo) / F.greatest(span, F.lit(1e-9))
    share = 1.0 - share if flip else share
    return F.greatest(F.lit(0), F.least(F.bround(share * (size - 1)).cast("int"), (size - 1).cast("int")))


def to_world(px: Column, lo: Column, span: Column, size: Column, flip: bool = False) -> Column:
    share = px / F.greatest(size - 1, F.lit(1))
    return lo + (1.0 - share if flip else share) * span
