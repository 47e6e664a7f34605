"""Cleaning of scanned plans as tables of ink cells (image, y, x).

The rules work on the runs of ink along rows (``intervals``); cells come in and go out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmstead.operators import grid as gd
from ohmstead.operators import intervals as iv
from ohmstead.session import cut_lineage, wide_side

K = ("image_id",)


def ink(raw: DataFrame, threshold: int = 245, parts: int | None = None) -> DataFrame:
    """Darkest value per pixel, kept when below the threshold.

    ``parts`` is the number of tasks, for large tables that of ``intervals.tasks``: lines stay whole, so the rows
    are not dealt again for their runs.
    """
    raw = raw if parts is None else raw.repartition(parts, *K, "y")
    return raw.groupBy(*K, "x", "y").agg(F.min("v").alias("v")).where(F.col("v") < threshold).select(*K, "x", "y")


def crop_box(cells: DataFrame, margin: int, size: tuple[int, int]) -> DataFrame:
    """Content box with a margin, inside the picture."""
    w, h = size
    return cells.groupBy(*K).agg(
        F.greatest(F.min("x") - margin, F.lit(0)).alias("x0"), F.greatest(F.min("y") - margin, F.lit(0)).alias("y0"),
        F.least(F.max("x") + margin + 1, F.lit(w)).alias("x1"), F.least(F.max("y") + margin + 1, F.lit(h)).alias("y1"))


def _thick(runs: DataFrame, size: tuple[int, int], erode: int = 2, dilate: int = 3, keep: int = 0) -> DataFrame:
    w, h = F.lit(size[0]), F.lit(size[1])
    grown = erode + dilate + keep
    core = cut_lineage(iv.eroded(runs, K, erode, w, h, iv.tasks(runs, 2 * erode + 1)))
    return iv.clipped(iv.dilated(core, K, grown, grown, iv.tasks(core, 2 * grown + 1)), w, h)


def thick(cells: DataFrame, size: tuple[int, int], erode: int = 2, dilate: int = 3, keep: int = 0) -> DataFrame:
    """Strokes that survive erosion, grown back and a little further."""
    return iv.cells_of(_thick(cut_lineage(iv.of_cells(cells, K)), size, erode, dilate, keep), K)


def _clip(v: Column, r: int, most: int) -> Column:
    return F.least(v + r + 1, F.lit(most)) - F.greatest(v - r, F.lit(0))


def _thin_runs(mask: DataFrame, wall: DataFrame, size: tuple[int, int], min_run: int, strip: int, dense: int, max_strip: float, dense_min: float) -> DataFrame:
    """Long horizontal runs whose strip is thin and whose surroundings are sparse."""
    w, h = size
    run = ["s", "e"]
    long = cut_lineage(iv.minus(mask, wall, K, iv.tasks(mask) + iv.tasks(wall)).where(F.col("e") - F.col("s") + 1 >= min_run))
    own = iv.sums_over(mask, K, strip, long.withColumns({"p0": F.col("s"), "p1": F.col("e") + 1}), run, iv.tasks(mask, 2 * strip + 1))
    thin = own.where(F.col("n") / (_clip(F.col("y"), strip, h) * (F.col("e") - F.col("s") + 1)) <= max_strip)
    around = thin.select(*K, "y", *run, F.greatest(F.col("s") - dense, F.lit(0)).alias("p0"), F.least(F.col("e") + 1 + dense, F.lit(w)).alias("p1"))
    near = iv.sums_over(mask, K, dense, around.withColumn("cols", F.col("p1") - F.col("p0")), [*run, "cols"], iv.tasks(mask, 2 * dense + 1))
    return near.where(F.col("n") / (F.col("cols") * _clip(F.col("y"), dense, h)) < dense_min).select(*K, "y", *run)


def remove_line_runs(mask: DataFrame, size: tuple[int, int], min_run: int = 22, min_ratio: float = 0.010, strip: int = 3, dense: int = 10, max_strip: float = 0.42, dense_min: float = 0.18, tiny: int = 8) -> DataFrame:
    """Long thin lines away from dense zones removed, rows first, then columns, then specks."""
    least = max(min_run, int(max(size) * min_ratio))
    mask = cut_lineage(iv.of_cells(mask, K))
    wall = cut_lineage(_thick(mask, size, 2, 2))
    for turned in (False, True):
        a, b, dims = (*(cut_lineage(iv.turned(x, K, iv.cell_tasks(x))) for x in (mask, wall)), size[::-1]) if turned else (mask, wall, size)
        left = iv.minus(a, _thin_runs(a, b, dims, least, strip, dense, max_strip, dense_min), K, iv.tasks(a) * 2)
        mask = cut_lineage(iv.turned(left, K, iv.cell_tasks(a)) if turned else left)
    return iv.cells_of(_without_small(mask, tiny), K)


def _hairs(runs: DataFrame, min_run: int, support: int, max_mean: float, max_median: float) -> DataFrame:
    """Parts of long runs that have little ink beside them, on the whole and where they are."""
    parts = iv.tasks(runs, 2 * support + 1)
    long = runs.where(F.col("e") - F.col("s") + 1 >= min_run).withColumns({"p0": F.col("s"), "p1": F.col("e") + 1})
    weak = iv.sums_over(runs, K, support, long, ["s", "e"], parts).where(F.col("n") / (F.col("e") - F.col("s") + 1) <= max_mean)
    faint = iv.coverage(runs, K, support, parts).where(F.col("c") <= max_median)
    return cut_lineage(iv.common(weak, faint, K, parts))


def remove_hairlines(mask: DataFrame, size: tuple[int, int], min_run: int = 34, min_ratio: float = 0.018, support: int = 3, max_mean: float = 2.35, max_median: float = 2.0, density: int = 10, dense_min: int = 32) -> DataFrame:
    """Long lines with little ink beside them, both directions judged on the untouched picture."""
    least = max(min_run, int(max(size) * min_ratio))
    args = (least, support, max_mean, max_median)
    runs = cut_lineage(iv.of_cells(mask, K))
    cells, parts = iv.cells_of(runs, K), iv.cell_tasks(runs)
    down = _hairs(cut_lineage(iv.turned(runs, K, parts)), *args)
    hairs = iv.cells_of(_hairs(runs, *args).unionByName(cut_lineage(iv.turned(down, K, iv.cell_tasks(down)))), K)
    lone = gd.box_counts(cells, K, density, parts).where(F.col("n") < dense_min).select(*K, "x", "y")
    cells, hairs, lone = (x.repartition(parts, *K, "x", "y") for x in (cells, hairs, lone))
    gone = hairs.join(wide_side(lone), [*K, "x", "y"], "left_semi")
    return cells.join(wide_side(gone), [*K, "x", "y"], "left_anti")


def _aligned(runs: DataFrame, length: int, min_span: float = 0.18, min_pixels: int = 18, lo: float = 0.18, hi: float = 0.80) -> DataFrame:
    g = runs.groupBy(*K, "y").agg(F.sum(F.col("e") - F.col("s") + 1).alias("n"), (F.max("e") - F.min("s") + 1).alias("span"))
    ok = (F.col("n") >= min_pixels) & (F.col("span") >= int(length * min_span)) & (F.col("n") / F.col("span")).between(lo, hi)
    return g.where(ok)


def aligned_lines(thin: DataFrame, length: int, **limits) -> DataFrame:
    """Rows whose ink is long and evenly sparse."""
    return _aligned(iv.of_cells(thin, K), length, **limits)


def dense_cells(mask: DataFrame, size: tuple[int, int], r: int = 9, threshold: float = 0.30, parts: int | None = None) -> DataFrame:
    """Set cells whose square holds enough ink; the square is clipped by the picture."""
    n = gd.box_counts(mask, K, r, parts)
    area = _clip(F.col("x"), r, size[0]) * _clip(F.col("y"), r, size[1])
    return n.where(F.col("n") / area >= threshold).select(*K, "x", "y")


def remove_aligned(mask: DataFrame, size: tuple[int, int], neighbour: int = 2, band: int = 1, **limits) -> DataFrame:
    """Thin ink on sparse aligned rows and columns removed, thick strokes and dense zones kept."""
    runs = cut_lineage(iv.of_cells(mask, K))
    parts, cells = iv.tasks(runs), iv.cell_tasks(runs)
    wall = cut_lineage(_thick(runs, size, 2, 3))
    thin = cut_lineage(iv.minus(runs, wall, K, parts + iv.tasks(wall)))
    dense = cut_lineage(iv.of_cells(dense_cells(iv.cells_of(runs, K), size, parts=cells), K, cells))
    free = cut_lineage(iv.minus(thin, dense, K, iv.tasks(thin) + iv.tasks(dense)))
    gone = None
    for turned in (False, True):
        t, f, (w, h) = (*(cut_lineage(iv.turned(x, K, cells)) for x in (thin, free)), size[::-1]) if turned else (thin, free, size)
        rows = _aligned(t, w, **limits).select(*K, F.explode(F.sequence(
            F.greatest(F.col("y") - neighbour, F.lit(0)), F.least(F.col("y") + neighbour, F.lit(h - 1)))).alias("y"))
        rows = rows.select(*K, F.explode(F.sequence(F.col("y") - band, F.col("y") + band)).alias("y")).distinct()
        hit = f.repartition(iv.tasks(f), *K, "y").join(wide_side(rows), [*K, "y"], "left_semi")
        hit = iv.turned(hit, K, cells) if turned else hit
        gone = hit if gone is None else gone.unionByName(hit)
    gone = cut_lineage(gone)
    return iv.cells_of(iv.minus(runs, gone, K, parts + iv.tasks(gone)), K)


def _without_small(runs: DataFrame, area_below: int, keep_largest: bool = False, keys: Sequence[str] = K) -> DataFrame:
    comps = iv.components(runs, keys)
    boxes = iv.boxes(comps, keys)
    kept = boxes.where(F.col("area") >= area_below)
    kept = kept.join(wide_side(gd.largest(boxes, keys)), [*keys, "comp"], "left_semi") if keep_largest else kept
    return iv.of_components(comps, kept, keys).select(*keys, "y", "s", "e")


def remove_small(mask: DataFrame, area_below: int, keep_largest: bool = False, keys: Sequence[str] = K) -> DataFrame:
    """Components under a size removed; optionally only the largest one kept."""
    return iv.cells_of(_without_small(iv.of_cells(mask, keys), area_below, keep_largest, keys), keys).select(*keys, "x", "y")


def line_cells(thin: DataFrame, min_run: int = 14, min_diagonal: int = 12, tasks: int | None = None) -> DataFrame:
    """Cells on long runs with one flag per direction."""
    parts = None
    for axis, least in (("h", min_run), ("v", min_run), ("d", min_diagonal), ("a", min_diagonal)):
        x = gd.runs(thin, K, axis, tasks).where(F.col("run_length") >= least).select(*K, "x", "y", F.lit(axis).alias("axis"))
        parts = x if parts is None else parts.unionByName(x)
    parts = parts if tasks is None else parts.repartition(tasks, *K, "y")
    return parts.groupBy(*K, "x", "y").agg(*[F.max((F.col("axis") == a).cast("int")).alias(a) for a in "hvda"])


def remove_meshes(mask: DataFrame, size: tuple[int, int], link: int = 2, min_w: int = 36, min_h: int = 28, min_pixels: int = 220, min_density: float = 0.045, min_axes: int = 2, margin: int = 3) -> DataFrame:
    """Thin ink in boxes of crossing lines removed, thick strokes kept."""
    runs = cut_lineage(iv.of_cells(mask, K))
    wall = cut_lineage(_thick(runs, size, 2, 3, 1))
    thin = cut_lineage(iv.minus(runs, wall, K, iv.tasks(runs) + iv.tasks(wall)))
    cells = iv.cell_tasks(thin)
    line = cut_lineage(line_cells(iv.cells_of(thin, K), tasks=cells))
    lines = cut_lineage(iv.of_cells(line, K, cells))
    linked = iv.clipped(iv.dilated(lines, K, link, link, iv.tasks(lines, 2 * link + 1)), F.lit(size[0]), F.lit(size[1]))
    boxes = iv.boxes(iv.components(linked, K), K).where((F.col("x1") - F.col("x0") + 1 >= min_w) & (F.col("y1") - F.col("y0") + 1 >= min_h))
    # a box reports itself to every row it covers; cells meet boxes on (image, row)
    rows = boxes.select(*K, "comp", "x0", "x1", "y0", "y1", F.explode(F.sequence("y0", "y1")).alias("y"))
    inside = rows.join(wide_side(line.repartition(cells, *K, "y")), [*K, "y"]).where(F.col("x").between(F.col("x0"), F.col("x1")))
    g = inside.groupBy(*K, "comp", "x0", "x1", "y0", "y1").agg(F.count("*").alias("n"), *[F.max(a).alias(a) for a in "hvda"])
    area = (F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)
    mesh = g.where((F.col("n") >= min_pixels) & (F.col("n") / area >= min_density) & (F.col("h") + F.col("v") + F.col("d") + F.col("a") >= min_axes))
    wide = mesh.select(*K, (F.col("x0") - margin).alias("s"), (F.col("x1") + margin).alias("e"), F.explode(F.sequence(F.col("y0") - margin, F.col("y1") + margin)).alias("y"))
    gone = cut_lineage(iv.common(thin, wide, K, iv.tasks(thin) + iv.tasks(wide)))
    return iv.cells_of(iv.minus(runs, gone, K, iv.tasks(runs) + iv.tasks(gone)), K)


def remove_specks(mask: DataFrame, size: tuple[int, int], area_below: int = 45, near: int = 7) -> DataFrame:
    """Small loose components removed unless they come near a thick stroke."""
    runs = cut_lineage(iv.of_cells(mask, K))
    wall = cut_lineage(_thick(runs, size, 2, 3, 1))
    comps = iv.components(iv.minus(runs, wall, K, iv.tasks(runs) + iv.tasks(wall)), K)
    small = iv.boxes(comps, K).where(F.col("area") < area_below).select(*K, "comp")
    reach = cut_lineage(iv.dilated(wall, K, near, near, iv.tasks(wall, 2 * near + 1)))
    safe = iv.meeting(comps, reach, K, ["comp"], []).select(*K, "comp").distinct()
    gone = iv.of_components(comps, small.join(wide_side(safe), [*K, "comp"], "left_anti"), K)
    return iv.cells_of(iv.minus(runs, gone, K, iv.tasks(runs) * 2), K)


def grow_main(mask: DataFrame, size: tuple[int, int], ratio: float = 0.12, passes: int = 4, min_area: int = 8, seed_area: int = 25) -> DataFrame:
    """Largest component and the ones its widened box reaches, box grown pass by pass."""
    comps = iv.components(iv.of_cells(mask, K), K)
    boxes = cut_lineage(iv.boxes(comps, K).where(F.col("area") >= min_area))
    seed = gd.largest(boxes.where(F.col("area") >= seed_area), K)
    kept = boxes.join(wide_side(seed), [*K, "comp"], "left_semi").select(*K, "comp")
    w, h = size
    for _ in range(max(1, passes)):
        main = boxes.join(wide_side(kept), [*K, "comp"], "left_semi").groupBy(*K).agg(
            F.min("x0").alias("mx0"), F.min("y0").alias("my0"), F.max("x1").alias("mx1"), F.max("y1").alias("my1"))
        m = (F.greatest(F.col("mx1") - F.col("mx0"), F.col("my1") - F.col("my0"), F.lit(1)) * ratio).cast("int")
        wide = main.select(*K, F.greatest(F.col("mx0") - m, F.lit(0)).alias("ax0"), F.greatest(F.col("my0") - m, F.lit(0)).alias("ay0"),
                           F.least(F.col("mx1") + m, F.lit(w - 1)).alias("ax1"), F.least(F.col("my1") + m, F.lit(h - 1)).alias("ay1"))
        j = boxes.join(wide, list(K))
        kept = cut_lineage(j.where(~((F.col("x1") < F.col("ax0")) | (F.col("x0") > F.col("ax1")) | (F.col("y1") < F.col("ay0")) | (F.col("y0") > F.col("ay1")))).select(*K, "comp"))
    return iv.cells_of(iv.of_components(comps, kept, K), K)
