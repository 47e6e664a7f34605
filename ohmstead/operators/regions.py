"""Main region of a plan from its segments, drawn on a coarse grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmstead.operators import grid as gd
from ohmstead.operators import intervals as iv
from ohmstead.operators.entities import segment_box
from ohmstead.session import cut_lineage


def canvas(segs: DataFrame, keys: Sequence[str], long_side: int, short_side: int) -> DataFrame:
    """World box and pixel size per plan."""
    b = segment_box(segs, keys)
    w, h = F.greatest(F.col("x_max") - F.col("x0"), F.lit(1e-9)), F.greatest(F.col("y_max") - F.col("y0"), F.lit(1e-9))
    b = b.withColumn("w", w).withColumn("h", h)
    wide = F.col("w") >= F.col("h")
    other = lambda a, c: F.greatest(F.lit(short_side), F.bround(F.lit(long_side) * a / c).cast("int"))
    return b.withColumn("wp", F.when(wide, F.lit(long_side)).otherwise(other(F.col("w"), F.col("h")))).withColumn(
        "hp", F.when(wide, other(F.col("h"), F.col("w"))).otherwise(F.lit(long_side))).select(*keys, "x0", "y0", "w", "h", "wp", "hp")


def _pixels(x, y):
    px = gd.to_pixel(x, F.col("x0"), F.col("w"), F.col("wp"))
    py = gd.to_pixel(y, F.col("y0"), F.col("h"), F.col("hp"), flip=True)
    return px, py


def drawn(segs: DataFrame, box: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Intervals of the cells along every segment, with the canvas size."""
    x = segs.join(box, list(keys))
    ax, ay = _pixels(F.col("x1"), F.col("y1"))
    bx, by = _pixels(F.col("x2"), F.col("y2"))
    x = x.select(*keys, "wp", "hp", *[c.cast("long").alias(n) for c, n in ((ax, "ax"), (ay, "ay"), (bx, "bx"), (by, "by"))])
    # a line of the canvas holds one stretch of a segment, so a segment gives a row per line and not one per cell
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    x = x.withColumns({"n": F.greatest(F.abs(dx), F.abs(dy)), "d": F.abs(dy), "wide": F.abs(dx) > F.abs(dy), "up": dy < 0})
    parts = max(1, -(-(x.agg(F.sum(F.col("d") + 1)).first()[0] or 0) // iv.TASK_ROWS))
    x = x.repartition(parts, "ax", "ay", "bx", "by").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("d"))).alias("m"))
    # steps i along the longer side with floor(dy * i / n + 0.5) = +-m: halves go up, so they end a line drawn upwards
    low, high, twice = (F.col("m") * 2 - 1) * F.col("n"), (F.col("m") * 2 + 1) * F.col("n"), F.greatest(F.col("d") * 2, F.lit(1))
    first = F.when(F.col("up"), F.floor(low / twice) + 1).otherwise(F.ceil(low / twice))
    last = F.when(F.col("up"), F.floor(high / twice)).otherwise(F.ceil(high / twice) - 1)
    first, last = F.greatest(first, F.lit(0)), F.when(F.col("d") == 0, F.col("n")).otherwise(F.least(last, F.col("n")))
    along = lambda i: F.col("ax") + F.signum(dx).cast("long") * i
    one = F.col("ax") + F.floor(dx * F.col("m") / F.greatest(F.col("n"), F.lit(1)) + 0.5)
    place = lambda pick: F.when(F.col("wide"), pick(along(first), along(last))).otherwise(one).cast("int")
    y = F.col("ay") + F.when(F.col("up"), -F.col("m")).otherwise(F.col("m"))
    return iv.merged(x.select(*keys, "wp", "hp", y.cast("int").alias("y"), place(F.least).alias("s"), place(F.greatest).alias("e")), [*keys, "wp", "hp"], parts)


def stretched(runs: DataFrame, keys: Sequence[str], rx: int, ry: int) -> DataFrame:
    """Rectangular dilation of written intervals on the canvas."""
    return iv.clipped(iv.dilated(runs, [*keys, "wp", "hp"], rx, ry, iv.tasks(runs, 2 * ry + 1)), F.col("wp"), F.col("hp"))


def closed(runs: DataFrame, keys: Sequence[str], r: int) -> DataFrame:
    """Dilation of written intervals followed by erosion, within the canvas."""
    grown = cut_lineage(stretched(runs, keys, r, r))
    return iv.eroded(grown, [*keys, "wp", "hp"], r, F.col("wp"), F.col("hp"), iv.tasks(grown, 2 * r + 1)).select(*keys, "y", "s", "e")


def midpoint_labels(segs: DataFrame, box: DataFrame, comps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Segments whose midpoint lies on a component, with that component."""
    px, py = _pixels(F.col("mx"), F.col("my"))
    at = cut_lineage(segs.join(box, list(keys)).select(*keys, F.struct(*segs.columns).alias("_seg"), px.alias("s"), px.alias("e"), py.alias("y")))
    return iv.meeting(at, comps, keys, ["_seg"], ["comp"]).select("_seg.*", "comp")


def main_region(
    segs: DataFrame, keys: Sequence[str], long_side: int = 2400, short_side: int = 800, link: tuple[int, int] = (30, 4), close: int = 6,
    min_w: int = 120, min_h: int = 70, min_area: int = 2000, min_segments: int = 500,
) -> DataFrame:
    """World box of the best-scored component and its real neighbours, the whole plan when none qualifies."""
    keys = list(keys)
    box = cut_lineage(canvas(segs, keys, long_side, short_side))
    comps = iv.components(closed(cut_lineage(stretched(cut_lineage(drawn(segs, box, keys)), keys, *link)), keys, close), keys)
    seen = midpoint_labels(segs, box, comps, keys).groupBy(*keys, "comp").agg(F.count("*").alias("seg_count"))
    c = iv.boxes(comps, keys).withColumnsRenamed({"x0": "cx", "y0": "cy"}).withColumn("cw", F.col("x1") - F.col("cx") + 1).withColumn("ch", F.col("y1") - F.col("cy") + 1)
    c = c.join(seen, [*keys, "comp"]).join(box.select(*keys, "wp", "hp"), keys)
    c = c.where((F.col("cw") >= min_w) & (F.col("ch") >= min_h) & (F.col("area") >= min_area) & (F.col("seg_count") >= min_segments))
    top = (F.col("cy") <= (F.col("hp") * 0.02).cast("int")).cast("int")
    right = (F.col("cx") + F.col("cw") >= (F.col("wp") * 0.98).cast("int")).cast("int")
    score = (
        F.col("cw") * 12.0 + F.col("cw") / F.col("ch") * 1800.0 + F.sqrt("area") * 10.0 + F.col("seg_count") * 0.08
        - F.col("area") / (F.col("cw") * F.col("ch")) * 1200.0 - top * 2500.0 - right * 1800.0)
    c = cut_lineage(c.withColumn("top", top).withColumn("right", right).withColumn("score", score))
    best = c.groupBy(*keys).agg(F.max_by(F.struct("comp", "cx", "cy", "cw", "ch"), F.struct("score", -F.col("comp"))).alias("b"))
    j = c.join(best, keys)
    shared = lambda p, s: F.greatest(F.lit(0), F.least(F.col(f"b.{p}") + F.col(f"b.{s}"), F.col(p) + F.col(s)) - F.greatest(F.col(f"b.{p}"), F.col(p)))
    gap = lambda p, s: F.greatest(F.lit(0), F.greatest(F.col(f"b.{p}"), F.col(p)) - F.least(F.col(f"b.{p}") + F.col(f"b.{s}"), F.col(p) + F.col(s)))
    beside = (shared("cy", "ch") >= F.least("b.ch", "ch") * 0.20) & (gap("cx", "cw") <= F.col("b.cw") * 0.30)
    above = (shared("cx", "cw") >= F.least("b.cw", "cw") * 0.20) & (gap("cy", "ch") <= F.col("b.ch") * 0.30)
    own = F.col("comp") == F.col("b.comp")
    merged = j.where(own | (~((F.col("top") == 1) & (F.col("right") == 1)) & (beside | above)))
    m = merged.groupBy(*keys).agg(F.min("cx").alias("px"), F.min("cy").alias("py"), F.max(F.col("cx") + F.col("cw")).alias("qx"), F.max(F.col("cy") + F.col("ch")).alias("qy"))
    w, h = F.col("qx") - F.col("px"), F.col("qy") - F.col("py")
    mx, my = F.bround(w * 0.05).cast("int"), F.bround(h * 0.08).cast("int")
    r = box.join(m, keys, "left")
    bx, by = F.greatest(F.lit(0), F.col("px") - mx), F.greatest(F.lit(0), F.col("py") - my)
    bw, bh = F.least(F.col("wp") - bx, w + mx * 2), F.least(F.col("hp") - by, h + my * 2)
    found = F.col("px").isNotNull()
    side = lambda px, lo, span, size, flip=False: gd.to_world(px, F.col(lo), F.col(span), F.col(size), flip)
    return r.select(
        *keys, found.alias("found"),
        F.when(found, side(bx, "x0", "w", "wp")).otherwise(F.col("x0")).alias("x0"), F.when(found, side(by + bh, "y0", "h", "hp", True)).otherwise(F.col("y0")).alias("y0"),
        F.when(found, side(bx + bw, "x0", "w", "wp")).otherwise(F.col("x0") + F.col("w")).alias("x1"),
        F.when(found, side(by, "y0", "h", "hp", True)).otherwise(F.col("y0") + F.col("h")).alias("y1"))


def crop(segs: DataFrame, region: DataFrame, keys: Sequence[str], least: int = 2000, share: float = 0.03) -> DataFrame:
    """Segments whose midpoint lies in the region, widened once where too few remain."""
    keys = list(keys)
    j = segs.join(region.select(*keys, "x0", "y0", F.col("x1").alias("rx1"), F.col("y1").alias("ry1")), keys)
    w, h = F.col("rx1") - F.col("x0"), F.col("ry1") - F.col("y0")
    within = lambda p: F.col("mx").between(F.col("x0") - w * p, F.col("rx1") + w * p) & F.col("my").between(F.col("y0") - h * p, F.col("ry1") + h * p)
    j = j.withColumn("_in", within(0.0)).withColumn("_near", within(0.15))
    n = j.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if("_in").alias("_k"))
    n = n.select(*keys, (F.col("_k") < F.greatest(F.lit(least), (F.col("_n") * share).cast("int"))).alias("_few"))
    return j.join(n, keys).where(F.col("_in") | (F.col("_few") & F.col("_near"))).select(*segs.columns)


def drop_small(segs: DataFrame, keys: Sequence[str], long_side: int = 1400, short_side: int = 500, close: int = 2, min_area: int = 50, min_w: int = 10, min_h: int = 10) -> DataFrame:
    """Segments on tiny isolated components removed."""
    keys = list(keys)
    box = cut_lineage(canvas(segs, keys, long_side, short_side))
    comps = iv.components(closed(cut_lineage(drawn(segs, box, keys)), keys, close), keys)
    boxes = iv.boxes(comps, keys)
    w, h = F.col("x1") - F.col("x0") + 1, F.col("y1") - F.col("y0") + 1
    kept = boxes.where((F.col("area") >= min_area) & ~((w < min_w) & (h < min_h))).select(*keys, "comp")
    return midpoint_labels(segs, box, comps, keys).join(kept, [*keys, "comp"], "left_semi").select(*segs.columns)
