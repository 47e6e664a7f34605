"""Rules over drawing entities: classes, filters, noise, selection, segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.functions import text as tx
from ohmstead.operators import grid as gd
from ohmstead.operators.keyed import top_n
from ohmstead.session import cut_lineage
from ohmstead.sources.drawings import closed_ring, edges

POLY = ["LWPOLYLINE", "POLYLINE", "LINE"]
OPEN_TYPES = ["LINE", "LWPOLYLINE", "POLYLINE", "INSERT"]
PHYSICAL = ["wall", "door", "window", "stairs"]
SUPPORTED = ["LINE", "LWPOLYLINE", "POLYLINE", "ARC", "CIRCLE", "ELLIPSE", "SPLINE", "INSERT"]


@dataclass(frozen=True)
class Rules:
    """Keyword lists and limits of the entity rules. Fixed values, all replaceable."""

    keywords: dict[str, list[str]] = field(default_factory=lambda: {
        "wall": ["MUR", "WALL", "CLOISON"], "door": ["PORTE", "DOOR"], "window": ["FENETRE", "WINDOW"], "stairs": ["ESCALIER", "STAIR"],
        "furniture": ["MOBILIER", "MEUBLE"], "annotation": ["COTE", "TEXT", "CARTOUCHE"],
    })
    thresholds: dict[str, float] = field(default_factory=lambda: {"wall": 0.48, "door": 0.45, "window": 0.42, "stairs": 0.45, "furniture": 0.50})
    physical_thresholds: dict[str, float] = field(default_factory=lambda: {"wall": 0.38, "door": 0.32, "window": 0.30, "stairs": 0.38})
    min_wall_length: float = 20.0
    min_feature_length: float = 3.0
    physical_wall_length: float = 10.0
    physical_feature_length: float = 2.0
    drop_types: tuple[str, ...] = ("TEXT", "MTEXT", "DIMENSION", "HATCH")
    drop_words: tuple[str, ...] = ("COTE", "HACH")
    hard_types: tuple[str, ...] = ("TEXT", "MTEXT", "DIMENSION", "HATCH", "TABLE")
    hard_words: tuple[str, ...] = ("COTE", "HACH", "CARTOUCHE")
    keep_layers: tuple[str, ...] = ()
    drop_tokens: tuple[str, ...] = ("SUR", "HACH")
    rescue_words: tuple[str, ...] = ("PORTE", "FENETRE", "ESCALIER", "CLOISON", "MUR")
    rescue_types: tuple[str, ...] = ("LINE", "ARC", "CIRCLE", "LWPOLYLINE", "POLYLINE", "ELLIPSE", "SPLINE", "INSERT")
    small_length: float = 1.0
    small_diag: float = 0.5
    respect_drop: bool = True
    render_undecided: bool = True


DEFAULT = Rules()


def _upper_any(c: Column, words: Sequence[str]) -> Column:
    return tx.any_in(F.upper(F.coalesce(c, F.lit(""))), [w.upper() for w in words])


def _blob() -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("layer", "source_block", "block_name", "entity_type")])


def with_decision(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Review decision of the layer, undecided when it has none."""
    return df.join(decisions.select("layer", "decision"), "layer", "left").withColumn("decision", F.coalesce("decision", F.lit("undecided")))


def _score(parts: Sequence[tuple[Column, float]]) -> Column:
    out = F.lit(0.0)
    for test, points in parts:
        out = out + F.when(test, points).otherwise(0.0)
    return out


def _shape() -> dict[str, Column]:
    w, h = F.abs("bbox_width"), F.abs("bbox_height")
    low, high = F.least(w, h), F.greatest(w, h)
    return {"w": w, "h": h, "low": low, "high": high, "aspect": high / F.when(low == 0, 1.0).otherwise(low), "type": F.upper(F.coalesce("entity_type", F.lit("")))}


def _best(labels: Sequence[str], thresholds: dict[str, float], other: str) -> Column:
    """First label with the highest score, when it reaches its threshold."""
    best = F.greatest(*[F.col(f"{x}_score") for x in labels])
    out = None
    for x in labels:
        label = F.when(best >= thresholds[x], F.lit(x)).otherwise(F.lit(other))
        out = F.when(F.col(f"{x}_score") == best, label) if out is None else out.when(F.col(f"{x}_score") == best, label)
    return out


def classify_features(df: DataFrame, decisions: DataFrame, r: Rules = DEFAULT) -> DataFrame:
    """Scores, class and keep/drop decision of every entity."""
    s, b, k = _shape(), _blob(), r.keywords
    etype, size = s["type"], F.col("length")
    shut = F.coalesce("closed", F.lit(False))
    x = df.withColumns({
        "wall_score": _score([(_upper_any(b, k["wall"]), 0.34), (etype.isin(POLY), 0.18), (shut, 0.12), (size >= r.min_wall_length, 0.22), (F.col("area") > 0, 0.06), ((s["w"] > 0) & (s["h"] > 0), 0.08)]),
        "door_score": _score([(_upper_any(b, k["door"]), 0.48), (etype.isin("ARC", *OPEN_TYPES), 0.15), (size >= r.min_feature_length, 0.12), (F.coalesce("arc_angle", F.lit(0.0)).between(35, 115), 0.22), (s["aspect"].between(1.2, 12), 0.03)]),
        "window_score": _score([(_upper_any(b, k["window"]), 0.45), (etype.isin(OPEN_TYPES), 0.16), (size >= r.min_feature_length, 0.12), (s["aspect"] >= 2.0, 0.17), (shut, 0.05)]),
        "stairs_score": _score([(_upper_any(b, k["stairs"]), 0.55), (etype.isin(OPEN_TYPES), 0.15), (size >= r.min_feature_length, 0.10)]),
        "furniture_score": _score([(_upper_any(b, k["furniture"]), 0.55), (etype.isin("INSERT", "CIRCLE", "LWPOLYLINE", "POLYLINE"), 0.08)]),
        "annotation_score": _score([(_upper_any(b, k["annotation"]), 0.55), (etype.isin(*r.drop_types), 0.45)]),
    })
    cls = F.when(F.col("annotation_score") >= 0.55, "annotation").otherwise(_best(["wall", "door", "window", "stairs", "furniture"], r.thresholds, "other"))
    x = with_decision(x.withColumn("feature_class", cls), decisions)
    keep = F.col("feature_class").isin(PHYSICAL)
    drop = (F.col("feature_class") == "annotation") | _upper_any(F.col("layer"), r.drop_words)
    auto = F.when(F.col("decision") != "undecided", F.col("decision")).when(keep, "keep").when(drop, "drop").when(F.col("feature_class") == "other", "keep").otherwise("undecided")
    scores = [c for c in x.columns if c.endswith("_score")]
    return x.withColumn("decision", auto).withColumns({c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0)) for c in scores})


def classify_physical(df: DataFrame, decisions: DataFrame, r: Rules = DEFAULT) -> DataFrame:
    """Wall, door, window, stairs, detail or noise."""
    s, b, k = _shape(), _blob(), r.keywords
    etype, size = s["type"], F.col("length")
    low = F.when(s["low"] == 0, 1.0).otherwise(s["low"])
    aspect = s["high"] / low
    x = df.withColumns({
        "hard_noise": etype.isin(*r.hard_types) | _upper_any(b, r.hard_words),
        "wall_score": _score([(_upper_any(b, k["wall"]), 0.42), (etype.isin(POLY), 0.16), (size >= r.physical_wall_length, 0.22), ((s["w"] > 0) & (s["h"] > 0), 0.08), (F.coalesce("closed", F.lit(False)), 0.06)]),
        "door_score": _score([(_upper_any(b, k["door"]), 0.48), (etype.isin("ARC", *OPEN_TYPES), 0.12), (F.coalesce("arc_angle", F.lit(0.0)).between(35, 115), 0.25), (size >= r.physical_feature_length, 0.1), (aspect.between(1.2, 18), 0.05)]),
        "window_score": _score([(_upper_any(b, k["window"]), 0.48), (etype.isin(OPEN_TYPES), 0.14), (size >= r.physical_feature_length, 0.1), (aspect >= 2.0, 0.15)]),
        "stairs_score": _score([(_upper_any(b, k["stairs"]), 0.55), (etype.isin(OPEN_TYPES), 0.15), (size >= r.physical_feature_length, 0.1)]),
    })
    cls = F.when(F.col("hard_noise"), "noise").otherwise(_best(PHYSICAL, r.physical_thresholds, "detail"))
    return with_decision(x.withColumn("feature_class", cls), decisions)


# ---- filters -------------------------------------------------------------------------------


def safe_filter(df: DataFrame, decisions: DataFrame, r: Rules = DEFAULT) -> DataFrame:
    """Sure drops and manual decisions only."""
    x = with_decision(df.where(F.size("points") >= 2), decisions)
    drop = F.upper("entity_type").isin(*r.drop_types) | _upper_any(F.col("layer"), r.drop_words) | ((F.col("length") < r.small_length) & (F.col("bbox_diag") < r.small_diag))
    drop = drop | (F.col("decision") == "drop") if r.respect_drop else drop
    return x.where(~drop if r.render_undecided else ~drop & (F.col("decision") == "keep"))


def token_match(layer: Column, token: str) -> Column:
    """Short tokens need a border on both sides, longer ones may stand anywhere."""
    t = token.lower()
    low = F.lower(layer)
    if len(t) > 4:
        return F.contains(low, F.lit(t))
    inside = tx.any_in(low, [f"-{t}-", f"_{t}_", f"/{t}/", f" {t} "])
    return inside | F.startswith(low, F.lit(f"{t}-")) | F.endswith(low, F.lit(f"-{t}"))


def layer_dropped(decision: Column, layer: Column, r: Rules = DEFAULT) -> Column:
    """Exact decision first, then the keep list, then the drop tokens."""
    tokens = tx.any_of(token_match(layer, t) for t in r.drop_tokens)
    kept = F.lower(layer).isin(*[x.lower() for x in r.keep_layers]) if r.keep_layers else F.lit(False)
    return F.when(decision == "keep", False).when(decision == "drop", True).when(kept, False).otherwise(tokens)


def entity_dropped(r: Rules = DEFAULT, min_line: float = 100.0) -> Column:
    """Excluded or unsupported type, layer word, or short line."""
    words = tx.any_in(F.lower("layer"), [w.lower() for w in r.drop_words])
    return ~F.col("entity_type").isin(SUPPORTED) | F.col("entity_type").isin(*r.drop_types) | words | ((F.col("entity_type") == "LINE") & (F.col("length") < min_line))


def base_mask(df: DataFrame, decisions: DataFrame, r: Rules = DEFAULT, min_length: float = 0.8, min_diag: float = 0.4) -> DataFrame:
    """Hard drops, manual drops and tiny entities flagged; ``base`` is what remains."""
    x = with_decision(df.where(F.size("points") >= 2), decisions)
    hard = F.upper("entity_type").isin(*r.hard_types) | _upper_any(_blob(), r.hard_words)
    tiny = (F.col("length") < min_length) & (F.col("bbox_diag") < min_diag)
    base = ~F.col("hard_drop") & ~tiny
    base = base & (F.col("decision") != "drop") if r.respect_drop else base
    base = base if r.render_undecided else base & (F.col("decision") == "keep")
    return x.withColumn("hard_drop", hard).withColumn("manual_drop", F.col("decision") == "drop").withColumn("base", base)


def renderable(df: DataFrame, decisions: DataFrame, r: Rules = DEFAULT) -> DataFrame:
    return classify_features(df, decisions, r).where((F.col("decision") == "keep") & (F.size("points") >= 2))


def noisy_layers(df: DataFrame, keys: Sequence[str], min_entities: int, small: float, small_ratio: float, physical_max: float, strict: bool = False) -> DataFrame:
    """Layers that are large, mostly small items and hardly physical."""
    little = (F.col("length") < small) | (F.col("bbox_diag") < small)
    g = df.groupBy(*keys, "layer").agg(
        F.count("*").alias("n"), F.avg(little.cast("double")).alias("small_ratio"), F.avg(F.col("feature_class").isin(PHYSICAL).cast("double")).alias("physical_ratio"))
    rare = F.col("physical_ratio") < physical_max if strict else F.col("physical_ratio") <= physical_max
    return g.withColumn("noisy", (F.col("n") >= min_entities) & (F.col("small_ratio") >= small_ratio) & rare)


# ---- review --------------------------------------------------------------------------------


def review_table(classified: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row per layer: counts, types, classes, mean scores, decision and suggestion.

    Block names fill at most 300 characters, so the first 150 distinct ones are enough.
    """
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ", ")
    g = classified.groupBy("layer").agg(
        F.count("*").alias("n_entities"), names("entity_type").alias("entity_types"),
        names("feature_class").alias("classes"), *[F.avg(f"{c}_score").alias(f"{c}_score") for c in PHYSICAL],
        F.count_if(F.col("decision") == "keep").alias("keep_count"), F.count_if(F.col("decision") == "drop").alias("drop_count"))
    blocks = top_n(classified.where("source_block <> ''").select("layer", "source_block").distinct(), ["layer"], [F.col("source_block")], 150)
    blocks = blocks.groupBy("layer").agg(F.substring(names("source_block"), 1, 300).alias("blocks"))
    g = g.join(blocks, "layer", "left").withColumn("blocks", F.coalesce("blocks", F.lit("")))
    return with_decision(g, decisions).withColumn("suggested_action", F.when(F.col("drop_count") > F.col("keep_count"), "drop").otherwise("keep"))


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("layer").agg(*[F.count_if(F.col("feature_class") == c).alias(c) for c in (*PHYSICAL, "detail", "noise")], F.count("*").alias("n"))


def settle_decisions(listed: DataFrame) -> DataFrame:
    """One decision per layer: keep over drop over undecided."""
    rank = F.when(F.col("decision") == "keep", 0).when(F.col("decision") == "drop", 1).otherwise(2)
    best = listed.groupBy("layer").agg(F.min(rank).alias("r"))
    return best.select("layer", F.when(F.col("r") == 0, "keep").when(F.col("r") == 1, "drop").otherwise("undecided").alias("decision"))


def move_layers(decisions: DataFrame, moves: DataFrame) -> DataFrame:
    """Moved layers take their new decision, the others stay."""
    return decisions.join(moves, "layer", "left_anti").unionByName(moves)


def decision_lists(review: DataFrame) -> DataFrame:
    """Sorted layers per decision, as rows; an unknown decision counts as undecided."""
    known = F.when(F.lower("decision").isin("keep", "drop", "undecided"), F.lower("decision")).otherwise("undecided")
    return review.select(known.alias("decision"), "layer").distinct().orderBy("decision", "layer")


def listing(manifest: DataFrame, decisions: DataFrame, status: str = "all", search: str = "") -> DataFrame:
    """Layers of one status whose name holds a text, largest first."""
    x = with_decision(manifest, decisions)
    x = x if status == "all" else x.where(F.col("decision") == status)
    x = x.where(F.contains(F.lower("layer"), F.lit(search.strip().lower()))) if search.strip() else x
    return x.orderBy(F.desc("segment_count"), F.desc("total_length"), "layer")


# ---- segments ------------------------------------------------------------------------------


def segments(df: DataFrame, keep: Sequence[str], min_length: float | Column = 0.0) -> DataFrame:
    """Edges of polylines with the closing edge, short ones dropped; midpoint, length and angle added."""
    x = df.select(*keep, F.posexplode(edges(closed_ring(F.col("points"), F.col("closed")))).alias("seg", "e")).select(*keep, "seg", "e.*")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    x = x.withColumn("length", F.sqrt(dx * dx + dy * dy)).where(F.col("length") >= min_length)
    angle = F.pmod(F.abs(F.degrees(F.atan2(dy, dx))), F.lit(180.0))
    return x.withColumns({"mx": (F.col("x1") + F.col("x2")) * 0.5, "my": (F.col("y1") + F.col("y2")) * 0.5, "angle": angle})


def near_axis(angle: Column, tol: float = 12.0) -> Column:
    return (F.abs(angle) <= tol) | (F.abs(angle - 90.0) <= tol) | (F.abs(angle - 180.0) <= tol)


def segment_box(segs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return segs.groupBy(*keys).agg(F.min(F.least("x1", "x2")).alias("x0"), F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("x1", "x2")).alias("x_max"), F.max(F.greatest("y1", "y2")).alias("y_max"))


def size_limits(boxes: DataFrame) -> DataFrame:
    """Limits relative to the longer side of a plan."""
    ref = F.greatest(F.col("x_max") - F.col("x0"), F.col("y_max") - F.col("y0"), F.lit(1e-9))
    return boxes.withColumns({
        "ref": ref, "min_arc_radius": ref * 0.0020, "min_segment_length": ref * 0.0006, "triangle_min_bbox": ref * 0.08,
        "triangle_min_area": ref * ref * 0.0020, "long_diag_len": ref * 0.06, "fan_diag_len": ref * 0.012, "fan_endpoint_radius": ref * 0.012,
    })


def layer_manifest(segs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return segs.groupBy(*keys, "layer").agg(
        F.count("*").alias("segment_count"), F.sum("length").alias("total_length"), F.min(F.least("x1", "x2")).alias("min_x"), F.min(F.least("y1", "y2")).alias("min_y"),
        F.max(F.greatest("x1", "x2")).alias("max_x"), F.max(F.greatest("y1", "y2")).alias("max_y"))


def angle_at(a: Column, p: Column, b: Column) -> Column:
    """Angle at ``p`` in degrees; 180 when a side has no length."""
    ax, ay, bx, by = a["x"] - p["x"], a["y"] - p["y"], b["x"] - p["x"], b["y"] - p["y"]
    na, nb = F.sqrt(ax * ax + ay * ay), F.sqrt(bx * bx + by * by)
    c = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ax * bx + ay * by) / F.nullif(na * nb, F.lit(0.0))))
    return F.coalesce(F.degrees(F.acos(c)), F.lit(180.0))


def _span(points: Column) -> Column:
    side = lambda c: F.array_max(F.transform(points, lambda p: p[c])) - F.array_min(F.transform(points, lambda p: p[c]))
    return F.greatest(side("x"), side("y"))


def _ring_area(points: Column, n: Column) -> Column:
    terms = F.transform(points, lambda p, i: tx.let(F.get(points, (i + 1) % n), lambda nx: p["x"] * nx["y"] - nx["x"] * p["y"]))
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)) * 0.5


def big_triangle(points: Column, min_box: Column, min_area: Column) -> Column:
    """Large closed triangle, or four corners with one almost straight."""
    def test(u: Column) -> Column:
        n = F.size(u)
        straight = F.exists(F.sequence(F.lit(0), n - 1), lambda i: angle_at(F.get(u, (i + n - 1) % n), F.get(u, i), F.get(u, (i + 1) % n)) > 170)
        return n.isin(3, 4) & (_span(u) >= min_box) & (_ring_area(u, n) >= min_area) & ((n == 3) | straight)

    first, last = F.get(points, F.lit(0)), F.try_element_at(points, F.lit(-1))
    open_ = F.when((F.size(points) >= 2) & (first["x"] == last["x"]) & (first["y"] == last["y"]), F.slice(points, F.lit(1), F.size(points) - 1)).otherwise(points)
    return F.when(F.size(points) >= 3, tx.let(open_, test)).otherwise(F.lit(False))


def big_open_v(points: Column, min_side: Column, min_box: Column) -> Column:
    """Large open V of two oblique strokes."""
    p = [F.get(points, F.lit(i)) for i in range(3)]
    side = lambda a, b: F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"]))
    slope = lambda a, b: F.pmod(F.abs(F.degrees(F.atan2(b["y"] - a["y"], b["x"] - a["x"]))), F.lit(180.0))
    ang = angle_at(p[0], p[1], p[2])
    return F.when(F.size(points) == 3, (
        (side(p[0], p[1]) >= min_side) & (side(p[1], p[2]) >= min_side) & ~near_axis(slope(p[0], p[1])) & ~near_axis(slope(p[1], p[2]))
        & ang.between(15, 120) & (_span(points) >= min_box))).otherwise(F.lit(False))


def fan_pass(segs: DataFrame, keys: Sequence[str], least_length: Column, radius: Column, min_segments: int, min_spread: float) -> DataFrame:
    """Oblique segments that crowd around one place, by bins of their midpoints.

    Every bin with segments looks at the 25 bins around it; per-bin counts, angle ranges and angle
    buckets are combined, never the segments themselves.
    """
    keys = list(keys)
    cell = F.greatest(radius, F.lit(1e-9))
    cand = segs.where((F.col("length") >= least_length) & ~near_axis(F.col("angle"), 4.0)).withColumns({
        "bx": F.floor(F.col("mx") / cell), "by": F.floor(F.col("my") / cell), "bucket": F.floor(F.col("angle") / 15).cast("int")})
    bits = F.bit_or(F.expr("shiftleft(1, bucket)"))
    bins = cand.groupBy(*keys, "bx", "by").agg(F.count("*").alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi"), bits.alias("bits"))
    near = bins.select("*", F.explode(gd.square(2)).alias("o")).select(
        *keys, (F.col("bx") + F.col("o.dx")).alias("cx"), (F.col("by") + F.col("o.dy")).alias("cy"), "n", "lo", "hi", "bits")
    own = bins.select(*keys, F.col("bx").alias("cx"), F.col("by").alias("cy"))
    hood = near.join(own, [*keys, "cx", "cy"], "left_semi").groupBy(*keys, "cx", "cy").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bit_or("bits").alias("bits"))
    fans = hood.where((F.col("n") >= min_segments) & (F.bit_count("bits") >= 3) & (F.col("hi") - F.col("lo") >= min_spread))
    marked = fans.select(*keys, "cx", "cy", F.explode(gd.square(2)).alias("o")).select(
        *keys, (F.col("cx") + F.col("o.dx")).alias("bx"), (F.col("cy") + F.col("o.dy")).alias("by")).distinct()
    return cand.join(marked, [*keys, "bx", "by"], "left_semi").drop("bx", "by", "bucket")


def remove_fans(segs: DataFrame, keys: Sequence[str], seg_keys: Sequence[str], limits: DataFrame, stop_below: int = 20) -> DataFrame:
    """Up to three passes with wider nets; a plan stops after a pass that removes few segments."""
    keys = list(keys)
    left = segs.join(limits.select(*keys, "fan_diag_len", "fan_endpoint_radius"), keys).withColumn("_on", F.lit(True))
    for length_x, radius_x, least, spread in ((1.0, 1.0, 4, 30.0), (0.75, 1.5, 3, 20.0), (0.60, 1.8, 3, 15.0)):
        left = cut_lineage(left)
        gone = fan_pass(left.where("_on"), keys, F.col("fan_diag_len") * length_x, F.col("fan_endpoint_radius") * radius_x, least, spread).select(*seg_keys)
        gone = cut_lineage(gone)
        going_on = gone.groupBy(*keys).agg(F.count("*").alias("_g")).where(F.col("_g") >= stop_below).select(*keys, F.lit(True).alias("_go"))
        left = left.join(gone, list(seg_keys), "left_anti").join(going_on, keys, "left").withColumn("_on", F.col("_on") & F.coalesce("_go", F.lit(False))).drop("_go")
    return left.drop("_on", "fan_diag_len", "fan_endpoint_radius")


# ---- selection by place --------------------------------------------------------------------


def inflate(box: DataFrame, ratio: float, prefix: str) -> DataFrame:
    m = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1.0)) * ratio
    return box.withColumns({f"{prefix}x0": F.col("x0") - m, f"{prefix}y0": F.col("y0") - m, f"{prefix}x1": F.col("x1") + m, f"{prefix}y1": F.col("y1") + m})


def touches(prefix: str) -> Column:
    return ~((F.col("bbox_max_x") < F.col(f"{prefix}x0")) | (F.col("bbox_min_x") > F.col(f"{prefix}x1")) | (F.col("bbox_max_y") < F.col(f"{prefix}y0")) | (F.col("bbox_min_y") > F.col(f"{prefix}y1")))


def centre_inside(prefix: str) -> Column:
    cx, cy = (F.col("bbox_min_x") + F.col("bbox_max_x")) / 2.0, (F.col("bbox_min_y") + F.col("bbox_max_y")) / 2.0
    return cx.between(F.col(f"{prefix}x0"), F.col(f"{prefix}x1")) & cy.between(F.col(f"{prefix}y0"), F.col(f"{prefix}y1"))


def component_rows(df: DataFrame, keys: Sequence[str], grid: int, dilate: int, connectivity: int = 8) -> DataFrame:
    """(entity, component) pairs; an entity may touch several components."""
    cells = cut_lineage(gd.entity_cells(df, keys, grid, dilate))
    comps = gd.components(cells, keys, connectivity)
    return cells.join(comps, [*keys, "x", "y"]).select(*keys, "row_id", "comp").distinct()


def _component_stats(df: DataFrame, pairs: DataFrame, keys: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    small = ((F.col("length") < 2.0) | (F.col("bbox_diag") < 2.0)).cast("double")
    return pairs.join(df, [*keys, "row_id"]).groupBy(*keys, "comp").agg(
        F.count("*").alias("n"), F.sum("length").alias("total"), F.avg(small).alias("small"), F.min("bbox_min_x").alias("x0"), F.min("bbox_min_y").alias("y0"),
        F.max("bbox_max_x").alias("x1"), F.max("bbox_max_y").alias("y1"), *extra)


def plan_scores(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ink-rich dense components score high, many small items cost."""
    g = _component_stats(df, pairs, keys)
    box = F.greatest((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), F.lit(1.0))
    return g.withColumn("score", F.col("total") + F.col("total") / F.sqrt(box) * 20.0 - F.col("small") * F.col("n") * 2.0)


def class_scores(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted length by class, a density term, a cost for small items."""
    by = lambda names: F.sum(F.when(F.col("feature_class").isin(names), F.col("length")).otherwise(0.0))
    useful = (by(["wall"]) * 2.0 + by(["door", "window", "stairs"]) * 1.4 + by(["detail"]) * 0.35).alias("useful")
    g = _component_stats(df, pairs, keys, [useful])
    box = F.greatest((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), F.lit(1.0))
    return g.withColumn("score", F.col("useful") + F.sqrt(F.col("total") / box) * 450.0 - F.col("small") * 0.35 * F.col("n"))


def strong_rows(pairs: DataFrame, scores: DataFrame, keys: Sequence[str], ratio: float) -> DataFrame:
    """Entities of the best component and of those close enough in score."""
    keys = list(keys)
    best = scores.groupBy(*keys).agg(F.max("score").alias("_top"), F.max_by("comp", F.struct("score", -F.col("comp"))).alias("_best"))
    kept = scores.join(best, keys).where((F.col("comp") == F.col("_best")) | ((F.col("_top") > 0) & (F.col("score") / F.col("_top") >= ratio)))
    return pairs.join(kept.select(*keys, "comp"), [*keys, "comp"], "left_semi").select(*keys, "row_id").distinct()


def main_plan(df: DataFrame, keys: Sequence[str], grid: int = 700, dilate: int = 1, ratio: float = 0.18) -> DataFrame:
    pairs = cut_lineage(component_rows(df, keys, grid, dilate))
    return strong_rows(pairs, plan_scores(df, pairs, keys), keys, ratio)


def select_entities(df: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("plan_id",), r: Rules = DEFAULT, grid: int = 700, dilate: int = 1) -> DataFrame:
    """Main plan plus small details near it rescued from dropped layers; flags for every entity."""
    keys = list(keys)
    x = cut_lineage(base_mask(df, decisions, r))
    main = main_plan(x.where("base"), keys, grid, dilate).withColumn("_main", F.lit(True))
    x = x.join(main, [*keys, "row_id"], "left").withColumn("_main", F.coalesce("_main", F.lit(False)))
    box = inflate(gd.box_of(x.where("_main"), keys), 0.10, "r_").drop("x0", "y0", "x1", "y1")
    x = x.join(box, keys, "left")
    longest = F.greatest(F.col("r_x1") - F.col("r_x0"), F.col("r_y1") - F.col("r_y0"), F.lit(1.0)) * 0.16
    rescue = (
        ~F.col("hard_drop") & touches("r_") & F.upper("entity_type").isin(*r.rescue_types) & (F.col("length") >= 0.6) & (F.col("bbox_diag") >= 0.35)
        & (F.col("length") <= longest) & (_upper_any(_blob(), r.rescue_words) | F.col("manual_drop")))
    x = x.withColumn("is_rescued_detail", F.coalesce(rescue, F.lit(False)))
    return x.withColumn("selected", F.col("_main") | F.col("is_rescued_detail")).drop("_main", "r_x0", "r_y0", "r_x1", "r_y1")


def component_clean(df: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("plan_id",), r: Rules = DEFAULT, grid: int = 650, ratio: float = 0.22) -> DataFrame:
    """Class-weighted main component and the entities near it."""
    keys = list(keys)
    x = classify_physical(df, decisions, r).where((F.size("points") >= 2) & (F.col("feature_class") != "noise") & (F.col("length") >= 0.8) & (F.col("bbox_diag") >= 0.5))
    x = cut_lineage(x)
    pairs = cut_lineage(component_rows(x, keys, grid, 1))
    main = strong_rows(pairs, class_scores(x, pairs, keys), keys, ratio).withColumn("_main", F.lit(True))
    x = x.join(main, [*keys, "row_id"], "left").withColumn("_main", F.coalesce("_main", F.lit(False)))
    box = inflate(gd.box_of(x.where("_main"), keys), 0.055, "r_")
    j = x.join(box, keys, "left")
    longest = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1.0)) * 0.18
    near = touches("r_") & F.upper("entity_type").isin(*r.rescue_types) & (F.col("length") >= 1.2) & (F.col("bbox_diag") >= 0.8) & (F.col("length") <= longest)
    shown = F.when(F.col("feature_class").isin(PHYSICAL), F.col("feature_class")).otherwise("detail")
    return j.where(F.col("_main") | F.coalesce(near, F.lit(False))).select(*df.columns, "feature_class", "decision", shown.alias("render_class"))


def largest_component_rows(df: DataFrame, keys: Sequence[str], grid: int = 420, margin: int = 2, connectivity: int = 8) -> DataFrame:
    """Entities with a cell in the largest component, widened by a margin."""
    keys = list(keys)
    cells = cut_lineage(gd.entity_cells(df, keys, grid, 0))
    comps = gd.components(cells, keys, connectivity)
    best = gd.largest(gd.component_boxes(comps, keys), keys)
    area = gd.dilated(comps.join(best, [*keys, "comp"], "left_semi"), keys, margin, grid)
    return cells.join(area, [*keys, "x", "y"], "left_semi").select(*keys, "row_id").distinct()


def strict_clean(df: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("plan_id",), r: Rules = DEFAULT, min_entities: int = 80) -> DataFrame:
    """Physical classes only, no tiny items, no noisy layers, largest component."""
    keys = list(keys)
    x = classify_physical(df, decisions, r).where(F.col("feature_class").isin(PHYSICAL) & (F.size("points") >= 2) & (F.col("length") >= 3.0) & (F.col("bbox_diag") >= 2.0))
    noisy = noisy_layers(x, keys, min_entities, 12.0, 0.72, 0.20).where("noisy").select(*keys, "layer")
    x = cut_lineage(x.join(noisy, [*keys, "layer"], "left_anti"))
    return x.join(largest_component_rows(x, keys), [*keys, "row_id"], "left_semi")


def balanced_clean(df: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("plan_id",), r: Rules = DEFAULT, min_entities: int = 180) -> DataFrame:
    """Physical entities and rescued details near the footprint of the walls."""
    keys = list(keys)
    x = classify_physical(df, decisions, r).where(F.size("points") >= 2)
    physical = F.col("feature_class").isin(PHYSICAL) & ~F.col("hard_noise")
    wall = physical & (F.col("feature_class") == "wall")
    part = lambda cond, c, f: f(F.when(cond, F.col(c)))
    names = {"x0": ("bbox_min_x", F.min), "y0": ("bbox_min_y", F.min), "x1": ("bbox_max_x", F.max), "y1": ("bbox_max_y", F.max)}
    box = x.groupBy(*keys).agg(*[F.coalesce(part(wall, c, f), part(physical, c, f)).alias(k) for k, (c, f) in names.items()]).where("x0 IS NOT NULL")
    box = inflate(inflate(box, 0.035, "n_"), 0.08, "f_")
    j = x.join(box, keys)
    longest = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1.0)) * 0.20
    rescue = touches("n_") & F.upper("entity_type").isin(*r.rescue_types) & ~F.col("hard_noise") & (F.col("length") >= 1.5) & (F.col("bbox_diag") >= 1.0) & (F.col("length") <= longest)
    kept = j.where(physical | rescue)
    noisy = noisy_layers(kept, keys, min_entities, 4.0, 0.86, 0.12, strict=True).where("noisy").select(*keys, "layer", F.lit(True).alias("_noisy"))
    kept = kept.join(noisy, [*keys, "layer"], "left").where(F.col("feature_class").isin(PHYSICAL) | F.col("_noisy").isNull()).where(centre_inside("f_"))
    shown = F.when(F.col("feature_class").isin(PHYSICAL), F.col("feature_class")).otherwise("detail")
    return kept.select(*df.columns, "feature_class", "decision", shown.alias("render_class"))


def longest(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Longest entities of a plan, for a preview."""
    return top_n(df, keys, [F.desc("length"), F.col("row_id")], n)
