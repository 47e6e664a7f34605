"""Queries over drawing entities, segments and ink cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmstead.operators import entities as en
from ohmstead.operators import grid as gd
from ohmstead.operators import ink as ik
from ohmstead.operators import intervals as iv
from ohmstead.operators import regions as rg
from ohmstead.plans.base_sql import with_
from ohmstead.plans.component_sql import CLASS_SCORE, PLAN_SCORE, components, fan_passes, grid_cells, growth, recursive, strong_rows
from ohmstead.plans.registry import Catalogue
from ohmstead.plans.reports import q, sql_any, sql_list
from ohmstead.sources import drawings as dr
from ohmstead.sources import tables as t

CAT = Catalogue()
query = CAT.query
R = en.DEFAULT
PLAN = ["plan_id"]

# ---- geometry in SQL -----------------------------------------------------------------------


def _folded(at: int) -> str:
    """Sum of all components that fall on one coordinate of point ``i``."""
    one = f"FLOOR(CAST(embedding[i * 2 + {at} + 2 * np * j] AS DOUBLE) * sc)"
    return f"FLOOR(list_sum(list_transform(range(0, CAST(ceil(len(embedding) / (2 * np)) AS BIGINT)), lambda j: COALESCE({one}, 0))) / dv)"


PTS = f"""e0 AS (SELECT vec_id AS row_id, 'P' || (vec_id // {dr.PLAN_SIZE}) AS plan_id, {sql_list(dr.LAYERS)}[label + 1] AS layer, {sql_list(dr.TYPES)}[vec_id % 4 + 1] AS entity_type,
  [{', '.join(str(dr.POINTS[k]) for k in dr.TYPES)}][vec_id % 4 + 1] AS np, [{', '.join(str(dr.FOLDED[k]) for k in dr.TYPES)}][vec_id % 4 + 1] AS dv, vec_id % 7 = 0 AND vec_id % 4 = 1 AS closed, CASE WHEN vec_id % 4 = 2 THEN CAST(vec_id % 180 AS DOUBLE) END AS arc_angle,
  CASE WHEN vec_id % 4 = 3 THEN 'B' || (vec_id % 3) END AS block_name, CASE WHEN vec_id % 9 = 0 THEN 'BLOC-PORTE' ELSE '' END AS source_block,
  CASE WHEN vec_id % 11 = 0 THEN 4.0::DOUBLE ELSE 1000.0::DOUBLE END AS sc, CASE WHEN label = 9 THEN 6000 ELSE 0 END AS sh, embedding FROM embeddings),
p0 AS (SELECT row_id, plan_id, closed, np, UNNEST(range(0, np)) AS i, embedding, sc, sh, dv FROM e0),
pts AS (SELECT row_id, plan_id, closed, np, i, {_folded(1)} + sh AS x, {_folded(2)} AS y FROM p0),
nx AS (SELECT *, LEAD(x) OVER w AS nx, LEAD(y) OVER w AS ny, FIRST_VALUE(x) OVER w AS fx, FIRST_VALUE(y) OVER w AS fy FROM pts WINDOW w AS (PARTITION BY row_id ORDER BY i)),
ed AS (SELECT row_id, plan_id, i AS seg, x AS x1, y AS y1, COALESCE(nx, fx) AS x2, COALESCE(ny, fy) AS y2 FROM nx WHERE nx IS NOT NULL OR (closed AND (x <> fx OR y <> fy))),
gm AS (SELECT row_id, MIN(x) AS bx0, MIN(y) AS by0, MAX(x) AS bx1, MAX(y) AS by1 FROM pts GROUP BY 1),
lg AS (SELECT row_id, SUM(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS length, ABS(SUM(x1 * y2 - x2 * y1)) / 2 AS ar FROM ed GROUP BY 1),
rg AS (SELECT row_id, MAX(CASE WHEN i = np - 1 AND x = fx AND y = fy AND np >= 3 THEN 1 ELSE 0 END) = 1 AS loops FROM nx GROUP BY 1),
en AS (SELECT e0.* EXCLUDE (embedding, sc, sh, dv), np AS n_points, bx0 AS bbox_min_x, by0 AS bbox_min_y, bx1 AS bbox_max_x, by1 AS bbox_max_y, bx1 - bx0 AS bw, by1 - by0 AS bh, sqrt((bx1 - bx0) * (bx1 - bx0) + (by1 - by0) * (by1 - by0)) AS bbox_diag,
  length, CASE WHEN np >= 3 AND (closed OR loops) THEN ar ELSE 0 END AS area FROM e0 JOIN gm USING (row_id) JOIN lg USING (row_id) JOIN rg USING (row_id)),
dec(layer, decision) AS (VALUES {', '.join(f"({q(n)}, {q('keep' if i < 3 else 'drop' if i < 5 else 'undecided')})" for i, n in enumerate(dr.LAYERS))}),
bl AS (SELECT en.*, decision AS dcs, upper(layer || ' ' || source_block || ' ' || COALESCE(block_name, '') || ' ' || entity_type) AS blob, LEAST(bw, bh) AS mind, GREATEST(bw, bh) AS maxd,
  GREATEST(bw, bh) / CASE WHEN LEAST(bw, bh) = 0 THEN 1 ELSE LEAST(bw, bh) END AS asp, COALESCE(arc_angle, 0) AS aa FROM en JOIN dec USING (layer))"""


def _d(v) -> str:
    return f"CAST({v} AS DOUBLE)"


def _sum(parts) -> str:
    return _d(0) + " + " + " + ".join(f"CASE WHEN {c} THEN {_d(v)} ELSE {_d(0)} END" for c, v in parts)


def _in(words) -> str:
    return "entity_type IN (" + ", ".join(q(w) for w in words) + ")"


_K = R.keywords
FEAT = f"""f0 AS (SELECT *, {_sum([(sql_any('blob', _K['wall']), .34), (_in(en.POLY), .18), ('closed', .12), ('length >= 20', .22), ('area > 0', .06), ('bw > 0 AND bh > 0', .08)])} AS wall_score,
 {_sum([(sql_any('blob', _K['door']), .48), (_in(['ARC', *en.OPEN_TYPES]), .15), ('length >= 3', .12), ('aa BETWEEN 35 AND 115', .22), ('asp BETWEEN 1.2 AND 12', .03)])} AS door_score,
 {_sum([(sql_any('blob', _K['window']), .45), (_in(en.OPEN_TYPES), .16), ('length >= 3', .12), ('asp >= 2', .17), ('closed', .05)])} AS window_score,
 {_sum([(sql_any('blob', _K['stairs']), .55), (_in(en.OPEN_TYPES), .15), ('length >= 3', .10)])} AS stairs_score,
 {_sum([(sql_any('blob', _K['furniture']), .55), (_in(['INSERT', 'CIRCLE', 'LWPOLYLINE', 'POLYLINE']), .08)])} AS furniture_score,
 {_sum([(sql_any('blob', _K['annotation']), .55), (_in(R.drop_types), .45)])} AS annotation_score FROM bl),
f1 AS (SELECT *, GREATEST(wall_score, door_score, window_score, stairs_score, furniture_score) AS top FROM f0),
f2 AS (SELECT *, CASE WHEN annotation_score >= 0.55::DOUBLE THEN 'annotation' {' '.join(f"WHEN {c}_score = top THEN CASE WHEN top >= {_d(v)} THEN '{c}' ELSE 'other' END" for c, v in R.thresholds.items())} END AS feature_class FROM f1),
ft AS (SELECT *, CASE WHEN dcs <> 'undecided' THEN dcs WHEN feature_class IN ('wall','door','window','stairs') THEN 'keep' WHEN feature_class = 'annotation' OR {sql_any('upper(layer)', R.drop_words)} THEN 'drop' WHEN feature_class = 'other' THEN 'keep' ELSE 'undecided' END AS decision FROM f2)"""
PHYS = f"""h0 AS (SELECT *, {_in(R.hard_types)} OR {sql_any('blob', R.hard_words)} AS hard_noise,
 {_sum([(sql_any('blob', _K['wall']), .42), (_in(en.POLY), .16), ('length >= 10', .22), ('bw > 0 AND bh > 0', .08), ('closed', .06)])} AS wall_score,
 {_sum([(sql_any('blob', _K['door']), .48), (_in(['ARC', *en.OPEN_TYPES]), .12), ('aa BETWEEN 35 AND 115', .25), ('length >= 2', .1), ('maxd / CASE WHEN mind = 0 THEN 1 ELSE mind END BETWEEN 1.2 AND 18', .05)])} AS door_score,
 {_sum([(sql_any('blob', _K['window']), .48), (_in(en.OPEN_TYPES), .14), ('length >= 2', .1), ('asp >= 2', .15)])} AS window_score,
 {_sum([(sql_any('blob', _K['stairs']), .55), (_in(en.OPEN_TYPES), .15), ('length >= 2', .1)])} AS stairs_score FROM bl),
h1 AS (SELECT *, GREATEST(wall_score, door_score, window_score, stairs_score) AS top FROM h0),
ph AS (SELECT *, CASE WHEN hard_noise THEN 'noise' {' '.join(f"WHEN {c}_score = top THEN CASE WHEN top >= {_d(v)} THEN '{c}' ELSE 'detail' END" for c, v in R.physical_thresholds.items())} END AS feature_class FROM h1)"""
SEG = """sg AS (SELECT ed.row_id, ed.plan_id, layer, seg, x1, y1, x2, y2, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS length, ABS(degrees(atan2(y2 - y1, x2 - x1))) % 180 AS angle FROM ed JOIN e0 USING (row_id))"""


def _geo(s, sf) -> DataFrame:
    return dr.geometry(s, sf)


def _segs(s, sf) -> DataFrame:
    return en.segments(dr.entities(s, sf), ["plan_id", "row_id", "layer"])


# ---- geometry ------------------------------------------------------------------------------


@query("entity_geometry", with_(PTS) + "SELECT row_id, plan_id, CAST(n_points AS INTEGER) AS n_points, bbox_min_x, bbox_min_y, bbox_max_x, bbox_max_y, ROUND(bbox_diag, 4) AS bbox_diag, ROUND(length, 4) AS length, CAST(area AS DOUBLE) AS area FROM en")
def entity_geometry(s, sf):
    return _geo(s, sf).select("row_id", "plan_id", "n_points", "bbox_min_x", "bbox_min_y", "bbox_max_x", "bbox_max_y", F.round("bbox_diag", 4).alias("bbox_diag"), F.round("length", 4).alias("length"), "area")


@query("arc_densification", """
WITH a AS (SELECT p_partkey, p_size, UNNEST(range(0, 40)) AS i, radians(CAST(p_size * 7 % 360 AS DOUBLE)) AS a0, radians(CAST(CASE WHEN p_partkey % 360 < p_size * 7 % 360 THEN p_partkey % 360 + 360 ELSE p_partkey % 360 END AS DOUBLE)) AS a1 FROM part)
SELECT p_partkey, i, ROUND(10 + p_size * cos(a0 + (a1 - a0) * i / 39), 5) AS x, ROUND(20 + p_size * sin(a0 + (a1 - a0) * i / 39), 5) AS y FROM a""")
def arc_densification(s, sf):
    p = t.table(s, sf, "part")
    pts = dr.arc_points(F.lit(10.0), F.lit(20.0), F.col("p_size").cast("double"), (F.col("p_size") * 7 % 360).cast("double"), (F.col("p_partkey") % 360).cast("double"))
    x = p.select("p_partkey", F.posexplode(pts).alias("i", "p"))
    return x.select("p_partkey", F.col("i").cast("long").alias("i"), F.round("p.x", 5).alias("x"), F.round("p.y", 5).alias("y"))


@query("segments", with_(PTS, SEG) + "SELECT row_id, CAST(seg AS INTEGER) AS seg, (x1 + x2) * 0.5::DOUBLE AS mx, (y1 + y2) * 0.5::DOUBLE AS my, ROUND(length, 4) AS length, ROUND(angle, 4) AS angle, ABS(angle) <= 12 OR ABS(angle - 90) <= 12 OR ABS(angle - 180) <= 12 AS axis FROM sg WHERE length >= 5")
def segments(s, sf):
    x = en.segments(dr.entities(s, sf), ["row_id"], 5.0)
    return x.select("row_id", "seg", "mx", "my", F.round("length", 4).alias("length"), F.round("angle", 4).alias("angle"), en.near_axis(F.col("angle")).alias("axis"))


@query("size_limits", with_(PTS, SEG) + """
, b AS (SELECT plan_id, GREATEST(MAX(GREATEST(x1, x2)) - MIN(LEAST(x1, x2)), MAX(GREATEST(y1, y2)) - MIN(LEAST(y1, y2))) AS ref FROM sg GROUP BY 1)
SELECT plan_id, ref, ROUND(ref * 0.0020::DOUBLE, 6) AS min_arc_radius, ROUND(ref * 0.08::DOUBLE, 6) AS triangle_min_bbox, ROUND(ref * ref * 0.0020::DOUBLE, 4) AS triangle_min_area, ROUND(ref * 0.012::DOUBLE, 6) AS fan_diag_len FROM b""")
def size_limits(s, sf):
    x = en.size_limits(en.segment_box(_segs(s, sf), PLAN))
    return x.select("plan_id", "ref", F.round("min_arc_radius", 6).alias("min_arc_radius"), F.round("triangle_min_bbox", 6).alias("triangle_min_bbox"), F.round("triangle_min_area", 4).alias("triangle_min_area"), F.round("fan_diag_len", 6).alias("fan_diag_len"))


@query("stray_shapes", with_(PTS) + """
, p AS (SELECT * FROM (SELECT row_id, i, x AS x0, y AS y0, LEAD(x) OVER w AS x1, LEAD(y) OVER w AS y1, LEAD(x, 2) OVER w AS x2, LEAD(y, 2) OVER w AS y2 FROM pts WINDOW w AS (PARTITION BY row_id ORDER BY i)) WHERE x2 IS NOT NULL),
m AS (SELECT *, GREATEST(GREATEST(x0, x1, x2) - LEAST(x0, x1, x2), GREATEST(y0, y1, y2) - LEAST(y0, y1, y2)) AS span, ABS(x0 * y1 - x1 * y0 + x1 * y2 - x2 * y1 + x2 * y0 - x0 * y2) * 0.5::DOUBLE AS area,
 sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) AS l1, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS l2, ABS(degrees(atan2(y1-y0, x1-x0))) % 180 AS a1, ABS(degrees(atan2(y2-y1, x2-x1))) % 180 AS a2 FROM p),
g AS (SELECT *, CASE WHEN l1 * l2 = 0 THEN 180 ELSE degrees(acos(GREATEST(-1, LEAST(1, ((x0-x1)*(x2-x1) + (y0-y1)*(y2-y1)) / (l1 * l2))))) END AS ang FROM m)
SELECT row_id, CAST(i AS INTEGER) AS i, (x0 <> x2 OR y0 <> y2) AND span >= 80 AND area >= 2000 AS triangle, l1 >= 60 AND l2 >= 60 AND NOT (a1 <= 12 OR ABS(a1 - 90) <= 12 OR ABS(a1 - 180) <= 12) AND NOT (a2 <= 12 OR ABS(a2 - 90) <= 12 OR ABS(a2 - 180) <= 12) AND ang BETWEEN 15 AND 120 AND span >= 80 AS vee FROM g""")
def stray_shapes(s, sf):
    x = dr.entities(s, sf).where(F.size("points") >= 3).select("row_id", "points", F.explode(F.sequence(F.lit(0), F.size("points") - 3)).alias("i"))
    x = x.select("row_id", "i", F.slice("points", F.col("i") + 1, F.lit(3)).alias("p"))
    return x.select("row_id", "i", en.big_triangle(F.col("p"), F.lit(80.0), F.lit(2000.0)).alias("triangle"), en.big_open_v(F.col("p"), F.lit(60.0), F.lit(80.0)).alias("vee"))


_FANIN = """sb AS (SELECT plan_id, GREATEST(MAX(GREATEST(x1, x2)) - MIN(LEAST(x1, x2)), MAX(GREATEST(y1, y2)) - MIN(LEAST(y1, y2))) AS ref FROM sg GROUP BY 1),
fs AS (SELECT plan_id, row_id, seg, (x1 + x2) * 0.5::DOUBLE AS mx, (y1 + y2) * 0.5::DOUBLE AS my, length, angle, ref * 0.012::DOUBLE AS fd, ref * 0.012::DOUBLE AS fr FROM sg JOIN sb USING (plan_id))"""


@query("fan_removal", with_(PTS, SEG, _FANIN, fan_passes()) + "SELECT plan_id, COUNT(*) AS segments, ROUND(SUM(length), 3) AS total_length FROM left3 GROUP BY 1")
def fan_removal(s, sf):
    segs = _segs(s, sf)
    left = en.remove_fans(segs, PLAN, ["plan_id", "row_id", "seg"], en.size_limits(en.segment_box(segs, PLAN)))
    return left.groupBy("plan_id").agg(F.count("*").alias("segments"), F.round(F.sum("length"), 3).alias("total_length"))


# ---- classes and filters -------------------------------------------------------------------


@query("feature_classes", with_(PTS, FEAT) + "SELECT row_id, ROUND(wall_score, 4) AS wall_score, ROUND(door_score, 4) AS door_score, ROUND(window_score, 4) AS window_score, ROUND(stairs_score, 4) AS stairs_score, ROUND(furniture_score, 4) AS furniture_score, ROUND(annotation_score, 4) AS annotation_score, feature_class, decision FROM ft")
def feature_classes(s, sf):
    x = en.classify_features(_geo(s, sf), dr.decisions(s))
    scores = [c for c in x.columns if c.endswith("_score")]
    return x.select("row_id", *[F.round(c, 4).alias(c) for c in scores], "feature_class", "decision")


@query("physical_classes", with_(PTS, PHYS) + "SELECT row_id, ROUND(wall_score, 4) AS wall_score, ROUND(door_score, 4) AS door_score, ROUND(window_score, 4) AS window_score, ROUND(stairs_score, 4) AS stairs_score, feature_class, hard_noise, dcs AS decision FROM ph")
def physical_classes(s, sf):
    x = en.classify_physical(_geo(s, sf), dr.decisions(s))
    return x.select("row_id", *[F.round(c, 4).alias(c) for c in x.columns if c.endswith("_score")], "feature_class", "hard_noise", "decision")


@query("safe_filter", with_(PTS) + f"SELECT row_id, layer FROM bl WHERE NOT (dcs = 'drop' OR {_in(R.drop_types)} OR {sql_any('upper(layer)', R.drop_words)} OR (length < 1 AND bbox_diag < 0.5))")
def safe_filter(s, sf):
    return en.safe_filter(_geo(s, sf), dr.decisions(s)).select("row_id", "layer")


@query("layer_drops", with_(PTS) + """
SELECT row_id, layer, CASE WHEN dcs = 'keep' THEN false WHEN dcs = 'drop' THEN true ELSE contains(lower(layer), '-sur-') OR contains(lower(layer), '_sur_') OR contains(lower(layer), '/sur/') OR contains(lower(layer), ' sur ') OR starts_with(lower(layer), 'sur-') OR ends_with(lower(layer), '-sur')
 OR contains(lower(layer), '-hach-') OR contains(lower(layer), '_hach_') OR contains(lower(layer), '/hach/') OR contains(lower(layer), ' hach ') OR starts_with(lower(layer), 'hach-') OR ends_with(lower(layer), '-hach') END AS dropped FROM bl""")
def layer_drops(s, sf):
    x = en.with_decision(dr.entities(s, sf), dr.decisions(s))
    return x.select("row_id", "layer", en.layer_dropped(F.col("decision"), F.col("layer")).alias("dropped"))


@query("entity_drops", with_(PTS) + f"SELECT row_id FROM bl WHERE NOT ({_in(R.drop_types)} OR contains(lower(layer), 'cote') OR contains(lower(layer), 'hach') OR (entity_type = 'LINE' AND length < 100))")
def entity_drops(s, sf):
    return _geo(s, sf).where(~en.entity_dropped()).select("row_id")


@query("base_mask", with_(PTS) + f"SELECT row_id, hd AS hard_drop, dcs = 'drop' AS manual_drop, NOT hd AND NOT (length < 0.8 AND bbox_diag < 0.4) AND dcs <> 'drop' AS base FROM (SELECT *, {_in(R.hard_types)} OR {sql_any('blob', R.hard_words)} AS hd FROM bl)")
def base_mask(s, sf):
    return en.base_mask(_geo(s, sf), dr.decisions(s)).select("row_id", "hard_drop", "manual_drop", "base")


@query("renderable", with_(PTS, FEAT) + "SELECT row_id, feature_class FROM ft WHERE decision = 'keep'")
def renderable(s, sf):
    return en.renderable(_geo(s, sf), dr.decisions(s)).select("row_id", "feature_class")


@query("kept_layers", with_(PTS) + "SELECT row_id FROM bl WHERE dcs = 'keep'")
def kept_layers(s, sf):
    return dr.entities(s, sf).join(dr.decisions(s).where("decision = 'keep'"), "layer", "left_semi").select("row_id")


@query("noisy_layers", with_(PTS, PHYS) + """
, g AS (SELECT plan_id, layer, COUNT(*) AS n, AVG(CASE WHEN length < 600 OR bbox_diag < 600 THEN 1.0 ELSE 0.0 END) AS sr, AVG(CASE WHEN feature_class IN ('wall','door','window','stairs') THEN 1.0 ELSE 0.0 END) AS pr FROM ph GROUP BY 1, 2)
SELECT plan_id, layer, n, ROUND(sr, 6) AS small_ratio, ROUND(pr, 6) AS physical_ratio, n >= 5 AND sr >= 0.5 AND pr <= 0.6 AS noisy FROM g""")
def noisy_layers(s, sf):
    x = en.noisy_layers(en.classify_physical(_geo(s, sf), dr.decisions(s)), PLAN, 5, 600.0, 0.5, 0.6)
    return x.withColumns({c: F.round(c, 6) for c in ("small_ratio", "physical_ratio")})


@query("balanced_clean", with_(PTS, PHYS) + """
, k AS (SELECT *, feature_class IN ('wall','door','window','stairs') AND NOT hard_noise AS phy FROM ph),
b AS (SELECT plan_id, COALESCE(MIN(CASE WHEN phy AND feature_class = 'wall' THEN bbox_min_x END), MIN(CASE WHEN phy THEN bbox_min_x END)) AS x0, COALESCE(MIN(CASE WHEN phy AND feature_class = 'wall' THEN bbox_min_y END), MIN(CASE WHEN phy THEN bbox_min_y END)) AS y0,
 COALESCE(MAX(CASE WHEN phy AND feature_class = 'wall' THEN bbox_max_x END), MAX(CASE WHEN phy THEN bbox_max_x END)) AS x1, COALESCE(MAX(CASE WHEN phy AND feature_class = 'wall' THEN bbox_max_y END), MAX(CASE WHEN phy THEN bbox_max_y END)) AS y1 FROM k GROUP BY 1),
i AS (SELECT *, GREATEST(x1 - x0, y1 - y0, 1) AS md FROM b),
c AS (SELECT k.*, x0, y0, x1, y1, md, phy OR (NOT (bbox_max_x < x0 - md * 0.035 OR bbox_min_x > x1 + md * 0.035 OR bbox_max_y < y0 - md * 0.035 OR bbox_min_y > y1 + md * 0.035) AND NOT hard_noise AND length >= 1.5 AND bbox_diag >= 1 AND length <= md * 0.2) AS kept FROM k JOIN i USING (plan_id) WHERE x0 IS NOT NULL),
d AS (SELECT *, feature_class IN ('wall','door','window','stairs') AS ip FROM c WHERE kept),
z AS (SELECT plan_id, layer FROM d GROUP BY 1, 2 HAVING COUNT(*) >= 3 AND AVG(CASE WHEN length < 4 OR bbox_diag < 4 THEN 1.0 ELSE 0.0 END) >= 0.86 AND AVG(CASE WHEN ip THEN 1.0 ELSE 0.0 END) < 0.12)
SELECT row_id, CASE WHEN ip THEN feature_class ELSE 'detail' END AS render_class FROM d WHERE (ip OR (plan_id, layer) NOT IN (SELECT plan_id, layer FROM z)) AND (bbox_min_x + bbox_max_x) / 2 BETWEEN x0 - md * 0.08 AND x1 + md * 0.08 AND (bbox_min_y + bbox_max_y) / 2 BETWEEN y0 - md * 0.08 AND y1 + md * 0.08""")
def balanced_clean(s, sf):
    return en.balanced_clean(_geo(s, sf), dr.decisions(s), min_entities=3).select("row_id", "render_class")


# ---- review --------------------------------------------------------------------------------

_REV = """rv AS (SELECT layer, COUNT(*) AS n_entities, array_to_string(list_sort(list_distinct(list(entity_type))), ', ') AS entity_types, COALESCE(array_to_string(list_sort(list_distinct(list(source_block) FILTER (WHERE source_block <> ''))), ', '), '') AS blocks,
 array_to_string(list_sort(list_distinct(list(feature_class))), ', ') AS classes, AVG(wall_score) AS wall_score, COUNT(CASE WHEN decision = 'keep' THEN 1 END) AS keep_count, COUNT(CASE WHEN decision = 'drop' THEN 1 END) AS drop_count, ANY_VALUE(dcs) AS decision FROM ft GROUP BY 1)"""


@query("review_table", with_(PTS, FEAT, _REV) + "SELECT layer, n_entities, entity_types, blocks, classes, ROUND(wall_score, 6) AS wall_score, keep_count, drop_count, decision, CASE WHEN drop_count > keep_count THEN 'drop' ELSE 'keep' END AS suggested_action FROM rv ORDER BY decision, n_entities DESC")
def review_table(s, sf):
    x = en.review_table(en.classify_features(_geo(s, sf), dr.decisions(s)), dr.decisions(s))
    return x.select("layer", "n_entities", "entity_types", "blocks", "classes", F.round("wall_score", 6).alias("wall_score"), "keep_count", "drop_count", "decision", "suggested_action").orderBy("decision", F.desc("n_entities"))


@query("class_counts", with_(PTS, PHYS) + "SELECT layer, " + ", ".join(f"COUNT(CASE WHEN feature_class = '{c}' THEN 1 END) AS {q(c).replace(chr(39), chr(34))}" for c in (*en.PHYSICAL, "detail", "noise")) + ", COUNT(*) AS n FROM ph GROUP BY 1")
def class_counts(s, sf):
    return en.class_counts(en.classify_physical(_geo(s, sf), dr.decisions(s)))


_MAN = "mf AS (SELECT layer, COUNT(*) AS segment_count, SUM(length) AS total_length, MIN(LEAST(x1, x2)) AS min_x, MIN(LEAST(y1, y2)) AS min_y, MAX(GREATEST(x1, x2)) AS max_x, MAX(GREATEST(y1, y2)) AS max_y FROM sg GROUP BY 1)"


@query("layer_manifest", with_(PTS, SEG, _MAN) + "SELECT layer, segment_count, ROUND(total_length, 3) AS total_length, min_x, min_y, max_x, max_y FROM mf ORDER BY segment_count DESC, total_length DESC")
def layer_manifest(s, sf):
    return en.layer_manifest(_segs(s, sf)).withColumn("total_length", F.round("total_length", 3)).orderBy(F.desc("segment_count"), F.desc("total_length"))


@query("layer_listing", with_(PTS, SEG, _MAN) + "SELECT layer, segment_count, ROUND(total_length, 3) AS total_length, decision FROM mf JOIN dec USING (layer) WHERE decision = 'undecided' AND contains(lower(layer), 'ca') ORDER BY 2 DESC, 3 DESC")
def layer_listing(s, sf):
    x = en.listing(en.layer_manifest(_segs(s, sf)), dr.decisions(s), "undecided", " CA ")
    return x.select("layer", "segment_count", F.round("total_length", 3).alias("total_length"), "decision")


@query("entity_counts", with_(PTS) + "SELECT plan_id, layer, entity_type, COUNT(*) AS n, CASE WHEN dcs = 'drop' THEN 'skipped' ELSE 'drawn' END AS status FROM bl GROUP BY 1, 2, 3, 5")
def entity_counts(s, sf):
    x = en.with_decision(dr.entities(s, sf), dr.decisions(s))
    return x.groupBy("plan_id", "layer", "entity_type", F.when(F.col("decision") == "drop", "skipped").otherwise("drawn").alias("status")).agg(F.count("*").alias("n"))


@query("plan_boxes", with_(PTS) + "SELECT plan_id, MIN(bbox_min_x) AS x0, MIN(bbox_min_y) AS y0, MAX(bbox_max_x) AS x1, MAX(bbox_max_y) AS y1 FROM en GROUP BY 1")
def plan_boxes(s, sf):
    return gd.box_of(_geo(s, sf), PLAN)


@query("longest_entities", with_(PTS) + "SELECT plan_id, row_id, ROUND(length, 3) AS length, CAST(rank AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY plan_id ORDER BY ROUND(length, 6) DESC, row_id) AS rank FROM en) WHERE rank <= 10")
def longest_entities(s, sf):
    x = _geo(s, sf).withColumn("length", F.round("length", 6))
    return en.longest(x, PLAN, 10).select("plan_id", "row_id", F.round("length", 3).alias("length"), "rank")


_LISTED = "li AS (SELECT DISTINCT layer, CASE row_id % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'drop' ELSE 'undecided' END AS decision FROM e0 WHERE layer IN ('MUR-EXT', 'PORTE') OR row_id % 3 > 0), sd AS (SELECT layer, CASE MIN(CASE decision WHEN 'keep' THEN 0 WHEN 'drop' THEN 1 ELSE 2 END) WHEN 0 THEN 'keep' WHEN 1 THEN 'drop' ELSE 'undecided' END AS decision FROM li GROUP BY 1)"


def _listed(s, sf) -> DataFrame:
    k = F.col("row_id") % 3
    x = dr.entities(s, sf).where(F.col("layer").isin("MUR-EXT", "PORTE") | (k > 0))
    return x.select("layer", F.when(k == 0, "keep").when(k == 1, "drop").otherwise("undecided").alias("decision")).distinct()


@query("settled_decisions", with_(PTS, _LISTED) + "SELECT * FROM sd")
def settled_decisions(s, sf):
    return en.settle_decisions(_listed(s, sf))


@query("moved_decisions", with_(PTS, _LISTED) + "SELECT layer, CASE WHEN layer = 'PORTE' THEN 'undecided' ELSE decision END AS decision FROM sd")
def moved_decisions(s, sf):
    moves = dr.entities(s, sf).where("layer = 'PORTE'").select("layer", F.lit("undecided").alias("decision")).distinct()
    return en.move_layers(en.settle_decisions(_listed(s, sf)), moves)


@query("decision_lists", with_(PTS, _LISTED) + "SELECT DISTINCT decision, layer FROM sd ORDER BY 1, 2")
def decision_lists(s, sf):
    return en.decision_lists(en.settle_decisions(_listed(s, sf)))


# ---- grid components -----------------------------------------------------------------------

_CELLS = """pb AS (SELECT plan_id, MIN(bbox_min_x) AS x0, MIN(bbox_min_y) AS y0, GREATEST(MAX(bbox_max_x) - MIN(bbox_min_x), 1) AS w, GREATEST(MAX(bbox_max_y) - MIN(bbox_min_y), 1) AS h FROM en GROUP BY 1),
c0 AS (SELECT DISTINCT plan_id, row_id, CAST(trunc((x - x0) * (99 / w)) AS INTEGER) AS cx, CAST(trunc((y - y0) * (99 / h)) AS INTEGER) AS cy FROM pts JOIN pb USING (plan_id)),
cl AS (SELECT DISTINCT plan_id, row_id, cx + dx AS x, cy + dy AS y FROM c0, (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy) WHERE cx + dx BETWEEN 0 AND 99 AND cy + dy BETWEEN 0 AND 99)"""


@query("entity_cells", with_(PTS, _CELLS) + "SELECT plan_id, row_id, x, y FROM cl")
def entity_cells(s, sf):
    return gd.entity_cells(_geo(s, sf), PLAN, 100, 1)


@query("cell_components", recursive(PTS, grid_cells("gc", "en", 60, 0), components("cc", "gc", "plan_id")) + "SELECT plan_id, COUNT(*) AS area, CAST(MIN(x) AS INTEGER) AS x0, CAST(MIN(y) AS INTEGER) AS y0, CAST(MAX(x) AS INTEGER) AS x1, CAST(MAX(y) AS INTEGER) AS y1 FROM cc GROUP BY plan_id, lab")
def cell_components(s, sf):
    cells = gd.entity_cells(_geo(s, sf), PLAN, 60, 0)
    return gd.component_boxes(gd.components(cells, PLAN), PLAN).drop("comp")


_MAININ = "mi AS (SELECT *, '' AS fc FROM en)"


@query("main_plan_rows", recursive(PTS, _MAININ, grid_cells("gc", "mi", 700, 1), components("cc", "gc", "plan_id"), strong_rows("st", "mi", "gc", "cc", PLAN_SCORE, 0.18)) + "SELECT plan_id, row_id FROM st")
def main_plan_rows(s, sf):
    return en.main_plan(_geo(s, sf), PLAN)


_BASE = f"bm AS (SELECT *, {_in(R.hard_types)} OR {sql_any('blob', R.hard_words)} AS hd, '' AS fc FROM bl),\nmi AS (SELECT * FROM bm WHERE NOT hd AND NOT (length < 0.8 AND bbox_diag < 0.4) AND dcs <> 'drop')"
_NEAR = "NOT (bbox_max_x < x0 - mg OR bbox_min_x > x1 + mg OR bbox_max_y < y0 - mg OR bbox_min_y > y1 + mg)"
_RTYPES = _in(R.rescue_types)


def _main_box(share: str) -> str:
    return f"mb0 AS (SELECT mi.plan_id, MIN(bbox_min_x) AS x0, MIN(bbox_min_y) AS y0, MAX(bbox_max_x) AS x1, MAX(bbox_max_y) AS y1 FROM mi SEMI JOIN st USING (plan_id, row_id) GROUP BY 1), mb AS (SELECT *, GREATEST(x1 - x0, y1 - y0, 1) AS md, GREATEST(x1 - x0, y1 - y0, 1) * {share}::DOUBLE AS mg FROM mb0)"


@query("selected_entities", recursive(PTS, _BASE, grid_cells("gc", "mi", 700, 1), components("cc", "gc", "plan_id"), strong_rows("st", "mi", "gc", "cc", PLAN_SCORE, 0.18), _main_box("0.10")) + f"""
, r AS (SELECT bm.plan_id, bm.row_id, hd, dcs, COALESCE(NOT hd AND {_NEAR} AND {_RTYPES} AND length >= 0.6 AND bbox_diag >= 0.35 AND length <= GREATEST(md + 2 * mg, 1) * 0.16::DOUBLE AND ({sql_any('blob', R.rescue_words)} OR dcs = 'drop'), false) AS rescued, st.row_id IS NOT NULL AS main
 FROM bm LEFT JOIN mb ON mb.plan_id = bm.plan_id LEFT JOIN st ON st.plan_id = bm.plan_id AND st.row_id = bm.row_id)
SELECT plan_id, row_id, main OR rescued AS selected, rescued AS is_rescued_detail, hd AS hard_drop, dcs = 'drop' AS manual_drop FROM r""")
def selected_entities(s, sf):
    return en.select_entities(_geo(s, sf), dr.decisions(s)).select("plan_id", "row_id", "selected", "is_rescued_detail", "hard_drop", "manual_drop")


_PHYSROWS = "mi AS (SELECT *, feature_class AS fc FROM ph WHERE feature_class <> 'noise' AND length >= 0.8 AND bbox_diag >= 0.5)"


@query("component_clean", recursive(PTS, PHYS, _PHYSROWS, grid_cells("gc", "mi", 650, 1), components("cc", "gc", "plan_id"), strong_rows("st", "mi", "gc", "cc", CLASS_SCORE, 0.22), _main_box("0.055")) + f"""
SELECT mi.plan_id, mi.row_id, feature_class, CASE WHEN feature_class IN ('wall', 'door', 'window', 'stairs') THEN feature_class ELSE 'detail' END AS render_class FROM mi JOIN mb ON mb.plan_id = mi.plan_id LEFT JOIN st ON st.plan_id = mi.plan_id AND st.row_id = mi.row_id
WHERE st.row_id IS NOT NULL OR ({_NEAR} AND {_RTYPES} AND length >= 1.2 AND bbox_diag >= 0.8 AND length <= md * 0.18::DOUBLE)""")
def component_clean(s, sf):
    return en.component_clean(_geo(s, sf), dr.decisions(s)).select("plan_id", "row_id", "feature_class", "render_class")


_STRICT = """pr AS (SELECT * FROM ph WHERE feature_class IN ('wall', 'door', 'window', 'stairs') AND length >= 3 AND bbox_diag >= 2),
nl AS (SELECT plan_id, layer FROM pr GROUP BY 1, 2 HAVING COUNT(*) >= 80 AND AVG(CASE WHEN length < 12 OR bbox_diag < 12 THEN 1.0 ELSE 0.0 END) >= 0.72 AND 1 <= 0.2),
mi AS (SELECT * FROM pr ANTI JOIN nl USING (plan_id, layer))"""
_LARGEST = """lb AS (SELECT plan_id, lab FROM (SELECT plan_id, lab, ROW_NUMBER() OVER (PARTITION BY plan_id ORDER BY COUNT(*) DESC, lab) AS r FROM cc GROUP BY 1, 2) WHERE r = 1),
la AS (SELECT DISTINCT c.plan_id, c.x + dx AS x, c.y + dy AS y FROM (SELECT * FROM cc SEMI JOIN lb USING (plan_id, lab)) c, (SELECT UNNEST(range(-2, 3)) AS dx) a, (SELECT UNNEST(range(-2, 3)) AS dy) b)"""


@query("strict_clean", recursive(PTS, PHYS, _STRICT, grid_cells("gc", "mi", 420, 0), components("cc", "gc", "plan_id"), _LARGEST) + "SELECT mi.plan_id, mi.row_id, feature_class FROM mi SEMI JOIN (SELECT DISTINCT gc.plan_id, row_id FROM gc JOIN la ON la.plan_id = gc.plan_id AND la.x = gc.x AND la.y = gc.y) k ON k.plan_id = mi.plan_id AND k.row_id = mi.row_id")
def strict_clean(s, sf):
    return en.strict_clean(_geo(s, sf), dr.decisions(s)).select("plan_id", "row_id", "feature_class")


@query("main_region")
def main_region(s, sf):
    segs = _segs(s, sf)
    r = rg.main_region(segs, PLAN)
    return rg.crop(segs, r, PLAN, least=10).groupBy("plan_id").agg(F.count("*").alias("segments"), F.round(F.sum("length"), 3).alias("total_length"))


@query("region_boxes")
def region_boxes(s, sf):
    return rg.main_region(_segs(s, sf), PLAN)


@query("small_parts_dropped")
def small_parts_dropped(s, sf):
    left = rg.drop_small(_segs(s, sf), PLAN)
    return left.groupBy("plan_id").agg(F.count("*").alias("segments"))


@query("pixel_places", with_(PTS, _CELLS) + "SELECT row_id, CAST(GREATEST(0, LEAST(1199, round_even((x - x0) / w * 1199, 0))) AS INTEGER) AS px, CAST(GREATEST(0, LEAST(799, round_even((1 - (y - y0) / h) * 799, 0))) AS INTEGER) AS py FROM pts JOIN pb USING (plan_id) WHERE i = 0")
def pixel_places(s, sf):
    g = _geo(s, sf)
    b = gd.box_of(g, PLAN)
    p = F.get("points", F.lit(0))
    span = lambda a, c: F.greatest(F.col(a) - F.col(c), F.lit(1.0))
    return g.join(b, PLAN).select("row_id", gd.to_pixel(p["x"], F.col("x0"), span("x1", "x0"), F.lit(1200)).alias("px"), gd.to_pixel(p["y"], F.col("y0"), span("y1", "y0"), F.lit(800), flip=True).alias("py"))


# ---- ink -----------------------------------------------------------------------------------

SIZE = (170, 170)
INK = """sk AS (SELECT c_custkey AS k, c_custkey // 60 AS image_id, (c_custkey * 53) % 90 + c_nationkey AS a0, (c_custkey * 37) % 120 + 10 AS b0, 3 + CAST(floor(abs(c_acctbal)) AS BIGINT) % 40 AS len, CASE WHEN c_custkey % 10 = 0 THEN 6 ELSE 1 END AS th, CASE WHEN c_custkey % 13 = 0 THEN 250 ELSE c_custkey % 200 END AS v FROM customer),
s1 AS (SELECT k, image_id, v, a0 + UNNEST(range(0, len)) AS a, b0, th FROM sk), s2 AS (SELECT k, image_id, v, a, b0 + UNNEST(range(0, th)) AS b FROM s1),
raw AS (SELECT image_id, CASE WHEN k % 3 = 0 THEN b ELSE a END AS x, CASE WHEN k % 3 = 0 THEN a ELSE b END AS y, v FROM s2),
ink AS (SELECT image_id, x, y FROM raw GROUP BY 1, 2, 3 HAVING MIN(v) < 245)"""


def _raw(s, sf) -> DataFrame:
    c = t.table(s, sf, "customer")
    k = F.col("c_custkey")
    x = c.select(
        k.alias("k"), F.floor(k / 60).alias("image_id"), ((k * 53) % 90 + F.col("c_nationkey")).alias("a0"), ((k * 37) % 120 + 10).alias("b0"),
        (3 + F.floor(F.abs("c_acctbal")) % 40).cast("long").alias("len"), F.when(k % 10 == 0, 6).otherwise(1).alias("th"), F.when(k % 13 == 0, 250).otherwise(k % 200).alias("v"))
    x = t.dealt(x, "k")
    x = x.select("k", "image_id", "v", "b0", "th", F.explode(F.sequence(F.col("a0"), F.col("a0") + F.col("len") - 1)).alias("a"))
    x = x.select("k", "image_id", "v", "a", F.explode(F.sequence(F.col("b0"), F.col("b0") + F.col("th") - 1)).alias("b"))
    turned = F.col("k") % 3 == 0
    return x.select("image_id", F.when(turned, F.col("b")).otherwise(F.col("a")).alias("x"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("y"), "v")


def _ink(s, sf) -> DataFrame:
    raw = _raw(s, sf)
    return ik.ink(raw, parts=iv.tasks(raw))


@query("ink_crop", with_(INK) + "SELECT image_id, GREATEST(MIN(x) - 20, 0) AS x0, GREATEST(MIN(y) - 20, 0) AS y0, LEAST(MAX(x) + 21, 170) AS x1, LEAST(MAX(y) + 21, 170) AS y1, COUNT(*) AS n FROM ink GROUP BY 1")
def ink_crop(s, sf):
    i = _ink(s, sf)
    return ik.crop_box(i, 20, SIZE).join(i.groupBy("image_id").agg(F.count("*").alias("n")), "image_id")


_RUNS = "ru AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS axis, image_id, {line} AS line, MIN({st}) AS start, COUNT(*) AS n FROM (SELECT *, {st} - ROW_NUMBER() OVER (PARTITION BY image_id, {line} ORDER BY {st}) AS g FROM ink) GROUP BY image_id, {line}, g"
    for a, line, st in (("h", "y", "x"), ("v", "x", "y"), ("d", "(y - x)", "x"), ("a", "(y + x)", "x"))) + ")"


@query("ink_runs", with_(INK, _RUNS) + "SELECT axis, image_id, line, start, n FROM ru WHERE n >= 8")
def ink_runs(s, sf):
    i = _ink(s, sf)
    out = None
    for a in "hvda":
        x = gd.runs(i, ["image_id"], a).where("run_length >= 8").select(F.lit(a).alias("axis"), "image_id", F.col("run_line").alias("line"), F.col("run_start").alias("start"), F.col("run_length").alias("n")).distinct()
        out = x if out is None else out.unionByName(x)
    return out


_BOX = "bx AS (SELECT a.image_id, a.x, a.y, COUNT(*) AS n FROM ink a JOIN ink b ON a.image_id = b.image_id AND b.x BETWEEN a.x - 4 AND a.x + 4 AND b.y BETWEEN a.y - 4 AND a.y + 4 GROUP BY 1, 2, 3)"


@query("box_density", with_(INK, _BOX) + "SELECT image_id, x, y, n FROM bx")
def box_density(s, sf):
    raw = _raw(s, sf)
    parts = iv.tasks(raw)
    return gd.box_counts(ik.ink(raw, parts=parts), ["image_id"], 4, parts)


_THICK = """er AS (SELECT a.image_id, a.x, a.y FROM ink a JOIN ink b ON a.image_id = b.image_id AND b.x BETWEEN a.x - 2 AND a.x + 2 AND b.y BETWEEN a.y - 2 AND a.y + 2 GROUP BY 1, 2, 3
  HAVING COUNT(*) = (LEAST(a.x + 2, 169) - GREATEST(a.x - 2, 0) + 1) * (LEAST(a.y + 2, 169) - GREATEST(a.y - 2, 0) + 1)),
th AS (SELECT DISTINCT image_id, x + dx AS x, y + dy AS y FROM er, (SELECT UNNEST(range(-5, 6)) AS dx) p, (SELECT UNNEST(range(-5, 6)) AS dy) r WHERE x + dx BETWEEN 0 AND 169 AND y + dy BETWEEN 0 AND 169)"""


@query("thick_strokes", with_(INK, _THICK) + "SELECT image_id, x, y FROM th")
def thick_strokes(s, sf):
    return ik.thick(_ink(s, sf), SIZE, 2, 3)


@query("aligned_lines", with_(INK) + """
SELECT image_id, y, COUNT(*) AS n, MAX(x) - MIN(x) + 1 AS span FROM ink GROUP BY 1, 2 HAVING COUNT(*) >= 18 AND MAX(x) - MIN(x) + 1 >= 30 AND CAST(COUNT(*) AS DOUBLE) / (MAX(x) - MIN(x) + 1) BETWEEN 0.18 AND 0.8""")
def aligned_lines(s, sf):
    return ik.aligned_lines(_ink(s, sf), SIZE[0])


_ALIGN = _THICK + """,
tn AS (SELECT * FROM ink ANTI JOIN th USING (image_id, x, y)),
b9 AS (SELECT a.image_id, a.x, a.y FROM ink a JOIN ink b ON a.image_id = b.image_id AND b.x BETWEEN a.x - 9 AND a.x + 9 AND b.y BETWEEN a.y - 9 AND a.y + 9 GROUP BY 1, 2, 3
  HAVING CAST(COUNT(*) AS DOUBLE) / ((LEAST(a.x + 10, 170) - GREATEST(a.x - 9, 0)) * (LEAST(a.y + 10, 170) - GREATEST(a.y - 9, 0))) >= 0.30),
hr AS (SELECT image_id, y FROM tn GROUP BY 1, 2 HAVING COUNT(*) >= 18 AND MAX(x) - MIN(x) + 1 >= 30 AND CAST(COUNT(*) AS DOUBLE) / (MAX(x) - MIN(x) + 1) BETWEEN 0.18 AND 0.8),
vr AS (SELECT image_id, x FROM tn GROUP BY 1, 2 HAVING COUNT(*) >= 18 AND MAX(y) - MIN(y) + 1 >= 30 AND CAST(COUNT(*) AS DOUBLE) / (MAX(y) - MIN(y) + 1) BETWEEN 0.18 AND 0.8),
gn AS (SELECT DISTINCT t.image_id, t.x, t.y FROM (SELECT * FROM tn ANTI JOIN b9 USING (image_id, x, y)) t WHERE EXISTS (SELECT 1 FROM hr WHERE hr.image_id = t.image_id AND abs(hr.y - t.y) <= 3) OR EXISTS (SELECT 1 FROM vr WHERE vr.image_id = t.image_id AND abs(vr.x - t.x) <= 3))"""


@query("aligned_removal", with_(INK, _ALIGN) + "SELECT image_id, x, y FROM ink ANTI JOIN gn USING (image_id, x, y)")
def aligned_removal(s, sf):
    return ik.remove_aligned(_ink(s, sf), SIZE)


@query("hairline_removal", with_(INK, _RUNS) + """
, hc AS (SELECT 'h' AS axis, i.image_id, i.x, i.y, r.start FROM ink i JOIN ru r ON r.axis = 'h' AND r.image_id = i.image_id AND r.line = i.y AND i.x BETWEEN r.start AND r.start + r.n - 1 WHERE r.n >= 20 UNION ALL
 SELECT 'v', i.image_id, i.x, i.y, r.start FROM ink i JOIN ru r ON r.axis = 'v' AND r.image_id = i.image_id AND r.line = i.x AND i.y BETWEEN r.start AND r.start + r.n - 1 WHERE r.n >= 20),
sp AS (SELECT c.axis, c.image_id, c.x, c.y, c.start, COUNT(*) AS c FROM hc c JOIN ink b ON b.image_id = c.image_id AND ((c.axis = 'h' AND b.x = c.x AND b.y BETWEEN c.y - 3 AND c.y + 3) OR (c.axis = 'v' AND b.y = c.y AND b.x BETWEEN c.x - 3 AND c.x + 3)) GROUP BY ALL),
mn AS (SELECT *, AVG(c) OVER (PARTITION BY axis, image_id, start, CASE axis WHEN 'h' THEN y ELSE x END) AS mean FROM sp),
dn AS (SELECT a.image_id, a.x, a.y, COUNT(*) AS n FROM ink a JOIN ink b ON a.image_id = b.image_id AND b.x BETWEEN a.x - 10 AND a.x + 10 AND b.y BETWEEN a.y - 10 AND a.y + 10 GROUP BY 1, 2, 3),
gn AS (SELECT DISTINCT image_id, x, y FROM mn JOIN dn USING (image_id, x, y) WHERE mean <= 2.35 AND c <= 2 AND n < 60)
SELECT image_id, x, y FROM ink ANTI JOIN gn USING (image_id, x, y)""")
def hairline_removal(s, sf):
    return ik.remove_hairlines(_ink(s, sf), SIZE, min_run=20, dense_min=60)


def _thick_sql(name: str, source: str, erode: int, grow: int) -> str:
    e, g = erode, grow
    return f"""{name}_e AS (SELECT a.image_id, a.x, a.y FROM {source} a JOIN {source} b ON a.image_id = b.image_id AND b.x BETWEEN a.x - {e} AND a.x + {e} AND b.y BETWEEN a.y - {e} AND a.y + {e} GROUP BY 1, 2, 3
  HAVING COUNT(*) = (LEAST(a.x + {e}, 169) - GREATEST(a.x - {e}, 0) + 1) * (LEAST(a.y + {e}, 169) - GREATEST(a.y - {e}, 0) + 1)),
{name} AS (SELECT DISTINCT image_id, x + dx AS x, y + dy AS y FROM {name}_e, (SELECT UNNEST(range({-g}, {g + 1})) AS dx) p, (SELECT UNNEST(range({-g}, {g + 1})) AS dy) r WHERE x + dx BETWEEN 0 AND 169 AND y + dy BETWEEN 0 AND 169)"""


def _line_pass(name: str, source: str, a: str, b: str) -> str:
    """Runs along ``a`` on lines of ``b``; what is left is called ``name``."""
    return f"""{name}_c AS (SELECT * FROM {source} ANTI JOIN th4 USING (image_id, x, y)),
{name}_r AS (SELECT image_id, {b} AS ln, MIN({a}) AS s, MAX({a}) + 1 AS e FROM (SELECT *, {a} - ROW_NUMBER() OVER (PARTITION BY image_id, {b} ORDER BY {a}) AS g FROM {name}_c) GROUP BY image_id, {b}, g HAVING COUNT(*) >= 14),
{name}_s AS (SELECT r.image_id, r.ln, r.s, r.e, COUNT(*) FILTER (WHERE i.{b} BETWEEN ln - 3 AND ln + 3 AND i.{a} >= s AND i.{a} < e) AS k1, COUNT(*) AS k2 FROM {name}_r r JOIN {source} i ON i.image_id = r.image_id AND i.{b} BETWEEN ln - 10 AND ln + 10 AND i.{a} >= s - 10 AND i.{a} < e + 10 GROUP BY 1, 2, 3, 4),
{name}_g AS (SELECT * FROM {name}_s WHERE CAST(k1 AS DOUBLE) / ((LEAST(ln + 4, 170) - GREATEST(ln - 3, 0)) * (e - s)) <= 0.42 AND CAST(k2 AS DOUBLE) / ((LEAST(ln + 11, 170) - GREATEST(ln - 10, 0)) * (LEAST(e + 10, 170) - GREATEST(s - 10, 0))) < 0.25),
{name} AS (SELECT i.* FROM {source} i WHERE NOT EXISTS (SELECT 1 FROM {name}_g g JOIN {name}_c c ON c.image_id = g.image_id AND c.{b} = g.ln AND c.{a} >= g.s AND c.{a} < g.e WHERE c.image_id = i.image_id AND c.x = i.x AND c.y = i.y))"""


_BIG = "ok AS (SELECT image_id, lab FROM cc GROUP BY 1, 2 HAVING COUNT(*) >= {n})"


@query("line_run_removal", recursive(INK, _thick_sql("th4", "ink", 2, 4), _line_pass("l1", "ink", "x", "y"), _line_pass("l2", "l1", "y", "x"), components("cc", "l2", "image_id"), _BIG.format(n=8)) + "SELECT image_id, COUNT(*) AS cells FROM cc SEMI JOIN ok USING (image_id, lab) GROUP BY 1")
def line_run_removal(s, sf):
    return ik.remove_line_runs(_ink(s, sf), SIZE, min_run=14, dense_min=0.25).groupBy("image_id").agg(F.count("*").alias("cells"))


@query("small_component_removal", recursive(INK, components("cc", "ink", "image_id"), _BIG.format(n=40)) + "SELECT image_id, COUNT(*) AS cells FROM cc SEMI JOIN ok USING (image_id, lab) GROUP BY 1")
def small_component_removal(s, sf):
    return ik.remove_small(_ink(s, sf), 40).groupBy("image_id").agg(F.count("*").alias("cells"))


_LINECELLS = "lr AS (" + " UNION ALL ".join(
    f"SELECT image_id, x, y, '{a}' AS ax FROM (SELECT *, COUNT(*) OVER (PARTITION BY image_id, {line}, g) AS n FROM (SELECT *, {st} - ROW_NUMBER() OVER (PARTITION BY image_id, {line} ORDER BY {st}) AS g FROM tn6)) WHERE n >= {least}"
    for a, line, st, least in (("h", "y", "x", 14), ("v", "x", "y", 14), ("d", "(y - x)", "x", 12), ("a", "(y + x)", "x", 12))) + "),\nlc AS (SELECT DISTINCT image_id, x, y FROM lr)"
_MESH = """lk AS (SELECT DISTINCT image_id, x + dx AS x, y + dy AS y FROM lc, (SELECT UNNEST(range(-2, 3)) AS dx) p, (SELECT UNNEST(range(-2, 3)) AS dy) r WHERE x + dx BETWEEN 0 AND 169 AND y + dy BETWEEN 0 AND 169)"""
_MESH2 = """mbx AS (SELECT image_id, lab, MIN(x) AS x0, MIN(y) AS y0, MAX(x) AS x1, MAX(y) AS y1 FROM cc GROUP BY 1, 2 HAVING MAX(x) - MIN(x) + 1 >= 36 AND MAX(y) - MIN(y) + 1 >= 28),
mok AS (SELECT b.* FROM mbx b JOIN lr ON lr.image_id = b.image_id AND lr.x BETWEEN x0 AND x1 AND lr.y BETWEEN y0 AND y1 GROUP BY ALL HAVING COUNT(DISTINCT lr.y * 1000 + lr.x) >= 60 AND CAST(COUNT(DISTINCT lr.y * 1000 + lr.x) AS DOUBLE) / ((x1 - x0 + 1) * (y1 - y0 + 1)) >= 0.01 AND COUNT(DISTINCT ax) >= 2),
mgn AS (SELECT DISTINCT t.image_id, t.x, t.y FROM tn6 t JOIN mok b ON b.image_id = t.image_id AND t.x BETWEEN x0 - 3 AND x1 + 3 AND t.y BETWEEN y0 - 3 AND y1 + 3)"""
_THIN6 = "tn6 AS (SELECT * FROM ink ANTI JOIN th6 USING (image_id, x, y))"


@query("mesh_removal", recursive(INK, _thick_sql("th6", "ink", 2, 6), _THIN6, _LINECELLS, _MESH, components("cc", "lk", "image_id"), _MESH2) + "SELECT image_id, COUNT(*) AS cells FROM ink ANTI JOIN mgn USING (image_id, x, y) GROUP BY 1")
def mesh_removal(s, sf):
    return ik.remove_meshes(_ink(s, sf), SIZE, min_pixels=60, min_density=0.01).groupBy("image_id").agg(F.count("*").alias("cells"))


@query("speck_removal", recursive(INK, _thick_sql("th6", "ink", 2, 6), _THIN6, components("cc", "tn6", "image_id")) + """
, sm AS (SELECT image_id, lab FROM cc GROUP BY 1, 2 HAVING COUNT(*) < 45), nr AS (SELECT DISTINCT image_id, x + dx AS x, y + dy AS y FROM th6, (SELECT UNNEST(range(-7, 8)) AS dx) p, (SELECT UNNEST(range(-7, 8)) AS dy) r),
sf AS (SELECT DISTINCT cc.image_id, lab FROM cc JOIN nr ON nr.image_id = cc.image_id AND nr.x = cc.x AND nr.y = cc.y), gn AS (SELECT image_id, x, y FROM cc WHERE (image_id, lab) IN (SELECT image_id, lab FROM sm) AND (image_id, lab) NOT IN (SELECT image_id, lab FROM sf))
SELECT image_id, COUNT(*) AS cells FROM ink ANTI JOIN gn USING (image_id, x, y) GROUP BY 1""")
def speck_removal(s, sf):
    return ik.remove_specks(_ink(s, sf), SIZE).groupBy("image_id").agg(F.count("*").alias("cells"))


@query("main_growth", recursive(INK, components("cc", "ink", "image_id"), "boxes AS (SELECT image_id, lab, COUNT(*) AS area, MIN(x) AS x0, MIN(y) AS y0, MAX(x) AS x1, MAX(y) AS y1 FROM cc GROUP BY 1, 2 HAVING COUNT(*) >= 8)", growth(SIZE, 0.12, 4)) + "SELECT image_id, COUNT(*) AS cells FROM cc SEMI JOIN kept USING (image_id, lab) GROUP BY 1")
def main_growth(s, sf):
    return ik.grow_main(_ink(s, sf), SIZE).groupBy("image_id").agg(F.count("*").alias("cells"))
