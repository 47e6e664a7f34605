"""Drawing entities: geometry columns, and the vector table seen as plans of polylines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmstead.operators.keyed import sealed
from ohmstead.sources.tables import texts

# Layer names of the test plans by label, entity types by row.
LAYERS = ["MUR-EXT", "PORTE", "FENETRE-N", "COTES", "MOBILIER", "ESCALIER", "A-SUR-TOIT", "HACH", "CLOISON", "CARTOUCHE-X"]
TYPES = ["LINE", "LWPOLYLINE", "ARC", "INSERT"]
POINTS = {"LINE": 2, "LWPOLYLINE": 32, "ARC": 16, "INSERT": 4}
#: Vectors of one plan, so that the number of plans grows with the table.
PLAN_SIZE = 100
#: Divisors that keep the coordinates of folded vectors in one range.
FOLDED = {"LINE": 4, "LWPOLYLINE": 1, "ARC": 1, "INSERT": 2}
LINEAR = ["LINE", "LWPOLYLINE", "POLYLINE", "ARC", "CIRCLE", "ELLIPSE", "SPLINE"]
TEXTUAL = ["TEXT", "MTEXT", "DIMENSION", "LEADER", "MULTILEADER", "TABLE"]


def _at(a: Column, i: Column | int) -> Column:
    return F.get(a, F.lit(i) if isinstance(i, int) else i)


def closed_ring(points: Column, closed: Column) -> Column:
    """Points with the first one repeated when the line is closed and does not end there."""
    first, last = _at(points, 0), F.try_element_at(points, F.lit(-1))
    return F.when(closed & (F.size(points) >= 2) & ~((first["x"] == last["x"]) & (first["y"] == last["y"])), F.concat(points, F.array(first))).otherwise(points)


def edges(points: Column) -> Column:
    """Consecutive point pairs."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    return F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def length_of(es: Column) -> Column:
    return F.aggregate(es, F.lit(0.0), lambda acc, e: acc + F.sqrt((e["x2"] - e["x1"]) * (e["x2"] - e["x1"]) + (e["y2"] - e["y1"]) * (e["y2"] - e["y1"])))


def area_of(es: Column) -> Column:
    return F.abs(F.aggregate(es, F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def with_geometry(df: DataFrame) -> DataFrame:
    """Box, length with the closing edge, enclosed area, type flags."""
    xs, ys = F.transform("points", lambda p: p["x"]), F.transform("points", lambda p: p["y"])
    zero = F.lit(0.0)
    x = sealed(df.select(
        "*", F.size("points").alias("n_points"),
        F.coalesce(F.array_min(xs), zero).alias("bbox_min_x"), F.coalesce(F.array_min(ys), zero).alias("bbox_min_y"),
        F.coalesce(F.array_max(xs), zero).alias("bbox_max_x"), F.coalesce(F.array_max(ys), zero).alias("bbox_max_y"),
        edges(closed_ring(F.col("points"), F.col("closed"))).alias("_e"),
    ))
    w, h = F.col("bbox_max_x") - F.col("bbox_min_x"), F.col("bbox_max_y") - F.col("bbox_min_y")
    first, last = _at(F.col("points"), 0), F.try_element_at("points", F.lit(-1))
    ring = (F.size("points") >= 3) & (F.col("closed") | ((first["x"] == last["x"]) & (first["y"] == last["y"])))
    return x.select(
        *[c for c in x.columns if c != "_e"], w.alias("bbox_width"), h.alias("bbox_height"), F.sqrt(w * w + h * h).alias("bbox_diag"),
        length_of(F.col("_e")).alias("length"), F.when(ring, area_of(F.col("_e"))).otherwise(0.0).alias("area"),
        F.col("entity_type").isin(TEXTUAL).alias("is_textual"), F.col("entity_type").isin(LINEAR).alias("is_linear"),
    )


def arc_points(cx: Column, cy: Column, radius: Column, start: Column, end: Column, n: int = 40) -> Column:
    """Points of an arc from start to end angle in degrees, both ends included."""
    n = max(10, n)
    stop = F.when(end < start, end + 360.0).otherwise(end)
    a0, a1 = F.radians(start), F.radians(stop)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        (cx + radius * F.cos(a0 + (a1 - a0) * i / (n - 1))).alias("x"), (cy + radius * F.sin(a0 + (a1 - a0) * i / (n - 1))).alias("y")))


def circle_points(cx: Column, cy: Column, radius: Column, n: int = 96) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        (cx + radius * F.cos(F.lit(2.0) * F.pi() * i / (n - 1))).alias("x"), (cy + radius * F.sin(F.lit(2.0) * F.pi() * i / (n - 1))).alias("y")))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as polylines of whole-number points, ``PLAN_SIZE`` to a plan, far layers set apart.

    A vector with more components than its points need is folded: a coordinate sums every component whose
    place agrees with its own, so all of the vector counts.
    """
    e = texts(spark, sf, "embeddings")
    pick = lambda words, i: F.element_at(F.array(*[F.lit(w) for w in words]), (i + 1).cast("int"))
    vec, kind = F.col("vec_id"), pick(TYPES, F.col("vec_id") % 4)
    n, divisor = pick([POINTS[k] for k in TYPES], vec % 4), pick([FOLDED[k] for k in TYPES], vec % 4)
    scale = F.when(vec % 11 == 0, 4.0).otherwise(1000.0)
    shift = F.when(F.col("label") == 9, 6000.0).otherwise(0.0)
    folds = F.sequence(F.lit(0), F.ceil(F.size("embedding") / (n * 2)).cast("int") - 1)

    def folded(at: Column) -> Column:
        total = F.aggregate(folds, F.lit(0.0), lambda acc, j: acc + F.coalesce(F.floor(F.get("embedding", at + j * n * 2).cast("double") * scale).cast("double"), F.lit(0.0)))
        return F.floor(total / divisor).cast("double")

    pts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((folded(i * 2) + shift).alias("x"), folded(i * 2 + 1).alias("y")))
    return e.select(
        F.concat(F.lit("P"), F.floor(vec / PLAN_SIZE).cast("string")).alias("plan_id"), vec.alias("row_id"), pick(LAYERS, F.col("label")).alias("layer"),
        kind.alias("entity_type"), pts.alias("points"), ((vec % 7 == 0) & (vec % 4 == 1)).alias("closed"),
        F.when(vec % 4 == 2, (vec % 180).cast("double")).alias("arc_angle"), F.when(vec % 4 == 3, F.concat(F.lit("B"), (vec % 3).cast("string"))).alias("block_name"),
        F.when(vec % 9 == 0, F.lit("BLOC-PORTE")).otherwise(F.lit("")).alias("source_block"),
    )


def geometry(spark: SparkSession, sf: str) -> DataFrame:
    return with_geometry(entities(spark, sf))


def decisions(spark: SparkSession) -> DataFrame:
    """Review decision per layer of the test plans: a list as long as the layer names."""
    rows = [(name, "keep" if i < 3 else "drop" if i < 5 else "undecided") for i, name in enumerate(LAYERS)]
    return spark.createDataFrame(rows, "layer string, decision string")
