"""Text tables with uncertain separators, and the sinks of every stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmstead.operators import enrich, series
from ohmstead.operators.keyed import first_known

# Texts that mean missing, and accepted names of the site table's columns.
MISSING = ["NULL", "null", ""]
SITE_NAMES = {
    "siteId": ["ID Site", "ID", "siteId", "SiteId", "id_site"], "surface_m2": ["Surface", "surface", "Surface (m2)", "Surface (m²)", "m2"],
    "activity": ["Activité", "Activite", "Activity"], "context": ["Info Contexte", "Contexte", "Context"],
}


def _separator(spark: SparkSession, path: str, required: Sequence[str] = ()) -> str:
    """The first of comma and semicolon whose header has several columns and the required names."""
    head = spark.read.text(path).limit(1).first()
    line = (head[0] if head else "").replace("﻿", "")
    for sep in (",", ";"):
        names = [c.strip().strip('"') for c in line.split(sep)]
        if len(names) > 1 and set(required) <= set(names):
            return sep
    raise ValueError(f"cannot read {path} as a table with columns {list(required) or 'more than one'}")


def _tidy(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, byte-order mark stripped, missing marks as NULL."""
    df = _tidy(spark.read.csv(path, sep=_separator(spark, path), header=True, inferSchema=False))
    return df.select(*[F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_lookup(spark: SparkSession, path: str, required: Sequence[str] = ("id", "name")) -> DataFrame:
    """A code table; lines that do not fit are skipped, rows without a numeric id too."""
    df = _tidy(spark.read.csv(path, sep=_separator(spark, path, required), header=True, inferSchema=True, mode="DROPMALFORMED"))
    if missing := set(required) - set(df.columns):
        raise ValueError(f"{path} lacks {sorted(missing)}")
    return df.select(F.col("id").cast("string").try_cast("int").alias("id"), F.col("name").cast("string").alias("name")).where("id IS NOT NULL")


def with_keys(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Numeric ids and a day column from ``date`` or ``dtUpdate``; rows without a key are dropped."""
    x = enrich.alias_keys(df)
    source = [c for c in ("date", "dtUpdate") if c in x.columns]
    if source:
        x = x.withColumn("date", F.coalesce(*[series.day(c) for c in source]))
    x = x.withColumns({c: F.col(c).cast("string").try_cast("long") for c in ids if c in x.columns})
    return x.dropna(subset=[c for c in [*ids, "date"] if c in x.columns])


def load_level(spark: SparkSession, folder: str, ids: Sequence[str], hist: str, pred: str, weather: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, predictions and weather of one level."""
    return (
        with_keys(read_table(spark, f"{folder}/{hist}"), ids), with_keys(read_table(spark, f"{folder}/{pred}"), ids),
        with_keys(read_table(spark, f"{folder}/{weather}"), ["siteId"]),
    )


def load_sites(spark: SparkSession, path: str) -> DataFrame:
    """One row per site from a table with several rows per site, whatever its column spelling."""
    df = (spark.read.parquet(path) if path.endswith(".parquet") else read_table(spark, path)).withColumn("_seq", F.monotonically_increasing_id())
    lower = {c.strip().lower(): c for c in df.columns}
    found = {k: next((lower[n.lower()] for n in names if n.lower() in lower), None) for k, names in SITE_NAMES.items()}
    text = lambda c: F.col(f"`{c}`").cast("string") if c else F.lit(None).cast("string")
    x = df.select(
        text(found["siteId"]).try_cast("long").alias("siteId"), series.number(text(found["surface_m2"])).alias("surface_m2"),
        text(found["activity"]).alias("activity"), text(found["context"]).alias("context"), F.col("_seq"))
    return first_known(x.dropna(subset=["siteId"]), ["siteId"], "_seq", ["surface_m2", "activity", "context"])


# ---- sinks ---------------------------------------------------------------------------------


def write_cleaned(cleaned: DataFrame, log: DataFrame, level: str, folder: str) -> None:
    """Cleaned table per level, its log by level and action."""
    cleaned.drop("log", "caps").withColumn("level", F.lit(level)).write.mode("overwrite").partitionBy("level").parquet(f"{folder}/cleaned_{level}")
    log.withColumn("level", F.lit(level)).write.mode("overwrite").partitionBy("level", "action").parquet(f"{folder}/cleaning_log_{level}")


def write_scores(df: DataFrame, kind: str, level: str, target: str, folder: str) -> None:
    """Predictions, metrics or forecasts, one folder per kind, by level and target."""
    df.withColumns({"level": F.lit(level), "target": F.lit(target)}).write.mode("append").partitionBy("level", "target").parquet(f"{folder}/{kind}")


def write_entities(entities: DataFrame, path: str) -> None:
    """Entity table without its geometry column."""
    entities.drop("points").write.mode("overwrite").option("header", True).csv(path)


def write_page_index(pages: DataFrame, path: str) -> None:
    """Page metadata as JSON lines."""
    cols = [c for c in ("page_id", "title", "notebook", "section", "section_group", "section_path") if c in pages.columns]
    pages.select(*cols, F.size("images").alias("num_images"), F.size("audio").alias("num_audio")).write.mode("overwrite").json(path)
