"""All named queries of the package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmstead.operators import clean, enrich, metrics, series
from ohmstead.plans import consumption, drawings, reports, rules
from ohmstead.plans.registry import Query
from ohmstead.sources import tables as t

MODULES = [consumption, reports, rules, drawings]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in MODULES:
        for name, q in m.CAT.items.items():
            if name in out:
                raise ValueError(f"query {name} registered twice")
            out[name] = q
    return out


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Daily usage enrichment, outlier cap and per-zone errors against the predictions."""
    log = enrich.name_log(t.daily_log(spark, sf), t.usages(spark), t.meters(spark))
    hist = enrich.enrich_history(t.zone_history(spark, sf), log, t.ZONE, consumption.USAGE_COLS)
    hist = enrich.total_accurate(hist)
    hist = hist.withColumn("elecTotalAccurateKwh", series.positive("elecTotalAccurateKwh"))
    capped = clean.cap_outliers(hist, t.ZONE, {"elecTotalKwh": 3.0, "elecTotalAccurateKwh": 3.0})
    pred = t.zone_pred(spark, sf).select(*t.ZONE, "date", F.col("totalKwh").alias("y_pred"))
    pairs = capped.withColumn("y_true", F.col("elecTotalKwh")).join(pred, [*t.ZONE, "date"])
    pairs = pairs.where("y_true > 0 AND y_pred > 0")
    return metrics.errors(pairs, t.ZONE, ["n", "MAE", "RMSE", "WAPE", "Bias", "R2"])
