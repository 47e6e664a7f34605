"""Adapters: the star-schema tables seen as meter logs, histories, weather and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITE = ["siteId"]
ZONE = ["siteId", "zoneId"]

# Usage and meter names the meter log refers to.
USAGES = [(0, "Bve"), (1, "Cvc"), (2, "Force"), (3, "Lighting"), (4, "Pc"), (5, "Process")]
METERS = [(1, "elec"), (2, "water"), (3, "eg"), (4, "ec")]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of texts, in the splits that ``spark.sql.files.maxPartitionBytes`` gives."""
    return table(spark, sf, name)


#: Rows of a narrow table that one task turns into many.
DEALT_ROWS = 1 << 13


def dealt(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """The same rows, dealt by a hash of the keys so that a task holds about ``rows`` of them, however few splits the file has.

    For rows that are exploded next: Spark sizes tasks by the bytes before that.
    """
    return df.repartition(max(1, -(-df.count() // (rows or DEALT_ROWS))), *keys)


#: Zones whose filled calendars one task holds, each of some thousand days.
DEALT_ZONES = 1 << 9


def dealt_zones(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    """Daily rows dealt by zone before their calendars are filled, which makes many rows of few bytes."""
    zones = table(spark, sf, "supplier").count()
    return df.repartition(max(1, -(-zones // DEALT_ZONES)), *ZONE)


def code_table(spark: SparkSession, rows: list[tuple[int, str]], key: str, name: str) -> DataFrame:
    """A few literal rows, which Spark knows the size of and so broadcasts."""
    values = ", ".join(f"({k}, '{v}')" for k, v in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({key}, {name})")


def usages(spark: SparkSession) -> DataFrame:
    return code_table(spark, USAGES, "usageId", "usage_name")


def meters(spark: SparkSession) -> DataFrame:
    return code_table(spark, METERS, "meterTypeId", "meter_name")


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("long").alias("siteId"), F.col("s_suppkey").alias("zoneId")
    )


def _log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("zoneId"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("consumption"),
        F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(6)).cast("int").alias("usageId"),
        (F.col("l_linenumber") % 4 + 1).cast("int").alias("meterTypeId"),
        F.when(F.col("l_linestatus") == "O", "zone").otherwise("site").alias("perimeter"),
    )


LOG_COLS = ["siteId", "zoneId", "perimeter", "date", "consumption", "usageId", "meterTypeId"]


def consumption_log(spark: SparkSession, sf: str) -> DataFrame:
    return _log_lines(spark, sf).join(_sites(spark, sf), "zoneId").select(*LOG_COLS)


def daily_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log summed per zone, day and codes before any join, so the few codes are never shuffle keys of raw rows."""
    summed = _log_lines(spark, sf).groupBy(*[c for c in LOG_COLS if c not in ("siteId", "consumption")]).agg(F.sum("consumption").alias("consumption"))
    return summed.join(_sites(spark, sf), "zoneId").select(*LOG_COLS)


def _when_sum(cond: Column, value: str) -> Column:
    return F.sum(F.when(cond, F.col(value)))


def zone_history(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (site, zone, day); summed per zone and day before the dimension join."""
    li = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("zoneId"),
        F.to_date("l_shipdate").alias("date"),
        F.floor(F.col("l_extendedprice") / 100).cast("double").alias("kwh"),
        F.col("l_quantity").alias("qty"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("temp"),
        "l_returnflag", "l_linestatus", "l_linenumber",
    )
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    daily = li.groupBy("zoneId", "date").agg(
        (F.avg("temp") * 3 + 10).alias("indoorTempDegC"),
        _when_sum(flag == "R", "qty").alias("elecBveKwh"),
        _when_sum(flag == "A", "qty").alias("elecCvcKwh"),
        _when_sum((flag == "N") & (line <= 3), "qty").alias("elecForceKwh"),
        _when_sum((flag == "N") & (line > 3), "qty").alias("elecLightingKwh"),
        _when_sum(F.col("l_linestatus") == "O", "kwh").alias("elecAggregatedKwh"),
        F.sum("kwh").alias("elecTotalKwh"),
        _when_sum(flag == "N", "qty").alias("waterM3"),
    )
    return daily.join(_sites(spark, sf), "zoneId").select("siteId", "zoneId", *[c for c in daily.columns if c != "zoneId"])


MEASURES = ["elecBveKwh", "elecCvcKwh", "elecForceKwh", "elecLightingKwh", "elecAggregatedKwh", "elecTotalKwh", "waterM3"]


def site_history(spark: SparkSession, sf: str) -> DataFrame:
    return zone_history(spark, sf).groupBy("siteId", "date").agg(
        F.max("indoorTempDegC").alias("indoorTempDegC"), *[F.sum(c).alias(c) for c in MEASURES]
    )


def zone_pred(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions from every line; those of open lines lie 45 days later, so the days differ from the history's."""
    li = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("zoneId"),
        F.date_add(F.to_date("l_shipdate"), F.when(F.col("l_linestatus") == "O", 45).otherwise(0)).alias("date"),
        F.floor(F.col("l_extendedprice") / 100).cast("double").alias("kwh"),
        F.col("l_quantity").alias("qty"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("temp"),
    )
    daily = li.groupBy("zoneId", "date").agg(
        F.sum("kwh").alias("totalKwh"), F.sum("qty").alias("totalWater"), (F.avg("temp") * 3 + 10).alias("tempAmb")
    )
    return daily.join(_sites(spark, sf), "zoneId").select("siteId", "zoneId", "date", "totalKwh", "totalWater", "tempAmb")


def site_pred(spark: SparkSession, sf: str) -> DataFrame:
    return zone_pred(spark, sf).groupBy("siteId", "date").agg(
        F.sum("totalKwh").alias("totalKwh"), F.sum("totalWater").alias("totalWater"), F.max("tempAmb").alias("tempAmb")
    )


WEATHER = ["tempAmb", "humidity", "djF", "djC", "tempMin", "tempMax", "chancePluie", "windSpeed"]


def weather_records(spark: SparkSession, sf: str) -> DataFrame:
    """Raw weather rows, several per site and day; ``seq`` is the order of arrival."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("siteId"))
    t = F.floor(F.col("o_totalprice") / 20000).cast("double")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "siteId",
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("seq"),
        t.alias("tempAmb"),
        (F.col("o_custkey") % 100).cast("double").alias("humidity"),
        F.greatest(F.lit(0.0), 18 - t).alias("djF"),
        F.greatest(F.lit(0.0), t - 18).alias("djC"),
        (t - 4).alias("tempMin"),
        (t + 5).alias("tempMax"),
        (F.col("o_orderkey") % 101).cast("double").alias("chancePluie"),
        (F.col("o_orderkey") % 37).cast("double").alias("windSpeed"),
    )


def site_info_records(spark: SparkSession, sf: str) -> DataFrame:
    bal = F.col("s_acctbal")
    return table(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("long").alias("siteId"),
        F.col("s_suppkey").alias("seq"),
        F.when(bal > 0, bal).alias("surface_m2"),
        F.col("s_name").alias("activity"),
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("context "), F.col("s_name"))).alias("context"),
    )
