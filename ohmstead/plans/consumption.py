"""Queries over meter logs, histories, predictions and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.operators import clean, enrich, learn, metrics, ridge, series
from ohmstead.operators.keyed import first_known, keep_one, top_n
from ohmstead.plans.base_sql import LOG, SH, SI, SP, WX, ZH, ZP, with_
from ohmstead.plans.component_sql import jump_scan, recursive, spike_scan
from ohmstead.plans.registry import Catalogue
from ohmstead.sources import tables as t

CAT = Catalogue()
query = CAT.query

USAGE_COLS = enrich.usage_names(t.USAGES, t.METERS)
ELEC = [c for c in USAGE_COLS if c.startswith("elec") and c.endswith("Kwh")]
WATER = [c for c in USAGE_COLS if c.startswith("water")]
EC = [c for c in USAGE_COLS if c.startswith("ec")]
EG = [c for c in USAGE_COLS if c.startswith("eg")]


def _text_date(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _named(s: SparkSession, sf: str) -> DataFrame:
    return enrich.name_log(t.consumption_log(s, sf), t.usages(s), t.meters(s))


def _daily_named(s: SparkSession, sf: str) -> DataFrame:
    return enrich.name_log(t.daily_log(s, sf), t.usages(s), t.meters(s))


# ---- scans, coercion, sentinels ------------------------------------------------------------


@query("level_scan", with_(SH, SP, WX) + """
SELECT 'history' AS kind, CAST(date AS VARCHAR) AS date, COUNT(*) AS n, SUM("elecTotalKwh") AS total FROM sh GROUP BY 2
UNION ALL SELECT 'prediction', CAST(date AS VARCHAR), COUNT(*), SUM("totalKwh") FROM sp GROUP BY 2
UNION ALL SELECT 'weather', CAST(date AS VARCHAR), COUNT(*), SUM("tempAmb") FROM wx GROUP BY 2""")
def level_scan(s, sf):
    def norm(df, kind, col):
        x = df.withColumn("siteId", F.col("siteId").cast("string").try_cast("long")).withColumn("date", series.day("date"))
        return x.groupBy("date").agg(F.count("siteId").alias("n"), F.sum(col).alias("total")).select(
            F.lit(kind).alias("kind"), F.col("date").cast("string").alias("date"), "n", "total")

    return (norm(t.site_history(s, sf), "history", "elecTotalKwh")
            .unionByName(norm(t.site_pred(s, sf), "prediction", "totalKwh"))
            .unionByName(norm(t.weather_records(s, sf), "weather", "tempAmb")))


@query("role_rename", with_(ZH) + """SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, "elecTotalKwh", "waterM3", "elecBveKwh" FROM zh""")
def role_rename(s, sf):
    raw = t.zone_history(s, sf).withColumnsRenamed({"elecTotalKwh": "ACTIVE_KWH", "waterM3": " m3 ", "elecBveKwh": "bve_kwh"})
    out = enrich.rename_roles(raw, {"elec_total": "ACTIVE_KWH", "water_total": "m3", "bve": "bve_kwh"})
    return _text_date(out.select("siteId", "zoneId", "date", "elecTotalKwh", "waterM3", "elecBveKwh"), "date")


@query("key_alias", with_(ZH) + """SELECT "siteId", "zoneId", MIN(CAST(date AS VARCHAR)) AS date, COUNT(*) AS n FROM zh GROUP BY 1, 2""")
def key_alias(s, sf):
    raw = t.zone_history(s, sf).withColumnsRenamed({"siteId": "SITEID", "zoneId": "ZoneID", "date": "Date"})
    return enrich.alias_keys(raw).groupBy("siteId", "zoneId").agg(F.min(F.col("date").cast("string")).alias("date"), F.count("*").alias("n"))


@query("site_infos", with_(SI) + "SELECT * FROM si")
def site_infos(s, sf):
    return first_known(t.site_info_records(s, sf), ["siteId"], "seq", ["surface_m2", "activity", "context"])


@query("day_normalisation", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(NULL AS VARCHAR) AS bad_day FROM orders""")
def day_normalisation(s, sf):
    return t.table(s, sf, "orders").select(
        "o_orderkey",
        series.day(F.coalesce(F.lit(None).cast("string"), F.col("o_orderdate").cast("string"))).cast("string").alias("day"),
        series.day("o_orderpriority").cast("string").alias("bad_day"),
    )


@query("numeric_coercion", """
SELECT event_type, COUNT(*) AS n, COUNT(TRY_CAST(event_type AS DOUBLE)) AS n_type,
       COUNT(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS n_value, SUM(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k
FROM events GROUP BY 1""")
def numeric_coercion(s, sf):
    e = t.table(s, sf, "events")
    return e.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count(series.number("event_type")).alias("n_type"),
        F.count(series.number(F.col("value").cast("string"))).alias("n_value"),
        F.sum(series.number(F.get_json_object("props", "$.k"))).alias("k"),
    )


@query("missing_sentinels", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS strict, CASE WHEN c_acctbal - 1000 >= 0 THEN c_acctbal - 1000 END AS loose
FROM customer""")
def missing_sentinels(s, sf):
    return t.table(s, sf, "customer").select(
        "c_custkey", series.positive("c_acctbal").alias("strict"), series.positive(F.col("c_acctbal") - 1000, False).alias("loose"))


@query("plausible_band", with_(ZH) + """
SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, CASE WHEN "indoorTempDegC" - 12 BETWEEN 5 AND 20 THEN ROUND("indoorTempDegC" - 12, 6) END AS temp FROM zh""")
def plausible_band(s, sf):
    x = t.zone_history(s, sf)
    return _text_date(x.select("siteId", "zoneId", "date", F.round(series.band(F.col("indoorTempDegC") - 12, 5, 20), 6).alias("temp")), "date")


# ---- enrichment ----------------------------------------------------------------------------


@query("lookup_join", with_(LOG) + """SELECT "siteId", usage_col, perimeter, COUNT(*) AS n, SUM(consumption) AS total FROM named GROUP BY 1, 2, 3""")
def lookup_join(s, sf):
    return _named(s, sf).groupBy("siteId", "usage_col", "perimeter").agg(F.count("*").alias("n"), F.sum("consumption").alias("total"))


@query("usage_naming", """
WITH u AS (SELECT p_partkey, p_name || ' ' || p_type AS usage_name, CASE p_size % 5 WHEN 0 THEN 'elec' WHEN 1 THEN 'water' WHEN 2 THEN 'eg' WHEN 3 THEN 'ec' ELSE 'gas' END AS meter_name FROM part),
c AS (SELECT *, array_to_string(list_transform(list_filter(regexp_split_to_array(usage_name, '[^a-zA-Z0-9]+'), lambda x: x <> ''), lambda x: upper(x[1]) || x[2:]), '') AS camel FROM u)
SELECT p_partkey, CASE meter_name WHEN 'elec' THEN 'elec' || camel || 'Kwh' WHEN 'water' THEN 'water' || camel || 'M3' ELSE meter_name || camel END AS usage_col FROM c""")
def usage_naming(s, sf):
    sz = F.col("p_size") % 5
    meter = F.when(sz == 0, "elec").when(sz == 1, "water").when(sz == 2, "eg").when(sz == 3, "ec").otherwise("gas")
    x = t.table(s, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("usage_name"), meter.alias("meter_name"))
    return x.select("p_partkey", enrich.usage_column("meter_name", "usage_name").alias("usage_col"))


def _wide_sql(ids: str) -> str:
    cols = ", ".join(f"SUM(CASE WHEN usage_col = '{c}' THEN consumption END) AS \"{c}\"" for c in USAGE_COLS)
    fam = {"elecTotalFromDriftKwh": ELEC, "waterTotalFromDriftM3": WATER, "ecTotalFromDrift": EC, "egTotalFromDrift": EG}
    tot = ", ".join(
        f"CASE WHEN COALESCE({', '.join(chr(34) + c + chr(34) for c in cs)}) IS NOT NULL THEN {' + '.join(f'COALESCE({chr(34)}{c}{chr(34)}, 0)' for c in cs)} END AS \"{name}\""
        for name, cs in fam.items())
    return f"""wide0 AS (SELECT {ids}, date, {cols} FROM named WHERE perimeter = 'zone' GROUP BY {ids}, date),
wide AS (SELECT *, {tot} FROM wide0)"""


@query("daily_usage_zone", with_(LOG, _wide_sql('"siteId", "zoneId"')) + "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM wide")
def daily_usage_zone(s, sf):
    return _text_date(enrich.daily_usage_wide(_daily_named(s, sf), t.ZONE, USAGE_COLS), "date")


@query("daily_usage_site", with_(LOG, _wide_sql('"siteId"')) + "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM wide")
def daily_usage_site(s, sf):
    return _text_date(enrich.daily_usage_wide(_daily_named(s, sf), t.SITE, USAGE_COLS), "date")


@query("usage_mapping", with_(LOG) + """SELECT DISTINCT "usageId", usage_name, "meterTypeId", meter_name, usage_col FROM named ORDER BY 3, 1""")
def usage_mapping(s, sf):
    return _named(s, sf).select("usageId", "usage_name", "meterTypeId", "meter_name", "usage_col").distinct().orderBy("meterTypeId", "usageId")


_FILL = ", ".join(f'CASE WHEN h."{c}" IS NULL OR h."{c}" = 0 THEN w."{c}_drift" ELSE h."{c}" END AS "{c}"' for c in enrich.LEGACY_USES)


@query("enriched_history", with_(LOG, ZH, _wide_sql('"siteId", "zoneId"')) + f"""
, j AS (SELECT h."siteId", h."zoneId", h.date, h."elecTotalKwh", {_FILL}, w."elecTotalFromDriftKwh", w."waterTotalFromDriftM3"
        FROM zh h LEFT JOIN wide w ON h."siteId" = w."siteId" AND h."zoneId" = w."zoneId" AND h.date = w.date)
SELECT * REPLACE (CAST(date AS VARCHAR) AS date), CASE WHEN "elecTotalKwh" - COALESCE("elecBveKwh", 0) < 0 THEN 0 ELSE "elecTotalKwh" - COALESCE("elecBveKwh", 0) END AS "elecTotalNoBveKwh" FROM j""")
def enriched_history(s, sf):
    x = enrich.enrich_history(t.zone_history(s, sf), _daily_named(s, sf), t.ZONE, USAGE_COLS)
    cols = [*t.ZONE, "date", "elecTotalKwh", *enrich.LEGACY_USES, "elecTotalFromDriftKwh", "waterTotalFromDriftM3", "elecTotalNoBveKwh"]
    return _text_date(x.select(*cols), "date")


@query("total_accurate", with_(SH) + """
SELECT "siteId", CAST(date AS VARCHAR) AS date, "elecAggregatedKwh" AS "elecTotalAccurateKwh",
       CASE WHEN "elecAggregatedKwh" IS NULL THEN NULL ELSE GREATEST("elecAggregatedKwh" - COALESCE("elecBveKwh", 0), 0) END AS "elecTotalNoBveKwh" FROM sh""")
def total_accurate(s, sf):
    x = t.site_history(s, sf).withColumn("elecTotalFromDriftKwh", F.lit(None).cast("double"))
    return _text_date(enrich.total_without(enrich.total_accurate(x)).select("siteId", "date", "elecTotalAccurateKwh", "elecTotalNoBveKwh"), "date")


_FOUND = " UNION ALL ".join(
    [f"SELECT '{c}' AS target, COUNT(\"{c}\") AS n, false AS from_log FROM zh" for c in enrich.LEGACY_USES]
    + [f"SELECT '{c}', COUNT(\"{c}\"), true FROM wide" for c in USAGE_COLS if not c.endswith("_drift")])


@query("target_discovery", with_(LOG, ZH, _wide_sql('"siteId", "zoneId"')) + _FOUND)
def target_discovery(s, sf):
    def known(df, from_log):
        names = enrich.discover_targets(df.columns)
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("n"), F.lit(from_log).alias("from_log")) for c in names]))
        return df.agg(*[F.count(c).alias(c) for c in names]).select(rows.alias("r")).select("r.*")

    wide = enrich.daily_usage_wide(_daily_named(s, sf), t.ZONE, USAGE_COLS)
    return known(t.zone_history(s, sf), False).unionByName(known(wide, True))


@query("signal_groups", with_(ZH) + """
SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, "elecForceKwh" FROM zh
WHERE ("siteId", "zoneId") IN (SELECT "siteId", "zoneId" FROM zh GROUP BY 1, 2 HAVING MAX("elecForceKwh") > 0)""")
def signal_groups(s, sf):
    return _text_date(enrich.keep_signal(t.zone_history(s, sf), t.ZONE, "elecForceKwh").select(*t.ZONE, "date", "elecForceKwh"), "date")


# ---- joins, ranges, spines -----------------------------------------------------------------


@query("weather_join", with_(SH, WX) + """
SELECT sh."siteId", CAST(sh.date AS VARCHAR) AS date, "elecTotalKwh", "tempAmb", humidity, "windSpeed" FROM sh LEFT JOIN wxd ON sh."siteId" = wxd."siteId" AND sh.date = wxd.date""")
def weather_join(s, sf):
    w = keep_one(t.weather_records(s, sf).select("siteId", "date", "seq", "tempAmb", "humidity", "windSpeed"), ["siteId", "date"], ["seq"], last=True)
    return _text_date(t.site_history(s, sf).join(w, ["siteId", "date"], "left").select("siteId", "date", "elecTotalKwh", "tempAmb", "humidity", "windSpeed"), "date")


@query("static_join", with_(ZH, SI) + """
SELECT zh."siteId", zh."zoneId", COUNT(*) AS n, MAX(surface_m2) AS surface_m2, MAX(activity) AS activity FROM zh LEFT JOIN si ON zh."siteId" = si."siteId" GROUP BY 1, 2""")
def static_join(s, sf):
    infos = first_known(t.site_info_records(s, sf), ["siteId"], "seq", ["surface_m2", "activity", "context"])
    return t.zone_history(s, sf).join(infos, "siteId", "left").groupBy(*t.ZONE).agg(
        F.count("*").alias("n"), F.max("surface_m2").alias("surface_m2"), F.max("activity").alias("activity"))


@query("positive_pairs", with_(ZH, ZP) + """
SELECT zh."siteId", zh."zoneId", CAST(zh.date AS VARCHAR) AS date, "elecTotalKwh", "totalKwh" FROM zh JOIN zp ON zh."siteId" = zp."siteId" AND zh."zoneId" = zp."zoneId" AND zh.date = zp.date
WHERE "elecTotalKwh" > 0 AND "totalKwh" > 0""")
def positive_pairs(s, sf):
    j = t.zone_history(s, sf).select(*t.ZONE, "date", "elecTotalKwh").join(t.zone_pred(s, sf).select(*t.ZONE, "date", "totalKwh"), [*t.ZONE, "date"])
    return _text_date(j.where("elecTotalKwh > 0 AND totalKwh > 0"), "date")


@query("prediction_base", with_(SH, SP, WX) + """
SELECT sp."siteId", CAST(sp.date AS VARCHAR) AS date, "totalKwh", "totalWater", sp."tempAmb" AS "tempAmb_pred", "elecTotalKwh", "waterM3", wxd."tempAmb" AS "weath_tempAmb", wxd.humidity AS weath_humidity
FROM sp LEFT JOIN sh ON sp."siteId" = sh."siteId" AND sp.date = sh.date LEFT JOIN wxd ON sp."siteId" = wxd."siteId" AND sp.date = wxd.date""")
def prediction_base(s, sf):
    return _text_date(_site_base(s, sf).select(
        "siteId", "date", "totalKwh", "totalWater", F.col("tempAmb").alias("tempAmb_pred"), "elecTotalKwh", "waterM3", "weath_tempAmb", "weath_humidity"), "date")


def _site_base(s, sf):
    k = ["siteId", "date"]
    w = keep_one(t.weather_records(s, sf).select(*k, "seq", "tempAmb", "humidity"), k, ["seq"], last=True)
    w = w.select(*k, *[F.col(c).alias(f"weath_{c}") for c in ("tempAmb", "humidity")])
    return t.site_pred(s, sf).join(t.site_history(s, sf), k, "left").join(w, k, "left")


_RANGE = """rng AS (SELECT "siteId", "zoneId", MIN(date) AS start, MAX(date) AS "end" FROM (SELECT "siteId", "zoneId", date FROM zh WHERE "siteId" % 2 = 0 OR "zoneId" % 3 > 0 UNION ALL SELECT "siteId", "zoneId", date FROM zp) GROUP BY 1, 2)"""


@query("expected_range", with_(ZH, ZP, _RANGE.replace(' WHERE "siteId" % 2 = 0 OR "zoneId" % 3 > 0', "")) + """SELECT "siteId", "zoneId", CAST(start AS VARCHAR) AS start, CAST("end" AS VARCHAR) AS "end" FROM rng""")
def expected_range(s, sf):
    return _text_date(series.expected_range(t.zone_history(s, sf), t.zone_pred(s, sf), t.ZONE), "start", "end")


_SPINE = """rng AS (SELECT "siteId", MIN(date) AS start, MAX(date) AS "end" FROM (SELECT "siteId", date FROM sh UNION ALL SELECT "siteId", date FROM sp) GROUP BY 1),
spine AS (SELECT "siteId", CAST(UNNEST(generate_series(start, "end", INTERVAL 1 DAY)) AS DATE) AS date FROM rng),
al AS (SELECT spine."siteId", spine.date, "elecTotalKwh" AS value, "totalKwh" AS pred FROM spine LEFT JOIN sh ON spine."siteId" = sh."siteId" AND spine.date = sh.date LEFT JOIN sp ON spine."siteId" = sp."siteId" AND spine.date = sp.date)"""
_ZSPINE = _SPINE.replace('"siteId"', '"siteId", "zoneId"').replace('spine."siteId", "zoneId" = sh."siteId", "zoneId"', 'spine."siteId" = zh."siteId" AND spine."zoneId" = zh."zoneId"').replace('spine."siteId", "zoneId" = sp."siteId", "zoneId"', 'spine."siteId" = zp."siteId" AND spine."zoneId" = zp."zoneId"').replace("FROM sh", "FROM zh").replace("FROM sp)", "FROM zp)").replace("JOIN sh", "JOIN zh").replace("JOIN sp ", "JOIN zp ").replace("sh.date", "zh.date").replace("sp.date", "zp.date").replace('SELECT spine."siteId", "zoneId", spine.date', 'SELECT spine."siteId", spine."zoneId", spine.date').replace("GROUP BY 1)", "GROUP BY 1, 2)").replace('"elecTotalKwh" AS value', '"elecBveKwh" AS value').replace('"totalKwh" AS pred', '"totalWater" AS pred')


def _site_aligned(s, sf):
    return series.align(t.site_history(s, sf), t.site_pred(s, sf), t.SITE, "elecTotalKwh", "totalKwh")


def _zone_aligned(s, sf):
    return series.align(t.zone_history(s, sf), t.zone_pred(s, sf), t.ZONE, "elecBveKwh", "totalWater")


@query("calendar_spine", with_(ZH, ZP, _ZSPINE) + """SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, value, pred FROM al""")
def calendar_spine(s, sf):
    return _text_date(series.fill_calendar(_zone_aligned(s, sf), t.ZONE, ["value", "pred"]), "date")


@query("missing_run_before", with_(SH, SP, _SPINE) + """
SELECT "siteId", CAST(date AS VARCHAR) AS date, value,
  CAST(date - COALESCE(MAX(CASE WHEN value > 0 THEN date END) OVER (PARTITION BY "siteId" ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), MIN(date) OVER (PARTITION BY "siteId") - 1) - 1 AS BIGINT) AS gap_before
FROM al""")
def missing_run_before(s, sf):
    x = series.missing_before(series.fill_calendar(_site_aligned(s, sf), t.SITE, ["value"]), t.SITE)
    return _text_date(x.select("siteId", "date", "value", F.col("gap_before").cast("long").alias("gap_before")), "date")


@query("long_gaps", with_(ZH, ZP, _ZSPINE) + """
, m AS (SELECT *, date - CAST(ROW_NUMBER() OVER (PARTITION BY "siteId", "zoneId" ORDER BY date) AS INTEGER) AS g FROM al WHERE value IS NULL OR value <= 0)
SELECT "siteId", "zoneId", CAST(MIN(date) AS VARCHAR) AS gap_start, CAST(MAX(date) AS VARCHAR) AS gap_end, COUNT(*) AS gap_days FROM m GROUP BY 1, 2, g HAVING COUNT(*) >= 30 ORDER BY gap_days DESC""")
def long_gaps(s, sf):
    return _text_date(series.long_gaps(_zone_aligned(s, sf), t.ZONE), "gap_start", "gap_end").orderBy(F.desc("gap_days"))


# ---- cleaning ------------------------------------------------------------------------------


@query("cap_outliers", with_(ZH) + """
, b AS (SELECT "siteId", "zoneId", date, "elecTotalKwh" AS v,
   MEDIAN("elecTotalKwh") OVER w AS med, COUNT("elecTotalKwh") OVER w AS n FROM zh WINDOW w AS (PARTITION BY "siteId", "zoneId" ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, 'cap' AS action, v AS old, ROUND(3 * med, 6) AS new FROM b WHERE n >= 10 AND med >= 1 AND v > 3 * med""")
def cap_outliers(s, sf):
    x = clean.cap_outliers(t.zone_history(s, sf).select(*t.ZONE, "date", "elecTotalKwh"), t.ZONE, {"elecTotalKwh": 3.0})
    log = x.select(*t.ZONE, F.col("date").cast("string").alias("date"), F.explode("caps").alias("c"))
    return log.select(*t.ZONE, "date", F.lit("cap").alias("action"), F.col("c.old").alias("old"), F.round("c.new", 6).alias("new"))


def _spike_frame(s, sf, col, pred):
    days = series.align(t.zone_history(s, sf), t.zone_pred(s, sf), t.ZONE, col, pred)
    return series.fill_calendar(t.dealt_zones(s, sf, days), t.ZONE, ["value", "pred"])


_ZDAYS = """zr AS (SELECT "siteId", "zoneId", MIN(date) AS a, MAX(date) AS b FROM (SELECT "siteId", "zoneId", date FROM zh UNION ALL SELECT "siteId", "zoneId", date FROM zp) GROUP BY 1, 2),
zd AS (SELECT "siteId", "zoneId", a, CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM zr),
zv AS (SELECT zd."siteId", zd."zoneId", zd.a, zd.date, CAST(zd.date - zd.a AS BIGINT) AS i, "elecTotalKwh" AS v, "totalKwh" AS pred, zd."siteId" * 1000000 + zd."zoneId" AS z FROM zd
  LEFT JOIN zh ON zh."siteId" = zd."siteId" AND zh."zoneId" = zd."zoneId" AND zh.date = zd.date LEFT JOIN zp ON zp."siteId" = zd."siteId" AND zp."zoneId" = zd."zoneId" AND zp.date = zd.date)"""
_SPIKEIN = """sf AS (SELECT z, i, v, pred, LEAD(v) OVER w AS n1, LEAD(v, 2) OVER w AS n2, i - 1 - COALESCE(MAX(CASE WHEN v > 0 THEN i END) OVER (PARTITION BY z ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS gap FROM zv WINDOW w AS (PARTITION BY z ORDER BY i))"""
_JUMPIN = """jv AS (SELECT z, ROW_NUMBER() OVER (PARTITION BY z ORDER BY i) AS k, i, v, i - LAG(i) OVER (PARTITION BY z ORDER BY i) - 1 AS gap, MEDIAN(v) OVER (PARTITION BY z) AS med FROM zv WHERE v > 0)"""


@query("local_spikes", recursive(ZH, ZP, _ZDAYS, _SPIKEIN, spike_scan(6.0)) + """
SELECT zv."siteId", zv."zoneId", CAST(zv.date AS VARCHAR) AS date, 'local_spike_drop' AS action, zv.v AS old, ROUND(ref, 6) AS reference, gap AS gap_days FROM scan JOIN zv ON zv.z = scan.z AND zv.i = scan.i WHERE zv.v > 0 AND scan.m IS NULL""")
def local_spikes(s, sf):
    x = clean.drop_and_spread(_spike_frame(s, sf, "elecTotalKwh", "totalKwh"), t.ZONE, [clean.Rule("value", "pred", 6.0)])
    out = x.select(*t.ZONE, "date", F.explode("log").alias("e")).select(*t.ZONE, "date", "e.action", "e.old", "e.reference", "e.gap_days")
    return _text_date(_round(out, 6, "reference"), "date")


@query("spike_candidates", with_(ZH) + """
, rng AS (SELECT "siteId", "zoneId", MIN(date) a, MAX(date) b FROM zh GROUP BY 1, 2),
sp AS (SELECT "siteId", "zoneId", CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM rng),
f AS (SELECT sp."siteId", sp."zoneId", sp.date, "elecTotalKwh" AS v FROM sp LEFT JOIN zh ON sp."siteId" = zh."siteId" AND sp."zoneId" = zh."zoneId" AND sp.date = zh.date),
g AS (SELECT *, [x for x in [LAG(v,1) OVER w, LAG(v,2) OVER w, LEAD(v,1) OVER w, LEAD(v,2) OVER w] if x > 0] AS nb,
  date - COALESCE(MAX(CASE WHEN v > 0 THEN date END) OVER (PARTITION BY "siteId", "zoneId" ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), MIN(date) OVER (PARTITION BY "siteId", "zoneId") - 1) - 1 AS gap
  FROM f WINDOW w AS (PARTITION BY "siteId", "zoneId" ORDER BY date))
SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, v AS value, list_median(nb) AS near FROM g WHERE v > 0 AND len(nb) >= 2 AND v > list_median(nb) * CASE WHEN gap >= 30 THEN 3.6 ELSE 6 END""")
def spike_candidates(s, sf):
    x = series.fill_calendar(t.zone_history(s, sf).select(*t.ZONE, "date", F.col("elecTotalKwh").alias("value")), t.ZONE, ["value"])
    w = Window.partitionBy(*t.ZONE).orderBy("date")
    near = F.filter(F.array(*[f("value", k).over(w) for k in (1, 2) for f in (F.lag, F.lead)]), lambda v: v > 0)
    x = x.withColumn("hit", clean.spike_candidate(t.ZONE, clean.Rule("value", factor=6.0))).withColumn("near", clean._middle(near))
    return _text_date(x.where("hit").select(*t.ZONE, "date", "value", "near"), "date")


@query("spread_jumps", recursive(ZH, ZP, _ZDAYS, _JUMPIN, jump_scan(4.0)) + """
SELECT zv."siteId", zv."zoneId", CAST(zv.date AS VARCHAR) AS date, action, zv.v AS old, ROUND(CASE WHEN action = 'spread' THEN zv.v / (gap + 1) END, 6) AS new, ROUND(ref, 6) AS reference, gap AS gap_days, gap + 1 AS span_days
FROM jump JOIN zv ON zv.z = jump.z AND zv.i = jump.i WHERE action <> ''""")
def spread_jumps(s, sf):
    lim = clean.Limits(spread_factor=4.0)
    x = clean.drop_and_spread(_spike_frame(s, sf, "elecTotalKwh", "totalKwh"), t.ZONE, [clean.Rule("value", passes=0, spread=True)], lim)
    out = x.select(*t.ZONE, "date", F.explode("log").alias("e")).select(*t.ZONE, "date", "e.*").drop("value_col")
    return _text_date(_round(out, 6, "new", "reference"), "date")


_CEIL = """c AS (SELECT *, CASE WHEN COUNT(value) OVER w >= 4 THEN MEDIAN(value) OVER w END AS roll FROM al WINDOW w AS (PARTITION BY "siteId" ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
d AS (SELECT *, LEAST(pred * 1.5, roll * 3) AS cap FROM c)"""


@query("point_ceiling", with_(SH, SP, _SPINE, _CEIL) + """
SELECT "siteId", CAST(date AS VARCHAR) AS date, value AS old, ROUND(cap, 6) AS new, ROUND(roll, 6) AS roll_med, pred FROM d WHERE value > 0 AND cap > 0 AND value > cap""")
def point_ceiling(s, sf):
    x = clean.clip_to_ceiling(_site_aligned(s, sf), t.SITE, "value", "pred", pred_factor=1.5, roll_factor=3.0)
    return _text_date(x.where("old IS NOT NULL").select(
        "siteId", "date", "old", F.round("value", 6).alias("new"), F.round("roll_med", 6).alias("roll_med"), "pred"), "date")


_UNIT = """al0 AS (SELECT "siteId", date, SUM(v) AS value, SUM(p) AS pred FROM (
  SELECT "siteId", date, CASE WHEN "siteId" % 3 = 0 THEN "elecTotalKwh" * 1000 ELSE "elecTotalKwh" END AS v, NULL AS p FROM sh UNION ALL SELECT "siteId", date, NULL, "totalKwh" FROM sp) GROUP BY 1, 2),
prs AS (SELECT *, value / pred AS ratio FROM al0 WHERE value > 0 AND pred > 0),
med AS (SELECT "siteId", MEDIAN(ratio) AS m, COUNT(*) AS pairs FROM prs GROUP BY 1 HAVING COUNT(*) >= 20),
sc AS (SELECT *, ABS(LOG10(m)) s0, ABS(LOG10(m / 1000)) s1, ABS(LOG10(m / 1000000)) s2 FROM med),
ch AS (SELECT "siteId", m, pairs, CASE WHEN s1 <= s2 THEN 1000.0 ELSE 1000000.0 END AS d FROM sc WHERE LEAST(s1, s2) < s0 AND LEAST(s1, s2) < LOG10(3) AND LEAST(s1, s2) + 0.15 < s0),
fx AS (SELECT ch."siteId", ANY_VALUE(m) AS m, ANY_VALUE(pairs) AS pairs, CAST(ANY_VALUE(d) AS DOUBLE) AS d, AVG(CASE WHEN ABS(LOG10(ratio / d)) <= LOG10(3) THEN 1.0 ELSE 0.0 END) AS prop FROM ch JOIN prs ON ch."siteId" = prs."siteId" GROUP BY 1)"""


def _unit_frame(s, sf):
    h = t.site_history(s, sf).withColumn("elecTotalKwh", F.when(F.col("siteId") % 3 == 0, F.col("elecTotalKwh") * 1000).otherwise(F.col("elecTotalKwh")))
    return series.align(h, t.site_pred(s, sf), t.SITE, "elecTotalKwh", "totalKwh")


@query("unit_fix_groups", with_(SH, SP, _UNIT) + """SELECT "siteId", ROUND(m, 6) AS median_ratio, pairs, d AS divisor, ROUND(prop, 6) AS prop_close, prop >= 0.6 AS whole_group FROM fx""")
def unit_fix_groups(s, sf):
    return _round(clean.unit_by_prediction(_unit_frame(s, sf), t.SITE), 6, "median_ratio", "prop_close")


@query("unit_fix_values", with_(SH, SP, _UNIT) + """
SELECT a."siteId", CAST(a.date AS VARCHAR) AS date, ROUND(CASE WHEN value > 0 AND d IS NOT NULL AND (prop >= 0.6 OR pred > 0) THEN value / d ELSE value END, 6) AS new_value FROM al0 a LEFT JOIN fx ON a."siteId" = fx."siteId" """)
def unit_fix_values(s, sf):
    x = _unit_frame(s, sf)
    out = clean.apply_unit(x, clean.unit_by_prediction(x, t.SITE), t.SITE)
    return _text_date(out.select("siteId", "date", F.round("new_value", 6).alias("new_value")), "date")


@query("unit_fallback", with_(ZH) + """
, v AS (SELECT "siteId", "zoneId", date, CASE WHEN "elecBveKwh" > 45 THEN "elecBveKwh" * 1000 ELSE "elecBveKwh" END AS value FROM zh),
m AS (SELECT "siteId", "zoneId", MEDIAN(value) AS med FROM v WHERE value > 0 GROUP BY 1, 2)
SELECT v."siteId", v."zoneId", CAST(date AS VARCHAR) AS date, value AS old, value / 1000 AS new FROM v JOIN m ON v."siteId" = m."siteId" AND v."zoneId" = m."zoneId" WHERE value / med > 200 AND value / 1000 / med <= 200""")
def unit_fallback(s, sf):
    b = F.col("elecBveKwh")
    x = t.zone_history(s, sf).select(*t.ZONE, "date", F.when(b > 45, b * 1000).otherwise(b).alias("value"))
    out = clean.unit_by_median(x, t.ZONE, divisors=(10.0, 1000.0)).where("divisor IS NOT NULL")
    return _text_date(out.select(*t.ZONE, "date", F.col("value").alias("old"), F.col("new_value").alias("new")), "date")


@query("clean_level_site")
def clean_level_site(s, sf):
    x = clean.clean_level(t.site_history(s, sf), t.site_pred(s, sf), t.SITE)
    return _text_date(x.drop("log", "caps", "totalKwh", "totalWater"), "date")


@query("cleaning_log_counts")
def cleaning_log_counts(s, sf):
    x = clean.clean_level(t.site_history(s, sf), t.site_pred(s, sf), t.SITE)
    return clean.cleaning_log(x, t.SITE).groupBy("value_col", "action").agg(F.count("*").alias("n"))


# ---- features ------------------------------------------------------------------------------


@query("lag_features", with_(ZH) + """
SELECT "siteId", "zoneId", CAST(date AS VARCHAR) AS date, LAG(v, 1) OVER w AS lag_1, LAG(v, 2) OVER w AS lag_2, LAG(v, 7) OVER w AS lag_7, LAG(v, 14) OVER w AS lag_14
FROM (SELECT *, "elecTotalKwh" AS v FROM zh) WINDOW w AS (PARTITION BY "siteId", "zoneId" ORDER BY date)""")
def lag_features(s, sf):
    x = series.add_lags(t.zone_history(s, sf).select(*t.ZONE, "date", "elecTotalKwh"), t.ZONE, "elecTotalKwh")
    return _text_date(x.drop("elecTotalKwh"), "date")


@query("lag_features_by_day", with_(ZH) + """
SELECT a."siteId", a."zoneId", CAST(a.date AS VARCHAR) AS date, b."elecTotalKwh" AS lag_1, c."elecTotalKwh" AS lag_7 FROM zh a
LEFT JOIN zh b ON a."siteId" = b."siteId" AND a."zoneId" = b."zoneId" AND b.date = a.date - 1 LEFT JOIN zh c ON a."siteId" = c."siteId" AND a."zoneId" = c."zoneId" AND c.date = a.date - 7""")
def lag_features_by_day(s, sf):
    x = series.add_lags(t.zone_history(s, sf).select(*t.ZONE, "date", "elecTotalKwh"), t.ZONE, "elecTotalKwh", (1, 7), mode="days")
    return _text_date(x.drop("elecTotalKwh"), "date")


_ROLL = ", ".join(
    f"ROUND(CASE WHEN COUNT(v) OVER w{k} >= {max(2, k // 3)} THEN MEDIAN(v) OVER w{k} END, 6) AS roll_med_{k}, ROUND(CASE WHEN COUNT(v) OVER w{k} >= {max(2, k // 3)} THEN AVG(v) OVER w{k} END, 6) AS roll_mean_{k}"
    for k in series.ROLLS)
_ROLLW = ", ".join(f'w{k} AS (PARTITION BY "siteId" ORDER BY date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)' for k in series.ROLLS)


@query("rolling_features", with_(SH) + f"""SELECT "siteId", CAST(date AS VARCHAR) AS date, {_ROLL} FROM (SELECT *, "elecBveKwh" AS v FROM sh) WINDOW {_ROLLW}""")
def rolling_features(s, sf):
    x = series.add_rolling(t.site_history(s, sf).select("siteId", "date", "elecBveKwh"), t.SITE, "elecBveKwh").drop("elecBveKwh")
    return _text_date(_round(x, 6, *[c for c in x.columns if c.startswith("roll_")]), "date")


@query("calendar_features", """
SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, CAST(isodow(l_shipdate) - 1 AS INTEGER) AS dow, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(dayofyear(l_shipdate) AS INTEGER) AS dayofyear, CAST(isodow(l_shipdate) >= 6 AS INTEGER) AS is_weekend FROM lineitem""")
def calendar_features(s, sf):
    x = t.table(s, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return _text_date(series.add_calendar(x), "date")


_FEAT = """y AS (SELECT "siteId", date, "waterM3" AS v FROM sh WHERE "waterM3" IS NOT NULL),
fr AS (SELECT *, """ + ", ".join(f"LAG(v, {k}) OVER o AS lag_{k}" for k in series.LAGS) + ", " + _ROLL + f""" FROM y WINDOW o AS (PARTITION BY "siteId" ORDER BY date), {_ROLLW}),
ff AS (SELECT * FROM fr WHERE lag_14 IS NOT NULL AND roll_med_30 IS NOT NULL AND roll_med_7 IS NOT NULL AND roll_med_14 IS NOT NULL)"""


@query("feature_frame", with_(SH, WX, SI, _FEAT) + """
SELECT ff."siteId", CAST(ff.date AS VARCHAR) AS date, v AS y, lag_1, lag_14, roll_med_7, roll_mean_30, "tempAmb", surface_m2,
 CASE WHEN ff.date <= (SELECT MAX(date) FROM ff) - 60 THEN 'train' ELSE 'valid' END AS part, CAST((SELECT MAX(date) FROM ff) - 60 AS VARCHAR) AS cutoff
FROM ff LEFT JOIN wxd ON ff."siteId" = wxd."siteId" AND ff.date = wxd.date LEFT JOIN si ON ff."siteId" = si."siteId" """)
def feature_frame(s, sf):
    infos = first_known(t.site_info_records(s, sf), ["siteId"], "seq", ["surface_m2", "activity", "context"])
    h = t.site_history(s, sf).join(infos, "siteId", "left")
    x = series.split_last_days(learn.feature_frame(h, t.weather_records(s, sf), t.SITE, "waterM3"))
    out = x.select("siteId", "date", "y", "lag_1", "lag_14", "roll_med_7", "roll_mean_30", "tempAmb", "surface_m2", "part", "cutoff")
    return _text_date(_round(out, 6, "roll_med_7", "roll_mean_30"), "date", "cutoff")


@query("signal_gates", with_(ZH) + """
, p AS (SELECT COUNT(CASE WHEN "elecTotalKwh" > 0 THEN 1 END) a, COUNT(CASE WHEN "elecBveKwh" > 0 THEN 1 END) b, COUNT(CASE WHEN "elecForceKwh" > 0 THEN 1 END) c FROM zh)
SELECT 'elecTotalKwh' AS target, a AS positives, false AS discovered, true AS trained FROM p UNION ALL SELECT 'elecBveKwh', b, true, b >= 50 FROM p UNION ALL SELECT 'elecForceKwh', c, true, c >= 50 FROM p""")
def signal_gates(s, sf):
    return learn.signal_gates(t.zone_history(s, sf), ["elecTotalKwh", "elecBveKwh", "elecForceKwh"])


@query("forecast_horizon", with_(SH, WX) + """
, h AS (SELECT DISTINCT "siteId" FROM sh), r AS (SELECT "siteId", MAX(date) AS reach FROM wx GROUP BY 1), l AS (SELECT MAX(date) - 900 AS last_date FROM sh)
SELECT h."siteId", CAST(last_date AS VARCHAR) AS last_date, CAST(COALESCE(LEAST(GREATEST(reach - last_date, 0), 400), 0) AS BIGINT) AS horizon FROM h CROSS JOIN l LEFT JOIN r ON h."siteId" = r."siteId" """)
def forecast_horizon(s, sf):
    h = t.site_history(s, sf).select("siteId", F.date_sub("date", 900).alias("date"))
    return _text_date(series.horizon(h, t.weather_records(s, sf), t.SITE, 400), "last_date")


@query("id_codes", """SELECT DISTINCT l_suppkey AS "zoneId", CAST(DENSE_RANK() OVER (ORDER BY l_suppkey) - 1 AS BIGINT) AS code FROM lineitem""")
def id_codes(s, sf):
    return learn.id_codes(t.table(s, sf, "lineitem").select(F.col("l_suppkey").alias("zoneId")), "zoneId")


# ---- metrics -------------------------------------------------------------------------------

_EVAL = """ev AS (SELECT zh."siteId", zh."zoneId", zh.date, "elecBveKwh" AS y_true, "totalWater" AS y_pred FROM zh JOIN zp ON zh."siteId" = zp."siteId" AND zh."zoneId" = zp."zoneId" AND zh.date = zp.date WHERE "elecBveKwh" IS NOT NULL)"""
_ERR = {
    "n": "COUNT(*)", "MAE": "AVG(ABS(y_pred - y_true))", "RMSE": "SQRT(AVG((y_pred - y_true) * (y_pred - y_true)))",
    "WAPE": "CASE WHEN SUM(ABS(y_true)) > 0 THEN SUM(ABS(y_pred - y_true)) / SUM(ABS(y_true)) END",
    "MAPE": "100 * AVG(CASE WHEN ABS(y_true) > 1e-9 THEN ABS(y_pred - y_true) / ABS(y_true) END)",
    "Bias": "AVG(y_pred - y_true)", "MedAE": "MEDIAN(ABS(y_pred - y_true))",
    "R2": "CASE WHEN SUM(y_true * y_true) - SUM(y_true) * AVG(y_true) > 0 THEN 1 - SUM((y_pred - y_true) * (y_pred - y_true)) / (SUM(y_true * y_true) - SUM(y_true) * AVG(y_true)) END",
    "sMAPE": "200 * AVG(CASE WHEN ABS(y_true) + ABS(y_pred) > 0 THEN ABS(y_pred - y_true) / (ABS(y_true) + ABS(y_pred)) END)",
}


def _err_sql(names, digits=6):
    return ", ".join(f'{_ERR[n]} AS "{n}"' if n == "n" else f'ROUND({_ERR[n]}, {digits}) AS "{n}"' for n in names)


def _eval(s, sf):
    j = t.zone_history(s, sf).select(*t.ZONE, "date", F.col("elecBveKwh").alias("y_true")).dropna()
    return j.join(t.zone_pred(s, sf).select(*t.ZONE, "date", F.col("totalWater").alias("y_pred")), [*t.ZONE, "date"])


@query("group_metrics", with_(ZH, ZP, _EVAL) + f"""SELECT "siteId", "zoneId", {_err_sql(["n", "MAE", "RMSE", "WAPE", "MAPE", "Bias", "R2"])} FROM ev GROUP BY 1, 2""")
def group_metrics(s, sf):
    names = ["n", "MAE", "RMSE", "WAPE", "MAPE", "Bias", "R2"]
    return _round(metrics.errors(_eval(s, sf), t.ZONE, names), 6, *names[1:])


@query("global_metrics", with_(ZH, ZP, _EVAL, SI) + f"""
, g AS (SELECT 'elecBveKwh' AS target, {_err_sql(["n", "MAE", "RMSE", "WAPE", "Bias", "sMAPE", "R2", "MedAE"], 5)} FROM ev),
m2 AS (SELECT ROUND(AVG(ABS(y_pred / surface_m2 - y_true / surface_m2)), 5) AS "MAE_m2", ROUND(SQRT(AVG(POW(y_pred / surface_m2 - y_true / surface_m2, 2))), 5) AS "RMSE_m2",
  ROUND(SUM(ABS(y_pred / surface_m2 - y_true / surface_m2)) / SUM(ABS(y_true / surface_m2)), 5) AS "WAPE_m2" FROM ev JOIN si ON ev."siteId" = si."siteId" WHERE surface_m2 > 0)
SELECT * FROM g, m2""")
def global_metrics(s, sf):
    infos = first_known(t.site_info_records(s, sf), ["siteId"], "seq", ["surface_m2"])
    x = _eval(s, sf).join(infos, "siteId", "left").withColumn("target", F.lit("elecBveKwh"))
    out = metrics.global_report(x, ["target"], "surface_m2")
    return _round(out, 5, *[c for c in out.columns if c not in ("target", "n")])


@query("baseline_metrics", with_(SH, SP, WX) + """
, b AS (SELECT sp."siteId", "totalKwh", "totalWater", sp."tempAmb" AS ta, "elecTotalKwh", "waterM3", wxd."tempAmb" AS wt FROM sp LEFT JOIN sh ON sp."siteId" = sh."siteId" AND sp.date = sh.date LEFT JOIN wxd ON sp."siteId" = wxd."siteId" AND sp.date = wxd.date),
u AS (SELECT "siteId", 'totalKwh' AS pred_col, 'elecTotalKwh' AS true_col, "elecTotalKwh" AS y_true, "totalKwh" AS y_pred FROM b UNION ALL SELECT "siteId", 'totalWater', 'waterM3', "waterM3", "totalWater" FROM b UNION ALL SELECT "siteId", 'tempAmb', 'weath_tempAmb', wt, ta FROM b)
SELECT "siteId", pred_col, true_col, COUNT(y_true) AS n, """ + _err_sql(["MAE", "RMSE", "MAPE", "Bias"], 5) + ' FROM u GROUP BY 1, 2, 3 ORDER BY "RMSE" DESC')
def baseline_metrics(s, sf):
    pairs = {"totalKwh": "elecTotalKwh", "totalWater": "waterM3", "tempAmb": "weath_tempAmb"}
    return _round(metrics.pair_errors(_site_base(s, sf), pairs, ["siteId"]), 5, "MAE", "RMSE", "MAPE", "Bias").orderBy(F.desc("RMSE"))


_USES = """us AS (SELECT "siteId", date, SUM(COALESCE(v, 0)) AS p FROM (SELECT "siteId", date, UNNEST(["elecBveKwh", "elecCvcKwh", "elecForceKwh", "elecLightingKwh"]) AS v FROM sh) GROUP BY 1, 2),
cmp AS (SELECT sh."siteId", "elecTotalKwh" AS y_true, "totalKwh" AS d, GREATEST(COALESCE(p, 0), 0) AS s FROM sh JOIN sp ON sh."siteId" = sp."siteId" AND sh.date = sp.date LEFT JOIN us ON sh."siteId" = us."siteId" AND sh.date = us.date),
agg AS (SELECT "siteId", COUNT(*) AS n, SQRT(AVG((y_true - d) * (y_true - d))) AS rd, SQRT(AVG((y_true - s) * (y_true - s))) AS rs, SUM(ABS(y_true - d)) / SUM(ABS(y_true)) AS wd, SUM(ABS(y_true - s)) / SUM(ABS(y_true)) AS ws FROM cmp GROUP BY 1)"""


def _compare(s, sf):
    k = ["siteId", "date"]
    h = t.site_history(s, sf)
    total = h.join(t.site_pred(s, sf), k).select(*k, F.col("elecTotalKwh").alias("y_true"), F.col("totalKwh").alias("y_pred"))
    uses = h.select(*k, F.explode(F.array(*enrich.LEGACY_USES)).alias("y_pred"))
    return metrics.compare_sum_of_uses(total, uses, t.SITE)


@query("direct_vs_uses", with_(SH, SP, _USES) + """
SELECT "siteId", n, ROUND(rd, 5) AS "RMSE_direct", ROUND(rs, 5) AS "RMSE_sumUses", ROUND(wd, 5) AS "WAPE_direct", ROUND(ws, 5) AS "WAPE_sumUses",
 ROUND(CASE WHEN rd <> 0 THEN (rd - rs) / rd * 100 END, 5) AS "RMSE_improvement", ROUND(CASE WHEN wd <> 0 THEN (wd - ws) / wd * 100 END, 5) AS "WAPE_improvement" FROM agg""")
def direct_vs_uses(s, sf):
    x = _compare(s, sf)
    return _round(x, 5, *[c for c in x.columns if c not in ("siteId", "n")])


@query("worst_groups", with_(ZH, ZP, _EVAL) + """
, g AS (SELECT "siteId", "zoneId", SQRT(AVG((y_pred - y_true) * (y_pred - y_true))) AS r, SUM(ABS(y_pred - y_true)) / SUM(ABS(y_true)) AS w FROM ev GROUP BY 1, 2),
u AS (SELECT "siteId", "zoneId", 'RMSE' AS metric, r AS v FROM g UNION ALL SELECT "siteId", "zoneId", 'WAPE', w FROM g)
SELECT "siteId", "zoneId", metric, ROUND(v, 6) AS value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY v DESC, "zoneId") AS rank FROM u) WHERE rank <= 50""")
def worst_groups(s, sf):
    g = metrics.errors(_eval(s, sf), t.ZONE, ["RMSE", "WAPE"])
    long = g.unpivot(t.ZONE, ["RMSE", "WAPE"], "metric", "value")
    return _round(top_n(long, ["metric"], [F.desc("value"), F.col("zoneId")], 50), 6, "value")


@query("plot_caps", with_(ZH, ZP, _EVAL) + """
, v AS (SELECT UNNEST([y_true, y_pred]) AS x FROM ev), q AS (SELECT quantile_cont(x, 0.25) q1, quantile_cont(x, 0.75) q3, quantile_cont(x, 0.95) p95, quantile_cont(x, 0.99) p99 FROM v),
l AS (SELECT GREATEST(LEAST(p99, q3 + 10 * GREATEST(q3 - q1, 1e-12)), 1e-6) AS f, GREATEST(LEAST(p95, q3 + 10 * GREATEST(q3 - q1, 1e-12)), 1e-6) AS z FROM q)
SELECT 'elecBveKwh' AS target, ROUND(f, 6) AS lim_full, ROUND(LEAST(z, f), 6) AS lim_zoom FROM l""")
def plot_caps(s, sf):
    return _round(metrics.plot_caps(_eval(s, sf).withColumn("target", F.lit("elecBveKwh")), ["target"]), 6, "lim_full", "lim_zoom")


def _hist_sql(p):
    return f"""
, q AS (SELECT quantile_cont(x, {p}) AS lim FROM (SELECT UNNEST([y_true, y_pred]) AS x FROM ev)), nb AS (SELECT CASE WHEN COUNT(*) > 5000 THEN 80 ELSE 60 END AS bins FROM ev),
b AS (SELECT LEAST(FLOOR(y_true / lim * bins), bins - 1) AS bx, LEAST(FLOOR(y_pred / lim * bins), bins - 1) AS by_ FROM ev, q, nb WHERE y_true BETWEEN 0 AND lim AND y_pred BETWEEN 0 AND lim)
SELECT 'elecBveKwh' AS target, CAST(bx AS BIGINT) AS bx, CAST(by_ AS BIGINT) AS "by", COUNT(*) AS n FROM b GROUP BY 2, 3"""


def _targeted(s, sf):
    return _eval(s, sf).withColumn("target", F.lit("elecBveKwh"))


@query("parity_p99", with_(ZH, ZP, _EVAL) + _hist_sql(0.99))
def parity_p99(s, sf):
    return metrics.parity_histogram(_targeted(s, sf), ["target"], 0.99)


@query("parity_p95", with_(ZH, ZP, _EVAL) + _hist_sql(0.95))
def parity_p95(s, sf):
    return metrics.parity_histogram(_targeted(s, sf), ["target"], 0.95)


@query("parity_log", with_(ZH, ZP, _EVAL) + """
, x AS (SELECT LOG10(y_true) AS a, LOG10(y_pred) AS b FROM ev WHERE y_true > 0 AND y_pred > 0), q AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM (SELECT UNNEST([a, b]) AS v FROM x)),
nb AS (SELECT CASE WHEN COUNT(*) > 5000 THEN 80 ELSE 60 END AS bins FROM x),
b AS (SELECT LEAST(FLOOR((a - lo) / (hi - lo) * bins), bins - 1) AS bx, LEAST(FLOOR((b - lo) / (hi - lo) * bins), bins - 1) AS by_ FROM x, q, nb WHERE a BETWEEN lo AND hi AND b BETWEEN lo AND hi)
SELECT 'elecBveKwh' AS target, CAST(bx AS BIGINT) AS bx, CAST(by_ AS BIGINT) AS "by", COUNT(*) AS n FROM b GROUP BY 2, 3""")
def parity_log(s, sf):
    return metrics.parity_histogram(_targeted(s, sf), ["target"], log=True)


@query("residual_histogram", with_(ZH, ZP, _EVAL) + """
, e AS (SELECT y_pred - y_true AS r FROM ev), q AS (SELECT quantile_cont(r, 0.01) AS lo, quantile_cont(r, 0.99) AS hi FROM e)
SELECT 'elecBveKwh' AS target, CAST(LEAST(FLOOR((r - lo) / (hi - lo) * 80), 79) AS BIGINT) AS bin, COUNT(*) AS n FROM e, q WHERE r BETWEEN lo AND hi GROUP BY 2""")
def residual_histogram(s, sf):
    return metrics.residual_histogram(_targeted(s, sf), ["target"])


@query("hex_density", with_(ZH, ZP, _EVAL) + """
, v AS (SELECT UNNEST([y_true, y_pred]) AS x FROM ev), q AS (SELECT quantile_cont(x, 0.25) q1, quantile_cont(x, 0.75) q3, quantile_cont(x, 0.99) p99 FROM v),
l AS (SELECT GREATEST(LEAST(p99, q3 + 10 * GREATEST(q3 - q1, 1e-12)), 1e-6) AS lim FROM q),
s AS (SELECT LEAST(GREATEST(y_true, 0), lim) / lim * 55 AS sx, LEAST(GREATEST(y_pred, 0), lim) / lim * 31 AS sy FROM ev, l),
d AS (SELECT *, POW(sx - round_even(sx, 0), 2) + 3 * POW(sy - round_even(sy, 0), 2) < POW(sx - floor(sx) - 0.5, 2) + 3 * POW(sy - floor(sy) - 0.5, 2) AS own FROM s)
SELECT 'elecBveKwh' AS target, CAST(CASE WHEN own THEN round_even(sx, 0) ELSE floor(sx) + 0.5 END AS DOUBLE) AS hx, CAST(CASE WHEN own THEN round_even(sy, 0) ELSE floor(sy) + 0.5 END AS DOUBLE) AS hy, COUNT(*) AS n FROM d GROUP BY 2, 3""")
def hex_density(s, sf):
    return metrics.hex_density(_targeted(s, sf), ["target"])


@query("train_valid_series", with_(SH, SP) + """
, j AS (SELECT sh."siteId", sh.date, "elecTotalKwh" AS y, "totalKwh" AS p FROM sh JOIN sp ON sh."siteId" = sp."siteId" AND sh.date = sp.date),
c AS (SELECT MAX(date) - 365 AS cut FROM j), r AS (SELECT "siteId", CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM j GROUP BY 1)
SELECT r."siteId", CAST(r.date AS VARCHAR) AS date, CASE WHEN r.date <= cut THEN y END AS truth_train, CASE WHEN r.date > cut THEN y END AS truth_valid, CASE WHEN r.date > cut THEN p END AS pred_valid
FROM r CROSS JOIN c LEFT JOIN j ON r."siteId" = j."siteId" AND r.date = j.date""")
def train_valid_series(s, sf):
    k = ["siteId", "date"]
    j = t.site_history(s, sf).join(t.site_pred(s, sf), k).select(*k, F.col("elecTotalKwh").alias("y"), F.col("totalKwh").alias("p"))
    x = series.split_last_days(j, 365)
    return _text_date(series.daily_parts(x.where("part = 'train'"), x.where("part = 'valid'"), t.SITE, "y", "p"), "date")


_LINES = """ln AS (SELECT CAST(s_nationkey AS BIGINT) AS "siteId", CAST(l_shipdate AS DATE) AS date, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) * 1000000000 + CAST(FLOOR(l_extendedprice * 100) AS BIGINT) AS seq, l_quantity AS v, FLOOR(l_extendedprice / 100) AS p FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def _day_lines(s, sf):
    """Several rows per site and day, in the order of ``seq``: line numbers can repeat, so the price breaks ties."""
    li = t.table(s, sf, "lineitem").join(t.table(s, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return li.select(
        F.col("s_nationkey").cast("long").alias("siteId"), F.to_date("l_shipdate").alias("date"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long") * 1000000000 + F.floor(F.col("l_extendedprice") * 100).cast("long")).alias("seq"),
        F.col("l_quantity").alias("v"), F.floor(F.col("l_extendedprice") / 100).cast("double").alias("p"))


@query("first_of_day", with_(_LINES) + """SELECT "siteId", CAST(date AS VARCHAR) AS date, arg_min(v, seq) AS value, arg_min(p, seq) AS pred, TRUE AS own FROM ln GROUP BY 1, 2""")
def first_of_day(s, sf):
    """Duplicate days on both sides: the first row of each counts, not its extremes."""
    x = _day_lines(s, sf)
    return _text_date(series.align(x, x, t.SITE, "v", "p", order="seq"), "date")


@query("last_of_day", with_(_LINES) + """
, c AS (SELECT MAX(date) - 365 AS cut FROM ln), d AS (SELECT "siteId", date, arg_max(v, seq) AS v, arg_max(p, seq) AS p FROM ln GROUP BY 1, 2),
r AS (SELECT "siteId", CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM ln GROUP BY 1)
SELECT r."siteId", CAST(r.date AS VARCHAR) AS date, CASE WHEN r.date <= cut THEN v END AS truth_train, CASE WHEN r.date > cut THEN v END AS truth_valid, CASE WHEN r.date > cut THEN p END AS pred_valid
FROM r CROSS JOIN c LEFT JOIN d ON r."siteId" = d."siteId" AND r.date = d.date""")
def last_of_day(s, sf):
    """Duplicate days in both parts: the last row of each counts, whole."""
    x = series.split_last_days(_day_lines(s, sf), 365)
    return _text_date(series.daily_parts(x.where("part = 'train'"), x.where("part = 'valid'"), t.SITE, "v", "p", order="seq"), "date")


@query("site_selection", with_(SH) + """
SELECT "siteId", COUNT(*) AS n, SUM("elecTotalKwh") AS total FROM sh WHERE "siteId" IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'ASIA')) GROUP BY 1""")
def site_selection(s, sf):
    wanted = t.table(s, sf, "region").where(F.col("r_name").isin("EUROPE", "ASIA"))
    sites = t.table(s, sf, "nation").join(wanted, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    h = t.site_history(s, sf)
    return h.join(sites, h.siteId == sites.n_nationkey, "left_semi").groupBy("siteId").agg(F.count("*").alias("n"), F.sum("elecTotalKwh").alias("total"))


@query("keep_last", with_(WX) + """SELECT "siteId", CAST(date AS VARCHAR) AS date, seq, "tempAmb" FROM wxd""")
def keep_last(s, sf):
    return _text_date(keep_one(t.weather_records(s, sf).select("siteId", "date", "seq", "tempAmb"), ["siteId", "date"], ["seq"], last=True), "date")


@query("sanitised_predictions", """
SELECT o_orderkey, CASE WHEN ABS(v) > 1e100 OR isnan(v) THEN NULL ELSE ROUND(v, 6) END AS clean, ROUND(LEAST(GREATEST(o_totalprice / 10000, 0), 30), 6) AS clipped
FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 1e200 WHEN o_orderkey % 7 = 0 THEN 'NaN'::DOUBLE ELSE o_totalprice / 10000 END AS v FROM orders)""")
def sanitised_predictions(s, sf):
    k = F.col("o_orderkey")
    v = F.when(k % 11 == 0, F.lit(1e200)).when(k % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice") / 10000)
    x = t.table(s, sf, "orders").withColumn("v", v)
    return x.select("o_orderkey", F.round(learn.finite(F.col("v")), 6).alias("clean"), F.round(learn.clipped_log(F.col("o_totalprice") / 10000), 6).alias("clipped"))


@query("transformed_target", """SELECT o_orderkey, ROUND(ln(1 + o_totalprice), 6) AS logged, ROUND(GREATEST(exp(o_totalprice / 100000) - 1, 0), 6) AS back FROM orders""")
def transformed_target(s, sf):
    p = F.col("o_totalprice")
    return t.table(s, sf, "orders").select("o_orderkey", F.round(F.log1p(p), 6).alias("logged"), F.round(learn.back_to_unit(p / 100000, True), 6).alias("back"))


# ---- learning ------------------------------------------------------------------------------


def _site_with_infos(s, sf):
    infos = first_known(t.site_info_records(s, sf), ["siteId"], "seq", ["surface_m2"])
    return t.site_history(s, sf).join(infos, "siteId", "left")


@query("ridge_evaluation")
def ridge_evaluation(s, sf):
    _, scored = learn.train_and_score(_site_with_infos(s, sf), t.weather_records(s, sf), "site", t.SITE, "waterM3")
    out = metrics.global_report(scored.withColumn("target", F.lit("waterM3")), ["target"], "surface_m2")
    return out


@query("ridge_forecast")
def ridge_forecast(s, sf):
    h = _site_with_infos(s, sf).withColumn("date", F.date_sub("date", 110))
    w = t.weather_records(s, sf)
    fitted, _ = learn.train_and_score(h, w, "site", t.SITE, "waterM3")
    return _text_date(learn.forecast(h, w, t.SITE, "waterM3", fitted), "date")


_STACKED = """y AS (SELECT 'waterM3' AS target, "siteId", date, "waterM3" AS v FROM sh WHERE "waterM3" IS NOT NULL UNION ALL SELECT 'elecTotalKwh', "siteId", date, "elecTotalKwh" FROM sh WHERE "elecTotalKwh" IS NOT NULL),
fr AS (SELECT *, LAG(v, 1) OVER o AS lag_1, LAG(v, 7) OVER o AS lag_7, LAG(v, 14) OVER o AS lag_14 FROM y WINDOW o AS (PARTITION BY target, "siteId" ORDER BY date)),
tm AS (SELECT target, row_number() OVER () AS r, [{'n': '(one)', 'v': 1.0::DOUBLE}, {'n': 'lag_1', 'v': lag_1}, {'n': 'lag_7', 'v': lag_7}, {'n': 'dayofyear', 'v': CAST(dayofyear(date) AS DOUBLE)}, {'n': '(truth)', 'v': v},
  {'n': 'dow=' || CAST(isodow(date) - 1 AS VARCHAR), 'v': 1.0::DOUBLE}, {'n': 'is_weekend=' || CASE WHEN isodow(date) >= 6 THEN '1' ELSE '0' END, 'v': 1.0::DOUBLE}] AS x FROM fr WHERE lag_14 IS NOT NULL)"""


@query("ridge_products", with_(SH, _STACKED) + """
SELECT target, x[i].n AS a, x[j].n AS b, SUM(x[i].v * x[j].v) AS v FROM tm, range(1, 8) p(i), range(1, 8) q(j) WHERE i <= j GROUP BY ALL HAVING SUM(x[i].v * x[j].v) <> 0""")
def ridge_products(s, sf):
    """The normal equations of two targets from one scan: sums of integers, so both engines agree to the digit."""
    x = learn.feature_frames(t.site_history(s, sf), None, t.SITE, ["waterM3", "elecTotalKwh"])
    return ridge.products(x, "target", ["dow", "is_weekend"], ["lag_1", "lag_7", "dayofyear"], "y").where("v <> 0")


@query("target_evaluations")
def target_evaluations(s, sf):
    """Four targets fitted and scored together, errors from the one table of hold-outs."""
    names = ["waterM3", "elecTotalKwh", "elecBveKwh", "indoorTempDegC"]
    _, scored = learn.evaluate_all(_site_with_infos(s, sf), t.weather_records(s, sf), "site", t.SITE, names)
    return metrics.errors(scored, ["target"], ["n", "MAE", "RMSE", "WAPE", "Bias", "R2"])


#: A model with set weights, so that SQL can restate its forecast.
_SET = learn.Fitted("site", "waterM3", ["lag_1", "lag_7", "roll_med_7", "roll_mean_14", "tempAmb", "is_weekend"], ["is_weekend"], True, {"is_weekend": "0"}, {"tempAmb": 10.0}, 60,
                    ridge.Ridge(["is_weekend"], ["lag_1", "lag_7", "roll_med_7", "roll_mean_14", "tempAmb"], [{"0": 0.25, "1": -0.5}], [0.002, 0.004, 0.001, 0.0005, 0.03125], 2.0))


@query("fold_forecast", recursive(SH, WX) + """
, h AS (SELECT "siteId", date - 110 AS date, "waterM3" AS v FROM sh), l AS (SELECT MAX(date) AS ld FROM h),
r AS (SELECT "siteId", CAST(LEAST(GREATEST(MAX(wx.date) - ld, 0), 90) AS INTEGER) AS hz FROM wx CROSS JOIN l WHERE "siteId" IN (SELECT "siteId" FROM h WHERE v IS NOT NULL) GROUP BY "siteId", ld),
s AS (SELECT r."siteId", ld, hz, list(h.v ORDER BY i) AS st FROM r CROSS JOIN l CROSS JOIN range(0, 30) g(i) LEFT JOIN h ON h."siteId" = r."siteId" AND h.date = ld - 29 + CAST(i AS INTEGER) WHERE hz > 0 GROUP BY ALL),
f AS (
  SELECT "siteId", ld, hz, 0 AS k, st, NULL::DOUBLE AS yhat FROM s
  UNION ALL
  SELECT "siteId", ld, hz, k + 1, list_append(st[2:], y), y FROM (
    SELECT f.*, GREATEST(exp(LEAST(GREATEST(2.0::DOUBLE + CASE WHEN isodow(ld + k + 1) >= 6 THEN -0.5::DOUBLE ELSE 0.25::DOUBLE END + 0.002::DOUBLE * COALESCE(st[30], 0) + 0.004::DOUBLE * COALESCE(st[24], 0)
      + 0.001::DOUBLE * COALESCE(list_aggregate(list_filter(st[24:30], lambda x: x IS NOT NULL), 'median'), 0) + 0.0005::DOUBLE * COALESCE(list_sum(list_filter(st[17:30], lambda x: x IS NOT NULL)) / len(list_filter(st[17:30], lambda x: x IS NOT NULL)), 0)
      + 0.03125::DOUBLE * COALESCE(wxd."tempAmb", 10), 0), 30)) - 1, 0) AS y
    FROM f LEFT JOIN wxd ON wxd."siteId" = f."siteId" AND wxd.date = ld + k + 1 WHERE k < hz))
SELECT "siteId", CAST(ld + k AS VARCHAR) AS date, ROUND(yhat, 6) AS yhat FROM f WHERE k > 0""")
def fold_forecast(s, sf):
    """The forecast's recurrence under a model with set weights."""
    h = t.site_history(s, sf).withColumn("date", F.date_sub("date", 110))
    return _text_date(_round(learn.forecast(h, t.weather_records(s, sf), t.SITE, "waterM3", _SET, max_days=90), 6, "yhat"), "date")


@query("boosted_evaluation")
def boosted_evaluation(s, sf):
    cfg = learn.Settings(model="gbt")
    _, scored = learn.train_and_score(_site_with_infos(s, sf), t.weather_records(s, sf), "site", t.SITE, "elecTotalKwh", cfg)
    return metrics.errors(scored, t.SITE, ["n", "MAE", "RMSE", "WAPE", "Bias", "R2"])
