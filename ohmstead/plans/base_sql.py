"""The adapters of ``sources.tables`` restated as SQL, for the reference queries."""

LOG = """log AS (
  SELECT CAST(s_nationkey AS BIGINT) AS "siteId", l_suppkey AS "zoneId", CAST(l_shipdate AS DATE) AS date,
         l_quantity AS consumption, CAST((l_orderkey*7 + l_linenumber) % 6 AS INTEGER) AS "usageId",
         CAST(l_linenumber % 4 + 1 AS INTEGER) AS "meterTypeId",
         CASE WHEN l_linestatus = 'O' THEN 'zone' ELSE 'site' END AS perimeter
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
usages("usageId", usage_name) AS (VALUES (0,'Bve'),(1,'Cvc'),(2,'Force'),(3,'Lighting'),(4,'Pc'),(5,'Process')),
meters("meterTypeId", meter_name) AS (VALUES (1,'elec'),(2,'water'),(3,'eg'),(4,'ec')),
named AS (
  SELECT log.*, usage_name, meter_name,
         CASE meter_name WHEN 'elec' THEN 'elec' || usage_name || 'Kwh' || CASE WHEN usage_name IN ('Bve','Cvc','Force','Lighting') THEN '_drift' ELSE '' END
              WHEN 'water' THEN 'water' || usage_name || 'M3' ELSE meter_name || usage_name END AS usage_col
  FROM log LEFT JOIN usages USING ("usageId") LEFT JOIN meters USING ("meterTypeId"))"""

ZH = """zh AS (
  SELECT CAST(s_nationkey AS BIGINT) AS "siteId", l_suppkey AS "zoneId", CAST(l_shipdate AS DATE) AS date,
         10 + 3 * AVG(FLOOR(l_discount * 100 + 0.5)) AS "indoorTempDegC",
         SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS "elecBveKwh",
         SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS "elecCvcKwh",
         SUM(CASE WHEN l_returnflag = 'N' AND l_linenumber <= 3 THEN l_quantity END) AS "elecForceKwh",
         SUM(CASE WHEN l_returnflag = 'N' AND l_linenumber > 3 THEN l_quantity END) AS "elecLightingKwh",
         SUM(CASE WHEN l_linestatus = 'O' THEN FLOOR(l_extendedprice / 100) END) AS "elecAggregatedKwh",
         SUM(FLOOR(l_extendedprice / 100)) AS "elecTotalKwh",
         SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS "waterM3"
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)"""

_M = ["elecBveKwh", "elecCvcKwh", "elecForceKwh", "elecLightingKwh", "elecAggregatedKwh", "elecTotalKwh", "waterM3"]
SH = ZH + ',\nsh AS (SELECT "siteId", date, MAX("indoorTempDegC") AS "indoorTempDegC", ' + ", ".join(f'SUM("{c}") AS "{c}"' for c in _M) + " FROM zh GROUP BY 1, 2)"

ZP = """zp AS (
  SELECT CAST(s_nationkey AS BIGINT) AS "siteId", l_suppkey AS "zoneId", CAST(l_shipdate AS DATE) + CASE WHEN l_linestatus = 'O' THEN 45 ELSE 0 END AS date,
         SUM(FLOOR(l_extendedprice / 100)) AS "totalKwh", SUM(l_quantity) AS "totalWater",
         10 + 3 * AVG(FLOOR(l_discount * 100 + 0.5)) AS "tempAmb"
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)"""
SP = ZP + ',\nsp AS (SELECT "siteId", date, SUM("totalKwh") AS "totalKwh", SUM("totalWater") AS "totalWater", MAX("tempAmb") AS "tempAmb" FROM zp GROUP BY 1, 2)'

WX = """wx AS (
  SELECT CAST(c_nationkey AS BIGINT) AS "siteId", CAST(o_orderdate AS DATE) AS date, o_orderkey AS seq,
         FLOOR(o_totalprice / 20000) AS "tempAmb", CAST(o_custkey % 100 AS DOUBLE) AS humidity,
         GREATEST(0.0::DOUBLE, 18 - FLOOR(o_totalprice / 20000)) AS "djF", GREATEST(0.0::DOUBLE, FLOOR(o_totalprice / 20000) - 18) AS "djC",
         FLOOR(o_totalprice / 20000) - 4 AS "tempMin", FLOOR(o_totalprice / 20000) + 5 AS "tempMax",
         CAST(o_orderkey % 101 AS DOUBLE) AS "chancePluie", CAST(o_orderkey % 37 AS DOUBLE) AS "windSpeed"
  FROM orders JOIN customer ON o_custkey = c_custkey),
wxd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "siteId", date ORDER BY seq DESC) rn FROM wx) WHERE rn = 1)"""

SI = """si_raw AS (
  SELECT CAST(s_nationkey AS BIGINT) AS "siteId", s_suppkey AS seq, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS surface_m2,
         s_name AS activity, CASE WHEN s_suppkey % 3 = 0 THEN 'context ' || s_name END AS context
  FROM supplier),
si AS (
  SELECT "siteId", ARG_MIN(surface_m2, seq) FILTER (WHERE surface_m2 IS NOT NULL) AS surface_m2,
         ARG_MIN(activity, seq) FILTER (WHERE activity IS NOT NULL) AS activity,
         ARG_MIN(context, seq) FILTER (WHERE context IS NOT NULL) AS context
  FROM si_raw GROUP BY 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
