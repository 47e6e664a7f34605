"""Usage breakdown of a meter log: names, wide daily tables, family totals, derived totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Canonical column names of the histories.
LEGACY_USES = ["elecBveKwh", "elecCvcKwh", "elecForceKwh", "elecLightingKwh"]
ELEC_TOTALS = ["elecTotalKwh", "elecAggregatedKwh", "elecTotalNoBveKwh", "elecTotalFromDriftKwh", "elecTotalAccurateKwh"]
BASE_TOTALS = [*ELEC_TOTALS, "waterM3", "waterTotalFromDriftM3", "ecTotalFromDrift", "egTotalFromDrift"]
ACCURATE_SOURCES = ["elecTotalFromDriftKwh", "elecAggregatedKwh", "elecTotalKwh"]
ROLES = {
    "elec_total": "elecTotalKwh", "elec_aggregated": "elecAggregatedKwh", "elec_total_from_drift": "elecTotalFromDriftKwh",
    "elec_total_accurate": "elecTotalAccurateKwh", "elec_total_no_bve": "elecTotalNoBveKwh", "water_total": "waterM3",
    "indoor_temp": "indoorTempDegC", "pred_total_elec": "totalKwh", "pred_total_water": "totalWater",
    "bve": "elecBveKwh", "cvc": "elecCvcKwh", "force": "elecForceKwh", "lighting": "elecLightingKwh",
}


def rename_roles(df: DataFrame, configured: dict[str, str]) -> DataFrame:
    """Configured source columns to canonical names; a canonical column already there wins."""
    clean = df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])
    moves = {
        src: ROLES[role] for role, src in configured.items()
        if role in ROLES and src in clean.columns and ROLES[role] not in clean.columns
    }
    return clean.withColumnsRenamed(moves)


def alias_keys(df: DataFrame, keys: Sequence[str] = ("siteId", "zoneId", "date", "dtUpdate")) -> DataFrame:
    """Key columns found whatever their letter case."""
    by_lower = {k.lower(): k for k in keys}
    return df.withColumnsRenamed({c: by_lower[c.strip().lower()] for c in df.columns if c.strip().lower() in by_lower})


def discover_usages(columns: Sequence[str]) -> list[str]:
    """Electric usage columns, structural totals left out."""
    return sorted(c for c in columns if c.startswith("elec") and c.endswith("Kwh") and c not in ELEC_TOTALS)


def discover_targets(columns: Sequence[str]) -> list[str]:
    """All usage-like targets by name: electricity, water, hot and chilled water."""
    def usage(c: str) -> bool:
        return (c.startswith("elec") and c.endswith("Kwh")) or (c.startswith("water") and c.endswith("M3")) or c.startswith(("ec", "eg"))

    return sorted(c for c in columns if usage(c) and c not in BASE_TOTALS and not c.endswith("_drift"))


def is_consumption(target: str) -> bool:
    return target in LEGACY_USES or target in BASE_TOTALS or target in discover_targets([target])


def camel(col: Column | str) -> Column:
    parts = F.filter(F.split(F.col(col) if isinstance(col, str) else col, "[^a-zA-Z0-9]+"), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), p.substr(F.lit(2), F.length(p)))), "")


def usage_column(meter: str, usage: str) -> Column:
    """Column name of a (meter, usage) pair; the four legacy usages get a suffix."""
    m, u = F.col(meter), camel(F.coalesce(F.col(usage), F.lit("nan")))
    elec = F.concat(F.lit("elec"), u, F.lit("Kwh"))
    return (
        F.when(m == "elec", F.when(elec.isin(LEGACY_USES), F.concat(elec, F.lit("_drift"))).otherwise(elec))
        .when(m == "water", F.concat(F.lit("water"), u, F.lit("M3")))
        .otherwise(F.concat(F.coalesce(m, F.lit("nan")), u))
    )


def name_log(log: DataFrame, usages: DataFrame, meters: DataFrame) -> DataFrame:
    """Left joins to the two code tables and the column name.

    Spark broadcasts code tables of known small size, such as literal rows; sum the log per day and codes first.
    """
    x = log.join(usages, "usageId", "left").join(meters, "meterTypeId", "left")
    return x.withColumn("usage_col", usage_column("meter_name", "usage_name"))


def daily_usage_long(named: DataFrame, ids: Sequence[str], perimeter: str = "zone") -> DataFrame:
    x = named.where(F.col("perimeter") == perimeter).dropna(subset=[*ids, "date", "consumption", "usage_col"])
    return x.groupBy(*ids, "date", "usage_col").agg(F.sum("consumption").alias("consumption"))


def known_total(cols: Sequence[str]) -> Column:
    """Sum over columns, NULL when all are NULL."""
    return F.when(F.coalesce(*[F.col(c) for c in cols]).isNotNull(), sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0)))


def family_totals(wide: DataFrame, include_drift: bool = False) -> DataFrame:
    """Totals per meter family over the usage columns found in the table."""
    c = wide.columns
    elec = [x for x in c if x.startswith("elec") and x.endswith("Kwh")]
    if include_drift:
        elec += [x for x in c if x.startswith("elec") and x.endswith("_drift")]
    families = {
        "elecTotalFromDriftKwh": elec,
        "waterTotalFromDriftM3": [x for x in c if x.startswith("water") and x.endswith("M3")],
        "ecTotalFromDrift": [x for x in c if x.startswith("ec")],
        "egTotalFromDrift": [x for x in c if x.startswith("eg")],
    }
    return wide.withColumns({name: known_total(cols) for name, cols in families.items() if cols})


def daily_usage_wide(named: DataFrame, ids: Sequence[str], usage_cols: Sequence[str], perimeter: str = "zone") -> DataFrame:
    """One column per usage. The names come from the code tables, so the plan is fixed up front."""
    x = named.where(F.col("perimeter") == perimeter).dropna(subset=[*ids, "date", "consumption", "usage_col"])
    wide = x.groupBy(*ids, "date").agg(
        *[F.sum(F.when(F.col("usage_col") == c, F.col("consumption"))).alias(c) for c in usage_cols]
    )
    return family_totals(wide)


def usage_names(usages: Sequence[tuple], meters: Sequence[tuple]) -> list[str]:
    """The same naming rule on the driver, for the few rows of the code tables."""
    out = []
    for _, m in meters:
        for _, u in usages:
            base = f"elec{u}Kwh" if m == "elec" else f"water{u}M3" if m == "water" else f"{m}{u}"
            out.append(base + "_drift" if base in LEGACY_USES else base)
    return sorted(out)


def fill_from_drift(df: DataFrame) -> DataFrame:
    """Legacy usage columns that are missing or zero take their companion's value."""
    cols = {}
    for base in LEGACY_USES:
        if base in df.columns and f"{base}_drift" in df.columns:
            c = F.col(base)
            cols[base] = F.when(c.isNull() | (c == 0), F.col(f"{base}_drift")).otherwise(c)
    return df.withColumns(cols)


def total_accurate(df: DataFrame) -> DataFrame:
    """Best total: the first source that has any value in the whole table, clamped at zero."""
    if "elecTotalAccurateKwh" in df.columns:
        return df
    present = [c for c in ACCURATE_SOURCES if c in df.columns]
    last = present[-1]
    expr = F.col(last)
    if len(present) > 1:
        code = F.lit(len(present) - 1)
        for i in range(len(present) - 2, -1, -1):
            code = F.when(F.count(present[i]) > 0, F.lit(i)).otherwise(code)
        chosen = df.agg(code.alias("source")).scalar()
        x = df.withColumn("_source", chosen)
        for i in range(len(present) - 2, -1, -1):
            expr = F.when(F.col("_source") == i, F.col(present[i])).otherwise(expr)
    else:
        x = df
    x = x.withColumn("elecTotalAccurateKwh", expr)
    c = F.col("elecTotalAccurateKwh")
    return x.withColumn("elecTotalAccurateKwh", F.when(c < 0, F.lit(0.0)).otherwise(c)).drop("_source")


def total_without(df: DataFrame, base: str = "elecTotalAccurateKwh", use: str = "elecBveKwh", name: str = "elecTotalNoBveKwh") -> DataFrame:
    """Total less one usage, never below zero, NULL when the total is."""
    rest = F.col(base) - F.coalesce(F.col(use), F.lit(0.0))
    return df.withColumn(name, F.when(rest < 0, F.lit(0.0)).otherwise(rest))


def enrich_history(hist: DataFrame, named: DataFrame, ids: Sequence[str], usage_cols: Sequence[str], perimeter: str = "zone", fill: bool = True) -> DataFrame:
    """History with the usage columns of the log, filled legacy columns and the derived total."""
    out = hist.join(daily_usage_wide(named, ids, usage_cols, perimeter), [*ids, "date"], "left")
    out = fill_from_drift(out) if fill else out
    return total_without(out, base="elecTotalKwh")


def keep_signal(df: DataFrame, ids: Sequence[str], target: str) -> DataFrame:
    """Groups with at least one positive value; the kept keys are a partial aggregate."""
    live = df.where(F.col(target) > 0).select(*ids).distinct()
    return df.join(live, list(ids), "left_semi")
