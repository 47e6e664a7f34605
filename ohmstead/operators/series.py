"""Daily series: calendar filling, gaps, lags, rolling features, splits and horizons.

After day-level reduction a group holds at most one row per calendar day, so the per-group
windows below are bounded by the length of the calendar, whatever the volume of raw readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.operators.keyed import keep_one

from ohmstead.operators.keyed import small_side

LAGS = (1, 2, 7, 14)
ROLLS = (7, 14, 30)


def day(col: Column | str) -> Column:
    """Calendar day of a timestamp, date or text; unreadable text gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c.cast("string")).cast("date")


def number(col: Column | str) -> Column:
    """Double or NULL; NaN counts as missing."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string").try_cast("double")
    return F.when(~F.isnan(c), c)


def positive(col: Column | str, zero_is_missing: bool = True) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > 0 if zero_is_missing else c >= 0, c)


def band(col: Column | str, low: float, high: float) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when((c > 0) & c.between(low, high), c)


def expected_range(hist: DataFrame, pred: DataFrame | None, ids: Sequence[str]) -> DataFrame:
    """First and last day per group over both tables, without a full outer join."""
    cols = [*ids, "date"]
    both = hist.select(*cols) if pred is None else hist.select(*cols).unionByName(pred.select(*cols))
    return both.dropna(subset=cols).groupBy(*ids).agg(F.min("date").alias("start"), F.max("date").alias("end"))


def align(hist: DataFrame, pred: DataFrame | None, ids: Sequence[str], value: str, pred_col: str | None, order: str | None = None) -> DataFrame:
    """History and prediction on one row per (group, day): a union and one aggregate.

    Tables with several rows per day need ``order``, a column of both: the first row of a day counts.
    """
    keys = [*ids, "date"]
    if order is not None:
        hist = keep_one(hist.dropna(subset=keys).select(*keys, order, value), keys, [order])
        if pred is not None:
            pred = keep_one(pred.dropna(subset=keys).select(*keys, order, *([pred_col] if pred_col else [])), keys, [order])
    h = hist.select(*keys, F.col(value).alias("value"), F.lit(None).cast("double").alias("pred"), F.lit(True).alias("own"))
    if pred is not None:
        p = F.col(pred_col) if pred_col else F.lit(None)
        h = h.unionByName(
            pred.select(*keys, F.lit(None).cast("double").alias("value"), p.cast("double").alias("pred"), F.lit(False).alias("own"))
        )
    return h.dropna(subset=keys).groupBy(*keys).agg(
        F.max("value").alias("value"), F.min("pred").alias("pred"), F.max("own").alias("own")
    )


def fill_calendar(df: DataFrame, ids: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Every day from the first to the last row of a group; added days hold NULLs.

    Each row is stretched up to the day before the next one, so no join with a date spine is needed.
    """
    w = Window.partitionBy(*ids).orderBy("date")
    until = F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.col("date"))
    days = df.withColumn("_days", F.sequence("date", until)).select(
        *ids, *carry, F.col("date").alias("_own"), F.explode("_days").alias("date")
    )
    own = F.col("_own") == F.col("date")
    return days.select(*ids, "date", *[F.when(own, F.col(c)).alias(c) for c in carry])


def missing_before(df: DataFrame, ids: Sequence[str], value: str = "value") -> DataFrame:
    """Length of the run of missing days that ends just before each day."""
    w = Window.partitionBy(*ids).orderBy("date")
    valid_day = F.when(F.col(value) > 0, F.col("date"))
    prev = F.last(valid_day, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    first = F.min("date").over(Window.partitionBy(*ids))
    return df.withColumn("gap_before", F.date_diff(F.col("date"), F.coalesce(prev, F.date_sub(first, 1))) - 1)


def long_gaps(aligned: DataFrame, ids: Sequence[str], min_days: int = 30) -> DataFrame:
    """Runs of missing or non-positive days, from distances between valid days."""
    w = Window.partitionBy(*ids).orderBy("date")
    whole = Window.partitionBy(*ids)
    valid = F.col("value") > 0
    prev = F.last(F.when(valid, F.col("date")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = (
        aligned.withColumn("_start", F.coalesce(F.date_add(prev, 1), F.min("date").over(whole)))
        .withColumn("_end", F.max("date").over(whole))
        .withColumn("_valid", F.coalesce(valid, F.lit(False)))
    )
    closes = x.where(F.col("_valid") | (F.col("date") == F.col("_end"))).withColumn(
        "gap_end", F.when(F.col("_valid"), F.date_sub("date", 1)).otherwise(F.col("date"))
    )
    out = closes.withColumn("gap_days", F.date_diff("gap_end", F.col("_start")) + 1)
    return out.where(F.col("gap_days") >= min_days).select(
        *ids, F.col("_start").alias("gap_start"), "gap_end", F.col("gap_days").cast("long").alias("gap_days")
    )


def calendar(date: Column | str) -> dict[str, Column]:
    """Calendar fields of a date; Monday is day 0."""
    dow = F.weekday(date)
    return {"dow": dow, "month": F.month(date), "dayofyear": F.dayofyear(date), "is_weekend": (dow >= 5).cast("int")}


def add_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar(date))


def _frame(ids: Sequence[str], back: int, mode: str, upto: int = -1) -> Window:
    if mode == "rows":
        return Window.partitionBy(*ids).orderBy("date").rowsBetween(-back, upto)
    return Window.partitionBy(*ids).orderBy(F.unix_date("date")).rangeBetween(-back, upto)


def add_lags(df: DataFrame, ids: Sequence[str], value: str, lags: Sequence[int] = LAGS, mode: str = "rows") -> DataFrame:
    """Earlier values by row, or by calendar day with ``mode='days'``."""
    if mode == "rows":
        w = Window.partitionBy(*ids).orderBy("date")
        return df.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in lags})
    return df.withColumns({f"lag_{k}": F.max(value).over(_frame(ids, k, mode, -k)) for k in lags})


def add_rolling(df: DataFrame, ids: Sequence[str], value: str, windows: Sequence[int] = ROLLS, mode: str = "rows", min_periods: bool = True) -> DataFrame:
    """Median and mean of earlier values, NULL when too few of them are known."""
    cols = {}
    for k in windows:
        w = _frame(ids, k, mode)
        enough = F.count(value).over(w) >= (max(2, k // 3) if min_periods else 1)
        cols[f"roll_med_{k}"] = F.when(enough, F.percentile(value, 0.5).over(w))
        cols[f"roll_mean_{k}"] = F.when(enough, F.avg(value).over(w))
    return df.withColumns(cols)


def feature_columns(columns: Sequence[str], ids: Sequence[str], weather: Sequence[str], static: Sequence[str] = ()) -> list[str]:
    """Calendar, then lags and rolling columns, then weather, ids and static columns."""
    out = [c for c in ("dow", "month", "dayofyear", "is_weekend") if c in columns]
    out += [c for c in columns if c.startswith(("lag_", "roll_"))]
    out += [c for c in (*weather, *ids) if c in columns]
    return out + [c for c in static if c in columns and c not in out]


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in df.columns if c.startswith(("lag_", "roll_"))])


def split_last_days(df: DataFrame, valid_days: int = 60, keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``part``: the days after max(date) - valid_days are for validation."""
    last = df.groupBy(*keys).agg(F.max("date").alias("_last"))
    x = df.join(small_side(last), list(keys)) if keys else df.withColumn("_last", last.scalar())
    cut = F.date_sub("_last", valid_days)
    return x.withColumn("cutoff", cut).withColumn(
        "part", F.when(F.col("date") <= cut, "train").otherwise("valid")
    ).drop("_last")


def horizon(hist: DataFrame, weather: DataFrame, ids: Sequence[str], max_days: int | None = None, anchor: str = "global") -> DataFrame:
    """Days of weather known after the last day of history, per group."""
    reach = weather.groupBy("siteId").agg(F.max("date").alias("_reach"))
    groups = hist.groupBy(*ids).agg(F.max("date").alias("last_date"))
    if anchor == "global":
        groups = groups.withColumn("last_date", hist.agg(F.max("date")).scalar())
    days = F.greatest(F.date_diff("_reach", F.col("last_date")), F.lit(0))
    days = F.least(days, F.lit(max_days)) if max_days is not None else days
    return groups.join(reach, "siteId", "left").withColumn("horizon", F.coalesce(days, F.lit(0)).cast("long")).drop("_reach")


def daily_parts(train: DataFrame, valid: DataFrame, ids: Sequence[str], truth: str, pred: str, order: str | None = None) -> DataFrame:
    """Truth and prediction of both parts on one calendar per group.

    Tables with several rows per day need ``order``, a column of both: the last row of a day counts, whole.
    """
    keys = [*ids, "date"]
    if order is not None:
        train = keep_one(train.select(*keys, order, truth), keys, [order], last=True)
        valid = keep_one(valid.select(*keys, order, truth, pred), keys, [order], last=True)
    t = train.select(*keys, F.col(truth).alias("truth_train"), F.lit(None).cast("double").alias("truth_valid"), F.lit(None).cast("double").alias("pred_valid"))
    v = valid.select(*keys, F.lit(None).cast("double").alias("truth_train"), F.col(truth).alias("truth_valid"), F.col(pred).alias("pred_valid"))
    cols = ["truth_train", "truth_valid", "pred_valid"]
    both = t.unionByName(v).groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])
    return fill_calendar(both, ids, cols)
