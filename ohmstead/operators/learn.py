"""Feature frames, model fitting and day-by-day forecasts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.functions.text import let
from ohmstead.operators import boost, enrich, ridge, series
from ohmstead.operators.keyed import exact_quantiles, keep_one, small_side
from ohmstead.session import cut_lineage

# Targets trained by default at each level, and the categorical features.
BASE_TARGETS = ["elecTotalAccurateKwh", "elecTotalKwh", "elecTotalNoBveKwh", "waterM3", "indoorTempDegC"]
CATEGORICAL = ["siteId", "dow", "month", "is_weekend"]


@dataclass(frozen=True)
class Settings:
    lags: tuple[int, ...] = series.LAGS
    rolls: tuple[int, ...] = series.ROLLS
    weather: tuple[str, ...] = ("tempAmb", "humidity", "djF", "djC", "tempMin", "tempMax", "chancePluie", "windSpeed")
    static: tuple[str, ...] = ("surface_m2",)
    model: str = "ridge"
    alpha: float = 1.0
    depth: int = 8
    rate: float = 0.08
    rounds: int = 350
    valid_days: int = 60


@dataclass
class Fitted:
    level: str
    target: str
    features: list[str]
    cat_columns: list[str]
    log1p: bool
    modes: dict[str, str]
    medians: dict[str, float]
    valid_days: int
    model: ridge.Ridge | boost.Boosted | None = field(default=None, repr=False)

    def metadata(self, spark: SparkSession) -> DataFrame:
        """One row that tells how the target was trained."""
        kind = "gbt" if isinstance(self.model, boost.Boosted) else "ridge"
        row = (self.level, self.target, self.features, self.cat_columns, self.log1p, json.dumps(self.modes), json.dumps(self.medians), self.valid_days, kind)
        return spark.createDataFrame([row], "level string, target string, features array<string>, cat_columns array<string>, log1p boolean, modes string, medians string, valid_days int, kind string")

    def save(self, path: str) -> None:
        self.model.save(f"{path}/{self.level}_{self.target}")
        self.metadata(SparkSession.active()).write.mode("overwrite").json(f"{path}/{self.level}_{self.target}.meta")


def load_fitted(spark: SparkSession, path: str, level: str, target: str) -> Fitted:
    m = spark.read.json(f"{path}/{level}_{target}.meta").first()
    return Fitted(
        level, target, list(m.features), list(m.cat_columns), m.log1p, json.loads(m.modes), json.loads(m.medians),
        int(m.valid_days), (boost.Boosted if m.kind == "gbt" else ridge.Ridge).load(spark, f"{path}/{level}_{target}"),
    )


def expand_targets(target: str, columns: Sequence[str]) -> list[str]:
    """``all``, ``elecUses`` or one target, checked against the columns of the history."""
    if target == "elecUses":
        return list(enrich.LEGACY_USES)
    dynamic = enrich.discover_targets(columns)
    if target == "all":
        return [*BASE_TARGETS, *[c for c in dynamic if c not in BASE_TARGETS]]
    if target not in {*BASE_TARGETS, *dynamic}:
        raise ValueError(f"unknown target {target!r}")
    return [target]


def signal_gates(hist: DataFrame, targets: Sequence[str], min_positive: int = 50) -> DataFrame:
    """Positive points per target and whether a discovered target has enough of them, in one scan."""
    dynamic = enrich.discover_targets(targets)
    counts = hist.agg(*[F.count_if(F.col(t) > 0).alias(t) for t in targets])
    rows = F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(t).alias("positives"), F.lit(t in dynamic).alias("discovered")) for t in targets
    ]))
    return counts.select(rows.alias("r")).select("r.*").withColumn(
        "trained", ~F.col("discovered") | (F.col("positives") >= min_positive)
    )


def feature_frames(hist: DataFrame, weather: DataFrame | None, ids: Sequence[str], targets: Sequence[str], cfg: Settings = Settings(), require_static: bool = False) -> DataFrame:
    """Known days of every target, one row per (target, ids, date): history is read and ordered once for all.

    Calendar, lags, rolling values and weather beside the truth; incomplete rows dropped, and of
    discovered targets the groups without any positive value.
    """
    static = [c for c in cfg.static if c in hist.columns]
    keys = ["target", *ids]
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in targets]))
    x = hist.select(*ids, "date", *static, each.alias("_t")).select("_t.target", *ids, "date", "_t.y", *static)
    if found := enrich.discover_targets(targets):
        live = F.max(F.when(F.col("y") > 0, True)).over(Window.partitionBy(*keys))
        x = x.withColumn("_live", live).where(~F.col("target").isin(found) | F.col("_live")).drop("_live")
    if "indoorTempDegC" in targets:
        x = x.withColumn("y", F.when(F.col("target") == "indoorTempDegC", series.positive("y")).otherwise(F.col("y")))
    x = x.dropna(subset=[*ids, "date", "y", *(static if require_static else [])])
    x = series.add_rolling(series.add_lags(x, keys, "y", cfg.lags), keys, "y", cfg.rolls)
    x = series.drop_incomplete(series.add_calendar(x))
    if weather is not None:
        latest = keep_one(weather.select("siteId", "date", "seq", *cfg.weather), ["siteId", "date"], ["seq"], last=True)
        x = x.join(latest.drop("seq"), ["siteId", "date"], "left")
    return x


def feature_frame(hist: DataFrame, weather: DataFrame | None, ids: Sequence[str], target: str, cfg: Settings = Settings(), require_static: bool = False) -> DataFrame:
    """The frame of one target, without the column that names it."""
    x = feature_frames(hist, weather, ids, [target], cfg, require_static)
    return x.drop("target", *([] if weather is None else set(cfg.weather) - set(_weather(target, cfg))))


def _weather(target: str, cfg: Settings) -> list[str]:
    return [c for c in cfg.weather if not (target == "indoorTempDegC" and c == "tempAmb")]


def _filled(f: Fitted, cols: dict[str, Column]) -> dict[str, Column]:
    """Features with the target's fills: text for categories, finite numbers for the others."""
    out = {}
    for c in f.features:
        if c in f.cat_columns:
            out[c] = F.coalesce(cols[c].cast("string"), F.lit(f.modes.get(c)))
        else:
            v = cols[c].cast("double")
            out[c] = F.coalesce(F.when(~F.isnan(v) & (F.abs(v) <= 1e100), v), F.lit(f.medians.get(c, 0.0)))
    return out


def _long(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in cols])
    return df.select("target", F.explode(cells).alias("e")).select("target", "e.*").where("value IS NOT NULL")


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, str]]:
    """Per target, the most frequent value of each column, the smallest among equals; one row each comes back."""
    if not cols:
        return {}
    n = _long(df, cols, "string").groupBy("target", "feature", "value").agg(F.count("*").alias("n"))
    best = n.groupBy("target", "feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    out: dict[str, dict[str, str]] = {}
    for r in best.collect():
        out.setdefault(r.target, {})[r.feature] = r.value
    return out


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, float]]:
    """Per target, the exact median of each column, selected without gathering a column; one row each comes back."""
    out: dict[str, dict[str, float]] = {}
    if cols:
        for r in exact_quantiles(_long(df, cols, "double"), ["target", "feature"], "value", {"m": 0.5}).collect():
            out.setdefault(r.target, {})[r.feature] = float(r.m)
    return out


def fit_all(train: DataFrame, level: str, ids: Sequence[str], targets: Sequence[str], cfg: Settings = Settings()) -> dict[str, Fitted]:
    """Fills, full one-hot, then ridge or boosted trees, for all targets of a stacked frame (``target``, ``y``).

    Fills of all targets come from one pass for texts and one for numbers; ridge models from one aggregate,
    boosted ones grow in the same jobs.
    """
    if cfg.model not in ("ridge", "gbt"):
        raise ValueError(f"unknown model {cfg.model!r}")
    feats = series.feature_columns(train.columns, ids, cfg.weather, cfg.static)
    cats = [c for c in CATEGORICAL if c in feats]
    known, middle = modes(train, cats), medians(train, [c for c in feats if c not in cats])
    out = {}
    for t in targets:
        own = [c for c in feats if c not in cfg.weather or c in _weather(t, cfg)]
        out[t] = Fitted(level, t, own, cats, enrich.is_consumption(t), known.get(t, {}), {c: v for c, v in middle.get(t, {}).items() if c in own}, cfg.valid_days)
    nums = {t: [c for c in f.features if c not in cats] for t, f in out.items()}
    cols = {c: F.col(c) for c in feats}

    def filled(f: Fitted) -> DataFrame:
        own = _filled(f, cols)
        y = F.log1p("y") if f.log1p else F.col("y")
        return train.where(F.col("target") == f.target).select("target", y.cast("double").alias("_y"), *[v.alias(c) for c, v in own.items()])

    if cfg.model == "gbt":
        found = boost.fit({t: boost.Frame(cut_lineage(filled(f)), cats, nums[t]) for t, f in out.items()}, boost.Shape(cfg.depth, cfg.rate, cfg.rounds))
    else:
        found = ridge.fit(_filled_together(train, out, feats), "target", cats, nums, "_y", cfg.alpha)
    for t, f in out.items():
        f.model = found.get(t)
    return {t: f for t, f in out.items() if f.model is not None}


def _filled_together(train: DataFrame, fitted: dict[str, Fitted], feats: Sequence[str]) -> DataFrame:
    """The stacked frame with each target's fills, so that one scan serves all."""
    def fill(c: str, kind: str) -> Column:
        values = {t: (f.modes if c in f.cat_columns else f.medians).get(c) for t, f in fitted.items()}
        pairs = [x for t, v in values.items() if v is not None for x in (F.lit(t), F.lit(v))]
        return F.try_element_at(F.create_map(*pairs), F.col("target")).cast(kind) if pairs else F.lit(None).cast(kind)

    cats = next(iter(fitted.values())).cat_columns
    logs = [t for t, f in fitted.items() if f.log1p]
    out = []
    for c in feats:
        if c in cats:
            out.append(F.coalesce(F.col(c).cast("string"), fill(c, "string")).alias(c))
        else:
            v = F.col(c).cast("double")
            out.append(F.coalesce(F.when(~F.isnan(v) & (F.abs(v) <= 1e100), v), fill(c, "double"), F.lit(0.0)).alias(c))
    y = F.when(F.col("target").isin(logs), F.log1p("y")).otherwise(F.col("y"))
    return train.where(F.col("target").isin(list(fitted))).select("target", y.cast("double").alias("_y"), *out)


def fit(train: DataFrame, level: str, ids: Sequence[str], target: str, cfg: Settings = Settings()) -> Fitted | None:
    """One target's model; None without rows."""
    return fit_all(train.withColumn("target", F.lit(target)), level, ids, [target], cfg).get(target)


def predicted(f: Fitted, cols: dict[str, Column], clip: bool = False) -> Column:
    """Prediction in the unit of the target from its features, never negative for consumptions."""
    own = _filled(f, cols)
    return back_to_unit(f.model.predicted([own[c] for c in f.cat_columns], [own[c] for c in f.features if c not in f.cat_columns]), f.log1p, clip)


def back_to_unit(p: Column, log1p: bool, clip: bool = False) -> Column:
    """A model's output in the unit of the target; the logarithm kept within 0 and 30 where asked."""
    if not log1p:
        return p
    return F.greatest(F.expm1(clipped_log(p) if clip else p), F.lit(0.0))


def clipped_log(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(30.0))


def finite(v: Column) -> Column:
    """The value, or null where it is no number or beyond 1e100."""
    return F.when(~F.isnan(v) & (F.abs(v) <= 1e100), v)


def score(df: DataFrame, f: Fitted, clip: bool = False) -> DataFrame:
    """Adds ``y_pred`` in the unit of the target, never negative for consumptions."""
    return df.withColumn("y_pred", predicted(f, {c: F.col(c) for c in f.features}, clip))


def evaluate_all(hist: DataFrame, weather: DataFrame | None, level: str, ids: Sequence[str], targets: Sequence[str], cfg: Settings = Settings()) -> tuple[dict[str, Fitted], DataFrame | None]:
    """Models of the targets that pass the gates, and one table of all scored hold-outs (``target``, ``y_true``, ``y_pred``).

    Each target holds out its own last days. Discovered targets need 50 positive points, every target 30 rows
    and both parts.
    """
    gates = {r.target for r in signal_gates(hist, targets).where("trained").collect()}
    wanted = [t for t in targets if t in gates]
    if not wanted:
        return {}, None
    frame = cut_lineage(series.split_last_days(cut_lineage(feature_frames(hist, weather, ids, wanted, cfg)), cfg.valid_days, ["target"]))
    rows = frame.groupBy("target").agg(F.count("*").alias("n"), F.count_if(F.col("part") == "train").alias("k")).collect()
    ready = {r.target for r in rows if r.n >= 30 and 0 < r.k < r.n}
    fitted = fit_all(frame.where("part = 'train'"), level, ids, [t for t in wanted if t in ready], cfg)
    out = None
    for t, f in fitted.items():
        valid = frame.where((F.col("part") == "valid") & (F.col("target") == t))
        part = score(valid.where("y >= 0") if f.log1p else valid, f).withColumnRenamed("y", "y_true")
        out = part if out is None else out.unionByName(part)
    return fitted, out


def train_and_score(hist: DataFrame, weather: DataFrame | None, level: str, ids: Sequence[str], target: str, cfg: Settings = Settings()) -> tuple[Fitted | None, DataFrame | None]:
    """Hold out the last days, fit on the rest, score the hold-out. None when a gate fails."""
    fitted, scored = evaluate_all(hist, weather, level, ids, [target], cfg)
    return (fitted[target], scored.drop("target")) if fitted else (None, None)


def train_all(hist: DataFrame, weather: DataFrame | None, level: str, ids: Sequence[str], folder: str, target: str = "all", cfg: Settings = Settings()) -> list[str]:
    """Fits and saves every wanted target that passes the gates; scored hold-outs are written beside the models.

    All targets share the frame, the fit and the table of hold-outs; only the writes of the models are one each.
    """
    names = [t for t in expand_targets(target, hist.columns) if t in hist.columns]
    fitted, scored = evaluate_all(hist, weather, level, ids, names, cfg)
    for f in fitted.values():
        f.save(f"{folder}/models")
    if scored is not None:
        out = scored.select(*ids, "date", "y_true", "y_pred", "target").withColumn("level", F.lit(level))
        out.write.mode("append").partitionBy("level", "target").parquet(f"{folder}/eval_preds")
    return list(fitted)


def _from_state(state: Column, cfg: Settings) -> dict[str, Column]:
    """Lags and rolling values from the last days, oldest first; a rolling value needs one known day."""
    out = {f"lag_{k}": F.element_at(state, -k) for k in cfg.lags}
    for k in cfg.rolls:
        vals = F.filter(F.slice(state, -k, k), lambda v: v.isNotNull())
        srt, n = F.sort_array(vals), F.size(vals)
        mid = (F.get(srt, F.floor((n - 1) / 2).cast("int")) + F.get(srt, F.floor(n / 2).cast("int"))) / 2
        out[f"roll_med_{k}"] = F.when(n > 0, mid)
        out[f"roll_mean_{k}"] = F.when(n > 0, F.aggregate(vals, F.lit(0.0), lambda a, b: a + b) / n)
    return out


def forecast(hist: DataFrame, weather: DataFrame, ids: Sequence[str], target: str, f: Fitted, cfg: Settings = Settings(), max_days: int | None = None, every: int = 10) -> DataFrame:
    """Day-by-day forecast that feeds on its own predictions.

    One row per group carries its last days as an array. A ridge model is an expression, so the whole horizon
    is one fold inside the row; boosted trees are asked once a day over all groups, with no join or shuffle.
    """
    span = max(*cfg.lags, *cfg.rolls)
    static = [c for c in cfg.static if c in hist.columns]
    reach = series.horizon(hist, weather, ids, max_days).where("horizon > 0")
    recent = (
        hist.select(*ids, "date", finite(F.col(target).cast("double")).alias("_v"), *static).join(reach, list(ids))
        .groupBy(*ids, "last_date", "horizon")
        .agg(
            F.map_from_entries(F.collect_list(F.when(
                F.col("_v").isNotNull() & (F.col("date") > F.date_sub("last_date", span)), F.struct("date", "_v")
            ))).alias("_days"),
            F.count("_v").alias("_known"),
            *[F.max(c).alias(c) for c in static],
        )
        .where("_known > 0")
    )
    state = F.transform(F.sequence(F.lit(span - 1), F.lit(0)), lambda back: F.try_element_at("_days", F.date_sub("last_date", back)))
    cols = _weather(target, cfg)
    latest = keep_one(weather.select("siteId", "date", "seq", *cols), ["siteId", "date"], ["seq"], last=True)
    ahead = (
        latest.join(reach.select("siteId", "last_date", "horizon").distinct(), "siteId")
        .where((F.col("date") > F.col("last_date")) & (F.date_diff("date", "last_date") <= F.col("horizon")))
        .groupBy("siteId").agg(F.map_from_entries(F.collect_list(F.struct("date", F.struct(*cols)))).alias("_weather"))
    )
    none = F.array().cast("array<struct<date:date,yhat:double>>")
    x = recent.withColumn("_state", state).drop("_days", "_known").join(ahead, "siteId", "left")
    x = _day_by_day(x.withColumn("_out", none), f, cfg, cols, span, every) if isinstance(f.model, boost.Boosted) else _folded(x, f, cfg, cols, [*ids, *static], span, none)
    return x.select(*ids, F.explode("_out").alias("o")).select(*ids, "o.date", "o.yhat")


def _folded(x: DataFrame, f: Fitted, cfg: Settings, cols: Sequence[str], own: Sequence[str], span: int, none: Column) -> DataFrame:
    """The days to come as one fold over the horizon, from the state of each row."""
    def day(acc: Column, k: Column) -> Column:
        d = F.date_add("last_date", k)

        def after(wx: Column) -> Column:
            feats = {**{c: F.col(c) for c in own}, **series.calendar(d), **_from_state(acc["state"], cfg), **{c: wx[c] for c in cols}}
            return finite(predicted(f, feats, clip=True))

        return let(let(F.try_element_at("_weather", d), after), lambda v: F.struct(
            F.slice(F.concat(acc["state"], F.array(v)), 2, span).alias("state"),
            F.when(v.isNotNull(), F.concat(acc["out"], F.array(F.struct(d.alias("date"), v.alias("yhat"))))).otherwise(acc["out"]).alias("out")))

    start = F.struct(F.col("_state").alias("state"), none.alias("out"))
    return x.withColumn("_out", F.aggregate(F.sequence(F.lit(1), F.col("horizon").cast("int")), start, day)["out"])


def _day_by_day(x: DataFrame, f: Fitted, cfg: Settings, cols: Sequence[str], span: int, every: int) -> DataFrame:
    base = x.columns
    steps = x.agg(F.max("horizon")).first()[0] or 0
    for step in range(1, int(steps) + 1):
        d = F.date_add("last_date", step)
        day = x.withColumn("date", d).withColumns({c: F.try_element_at("_weather", d)[c] for c in cols})
        scored = score(series.add_calendar(day).withColumns(_from_state(F.col("_state"), cfg)), f, clip=True)
        yhat = F.when(F.col("horizon") >= step, finite(F.col("y_pred")))
        x = scored.withColumn("_yhat", yhat).withColumn("_state", F.slice(F.concat("_state", F.array("_yhat")), 2, span)).withColumn(
            "_out", F.when(F.col("_yhat").isNotNull(), F.concat("_out", F.array(F.struct(F.col("date"), F.col("_yhat").alias("yhat"))))).otherwise(F.col("_out"))
        ).select(*base)
        if step % every == 0:
            x = cut_lineage(x)
    return x


def id_codes(df: DataFrame, col: str) -> DataFrame:
    """Code of each distinct id in sorted order, numbered without a global window.

    Ids are range-partitioned; a first pass counts them per partition and the offsets are added.
    """
    ids = df.select(col).dropna().distinct()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = ids.repartitionByRange(n, col).sortWithinPartitions(col).withColumn("_mono", F.monotonically_increasing_id())
    parts = cut_lineage(parts.select(col, F.shiftright("_mono", 33).alias("_part"), F.col("_mono").bitwiseAND((1 << 33) - 1).alias("_pos")))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_off"))
    return parts.join(small_side(offsets), "_part").select(col, (F.col("_off") + F.col("_pos")).cast("long").alias("code"))
