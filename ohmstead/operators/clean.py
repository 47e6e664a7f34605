"""Cleaning of daily series, every change logged.

Two rules depend on their own earlier changes and are folded in order, one group at a time, as array
expressions; a group is one daily series, bounded by its calendar, and groups that neither rule can touch
never get there. All other rules are window expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.functions.text import let
from ohmstead.operators import enrich, series
from ohmstead.operators.keyed import sealed
from ohmstead.session import cut_lineage

LOG_TYPE = "array<struct<value_col:string,action:string,old:double,new:double,reference:double,gap_days:long,span_days:long>>"


@dataclass(frozen=True)
class Rule:
    """How one column is cleaned; ``passes`` counts the spike scans."""

    col: str
    pred: str | None = None
    factor: float = 8.0
    passes: int = 1
    spread: bool = False


@dataclass(frozen=True)
class Limits:
    """Fixed values of the sequential rules."""

    near_days: int = 2
    long_gap: int = 30
    gap_factor: float = 0.6
    pred_factor: float = 10.0
    min_run: int = 3
    spread_factor: float = 20.0
    baseline_points: int = 30
    max_span: int = 370


def _middle(values: Column) -> Column:
    """Median of a short array."""
    s, n = F.sort_array(values), F.size(values)
    lo, hi = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(s, lo) + F.get(s, hi)) / 2


def spike_candidate(ids: Sequence[str], rule: Rule, lim: Limits = Limits()) -> Column:
    """Spike test against unchanged neighbours, on a filled calendar."""
    w = Window.partitionBy(*ids).orderBy("date")
    v = F.col(rule.col)
    around = [f(v, k).over(w) for k in range(1, lim.near_days + 1) for f in (F.lag, F.lead)]
    near = F.filter(F.array(*around), lambda x: x > 0)
    valid_day = F.when(v > 0, F.col("date"))
    prev = F.last(valid_day, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.date_diff("date", F.coalesce(prev, F.date_sub(F.min("date").over(Window.partitionBy(*ids)), 1))) - 1
    factor = F.when(gap >= lim.long_gap, rule.factor * lim.gap_factor).otherwise(F.lit(rule.factor))
    high = v > _middle(near) * factor
    if rule.pred:
        high = high | F.coalesce((F.col(rule.pred) > 0) & (v > F.col(rule.pred) * lim.pred_factor), F.lit(False))
    return F.coalesce((v > 0) & (F.size(near) >= 2) & high, F.lit(False))


_ENTRY = "struct<day:int,value_col:string,action:string,old:double,new:double,reference:double,gap_days:long,span_days:long>"


def _entry(day: Column, rule: Rule, action: Column, old: Column, new: Column, ref: Column, gap: Column, span: Column) -> Column:
    return F.struct(day, F.lit(rule.col), action, old, new, ref, gap.cast("long"), span.cast("long")).cast(_ENTRY)


def _places(v: Column) -> Column:
    """Positions of the positive values."""
    return F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: F.get(v, i) > 0)


def _spikes(v0: Column, p: Column | None, rule: Rule, lim: Limits) -> Column:
    """One scan over a series as an array: (v, log). A dropped day is gone for the days after it.

    Only days above their lowest neighbour by the factor are visited: dropping a neighbour never lowers it.
    """
    near_days = [k for k in range(-lim.near_days, lim.near_days + 1) if k]
    around = lambda v, i: F.filter(F.array(*[F.get(v, i + k) for k in near_days]), lambda x: x > 0)

    def over_pred(v: Column, i: Column) -> Column:
        return F.lit(False) if p is None else F.coalesce((F.get(p, i) > 0) & (F.get(v, i) > F.get(p, i) * lim.pred_factor), F.lit(False))

    def visited(present: Column) -> Column:
        ahead = F.concat(F.array(F.lit(-1)), F.slice(present, F.lit(1), F.greatest(F.size(present) - 1, F.lit(0))))
        pairs = F.zip_with(present, ahead, lambda i, prev: F.struct(i.alias("i"), (i - prev - 1).alias("gap")))
        return F.filter(pairs, lambda e: e["i"].isNotNull() & (F.coalesce(F.get(v0, e["i"]) > F.array_min(around(v0, e["i"])) * (rule.factor * min(1.0, lim.gap_factor)), F.lit(False)) | over_pred(v0, e["i"])))

    may = let(_places(v0), visited)

    def step(acc: Column, e: Column) -> Column:
        i, gap = e["i"], e["gap"]

        def judged(near: Column) -> Column:
            mid = _middle(near)
            factor = F.when(gap >= lim.long_gap, F.lit(lim.gap_factor)).otherwise(F.lit(1.0))
            value = F.get(acc["v"], i)
            hit = (F.size(near) >= 2) & ((value > mid * rule.factor * factor) | over_pred(acc["v"], i))
            none = F.lit(None).cast("double")
            return F.when(hit, F.struct(
                F.transform(acc["v"], lambda x, j: F.when(j != i, x)).alias("v"),
                F.concat(acc["log"], F.array(_entry(i, rule, F.lit("local_spike_drop"), value, none, mid, gap, F.lit(None)))).alias("log"))).otherwise(acc)

        return let(around(acc["v"], i), judged)

    return F.aggregate(may, F.struct(v0.alias("v"), F.array().cast(f"array<{_ENTRY}>").alias("log")), step)


def _jumps(v0: Column, rule: Rule, lim: Limits) -> Column:
    """Cumulated readings after a gap spread over it, in order: (v, log)."""
    def scanned(present: Column) -> Column:
        overall = _middle(F.transform(present, lambda i: F.get(v0, i)))
        n = F.greatest(F.size(present) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(present, F.lit(2), n), F.slice(present, F.lit(1), n), lambda i, prev: F.struct(i.alias("i"), prev.alias("prev")))
        wide = F.filter(pairs, lambda e: e["i"] - e["prev"] - 1 >= lim.min_run)

        def step(acc: Column, e: Column) -> Column:
            i, gap = e["i"], e["i"] - e["prev"] - 1
            known = F.filter(F.slice(acc["v"], F.lit(1), e["prev"] + 1), lambda x: x > 0)

            def judged(own: Column) -> Column:
                base = F.when(F.size(own) > 0, _middle(F.slice(own, F.greatest(F.size(own) - lim.baseline_points, F.lit(0)) + 1, F.lit(lim.baseline_points)))).otherwise(overall)
                value, span = F.get(acc["v"], i), gap + 1
                far = span > lim.max_span
                share = F.when(~far, value / span)
                changed = F.transform(acc["v"], lambda x, j: F.when(far & (j == i), F.lit(None).cast("double")).when(~far & (j >= i - gap) & (j <= i), share).otherwise(x))
                action = F.when(far, "drop").otherwise("spread")
                return F.when(value > base * lim.spread_factor, F.struct(
                    changed.alias("v"), F.concat(acc["log"], F.array(_entry(i, rule, action, value, share, base, gap, span))).alias("log"))).otherwise(acc)

            return let(known, judged)

        return F.aggregate(wide, F.struct(v0.alias("v"), F.array().cast(f"array<{_ENTRY}>").alias("log")), step)

    return let(_places(v0), scanned)


def _touched(ids: Sequence[str], rules: Sequence[Rule], lim: Limits) -> Column:
    """Whether a day may be the first one that a rule changes; a group without such a day keeps all its values."""
    w = Window.partitionBy(*ids).orderBy("date")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    out = F.lit(False)
    for r in rules:
        v = F.col(r.col)
        if r.passes:
            near = F.filter(F.array(*[f(v, k).over(w) for k in range(1, lim.near_days + 1) for f in (F.lag, F.lead)]), lambda x: x > 0)
            high = v > F.array_min(near) * (r.factor * min(1.0, lim.gap_factor))
            if r.pred:
                high = F.coalesce(high, F.lit(False)) | ((F.col(r.pred) > 0) & (v > F.col(r.pred) * lim.pred_factor))
            out = out | F.coalesce((v > 0) & high, F.lit(False))
        if r.spread:
            gap = F.date_diff("date", F.last(F.when(v > 0, F.col("date")), ignorenulls=True).over(earlier)) - 1
            out = out | F.coalesce((v > 0) & (gap >= lim.min_run) & (v > F.min(F.when(v > 0, v)).over(earlier) * lim.spread_factor), F.lit(False))
    return out


def drop_and_spread(df: DataFrame, ids: Sequence[str], rules: Sequence[Rule], lim: Limits = Limits()) -> DataFrame:
    """Spike drops, then spreads of cumulated readings, on a filled calendar; adds ``log``.

    Groups that no rule can touch pass through. The others become one row each, a daily series bounded by
    its calendar, and are folded in order by array expressions.
    """
    ids = list(ids)
    marked = df.withColumn("_touch", F.max(_touched(ids, rules, lim)).over(Window.partitionBy(*ids)))
    rest = [c for c in df.columns if c not in ids]
    calm = marked.where(~F.col("_touch")).select(*df.columns, F.array().cast(LOG_TYPE).alias("log"))
    x = marked.where("_touch").groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("date", *[c for c in rest if c != "date"]))).alias("_days"))
    # sealed: a series is taken out of the days once, not at every mention
    x = sealed(x.withColumns({**{f"_v{n}": F.col("_days")[r.col].cast("array<double>") for n, r in enumerate(rules)},
                              **{f"_p{n}": F.col("_days")[r.pred].cast("array<double>") for n, r in enumerate(rules) if r.pred}}))
    logs = [f"_l{n}_{k}" for n, r in enumerate(rules) for k in range(r.passes + r.spread)]
    # columns do not touch each other, so a scan runs over all of them at once
    for k in range(max([r.passes + r.spread for r in rules], default=0)):
        now = [n for n, r in enumerate(rules) if k < r.passes + r.spread]
        guess = {n: F.col(f"_p{n}") if rules[n].pred else None for n in now}
        x = sealed(x.withColumns({f"_s{n}": _spikes(F.col(f"_v{n}"), guess[n], rules[n], lim) if k < rules[n].passes else _jumps(F.col(f"_v{n}"), rules[n], lim) for n in now}))
        x = x.withColumns({**{f"_v{n}": F.col(f"_s{n}.v") for n in now}, **{f"_l{n}_{k}": F.col(f"_s{n}.log") for n in now}}).drop(*[f"_s{n}" for n in now])
    found = F.concat(*logs) if logs else F.array().cast(f"array<{_ENTRY}>")
    # the entries of every day that has any, found once and then looked up
    x = sealed(sealed(x.withColumn("_log", found).drop(*logs)).withColumn("_by_day", let(
        F.array_distinct(F.transform("_log", lambda e: e["day"])),
        lambda hit: F.map_from_arrays(hit, F.transform(hit, lambda d: F.filter("_log", lambda e: e["day"] == d))))))
    kinds = dict(df.dtypes)
    place = {r.col: f"_v{n}" for n, r in enumerate(rules)}
    own = [c for c in LOG_TYPE[len("array<struct<"):-2].split(",")]
    days = F.transform("_days", lambda d, i: F.struct(
        *[(F.get(F.col(place[c]), i).cast(kinds[c]) if c in place else d[c]).alias(c) for c in rest],
        F.transform(F.coalesce(F.try_element_at("_by_day", i), F.array().cast(f"array<{_ENTRY}>")), lambda e: F.struct(*[e[c.split(":")[0]] for c in own])).cast(LOG_TYPE).alias("log")))
    return calm.unionByName(x.select(*ids, F.inline(days)))


def cap_outliers(df: DataFrame, ids: Sequence[str], factors: dict[str, float], window: int = 30, min_baseline: float = 1.0) -> DataFrame:
    """Caps at a multiple of the trailing median, all columns over one window; adds ``caps``."""
    w = Window.partitionBy(*ids).orderBy("date").rowsBetween(-window, -1)
    enough = max(5, window // 3)
    x = df.withColumns({
        f"_cap_{c}": F.when(F.count(c).over(w) >= enough, F.percentile(c, 0.5).over(w)) for c in factors
    })
    limit = {c: F.when(F.col(f"_cap_{c}") >= min_baseline, F.col(f"_cap_{c}") * f) for c, f in factors.items()}
    entries = [
        F.when(F.col(c) > limit[c], F.struct(F.lit(c).alias("value_col"), F.col(c).alias("old"), limit[c].alias("new")))
        for c in factors
    ]
    x = x.withColumn("caps", F.filter(F.array(*entries), lambda e: e.isNotNull()))
    x = x.withColumns({c: F.when(F.col(c) > limit[c], limit[c]).otherwise(F.col(c)) for c in factors})
    return x.drop(*[f"_cap_{c}" for c in factors])


def clip_to_ceiling(df: DataFrame, ids: Sequence[str], value: str, pred: str, roll_days: int = 14, pred_factor: float = 25.0, roll_factor: float = 50.0, strategy: str = "cap") -> DataFrame:
    """Ceiling from the prediction and the rolling median of the last calendar days, this day included."""
    w = Window.partitionBy(*ids).orderBy(F.unix_date("date")).rangeBetween(-(roll_days - 1), 0)
    roll = F.when(F.count(value).over(w) >= max(3, roll_days // 3), F.percentile(value, 0.5).over(w))
    x = df.withColumn("roll_med", roll).withColumn("cap", F.least(F.col(pred) * pred_factor, F.col("roll_med") * roll_factor))
    high = (F.col(value) > 0) & (F.col("cap") > 0) & (F.col(value) > F.col("cap"))
    fixed = F.lit(None).cast("double") if strategy == "drop" else F.col("cap")
    return x.withColumn("old", F.when(high, F.col(value))).withColumn(value, F.when(high, fixed).otherwise(F.col(value)))


def unit_by_prediction(aligned: DataFrame, ids: Sequence[str], divisors: Sequence[float] = (1000.0, 1e6), tol: float = 3.0, min_pairs: int = 20, min_prop: float = 0.6) -> DataFrame:
    """Groups whose readings are a power of ten off the prediction: divisor, evidence, whole or paired rows."""
    pairs = aligned.where((F.col("value") > 0) & (F.col("pred") > 0)).select(*ids, (F.col("value") / F.col("pred")).alias("ratio"))
    pairs = cut_lineage(pairs)
    med = pairs.groupBy(*ids).agg(F.percentile("ratio", 0.5).alias("median_ratio"), F.count("*").alias("pairs")).where(F.col("pairs") >= min_pairs)
    options = F.array(*[
        F.struct(F.abs(F.log10(F.col("median_ratio") / d)).alias("score"), F.lit(i).alias("pos"), F.lit(float(d)).alias("divisor"))
        for i, d in enumerate((1.0, *divisors))
    ])
    best = med.withColumn("_best", F.array_min(options)).withColumn("_own", F.abs(F.log10("median_ratio")))
    tol10 = float(np.log10(tol))
    chosen = best.where(
        (F.col("_best.divisor") != 1.0) & (F.col("_best.score") < tol10) & (F.col("_best.score") + 0.15 < F.col("_own"))
    ).select(*ids, "median_ratio", "pairs", F.col("_best.divisor").alias("divisor"))
    close = F.abs(F.log10(F.col("ratio") / F.col("divisor"))) <= tol10
    out = pairs.join(chosen, list(ids)).groupBy(*ids).agg(
        F.max("median_ratio").alias("median_ratio"), F.max("pairs").alias("pairs"), F.max("divisor").alias("divisor"), F.avg(close.cast("double")).alias("prop_close"))
    return out.withColumn("whole_group", F.col("prop_close") >= min_prop)


def apply_unit(aligned: DataFrame, fixes: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Divides positive readings of corrected groups; only paired days when the evidence is partial."""
    x = aligned.join(fixes.select(*ids, "divisor", "whole_group"), list(ids), "left")
    use = (F.col("value") > 0) & F.col("divisor").isNotNull() & (F.col("whole_group") | (F.col("pred") > 0))
    return x.withColumn("new_value", F.when(use, F.col("value") / F.col("divisor")).otherwise(F.col("value")))


def unit_by_median(df: DataFrame, ids: Sequence[str], value: str = "value", divisors: Sequence[float] = (1000.0, 1e6), factor: float = 200.0, min_med: float = 1e-9) -> DataFrame:
    """Readings far above the group's median are divided when that brings them back."""
    med = df.where(F.col(value) > 0).groupBy(*ids).agg(F.percentile(value, 0.5).alias("_med"))
    x = df.join(med, list(ids), "left")
    v, m = F.col(value), F.col("_med")
    odd = (v > 0) & (m >= min_med) & (v / m > factor)
    best = F.array_max(F.array(*[F.when(F.lit(d) > 1, F.lit(float(d))) for d in divisors]))
    ok = odd & (v / best / m <= factor)
    return x.withColumn("divisor", F.when(ok, best)).withColumn("new_value", F.when(ok, v / best).otherwise(v)).drop("_med")


# ---- the whole chain -----------------------------------------------------------------------


def clean_level(hist: DataFrame, pred: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Sentinels, spikes, spreads, caps, rebuilt totals, caps again; one row per calendar day."""
    ids = list(ids)
    keys = [*ids, "date"]
    x = enrich.total_without(enrich.total_accurate(cut_lineage(hist)))
    if "indoorTempDegC" in x.columns:
        x = x.withColumn("indoorTempDegC", series.band("indoorTempDegC", 5, 40))
    usages = enrich.discover_usages(x.columns)
    totals = [c for c in ("elecTotalKwh", "elecAggregatedKwh", "elecTotalFromDriftKwh") if c in x.columns]
    source = [*totals, *usages, *[c for c in ("waterM3",) if c in x.columns]]
    other = [c for c in enrich.discover_targets(x.columns) if c not in source]
    measures = [*source, *other]
    x = x.withColumns({c: series.positive(c) for c in source})
    preds = [c for c in ("totalKwh", "totalWater") if c in pred.columns]
    p = pred.select(*keys, *[series.positive(c).alias(c) for c in preds])
    kept = [c for c in ("indoorTempDegC",) if c in x.columns]
    both = x.select(*keys, *kept, *measures).unionByName(p, allowMissingColumns=True)
    daily = both.dropna(subset=keys).groupBy(*keys).agg(*[F.max(c).alias(c) for c in [*kept, *measures, *preds]])
    daily = series.fill_calendar(daily, ids, [*kept, *measures, *preds])

    matched = {"elecTotalKwh": "totalKwh", "waterM3": "totalWater"}
    rules = []
    for c in measures:
        scans = 0 if c == "elecAggregatedKwh" else 2 if c in usages else 1
        scans = 0 if c == "elecTotalKwh" and "totalKwh" not in preds else scans
        guess = matched.get(c) if matched.get(c) in preds else None
        rules.append(Rule(c, guess, 6.0 if c == "waterM3" else 8.0, scans, c in totals or c == "waterM3"))
    done = drop_and_spread(daily, ids, rules)
    done = cap_outliers(done, ids, {c: 8.0 if c.startswith("elec") else 6.0 for c in source}).withColumnRenamed("caps", "_caps1")
    done = cut_lineage(done)
    done = enrich.total_without(enrich.total_accurate(done))
    done = cap_outliers(done, ids, {c: 8.0 for c in ("elecTotalAccurateKwh", "elecTotalNoBveKwh")})
    return done.withColumn("caps", F.concat("_caps1", "caps")).drop("_caps1")


def cleaning_log(cleaned: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Every changed value as one row with the rule that changed it."""
    cap = F.transform("caps", lambda c: F.struct(
        c["value_col"].alias("value_col"), F.lit("cap").alias("action"), c["old"].alias("old"), c["new"].alias("new"),
        c["new"].alias("reference"), F.lit(None).cast("long").alias("gap_days"), F.lit(None).cast("long").alias("span_days"),
    ))
    entries = F.concat(F.coalesce("log", F.array().cast(LOG_TYPE)), cap.cast(LOG_TYPE))
    return cleaned.select(*ids, "date", F.explode(entries).alias("e")).select(*ids, "date", "e.*")
