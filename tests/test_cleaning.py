import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ohmstead.operators import clean, series
from ohmstead.operators.keyed import exact_quantiles

DAY0 = dt.date(2020, 1, 1)
SCHEMA = "siteId long, date date, value double, pred double"


def number(v):
    return None if v is None else float(v)


def frame(spark, values, site=1, preds=None):
    preds = preds or [None] * len(values)
    return spark.createDataFrame([(site, DAY0 + dt.timedelta(days=i), v, p) for i, (v, p) in enumerate(zip(map(number, values), map(number, preds)))], SCHEMA)


def spikes(values, preds=None, factor=8.0):
    """Plain restatement: scan the days in order, dropped days vanish for the later ones."""
    s, out = list(values), []
    n = len(s)
    preds = preds or [None] * n
    ok = lambda v: v is not None and v > 0
    before, run = [], 0
    for v in s:
        before.append(run)
        run = 0 if ok(v) else run + 1
    for i in range(n):
        if not ok(s[i]):
            continue
        near = [s[j] for j in range(max(0, i - 2), min(n, i + 3)) if j != i and ok(s[j])]
        if len(near) < 2:
            continue
        limit = float(np.median(near)) * factor * (0.6 if before[i] >= 30 else 1.0)
        if s[i] > limit or (ok(preds[i]) and s[i] > 10 * preds[i]):
            out.append(i)
            s[i] = None
    return s, out


def jumps(values, factor=20.0, most=370):
    s, log = list(values), []
    ok = lambda v: v is not None and v > 0
    missing = [not ok(v) for v in s]
    allv = [v for v in s if ok(v)]
    last = -1
    for i, m in enumerate(missing):
        if m:
            continue
        prev, last = last, i
        gap = i - prev - 1
        if prev < 0 or gap < 3 or not ok(s[i]):
            continue
        known = [v for v in s[: prev + 1] if ok(v)][-30:]
        base = float(np.median(known)) if known else float(np.median(allv))
        if s[i] <= factor * base:
            continue
        if gap + 1 > most:
            log.append((i, "drop"))
            s[i] = None
        else:
            part = s[i] / (gap + 1)
            log.append((i, "spread"))
            for j in range(i - gap, i + 1):
                s[j] = part
    return s, log


def run(spark, df, rule, lim=clean.Limits()):
    out = clean.drop_and_spread(series.fill_calendar(df, ["siteId"], ["value", "pred"]), ["siteId"], [rule], lim)
    return out.orderBy("siteId", "date").toPandas()


def as_list(col):
    return [None if pd.isna(v) else v for v in col]


@pytest.mark.parametrize("values,preds", [
    ([10.0, 10, 10, 200, 10, 10], None),
    ([10.0, 10, 500, 400, 10, 10], None),
    ([10.0, None, 500, None, None, 1.0], None),
    ([10.0] * 5 + [None] * 35 + [60.0, 10, 10], None),
    ([50.0] * 8, [4.0] * 8),
])
def test_spike_cases(spark, values, preds):
    got = run(spark, frame(spark, values, preds=preds), clean.Rule("value", "pred"))
    want, dropped = spikes(values, preds)
    assert as_list(got.value) == want
    assert [i for i, log in enumerate(got["log"]) if len(log)] == dropped


@pytest.mark.parametrize("values", [
    [10.0] * 30 + [None] * 4 + [900.0] + [10.0] * 3,
    [10.0] * 30 + [None] * 400 + [900.0] + [10.0] * 3,
    [10.0] * 30 + [None] * 2 + [900.0] + [10.0] * 3,
])
def test_spread_cases(spark, values):
    got = run(spark, frame(spark, values), clean.Rule("value", passes=0, spread=True))
    want, log = jumps(values)
    assert as_list(got.value) == pytest.approx(want)
    assert [(i, e[0]["action"]) for i, e in enumerate(got["log"]) if len(e)] == log


def test_random_series_match_plain_scan(spark):
    rng = np.random.default_rng(3)
    parts, want_s, want_j = [], {}, {}
    for site in range(40):
        v = [None if rng.random() < 0.35 else float(rng.choice([5, 8, 10, 12, 90, 400, 900], p=[.25, .25, .2, .2, .04, .03, .03])) for _ in range(150)]
        v[0] = v[-1] = 10.0
        parts += [(site, DAY0 + dt.timedelta(days=i), x, None) for i, x in enumerate(v)]
        want_s[site], _ = spikes(v)
        want_j[site], _ = jumps(v, 6.0)
    df = spark.createDataFrame(parts, SCHEMA).orderBy(F.rand(1))
    a = run(spark, df, clean.Rule("value"))
    b = run(spark, df, clean.Rule("value", passes=0, spread=True), clean.Limits(spread_factor=6.0))
    for site in range(40):
        assert as_list(a[a.siteId == site].value) == want_s[site]
        assert as_list(b[b.siteId == site].value) == pytest.approx(want_j[site])


def test_cap_has_no_leak_between_groups(spark):
    high, low = frame(spark, [1000.0] * 40, 1), frame(spark, [10.0] * 39 + [500.0], 2)
    out = clean.cap_outliers(high.union(low), ["siteId"], {"value": 8.0}).orderBy("siteId", "date").toPandas()
    assert out[out.siteId == 1].value.eq(1000.0).all()
    assert out[out.siteId == 2].value.iloc[-1] == 80.0
    assert out.caps.map(len).sum() == 1


def test_long_gaps_at_edges(spark):
    values = [None] * 30 + [1.0] + [None] * 29 + [1.0] + [None] * 30 + [1.0] + [None] * 31
    out = series.long_gaps(frame(spark, values), ["siteId"]).orderBy("gap_start").toPandas()
    assert out.gap_days.tolist() == [30, 30, 31]


def test_unit_fix_needs_twenty_pairs(spark):
    ok = frame(spark, [1000.0 * (i + 1) for i in range(25)], 1, [float(i + 1) for i in range(25)])
    few = frame(spark, [1000.0 * (i + 1) for i in range(19)], 2, [float(i + 1) for i in range(19)])
    fixes = clean.unit_by_prediction(ok.union(few), ["siteId"]).toPandas()
    assert fixes.siteId.tolist() == [1] and fixes.divisor.tolist() == [1000.0]


def test_lags_by_row_and_by_day(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0]).where("value <> 3").select("siteId", "date", "value")
    by_row = series.add_lags(df, ["siteId"], "value", (1,)).orderBy("date").toPandas().lag_1.tolist()
    by_day = series.add_lags(df, ["siteId"], "value", (1,), mode="days").orderBy("date").toPandas().lag_1.tolist()
    assert by_row[1:] == [1.0, 2.0] and by_day[1] == 1.0 and np.isnan(by_day[2])


@pytest.mark.parametrize("partitions", [1, 8])
def test_exact_quantiles(spark, partitions):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=5000).round(2), np.concatenate([np.zeros(3000), rng.exponential(size=1001)])
    df = spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b], "k string, v double").repartition(partitions)
    out = exact_quantiles(df, ["k"], "v", {"p1": 0.01, "p50": 0.5, "p99": 0.99}).toPandas().set_index("k")
    for k, x in (("a", a), ("b", b)):
        assert out.loc[k].tolist() == pytest.approx(np.quantile(x, [0.01, 0.5, 0.99]).tolist(), abs=1e-12)


def test_whole_chain_keeps_its_contract(spark, data):
    from ohmstead.sources import tables as t

    ids = ["siteId"]
    hist, pred = t.site_history(spark, data), t.site_pred(spark, data)
    out = clean.clean_level(hist, pred, ids).persist()
    span = series.expected_range(hist, pred, ids).select(F.sum(F.date_diff("end", "start") + 1)).first()[0]
    assert out.count() == span and out.select(*ids, "date").distinct().count() == span
    log = clean.cleaning_log(out, ids)
    assert set(log.columns) >= {"value_col", "action", "old", "new"}
    before = hist.select("siteId", "date", F.col("waterM3").alias("old_value"))
    changed = out.join(before, ["siteId", "date"], "left").where(~F.col("waterM3").eqNullSafe(F.when(F.col("old_value") > 0, F.col("old_value")))).select("siteId", "date")
    logged = log.where("value_col = 'waterM3' AND action IN ('cap', 'local_spike_drop')").select("siteId", "date")
    spread = log.where("value_col = 'waterM3' AND action IN ('spread', 'drop')").count()
    assert changed.join(logged, ["siteId", "date"], "left_anti").count() == 0 or spread > 0
    out.unpersist()
