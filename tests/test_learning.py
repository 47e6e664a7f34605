import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohmstead.operators import learn, metrics, ridge, series

DAY0 = dt.date(2021, 1, 4)


def history(spark, days=220):
    rng = np.random.default_rng(5)
    rows = []
    for site in (1, 2, 3):
        for i in range(days):
            v = 40 * site + 5 * np.sin(i / 7) + rng.normal()
            rows.append((site, DAY0 + dt.timedelta(days=i), float(v), float(100 * site)))
    return spark.createDataFrame(rows, "siteId long, date date, waterM3 double, surface_m2 double")


def weather(spark, days=230):
    rows = [(s, DAY0 + dt.timedelta(days=i), i, *[float((i * k) % 17) for k in range(1, 9)]) for s in (1, 2, 3) for i in range(days)]
    cols = ", ".join(f"{c} double" for c in learn.Settings().weather)
    return spark.createDataFrame(rows, f"siteId long, date date, seq long, {cols}")


@pytest.fixture(scope="module")
def trained(spark):
    h, w = history(spark), weather(spark)
    f, scored = learn.train_and_score(h, w, "site", ["siteId"], "waterM3")
    return h, w, f, scored


def test_ridge_equals_closed_form(spark, trained):
    h, w, f, _ = trained
    frame = series.split_last_days(learn.feature_frame(h, w, ["siteId"], "waterM3"), 60).where("part = 'train'")
    x = learn.score(frame, f).toPandas()
    y = np.log1p(x["y"].to_numpy())
    nums = [c for c in f.features if c not in f.cat_columns]
    cells = [x[c].astype(float).fillna(f.medians.get(c, 0.0)).to_numpy() for c in nums]
    cells += [(x[c].astype(str) == v).to_numpy(float) for c in f.cat_columns for v in sorted(x[c].astype(str).unique())]
    m = np.array(cells).T
    mu, c = m.mean(0), y - y.mean()
    coef = np.linalg.solve((m - mu).T @ (m - mu) + np.eye(m.shape[1]), (m - mu).T @ c)
    assert np.log1p(x["y_pred"].to_numpy()) == pytest.approx(np.maximum((m - mu) @ coef + y.mean(), 0), abs=1e-6)


def test_products_of_terms(spark):
    rows = [("t", "u", "x", 1.0, 2.0, 3.0), ("t", "u", None, 2.0, 0.0, 1.0), ("t", "v", "x", -1.0, 4.0, 2.0), ("s", "u", "y", 5.0, 1.0, 1.0)] * 3
    df = spark.createDataFrame(rows, "g string, a string, b string, p double, q double, y double").repartition(4)
    got = {(r.target, frozenset((r.a, r.b))): r.v for r in ridge.products(df, "g", ["a", "b"], ["p", "q"], "y").collect()}
    terms = [{ridge.ONE: 1.0, f"a={a}": 1.0, **({f"b={b}": 1.0} if b else {}), "p": p, "q": q, ridge.TRUTH: y, "g": g} for g, a, b, p, q, y in rows]
    want = {}
    for row in terms:
        g = row.pop("g")
        for i in row:
            for j in row:
                if i <= j:
                    want[g, frozenset((i, j))] = want.get((g, frozenset((i, j))), 0) + row[i] * row[j]
    want = {k: v for k, v in want.items() if v}
    assert {k: v for k, v in got.items() if v} == pytest.approx(want), set(want) ^ set(got)


def test_all_targets_equal_each_alone(spark):
    h = history(spark).withColumns({"elecPcKwh": F.when(F.col("siteId") > 1, F.col("waterM3") * 2), "indoorTempDegC": F.col("waterM3") / 10})
    w = weather(spark)
    names = ["waterM3", "elecPcKwh", "indoorTempDegC"]
    fitted, scored = learn.evaluate_all(h, w, "site", ["siteId"], names)
    assert set(fitted) == set(names) and "tempAmb" not in fitted["indoorTempDegC"].features
    together = scored.select("target", "siteId", "date", "y_pred").toPandas().set_index(["target", "siteId", "date"]).y_pred
    for t in names:
        f, alone = learn.train_and_score(h, w, "site", ["siteId"], t)
        alone = alone.select("siteId", "date", "y_pred").toPandas().set_index(["siteId", "date"]).y_pred
        assert together[t].sort_index().to_numpy() == pytest.approx(alone.sort_index().to_numpy(), rel=1e-9) and len(alone) > 100


def test_boosted_forecast_feeds_on_itself(spark):
    h, w = history(spark, 120), weather(spark, 130)
    cfg = learn.Settings(model="gbt", rounds=3, depth=3, valid_days=10)
    f, _ = learn.train_and_score(h, w, "site", ["siteId"], "waterM3", cfg)
    got = learn.forecast(h, w, ["siteId"], "waterM3", f, cfg, max_days=3, every=2).collect()
    assert len(got) == 9 and all(r.yhat > 0 for r in got)


def test_holdout_is_the_last_sixty_days(trained):
    _, _, f, scored = trained
    assert f.log1p and f.cat_columns == ["siteId", "dow", "month", "is_weekend"]
    assert scored.select(F.countDistinct("date")).first()[0] == 60
    assert scored.where("y_pred < 0").count() == 0


def test_forecast_matches_day_by_day_scoring(spark, trained):
    h, w, f, _ = trained
    got = {(r.siteId, r.date): r.yhat for r in learn.forecast(h, w, ["siteId"], "waterM3", f, max_days=4).collect()}
    assert len(got) == 12
    last = DAY0 + dt.timedelta(days=219)
    state = {(r.siteId, r.date): r.waterM3 for r in h.collect()}
    for step in range(1, 5):
        d, rows = last + dt.timedelta(days=step), []
        for s in (1, 2, 3):
            row = {"siteId": s, "date": d, "surface_m2": float(100 * s)}
            for k in (1, 2, 7, 14):
                row[f"lag_{k}"] = state.get((s, d - dt.timedelta(days=k)))
            for k in (7, 14, 30):
                v = [state[(s, d - dt.timedelta(days=j))] for j in range(1, k + 1) if (s, d - dt.timedelta(days=j)) in state]
                row[f"roll_med_{k}"], row[f"roll_mean_{k}"] = float(np.median(v)), float(np.mean(v))
            rows.append(row)
        df = series.add_calendar(spark.createDataFrame(rows)).join(w.drop("seq"), ["siteId", "date"])
        for r in learn.score(df, f, clip=True).select("siteId", "y_pred").collect():
            assert got[(r.siteId, d)] == pytest.approx(r.y_pred, rel=1e-9)
            state[(r.siteId, d)] = r.y_pred


def test_saved_model_scores_alike(spark, trained, tmp_path):
    _, _, f, scored = trained
    f.save(str(tmp_path))
    g = learn.load_fitted(spark, str(tmp_path), "site", "waterM3")
    assert g.features == f.features and g.medians == pytest.approx(f.medians)
    again = learn.score(scored.drop("y_pred").limit(5), g).select("y_pred").toPandas()
    assert again.y_pred.notna().all()


def test_gates_and_targets(spark):
    with pytest.raises(ValueError):
        learn.expand_targets("nothing", ["elecPcKwh"])
    assert learn.expand_targets("all", ["elecPcKwh", "elecTotalKwh", "waterPcM3", "elecBveKwh_drift"])[-2:] == ["elecPcKwh", "waterPcM3"]
    few = spark.createDataFrame([(1, DAY0, 3.0)], "siteId long, date date, elecPcKwh double")
    assert learn.train_and_score(few, None, "site", ["siteId"], "elecPcKwh") == (None, None)


def test_id_codes(spark):
    df = spark.createDataFrame([(v,) for v in (40, 7, 7, 99, 12, None)], "zoneId long")
    assert {r.zoneId: r.code for r in learn.id_codes(df, "zoneId").collect()} == {7: 0, 12: 1, 40: 2, 99: 3}


def test_metric_edges(spark):
    df = spark.createDataFrame([("z", 0.0, 1.0), ("z", 0.0, 0.0), ("c", 5.0, 4.0), ("c", 5.0, 6.0), ("n", None, 1.0)], "k string, y_true double, y_pred double")
    out = metrics.errors(df, ["k"], ["n", "MAE", "WAPE", "MAPE", "R2", "sMAPE"]).toPandas().set_index("k")
    assert np.isnan(out.loc["z", "WAPE"]) and np.isnan(out.loc["z", "MAPE"]) and out.loc["z", "sMAPE"] == 200.0
    assert np.isnan(out.loc["c", "R2"]) and out.loc["c", "WAPE"] == 0.2
    assert out.loc["n", "n"] == 0 and np.isnan(out.loc["n", "MAE"])


def test_all_targets_are_trained_saved_and_scored(spark, tmp_path):
    h = history(spark).withColumns({"elecPcKwh": F.lit(None).cast("double"), "indoorTempDegC": F.col("waterM3") / 10})
    cfg = learn.Settings(weather=(), static=())
    assert learn.train_all(h, None, "site", ["siteId"], str(tmp_path), cfg=cfg) == ["waterM3", "indoorTempDegC"]
    out = spark.read.parquet(str(tmp_path / "eval_preds"))
    assert {r.target for r in out.select("target").distinct().collect()} == {"waterM3", "indoorTempDegC"}
    assert not learn.load_fitted(spark, str(tmp_path / "models"), "site", "indoorTempDegC").log1p


def test_boosted_query_fits_the_full_model(spark, data, monkeypatch):
    from ohmstead.plans import consumption

    seen = []

    def fitted(hist, weather, level, ids, target, cfg):
        seen.append(cfg)
        return None, spark.createDataFrame([(1, 2.0, 1.0)], "siteId long, y_true double, y_pred double")

    monkeypatch.setattr(learn, "train_and_score", fitted)
    consumption.boosted_evaluation(spark, data)
    assert seen == [learn.Settings(model="gbt")] and (seen[0].depth, seen[0].rounds) == (8, 350)
