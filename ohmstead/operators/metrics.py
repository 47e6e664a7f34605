"""Error metrics, comparisons, histograms. All are single partial aggregates per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmstead.operators.keyed import exact_quantiles, small_side
from ohmstead.session import cut_lineage


def _pair(truth: str, pred: str) -> tuple[Column, Column, Column]:
    y, p = F.col(truth), F.col(pred)
    ok = y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)
    return y, p, ok


def error_aggregates(truth: str = "y_true", pred: str = "y_pred", consumption: Column | bool = True) -> dict[str, Column]:
    """MAE, RMSE, WAPE, MAPE, bias, R2 and sMAPE of finite pairs."""
    y, p, ok = _pair(truth, pred)
    err = F.when(ok, p - y)
    size = F.abs(F.when(ok, y))
    both = size + F.abs(F.when(ok, p))
    use = consumption if isinstance(consumption, Column) else F.lit(consumption)
    spread = F.sum(F.when(ok, y * y)) - F.sum(F.when(ok, y)) * F.avg(F.when(ok, y))
    return {
        "n": F.count(err),
        "MAE": F.avg(F.abs(err)),
        "RMSE": F.sqrt(F.avg(err * err)),
        "WAPE": F.when(use & (F.sum(size) > 0), F.sum(F.abs(err)) / F.sum(size)),
        "MAPE": F.avg(F.when(size > 1e-9, F.abs(err) / size)) * 100,
        "Bias": F.avg(err),
        "R2": F.when(spread > 0, 1 - F.sum(err * err) / spread),
        "sMAPE": F.when(use, F.avg(F.when(both > 0, F.abs(err) / both)) * 200),
    }


def errors(df: DataFrame, keys: Sequence[str], wanted: Sequence[str], truth: str = "y_true", pred: str = "y_pred", consumption: Column | bool = True) -> DataFrame:
    agg = error_aggregates(truth, pred, consumption)
    return df.groupBy(*keys).agg(*[agg[m].alias(m) for m in wanted])


def per_surface(df: DataFrame, keys: Sequence[str], surface: str = "surface_m2") -> DataFrame:
    """MAE, RMSE and WAPE of values divided by the floor area."""
    s = F.when(F.col(surface) > 0, F.col(surface))
    x = df.withColumn("_y", F.col("y_true") / s).withColumn("_p", F.col("y_pred") / s)
    return errors(x, keys, ["MAE", "RMSE", "WAPE"], "_y", "_p").withColumnsRenamed(
        {"MAE": "MAE_m2", "RMSE": "RMSE_m2", "WAPE": "WAPE_m2"}
    )


def global_report(df: DataFrame, keys: Sequence[str], surface: str | None = None) -> DataFrame:
    """Whole-table metrics per target; the median error uses a distributed selection."""
    df = cut_lineage(df.select(*keys, "y_true", "y_pred", *([surface] if surface else [])))
    base = errors(df, keys, ["n", "MAE", "RMSE", "WAPE", "Bias", "sMAPE", "R2"])
    med = exact_quantiles(df.withColumn("_e", F.abs(F.col("y_pred") - F.col("y_true"))), keys, "_e", {"MedAE": 0.5})
    out = base.join(small_side(med), list(keys), "left")
    return out.join(small_side(per_surface(df, keys, surface)), list(keys), "left") if surface else out


def pair_errors(df: DataFrame, pairs: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Errors of several (prediction, truth) column pairs in one pass."""
    entries = F.array(*[
        F.struct(F.lit(p).alias("pred_col"), F.lit(t).alias("true_col"), F.col(t).alias("y_true"), F.col(p).alias("y_pred"))
        for p, t in pairs.items()
    ])
    long = df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*")
    agg = error_aggregates()
    return long.groupBy(*keys, "pred_col", "true_col").agg(
        F.count("y_true").alias("n"), *[agg[m].alias(m) for m in ("MAE", "RMSE", "MAPE", "Bias")]
    )


def compare_sum_of_uses(total: DataFrame, uses: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Direct total against the sum of per-usage predictions: errors of both and the gain."""
    keys = [*ids, "date"]
    summed = uses.groupBy(*keys).agg(F.sum(F.coalesce("y_pred", F.lit(0.0))).alias("_sum"))
    x = total.select(*keys, "y_true", F.col("y_pred").alias("direct")).join(summed, keys, "left")
    x = x.withColumn("by_use", F.greatest(F.coalesce("_sum", F.lit(0.0)), F.lit(0.0)))
    d, s = error_aggregates("y_true", "direct"), error_aggregates("y_true", "by_use")
    out = x.groupBy(*ids).agg(
        F.count("*").alias("n"),
        d["RMSE"].alias("RMSE_direct"), s["RMSE"].alias("RMSE_sumUses"),
        d["WAPE"].alias("WAPE_direct"), s["WAPE"].alias("WAPE_sumUses"),
    )
    for m in ("RMSE", "WAPE"):
        base, new = F.col(f"{m}_direct"), F.col(f"{m}_sumUses")
        out = out.withColumn(f"{m}_improvement", F.when(base != 0, (base - new) / base * 100))
    return out


def plot_caps(df: DataFrame, keys: Sequence[str], x: str = "y_true", y: str = "y_pred") -> DataFrame:
    """Axis limits: p99 and p95 of both columns, bounded by q3 + 10 IQR."""
    a, b, ok = _pair(x, y)
    v = df.where(ok).select(*keys, F.explode(F.array(a, b)).alias("_x"))
    q = exact_quantiles(v, keys, "_x", {"q1": 0.25, "q3": 0.75, "p95": 0.95, "p99": 0.99})
    bound = F.col("q3") + 10 * F.greatest(F.col("q3") - F.col("q1"), F.lit(1e-12))
    full = F.greatest(F.least("p99", bound), F.lit(1e-6))
    zoom = F.greatest(F.least("p95", bound), F.lit(1e-6))
    return q.select(*keys, full.alias("lim_full"), F.least(zoom, full).alias("lim_zoom"))


def _bin(v: Column, lo: Column, hi: Column, bins: Column) -> Column:
    """Equal bins, the last one closed on the right; NULL outside."""
    b = F.floor((v - lo) / (hi - lo) * bins)
    return F.when((v >= lo) & (v <= hi), F.least(b, bins - 1)).cast("long")


def parity_histogram(df: DataFrame, keys: Sequence[str], top: float | None = 0.99, log: bool = False) -> DataFrame:
    """2-D counts of truth against prediction, on linear or log10 axes."""
    a, b, ok = _pair("y_true", "y_pred")
    x = df.where(ok & (a > 0) & (b > 0) if log else ok)
    x = cut_lineage(x.select(*keys, (F.log10(a) if log else a).alias("_a"), (F.log10(b) if log else b).alias("_b")))
    both = x.select(*keys, F.explode(F.array("_a", "_b")).alias("_x"))
    probs = {"lo": 0.01, "hi": 0.99} if log else {"hi": top}
    lim = exact_quantiles(both, keys, "_x", probs)
    if not log:
        lim = lim.withColumn("lo", F.lit(0.0)).withColumn("hi", F.greatest("hi", F.lit(1e-9)))
    n = x.groupBy(*keys).agg(F.when(F.count("*") > 5000, 80).otherwise(60).alias("bins"))
    lim = lim.join(small_side(n), list(keys)).where("hi > lo")
    j = x.join(small_side(lim), list(keys))
    bx, by = (_bin(F.col(c), F.col("lo"), F.col("hi"), F.col("bins")) for c in ("_a", "_b"))
    return j.select(*keys, bx.alias("bx"), by.alias("by")).dropna(subset=["bx", "by"]).groupBy(*keys, "bx", "by").agg(F.count("*").alias("n"))


def residual_histogram(df: DataFrame, keys: Sequence[str], bins: int = 80) -> DataFrame:
    a, b, ok = _pair("y_true", "y_pred")
    x = cut_lineage(df.where(ok).select(*keys, (b - a).alias("_e")))
    lim = exact_quantiles(x, keys, "_e", {"lo": 0.01, "hi": 0.99})
    j = x.join(small_side(lim), list(keys))
    return j.select(*keys, _bin(F.col("_e"), F.col("lo"), F.col("hi"), F.lit(bins)).alias("bin")).dropna(subset=["bin"]).groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def hex_density(df: DataFrame, keys: Sequence[str], grid: int = 55) -> DataFrame:
    """Hexagonal counts: the nearer of two interleaved lattices takes the point."""
    a, b, ok = _pair("y_true", "y_pred")
    caps = plot_caps(df, keys)
    rows = int(grid / 3 ** 0.5)
    j = df.where(ok).join(small_side(caps), list(keys))
    lim = F.col("lim_full")
    sx = F.least(F.greatest(a, F.lit(0.0)), lim) / lim * grid
    sy = F.least(F.greatest(b, F.lit(0.0)), lim) / lim * rows
    x = j.select(*keys, sx.alias("sx"), sy.alias("sy")).withColumns({
        "i1": F.bround("sx"), "j1": F.bround("sy"), "i2": F.floor("sx"), "j2": F.floor("sy"),
    })
    d1 = (F.col("sx") - F.col("i1")) ** 2 + 3 * (F.col("sy") - F.col("j1")) ** 2
    d2 = (F.col("sx") - F.col("i2") - 0.5) ** 2 + 3 * (F.col("sy") - F.col("j2") - 0.5) ** 2
    cx = F.when(d1 < d2, F.col("i1")).otherwise(F.col("i2") + 0.5)
    cy = F.when(d1 < d2, F.col("j1")).otherwise(F.col("j2") + 0.5)
    return x.select(*keys, cx.cast("double").alias("hx"), cy.cast("double").alias("hy")).groupBy(*keys, "hx", "hy").agg(F.count("*").alias("n"))
