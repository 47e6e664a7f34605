"""Interval sets against plain arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohmstead.operators import grid as gd
from ohmstead.operators import intervals as iv

K = ["k"]
W, H = 40, 30


def cells(spark, m, key=1):
    return [(key, int(x), int(y)) for y, x in zip(*np.nonzero(m))]


def frame(spark, *masks):
    rows = [c for i, m in enumerate(masks) for c in cells(spark, m, i)]
    return spark.createDataFrame(rows + rows[:7], "k int, x long, y long")


def back(df, n=1, shape=(H, W)):
    out = np.zeros((n, *shape), bool)
    for r in iv.cells_of(df, K).collect():
        assert not out[r.k, r.y, r.x]
        out[r.k, r.y, r.x] = True
    return out


def grown(m, rx, ry):
    out = np.zeros_like(m)
    for y, x in zip(*np.nonzero(m)):
        out[max(0, y - ry) : y + ry + 1, max(0, x - rx) : x + rx + 1] = True
    return out


@pytest.fixture(scope="module")
def masks():
    rng = np.random.default_rng(11)
    return [rng.random((H, W)) < p for p in (0.2, 0.75)]


def test_runs_and_turning(spark, masks):
    runs = iv.of_cells(frame(spark, *masks), K)
    assert (back(runs, 2) == np.stack(masks)).all()
    lines = runs.groupBy("k", "y").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("r")).collect()
    assert all(b.s > a.e + 1 for r in lines for a, b in zip(r.r, r.r[1:]))
    assert (back(iv.turned(runs, K), 2, (W, H)) == np.stack([m.T for m in masks])).all()


@pytest.mark.parametrize("rx,ry", [(3, 0), (0, 2), (2, 4), (0, 0)])
def test_growing(spark, masks, rx, ry):
    runs = iv.of_cells(frame(spark, *masks), K)
    got = iv.clipped(iv.dilated(runs, K, rx, ry), F.lit(W), F.lit(H))
    assert (back(got, 2) == np.stack([grown(m, rx, ry) for m in masks])).all()


@pytest.mark.parametrize("r", [0, 1, 2])
def test_shrinking(spark, masks, r):
    m = [grown(x, 1, 1) for x in masks]
    runs = iv.of_cells(frame(spark, *m), K)
    inside = np.stack([~grown(~x, r, r) for x in m])
    assert (back(iv.eroded(runs, K, r, F.lit(W), F.lit(H)), 2) == inside).all()
    padded = np.stack([~grown(np.pad(~x, r, constant_values=True), r, r)[r : H + r, r : W + r] for x in m])
    assert (back(iv.eroded(runs, K, r), 2) == padded).all()


def test_set_operations(spark, masks):
    a, b = (iv.of_cells(frame(spark, m), K) for m in masks)
    assert (back(iv.minus(a, b, K))[0] == (masks[0] & ~masks[1])).all()
    assert (back(iv.common(a, b, K))[0] == (masks[0] & masks[1])).all()
    assert (back(iv.union([a, b, a], K))[0] == (masks[0] | masks[1])).all()


def test_sums_over_overlapping_spans(spark, masks):
    m = masks[0]
    spans = [(0, y, a, b) for y in (0, 7, H - 1) for a, b in ((0, W), (3, 9), (5, 30), (5, 5), (W - 1, W))]
    df = spark.createDataFrame(spans, "k int, y long, p0 long, p1 long").withColumn("id", F.struct("p0", "p1"))
    for ry in (0, 2):
        got = {(r.y, r.id.p0, r.id.p1): r.n for r in iv.sums_over(iv.of_cells(frame(spark, m), K), K, ry, df, ["id"]).collect()}
        assert got == {(y, a, b): int(m[max(0, y - ry) : y + ry + 1, a:b].sum()) for _, y, a, b in spans}


def test_meeting(spark, masks, monkeypatch):
    monkeypatch.setattr(iv, "BUCKET", 8)
    runs = [iv.of_cells(frame(spark, m), K) for m in masks]
    plain = [[tuple(r) for r in x.select("y", "s", "e").collect()] for x in runs]
    for shift, reach in ((0, 0), (1, 1), (1, 0)):
        got = iv.meeting(runs[0].withColumn("a", F.struct("y", "s")), runs[1].withColumn("b", F.struct("y", "s")), K, ["a"], ["b"], shift, reach).collect()
        want = {((y, s), (v, t)) for y, s, e in plain[0] for v, t, f in plain[1] if v == y + shift and s - reach <= f and t <= e + reach}
        assert sorted((tuple(r.a), tuple(r.b)) for r in got) == sorted(want)


@pytest.mark.parametrize("strip,eight", [(256, True), (4, True), (4, False), (1, True)])
def test_components_across_strips(spark, masks, monkeypatch, strip, eight):
    monkeypatch.setattr(iv, "STRIP", strip)
    snake = np.zeros((H, W), bool)
    snake[::2], snake[1::4, 0], snake[3::4, -1] = True, True, True
    m = np.stack([masks[0], snake])
    got = {(r.k, r.y, r.x): r.comp for r in iv.cells_of(iv.components(iv.of_cells(frame(spark, *m), K), K, 8 if eight else 4), K, "comp").collect()}
    near = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (eight or not (dy and dx))]
    label = {}
    for start in zip(*np.nonzero(m)):
        if start in label:
            continue
        todo, part = [start], []
        label[start] = start
        while todo:
            k, y, x = todo.pop()
            part.append((k, y, x))
            for dy, dx in near:
                n = (k, y + dy, x + dx)
                if 0 <= n[1] < H and 0 <= n[2] < W and m[n] and n not in label:
                    label[n] = start
                    todo.append(n)
    assert len(got) == len(label)
    assert len({(label[c], v) for c, v in got.items()}) == len(set(label.values())) == len({(c[0], v) for c, v in got.items()})


def test_box_counts_across_tiles(spark, masks, monkeypatch):
    monkeypatch.setattr(gd, "TILE", 8)
    r = 2
    df = frame(spark, *masks).select("k", (F.col("x") - 15).alias("x"), (F.col("y") - 11).alias("y"))
    got = {(c.k, c.y + 11, c.x + 15): c.n for c in gd.box_counts(df, K, r).collect()}
    want = {(k, y, x): int(m[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1].sum()) for k, m in enumerate(masks) for y, x in zip(*np.nonzero(m))}
    assert got == want


def test_empty(spark):
    none = spark.createDataFrame([], "k int, x long, y long")
    runs = iv.of_cells(none, K)
    for x in (runs, iv.dilated(runs, K, 2, 2), iv.eroded(runs, K, 1), iv.minus(runs, runs, K), iv.components(runs, K), gd.box_counts(none, K, 3)):
        assert x.count() == 0
