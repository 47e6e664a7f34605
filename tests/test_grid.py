from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohmstead.operators import entities as en
from ohmstead.operators import grid as gd
from ohmstead.operators import ink as ik

SIZE = (60, 50)


def cells(spark, mask, image=0):
    ys, xs = np.nonzero(mask)
    return spark.createDataFrame([(image, int(x), int(y)) for y, x in zip(ys, xs)], "image_id long, x int, y int")


def back(df, shape=SIZE[::-1]):
    out = np.zeros(shape, bool)
    for r in df.collect():
        out[r.y, r.x] = True
    return out


def flood(mask, eight=True):
    h, w = mask.shape
    label = -np.ones((h, w), int)
    comps = []
    for y in range(h):
        for x in range(w):
            if not mask[y, x] or label[y, x] >= 0:
                continue
            q, got = deque([(y, x)]), []
            label[y, x] = len(comps)
            while q:
                a, b = q.popleft()
                got.append((a, b))
                for da in (-1, 0, 1):
                    for db in (-1, 0, 1):
                        if not eight and da and db:
                            continue
                        c, d = a + da, b + db
                        if 0 <= c < h and 0 <= d < w and mask[c, d] and label[c, d] < 0:
                            label[c, d] = len(comps)
                            q.append((c, d))
            comps.append(got)
    return label, comps


def noise(seed, p=0.35):
    return np.random.default_rng(seed).random(SIZE[::-1]) < p


def window_sum(mask, r):
    h, w = mask.shape
    return np.array([[mask[max(0, y - r):y + r + 1, max(0, x - r):x + r + 1].sum() for x in range(w)] for y in range(h)])


@pytest.mark.parametrize("eight", [True, False])
def test_components_match_flood_fill(spark, eight):
    masks = [noise(1, 0.3), noise(2, 0.45)]
    df = cells(spark, masks[0], 0).union(cells(spark, masks[1], 1))
    got = gd.components(df, ["image_id"], 8 if eight else 4).toPandas()
    for i, m in enumerate(masks):
        _, comps = flood(m, eight)
        mine = got[got.image_id == i].groupby("comp").apply(lambda g: frozenset(zip(g.y, g.x)), include_groups=False)
        assert set(mine) == {frozenset(c) for c in comps}


def test_snake_component_settles(spark):
    m = np.zeros(SIZE[::-1], bool)
    for y in range(0, 50, 2):
        m[y] = True
    for k, y in enumerate(range(1, 49, 2)):
        m[y, 59 if k % 2 else 0] = True
    assert gd.components(cells(spark, m), ["image_id"]).select("comp").distinct().count() == 1


def test_diagonal_contact(spark):
    m = np.zeros(SIZE[::-1], bool)
    m[3:6, 3:6] = m[6:9, 6:9] = True
    df = cells(spark, m)
    assert gd.components(df, ["image_id"], 8).select("comp").distinct().count() == 1
    assert gd.components(df, ["image_id"], 4).select("comp").distinct().count() == 2


def test_morphology_and_density(spark):
    m = noise(4, 0.7)
    h, w = m.shape
    df = cells(spark, m)
    padded = np.pad(m, 1, constant_values=True)
    ero = np.array([[padded[y:y + 3, x:x + 3].all() for x in range(w)] for y in range(h)])
    size = spark.createDataFrame([(0, w, h)], "image_id long, w int, h int")
    assert (back(gd.eroded(df, ["image_id"], 1, size)) == ero).all()
    dense = {(r.y, r.x): r.n for r in gd.box_counts(df, ["image_id"], 3).collect()}
    want = window_sum(m, 3)
    assert dense == {(y, x): want[y, x] for y, x in zip(*np.nonzero(m))}


def lines_picture():
    m = noise(9, 0.03)
    m[10, 2:50] = m[30, 5:55] = True
    m[5:45, 20] = True
    m[20:28, 30:45] = True
    return m


def _runs(v):
    out, i = [], 0
    while i < len(v):
        if v[i]:
            j = i
            while j < len(v) and v[j]:
                j += 1
            out.append((i, j))
            i = j
        else:
            i += 1
    return out


def plain_thick(m, er, di):
    h, w = m.shape
    e = np.array([[m[max(0, y - er):y + er + 1, max(0, x - er):x + er + 1].all() for x in range(w)] for y in range(h)])
    return window_sum(e, er + di) > 0


def test_line_run_removal(spark):
    m = lines_picture()
    wall = plain_thick(m, 2, 2)

    def one(mask, wall):
        h, w = mask.shape
        out = mask.copy()
        for y in range(h):
            for a, b in _runs(mask[y] & ~wall[y]):
                if b - a < 12:
                    continue
                strip = mask[max(0, y - 3):y + 4, a:b]
                zone = mask[max(0, y - 10):y + 11, max(0, a - 10):min(w, b + 10)]
                if strip.mean() <= 0.42 and zone.mean() < 0.18:
                    out[y, a:b] = False
        return out

    want = one(m, wall)
    want = one(want.T, wall.T).T
    _, comps = flood(want)
    for c in comps:
        if len(c) < 8:
            for y, x in c:
                want[y, x] = False
    got = back(ik.remove_line_runs(cells(spark, m), SIZE, min_run=12))
    assert (got == want).all() and want.sum() < m.sum()


def test_hairline_removal(spark):
    m = lines_picture()
    box = window_sum(m, 10)

    def gone(mask, box):
        out = np.zeros_like(mask)
        for y in range(mask.shape[0]):
            for a, b in _runs(mask[y]):
                if b - a < 34:
                    continue
                support = mask[max(0, y - 3):y + 4, a:b].sum(0)
                if support.mean() <= 2.35:
                    out[y, a:b] = (support <= 2.0) & (box[y, a:b] < 60)
        return out

    want = m & ~gone(m, box) & ~gone(m.T, box.T).T
    got = back(ik.remove_hairlines(cells(spark, m), SIZE, dense_min=60))
    assert (got == want).all() and want.sum() < m.sum()


def test_mesh_and_speck_removal(spark):
    m = np.zeros(SIZE[::-1], bool)
    m[5:40:6, 4:44] = True
    m[5:36, 4:44:8] = True
    m[42:49, 2:20] = True
    m[45, 50:53] = m[38, 10:12] = True
    wall = window_sum(plain_thick(m, 2, 3), 1) > 0
    thin = m & ~wall
    masks = [np.zeros_like(m) for _ in range(4)]
    h, w = m.shape
    for y in range(h):
        for a, b in _runs(thin[y]):
            if b - a >= 14:
                masks[0][y, a:b] = True
    for x in range(w):
        for a, b in _runs(thin[:, x]):
            if b - a >= 14:
                masks[1][a:b, x] = True
    line = masks[0] | masks[1]
    _, comps = flood(window_sum(line, 2) > 0)
    want = m.copy()
    for c in comps:
        ys, xs = [p[0] for p in c], [p[1] for p in c]
        y0, y1, x0, x1 = min(ys), max(ys), min(xs), max(xs)
        sub = line[y0:y1 + 1, x0:x1 + 1]
        axes = sum(k[y0:y1 + 1, x0:x1 + 1].any() for k in masks)
        if x1 - x0 + 1 >= 36 and y1 - y0 + 1 >= 28 and sub.sum() >= 220 and sub.mean() >= 0.045 and axes >= 2:
            a, b, c0, d = max(0, y0 - 3), y1 + 4, max(0, x0 - 3), x1 + 4
            want[a:b, c0:d] &= ~thin[a:b, c0:d]
    assert (back(ik.remove_meshes(cells(spark, m), SIZE)) == want).all() and want.sum() < m.sum()

    near = window_sum(wall, 7) > 0
    left = m.copy()
    for c in flood(m & ~wall)[1]:
        if len(c) < 45 and not any(near[y, x] for y, x in c):
            for y, x in c:
                left[y, x] = False
    assert (back(ik.remove_specks(cells(spark, m), SIZE)) == left).all()


def test_growth_and_small_parts(spark):
    m = np.zeros(SIZE[::-1], bool)
    m[5:15, 5:25] = m[8:12, 28:33] = m[8:12, 35:40] = m[40:46, 52:58] = True
    m[30, 30:33] = True
    got = back(ik.grow_main(cells(spark, m), SIZE, ratio=0.25))
    assert got[6, 6] and got[9, 29] and got[9, 36] and not got[41, 53] and not got[30, 31]
    kept = back(ik.remove_small(cells(spark, m), 8, keep_largest=True))
    assert kept.sum() == 200


def segs(spark, rows):
    df = spark.createDataFrame([("p", i, [(float(a), float(b)), (float(c), float(d))], False, "L") for i, (a, b, c, d) in enumerate(rows)],
                               "plan_id string, row_id int, points array<struct<x:double,y:double>>, closed boolean, layer string")
    return en.segments(df, ["plan_id", "row_id", "layer"])


def test_fan_is_removed_and_walls_stay(spark):
    walls = [(0, y, 1000, y) for y in range(0, 1001, 100)] + [(x, 0, x, 1000) for x in range(0, 1001, 100)]
    fan = [(500 - 40 * np.cos(a), 500 - 40 * np.sin(a), 500 + 40 * np.cos(a), 500 + 40 * np.sin(a)) for a in np.radians([15, 35, 55, 75, 110, 140])]
    x = segs(spark, walls + fan)
    left = en.remove_fans(x, ["plan_id"], ["plan_id", "row_id", "seg"], en.size_limits(en.segment_box(x, ["plan_id"])))
    assert sorted(r.row_id for r in left.collect()) == list(range(len(walls)))


def test_settled_decisions_and_moves(spark):
    d = spark.createDataFrame([("A", "drop"), ("A", "keep"), ("B", "undecided"), ("B", "drop")], "layer string, decision string")
    s = en.settle_decisions(d)
    assert {r.layer: r.decision for r in s.collect()} == {"A": "keep", "B": "drop"}
    m = en.move_layers(s, spark.createDataFrame([("B", "keep")], "layer string, decision string"))
    assert {r.layer: r.decision for r in m.collect()} == {"A": "keep", "B": "keep"}


def test_main_plan_prefers_ink(spark):
    pts = lambda x0, y0, n: [(float(x0 + i), float(y0 + (i % 3))) for i in range(n)]
    rows = [("p", i, pts(0, 3 * i, 40), False) for i in range(8)] + [("p", 100, pts(900, 900, 5), False)]
    from ohmstead.sources.drawings import with_geometry

    df = with_geometry(spark.createDataFrame(rows, "plan_id string, row_id int, points array<struct<x:double,y:double>>, closed boolean")
                       .withColumns({"entity_type": F.lit("LWPOLYLINE"), "layer": F.lit("MUR")}))
    kept = {r.row_id for r in en.main_plan(df, ["plan_id"], grid=50).collect()}
    assert kept == set(range(8))
