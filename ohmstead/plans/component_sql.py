"""Reference SQL for rules that need connected components or an ordered scan."""

from __future__ import annotations


def recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def components(name: str, cells: str, key: str, eight: bool = True) -> str:
    """``name(key, x, y, lab)``: the smallest y * 100000 + x of every component."""
    diag = "" if eight else " AND (dx = 0 OR dy = 0)"
    return f"""{name}({key}, x, y, lab) USING KEY ({key}, x, y) AS (SELECT DISTINCT {key}, CAST(x AS BIGINT), CAST(y AS BIGINT), CAST(y AS BIGINT) * 100000 + x FROM {cells}
 UNION SELECT n.{key}, n.x, n.y, MIN(c.lab) FROM {name} c, (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy), recurring.{name} n
 WHERE n.{key} = c.{key} AND n.x = c.x + dx AND n.y = c.y + dy AND c.lab < n.lab{diag} GROUP BY 1, 2, 3)"""


def grid_cells(name: str, source: str, grid: int, dilate: int) -> str:
    """``name(plan_id, row_id, x, y)`` of the entities in ``source``."""
    box = f"{name}_b AS (SELECT plan_id, MIN(bbox_min_x) AS gx, MIN(bbox_min_y) AS gy, GREATEST(MAX(bbox_max_x) - MIN(bbox_min_x), 1) AS gw, GREATEST(MAX(bbox_max_y) - MIN(bbox_min_y), 1) AS gh FROM {source} GROUP BY 1)"
    place = f"{name}_0 AS (SELECT DISTINCT s.plan_id, s.row_id, CAST(trunc((p.x - gx) * ({grid - 1} / gw)) AS INTEGER) AS x, CAST(trunc((p.y - gy) * ({grid - 1} / gh)) AS INTEGER) AS y FROM {source} s JOIN pts p ON p.row_id = s.row_id JOIN {name}_b b ON b.plan_id = s.plan_id)"
    grown = f"{name} AS (SELECT DISTINCT plan_id, row_id, x + dx AS x, y + dy AS y FROM {name}_0, (SELECT UNNEST(range({-dilate}, {dilate + 1})) AS dx) a, (SELECT UNNEST(range({-dilate}, {dilate + 1})) AS dy) b WHERE x + dx BETWEEN 0 AND {grid - 1} AND y + dy BETWEEN 0 AND {grid - 1})"
    return ",\n".join((box, place, grown))


def strong_rows(name: str, source: str, cells: str, cc: str, score: str, ratio: float) -> str:
    """``name(plan_id, row_id)``: entities of the best component and of close ones."""
    return f"""{name}_p AS (SELECT DISTINCT c.plan_id, c.row_id, lab FROM {cells} c JOIN {cc} k ON k.plan_id = c.plan_id AND k.x = c.x AND k.y = c.y),
{name}_s AS (SELECT plan_id, lab, {score} AS score FROM (SELECT p.plan_id, p.lab, COUNT(*) AS n, SUM(length) AS total, AVG(CASE WHEN length < 2 OR bbox_diag < 2 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS small,
  GREATEST((MAX(bbox_max_x) - MIN(bbox_min_x)) * (MAX(bbox_max_y) - MIN(bbox_min_y)), 1) AS barea, SUM(CASE WHEN fc = 'wall' THEN 2.0::DOUBLE * length WHEN fc IN ('door', 'window', 'stairs') THEN 1.4::DOUBLE * length WHEN fc = 'detail' THEN 0.35::DOUBLE * length ELSE 0 END) AS useful
  FROM {name}_p p JOIN {source} s ON s.plan_id = p.plan_id AND s.row_id = p.row_id GROUP BY 1, 2)),
{name}_t AS (SELECT *, MAX(score) OVER (PARTITION BY plan_id) AS top, ROW_NUMBER() OVER (PARTITION BY plan_id ORDER BY score DESC, lab) AS rk FROM {name}_s),
{name} AS (SELECT DISTINCT p.plan_id, p.row_id FROM {name}_p p JOIN {name}_t t ON t.plan_id = p.plan_id AND t.lab = p.lab WHERE rk = 1 OR (top > 0 AND score / top >= {ratio}))"""


PLAN_SCORE = "total + total / sqrt(barea) * 20 - small * n * 2"
CLASS_SCORE = "useful + sqrt(total / barea) * 450 - small * 0.35::DOUBLE * n"


def fan_passes(keys: str = "plan_id, row_id, seg") -> str:
    """Three passes over ``fs(plan_id, row_id, seg, mx, my, length, angle, fd, fr)``; ``left3`` remains."""
    out, left = [], "fs"
    for i, (lx, rx, least, spread) in enumerate(((1.0, 1.0, 4, 30), (0.75, 1.5, 3, 20), (0.60, 1.8, 3, 15)), 1):
        on = "true" if i == 1 else f"plan_id IN (SELECT plan_id FROM gone{i - 1} GROUP BY 1 HAVING COUNT(*) >= 20)" + ("" if i == 2 else " AND plan_id IN (SELECT plan_id FROM gone1 GROUP BY 1 HAVING COUNT(*) >= 20)")
        out.append(f"""cand{i} AS (SELECT *, CAST(floor(mx / GREATEST(fr * {rx}::DOUBLE, 1e-9)) AS BIGINT) AS bx, CAST(floor(my / GREATEST(fr * {rx}::DOUBLE, 1e-9)) AS BIGINT) AS b_y, CAST(floor(angle / 15) AS INTEGER) AS bk FROM {left}
  WHERE {on} AND length >= fd * {lx}::DOUBLE AND NOT (abs(angle) <= 4 OR abs(angle - 90) <= 4 OR abs(angle - 180) <= 4)),
bins{i} AS (SELECT DISTINCT plan_id, bx, b_y FROM cand{i}),
fan{i} AS (SELECT b.plan_id, b.bx, b.b_y FROM bins{i} b JOIN cand{i} c ON c.plan_id = b.plan_id AND c.bx BETWEEN b.bx - 2 AND b.bx + 2 AND c.b_y BETWEEN b.b_y - 2 AND b.b_y + 2 GROUP BY 1, 2, 3
  HAVING COUNT(*) >= {least} AND COUNT(DISTINCT bk) >= 3 AND MAX(angle) - MIN(angle) >= {spread}),
gone{i} AS (SELECT DISTINCT c.plan_id, c.row_id, c.seg FROM cand{i} c JOIN fan{i} f ON c.plan_id = f.plan_id AND c.bx BETWEEN f.bx - 2 AND f.bx + 2 AND c.b_y BETWEEN f.b_y - 2 AND f.b_y + 2),
left{i} AS (SELECT * FROM {left} ANTI JOIN gone{i} USING ({keys}))""")
        left = f"left{i}"
    return ",\n".join(out)


def growth(size: tuple[int, int], ratio: float, passes: int) -> str:
    """``kept`` labels after growing the box of the seed, from ``boxes(image_id, lab, area, x0, y0, x1, y1)``."""
    w, h = size
    out = ["k0 AS (SELECT image_id, lab FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY image_id ORDER BY area DESC, lab) AS r FROM boxes WHERE area >= 25) WHERE r = 1)"]
    for i in range(1, passes + 1):
        out.append(f"""m{i} AS (SELECT image_id, MIN(x0) AS a, MIN(y0) AS b, MAX(x1) AS c, MAX(y1) AS d FROM boxes SEMI JOIN k{i - 1} USING (image_id, lab) GROUP BY 1),
g{i} AS (SELECT *, CAST(trunc(GREATEST(c - a, d - b, 1) * {ratio}::DOUBLE) AS INTEGER) AS m FROM m{i}),
k{i} AS (SELECT image_id, lab FROM boxes JOIN g{i} USING (image_id) WHERE NOT (x1 < GREATEST(a - m, 0) OR x0 > LEAST(c + m, {w - 1}) OR y1 < GREATEST(b - m, 0) OR y0 > LEAST(d + m, {h - 1})))""")
    return ",\n".join(out) + f",\nkept AS (SELECT * FROM k{passes})"


def spike_scan(factor: float) -> str:
    """Day-by-day scan of ``sf(z, i, v, pred, n1, n2, gap)``; ``scan`` holds the value kept on each day."""
    near = "list_filter([{a}, {b}, f.n1, f.n2], lambda x: x > 0)"

    def hit(a: str, b: str) -> str:
        nb = near.format(a=a, b=b)
        return f"f.v > 0 AND len({nb}) >= 2 AND (f.v > list_median({nb}) * CASE WHEN f.gap >= 30 THEN {factor * 0.6}::DOUBLE ELSE {factor}::DOUBLE END OR (f.pred > 0 AND f.v > f.pred * 10))"

    none = "CAST(NULL AS DOUBLE)"
    return f"""scan(z, i, v, ref, gap, m, m1) AS (SELECT f.z, f.i, f.v, list_median({near.format(a=none, b=none)}), f.gap, CASE WHEN {hit(none, none)} THEN NULL ELSE f.v END, {none} FROM sf f WHERE f.i = 0
 UNION ALL SELECT f.z, f.i, f.v, list_median({near.format(a='r.m', b='r.m1')}), f.gap, CASE WHEN {hit('r.m', 'r.m1')} THEN NULL ELSE f.v END, r.m FROM scan r JOIN sf f ON f.z = r.z AND f.i = r.i + 1)"""


def jump_scan(factor: float) -> str:
    """Scan over the valid days ``jv(z, k, i, v, gap, med)``; the state is the list of the last thirty known values."""
    base = "CASE WHEN len(r.h) > 0 THEN list_median(r.h) ELSE f.med END"
    jump = f"f.gap >= 3 AND f.v > {factor}::DOUBLE * {base}"
    tail = "list_slice({x}, -30, -1)"
    grown = tail.format(x="list_concat(r.h, list_resize(CAST([] AS DOUBLE[]), LEAST(f.gap + 1, 30), f.v / (f.gap + 1)))")
    plain = tail.format(x="list_append(r.h, f.v)")
    return f"""jump(z, k, i, v, gap, action, ref, h) AS (SELECT z, k, i, v, gap, CAST('' AS VARCHAR), CAST(NULL AS DOUBLE), [v] FROM jv WHERE k = 1
 UNION ALL SELECT f.z, f.k, f.i, f.v, f.gap, CASE WHEN NOT ({jump}) THEN '' WHEN f.gap + 1 > 370 THEN 'drop' ELSE 'spread' END, {base},
 CASE WHEN NOT ({jump}) THEN {plain} WHEN f.gap + 1 > 370 THEN r.h ELSE {grown} END FROM jump r JOIN jv f ON f.z = r.z AND f.k = r.k + 1)"""
