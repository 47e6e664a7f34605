"""Shapes of plans on which size depends: what is broadcast, and how many tasks share the rows."""

import math

import numpy as np
import pytest

from ohmstead.functions import text as tx
from ohmstead.llm import jaccard
from ohmstead.operators import intervals as iv
from ohmstead.operators import regions as rg
from ohmstead.plans import consumption, drawings, reports, rules
from ohmstead.session import cut_lineage
from ohmstead.sources import tables as t


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["hairline_removal", "line_run_removal", "small_component_removal", "main_growth"])
def test_cells_are_not_broadcast(spark, data, name):
    p = plan(drawings.CAT.items[name].build(spark, data))
    assert "Join" in p and "BroadcastHashJoin" not in p


def test_customers_are_dealt_before_they_become_cells(spark, data, monkeypatch):
    whole = sorted(map(tuple, drawings._raw(spark, data).collect()))
    monkeypatch.setattr(t, "DEALT_ROWS", 30)
    x = drawings._raw(spark, data)
    assert x.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, x.collect())) == whole


def test_segments_are_drawn_by_lines(spark):
    rng = np.random.default_rng(3)
    ends = [(0, 0, 40, 30), (40, 30, 0, 0), (0, 30, 40, 0), (8, 5, 8, 5), (0, 7, 40, 7), (40, 3, 0, 3), (5, 0, 5, 30), (0, 0, 4, 2), (4, 2, 0, 0), (0, 2, 4, 0), (6, 0, 0, 3), (1, 1, 31, 6)]
    ends += [tuple(map(int, (*rng.integers(0, 41, 1), *rng.integers(0, 31, 1), *rng.integers(0, 41, 1), *rng.integers(0, 31, 1)))) for _ in range(200)]
    box = spark.createDataFrame([(0.0, 0.0, 40.0, 30.0, 41, 31, i) for i in range(len(ends))], "x0 double, y0 double, w double, h double, wp int, hp int, plan_id int")
    segs = spark.createDataFrame([(i, float(a), 30.0 - b, float(c), 30.0 - d) for i, (a, b, c, d) in enumerate(ends)], "plan_id int, x1 double, y1 double, x2 double, y2 double")
    got = {}
    for r in rg.drawn(segs, box, ["plan_id"]).collect():
        got.setdefault(r.plan_id, []).extend((x, r.y) for x in range(r.s, r.e + 1))
    for k, (a, b, c, d) in enumerate(ends):
        n = max(abs(c - a), abs(d - b))
        step = lambda p, q, i: p + math.floor((q - p) * i / max(n, 1) + 0.5)
        assert sorted(got[k]) == sorted({(step(a, c, i), step(b, d, i)) for i in range(n + 1)}), ends[k]


def test_large_sweeps_are_dealt_by_rows(spark, monkeypatch):
    runs = cut_lineage(spark.createDataFrame([(1, y, s, s + 2) for y in range(20) for s in (0, 5, 9)], "image_id int, y int, s int, e int"))
    want = sorted(map(tuple, iv.dilated(runs, ["image_id"], 1, 2).collect()))
    monkeypatch.setattr(iv, "TASK_ROWS", 100)
    assert iv.tasks(runs, 5) == 6
    x = iv.dilated(runs, ["image_id"], 1, 2, iv.tasks(runs, 5))
    assert x.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, x.collect())) == want


def test_bitmaps_tell_near_misses_apart():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
    # any two of these share 136 of 184 shingles, a Jaccard index of 0.74
    sets = [np.unique(np.concatenate([base[:136], rng.integers(0, 1 << 63, 24, dtype=np.uint64)])) for _ in range(200)]
    n = np.array(list(map(len, sets)))
    sig = np.array([np.frombuffer(jaccard._signature(h), np.uint64) for h in sets])
    own = np.arange(len(sets))
    tree = jaccard.Tree(own, n, own, n, np.zeros((len(sets), jaccard.PAST), np.int64), sig)
    assert len(jaccard.walk(tree, tree)[0]) < 0.05 * len(sets) * (len(sets) - 1) / 2


def test_links_of_near_copies_grow_with_members(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(62)]
    texts = [" ".join([*base[:at], f"x{i}", *base[at + 1 :]]) for i, at in enumerate(rng.integers(0, 62, 400).tolist())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts, components = [], jaccard.components

    def counted(links):
        counts.append(links.count())
        return components(links)

    monkeypatch.setattr(jaccard, "components", counted)
    got = {r.doc_id: r.component_id for r in jaccard.join(docs, chunk=100).select("doc_id", "component_id").collect()}
    # one word changed in the same place or beside it leaves a Jaccard index of 0.8 or more
    sets = [{tuple(x[i : i + 5]) for i in range(58)} for x in map(str.split, texts)]
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if want[i] != want[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((want[i], want[j]))
                want = [low if c == high else c for c in want]
    assert got == dict(enumerate(want))
    assert counts[1] < 8 * len(texts)


def test_zones_are_dealt_before_calendars_are_filled(spark, data, monkeypatch):
    whole = sorted(map(tuple, consumption._spike_frame(spark, data, "elecTotalKwh", "totalKwh").collect()), key=str)
    monkeypatch.setattr(t, "DEALT_ZONES", 2)
    x = consumption._spike_frame(spark, data, "elecTotalKwh", "totalKwh")
    assert x.rdd.getNumPartitions() == -(-t.table(spark, data, "supplier").count() // 2)
    assert sorted(map(tuple, x.collect()), key=str) == whole


def test_routed_pages_are_ranked_from_one_scan(spark, data):
    assert "FileScan" not in plan(reports.CAT.items["spared_pages"].build(spark, data))


def test_names_are_cut_outside_of_the_aggregate(spark, data):
    p = rules.CAT.items["slugs"].build(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in p
    assert not [x for x in p.splitlines() if "Aggregate" in x and "regexp_replace" in x]


def test_slugs_of_odd_texts(spark):
    texts = ["", " - ", " Été 2--b_c!", "-a-", "_", "a\tb ", "İx"]
    x = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [tuple(r) for r in x.select(tx.slug("t"), tx.slug("t", "_", "section")).collect()]
    assert got[:6] == [("page", "section"), ("page", "section"), ("t-2-b-c", "t_2_b_c"), ("a", "a"), ("page", "section"), ("a-b", "a_b")]
    assert got[6][1] == got[6][0].replace("-", "_")


def test_words_of_reports_are_counted_once(spark, data):
    assert "regexp_extract_all" not in plan(rules.CAT.items["text_clarity"].build(spark, data))


@pytest.mark.parametrize("name", ["aligned_removal", "mesh_removal", "speck_removal"])
def test_ink_rules_do_not_depend_on_the_number_of_tasks(spark, data, monkeypatch, name):
    want = sorted(map(tuple, drawings.CAT.items[name].build(spark, data).collect()))
    monkeypatch.setattr(iv, "TASK_ROWS", 4000)
    assert sorted(map(tuple, drawings.CAT.items[name].build(spark, data).collect())) == want


def test_ink_is_dealt_once_for_pixels_and_runs(spark, data, monkeypatch):
    monkeypatch.setattr(iv, "TASK_ROWS", 1000)
    x = iv.of_cells(drawings._ink(spark, data), ["image_id"])
    n = drawings._raw(spark, data).count()
    assert x.rdd.getNumPartitions() == -(-2 * n // 1000) > 4


def test_wide_intervals_meet_in_counted_tasks(spark, monkeypatch):
    a = cut_lineage(spark.createDataFrame([(1, y, 0, 6399, y) for y in range(30)], "image_id int, y int, s int, e int, a int"))
    b = cut_lineage(spark.createDataFrame([(1, y, x, x, 100 * y + x) for y in range(30) for x in (3, 5000)], "image_id int, y int, s int, e int, b int"))
    want = sorted((y, y, 100 * y + x) for y in range(30) for x in (3, 5000))
    monkeypatch.setattr(iv, "TASK_ROWS", 100)
    x = iv.meeting(a, b, ["image_id"], ["a"], ["b"])
    assert x.rdd.getNumPartitions() == 31
    assert sorted((r.y, r.a, r.b) for r in x.collect()) == want
