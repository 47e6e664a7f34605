"""Boosted trees against a plain version, row by row and split by split."""

import pickle

import numpy as np
import pandas as pd
import pyspark
import pytest

from ohmstead.operators import boost


def plain(x, c, y, shape, n_values):
    """Best-first trees over binned columns, each split searched over the node's own rows; returns predictions."""
    mean = y.mean()
    scale = boost.SCALE / np.abs(y - mean).max()
    pred = np.full(len(y), mean)

    def split(rows, q, depth):
        best = (0.0, None)
        if depth >= shape.depth or len(rows) < 2 * shape.least_rows:
            return best
        total = int(q[rows].sum())
        base = float(total) ** 2 / len(rows)
        tests = [(f, b) for f in range(len(x)) for b in range(256)] + [(len(x) + f, v) for f in range(len(c)) for v in range(1, n_values[f] + 1)]
        for f, b in tests:
            right = x[f, rows] > b if f < len(x) else c[f - len(x), rows] == b
            n = int((~right).sum())
            if n < shape.least_rows or len(rows) - n < shape.least_rows:
                continue
            a = float(int(q[rows[~right]].sum()))
            gain = a * a / n + (total - a) ** 2 / (len(rows) - n) - base
            if gain > best[0] and gain > 1e-12 * base:
                best = (gain, (rows[~right], rows[right]))
        return best

    for _ in range(shape.rounds):
        q = np.rint((y - pred) * scale).astype(np.int64)
        nodes = [(np.arange(len(y)), 0)]
        open_ = {0: split(nodes[0][0], q, 0)}
        for _ in range(shape.leaves - 1):
            ready = [(-g, i) for i, (g, s) in open_.items() if s]
            if not ready:
                break
            _, i = min(ready)
            depth = nodes[i][1]
            for rows in open_.pop(i)[1]:
                nodes.append((rows, depth + 1))
                open_[len(nodes) - 1] = split(rows, q, depth + 1)
        for i in open_:
            rows = nodes[i][0]
            pred[rows] = pred[rows] + shape.rate * int(q[rows].sum()) / (len(rows) * scale)
    return pred


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 900
    a, b = rng.normal(size=n), rng.integers(0, 6, n).astype(float)
    k = rng.choice(["u", "v", "w"], n)
    y = 3 * np.sin(2 * a) + b * (k == "v") + rng.normal(0, 0.3, n)
    return pd.DataFrame({"k": k, "a": a, "b": b, "_y": y})


SHAPE = boost.Shape(depth=4, rounds=12, leaves=9, least_rows=15)


def arrays(b, table):
    n = len(table)
    return b.numeric([table["a"].to_numpy(), table["b"].to_numpy()], n), b.codes([table["k"].tolist()], n)


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_a_plain_version(spark, table, parts, monkeypatch):
    monkeypatch.setattr(boost, "SNAPSHOT", 5)
    monkeypatch.setattr(boost, "PARTITION_ROWS", 1)
    df = spark.createDataFrame(table).repartition(parts)
    model = boost.fit({"t": boost.Frame(df, ["k"], ["a", "b"])}, SHAPE)["t"]
    x, c = arrays(model.binning, table)
    got = model.predict([table["k"].tolist()], [table["a"].to_numpy(), table["b"].to_numpy()], len(table))
    want = plain(x, c, table["_y"].to_numpy(), SHAPE, [3])
    assert got == pytest.approx(want, abs=1e-6)
    assert np.corrcoef(got, table["_y"])[0, 1] > 0.9
    assert all(t.feature[t.feature >= 0].size <= SHAPE.leaves - 1 for t in model.trees) and len(model.trees) == SHAPE.rounds


def test_targets_grow_together_as_alone(spark, table):
    first, second = spark.createDataFrame(table), spark.createDataFrame(table.assign(_y=table["_y"] ** 2).iloc[:500])
    frames = {"p": boost.Frame(first, ["k"], ["a", "b"]), "q": boost.Frame(second, [], ["a"])}
    both = boost.fit(frames, SHAPE)
    for name in frames:
        assert boost.fit({name: frames[name]}, SHAPE)[name].rows() == both[name].rows()


def test_saved_model_and_column(spark, table, tmp_path):
    df = spark.createDataFrame(table)
    model = boost.fit({"t": boost.Frame(df, ["k"], ["a", "b"])}, SHAPE)["t"]
    model.save(str(tmp_path))
    again = boost.Boosted.load(spark, str(tmp_path))
    assert again.rows() == model.rows() and again.base == model.base
    got = df.select("a", again.predicted([df.k], [df.a, df.b]).alias("p")).toPandas().sort_values("a")
    order = table.sort_values("a")
    assert got.p.to_numpy() == pytest.approx(model.predict([order["k"].tolist()], [order["a"].to_numpy(), order["b"].to_numpy()], len(order)))
    assert model.predict([["unknown"]], [np.array([0.0]), np.array([1.0])], 1).shape == (1,)


def test_edges(spark, table):
    none = spark.createDataFrame([], "k string, a double, _y double")
    assert boost.fit({"t": boost.Frame(none, ["k"], ["a"])}, SHAPE) == {}
    same = spark.createDataFrame([("u", 1.0, 7.0)] * 60, "k string, a double, _y double")
    model = boost.fit({"t": boost.Frame(same, ["k"], ["a"])}, boost.Shape(rounds=2))["t"]
    assert model.predict([["u", "x"]], [np.array([1.0, 9.0])], 2).tolist() == [7.0, 7.0]
    bare = boost.fit({"t": boost.Frame(same, [], [])}, boost.Shape(rounds=2))["t"]
    assert bare.predict([], [], 3).tolist() == [7.0] * 3


def test_no_sums_reach_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({f"a{i}": rng.normal(size=600) for i in range(12)})
    rows["_y"] = rows["a0"] * rows["a3"] + rng.normal(0, 0.1, 600)
    frame = boost.Frame(spark.createDataFrame(rows).repartition(3), [], [f"a{i}" for i in range(12)])
    shape = boost.Shape(depth=5, rounds=3, leaves=16, least_rows=5)
    sizes, load = [], pyspark.rdd._load_from_socket

    def counted(sock, serializer):
        got = list(load(sock, serializer))
        sizes.append(len(pickle.dumps(got)))
        return iter(got)

    monkeypatch.setattr(boost, "PARTITION_ROWS", 1)
    monkeypatch.setattr(pyspark.rdd, "_load_from_socket", counted)
    one = boost.fit({"t": frame}, shape)["t"].rows()
    assert len(sizes) >= 9 and max(sizes) < 20_000
    monkeypatch.setattr(boost, "TASK_BINS", boost.SLOTS)
    assert boost.fit({"t": frame}, shape)["t"].rows() == one
