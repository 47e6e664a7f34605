"""Gradient-boosted trees on binned features, for squared loss and several targets at once.

Features are cut into bins once and kept as blocks of rows spread over the cluster. For every level of
a tree one job adds up residuals and rows per (target, feature, node, bin), brings the sums of a feature
together by its key, and finds the best split of every node where they are. The driver sees only these
splits, one per node and task, and sends the tree so far back with the next job; no sums leave the
executors, so both siblings are counted. The trees of all targets grow in the same jobs. Residuals are
summed as scaled integers, so that neither the partitioning nor the order of arrival changes a model.

The fit iterates over blocks that stay in memory, thousands of short jobs that need no plan: these run
on a cached RDD of arrays. A lost block is made again from the written table of bins.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmstead.session import cut_lineage

#: Slots of a numeric feature in a table of sums.
SLOTS = 256
#: Residuals are scaled so that the largest first one becomes this integer.
SCALE = float(1 << 30)
#: Trees after which the predictions kept with the blocks are brought up to date.
SNAPSHOT = 10
#: Rows that a partition should have before another one is worth its overhead.
PARTITION_ROWS = 1 << 14
#: Bins of all features for whose sums another task is worth its overhead.
TASK_BINS = 1 << 16


@dataclass(frozen=True)
class Shape:
    """Trees of up to ``leaves`` leaves, grown best split first, at most ``depth`` deep."""

    depth: int = 8
    rate: float = 0.08
    rounds: int = 350
    leaves: int = 31
    least_rows: int = 20
    bins: int = 255


@dataclass(frozen=True)
class Frame:
    """Training rows of one target: text columns, numeric columns without nulls, and the truth."""

    rows: DataFrame
    cats: list[str]
    nums: list[str]
    y: str = "_y"


@dataclass
class Binning:
    """Upper ends of the bins of every numeric column, and the numbered values of every text column."""

    cats: list[str]
    nums: list[str]
    cuts: list[np.ndarray]
    values: list[dict[str, int]]

    @property
    def width(self) -> int:
        return SLOTS * len(self.nums) + sum(len(v) + 1 for v in self.values)

    def numeric(self, cols: Sequence[np.ndarray], n: int) -> np.ndarray:
        out = np.empty((len(cols), n), np.uint8)
        for k, (cut, col) in enumerate(zip(self.cuts, cols)):
            out[k] = np.searchsorted(cut, col, side="left")
        return out

    def codes(self, cols: Sequence[Sequence[str]], n: int) -> np.ndarray:
        """Number of each value from 1; 0 for one not seen in training, which equals none."""
        out = np.empty((len(cols), n), np.int32)
        for k, (known, col) in enumerate(zip(self.values, cols)):
            out[k] = [known.get(v, 0) for v in col]
        return out


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1. A row goes right above the bin ``cut``, or if its value is number ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.feature, self.cut, self.left, self.right, self.value


def _walk(tree: tuple[np.ndarray, ...], x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """Node of every row."""
    feature, cut, left, right = tree[:4]
    at = np.zeros(n, np.int32)
    live = np.arange(n) if feature[0] >= 0 else np.empty(0, np.int64)
    while len(live):
        node = at[live]
        f = feature[node]
        goes = np.empty(len(live), bool)
        num = f < len(x)
        goes[num] = x[f[num], live[num]] > cut[node[num]]
        goes[~num] = c[f[~num] - len(x), live[~num]] == cut[node[~num]]
        at[live] = np.where(goes, right[node], left[node])
        live = live[feature[at[live]] >= 0]
    return at


def _added(pred: np.ndarray, trees: list[tuple[np.ndarray, ...]], x: np.ndarray, c: np.ndarray) -> np.ndarray:
    for tree in trees:
        pred = pred + tree[4][_walk(tree, x, c, len(pred))]
    return pred


def _sums(work: dict[int, tuple], blocks: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], tuple[np.ndarray, np.ndarray]]]:
    """Residuals and rows by node and bin in these blocks, for every target and feature."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for target, x, c, y, pred in blocks:
        if target not in work:
            continue
        trees, tree, slots, n_slots, offsets, width, scale = work[target]
        slot = slots[_walk(tree, x, c, len(y))]
        rows = np.flatnonzero(slot >= 0)
        g, n = out.get(target) or (np.zeros(n_slots * width, np.int64), np.zeros(n_slots * width, np.int64))
        if len(rows):
            x, c = x[:, rows], c[:, rows]
            q = np.rint((y[rows] - _added(pred[rows], trees, x, c)) * scale)
            # one table of cells for all features: sums of integers below 2**53, so doubles hold them exactly
            cells = np.concatenate([x, c]) + (slot[rows].astype(np.int64) * width + np.array(offsets, np.int64)[:, None])
            g = g + np.bincount(cells.ravel(), weights=np.tile(q, len(cells)), minlength=len(g)).astype(np.int64)
            n = n + np.bincount(cells.ravel(), minlength=len(n))
        out[target] = g, n
    for target, sums in out.items():
        _, _, _, _, offsets, width, _ = work[target]
        g, n = (x.reshape(-1, width) for x in sums)
        for f, (first, end) in enumerate(zip(offsets, [*offsets[1:], width])):
            yield (target, f), (g[:, first:end], n[:, first:end])


def _merged(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


#: Residuals and rows of a node, then gain, feature and cut of its best split, and residuals and rows on the left.
_Split = tuple[int, int, float, int, int, int, int]


def _splits(numbers: dict[int, int], least: int, merged: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], _Split]]:
    """The best split of every node of each target among these features; feature -1 if there is none."""
    out: dict[tuple[int, int], _Split] = {}
    for (target, f), (g, n) in merged:
        sums, rows = g.sum(axis=1), n.sum(axis=1)
        # rows and sums of the left side for every cut of a number, and for every value set apart
        if f < numbers[target]:
            nl, gl = np.cumsum(n, axis=1), np.cumsum(g, axis=1)
        else:
            nl, gl = rows[:, None] - n, sums[:, None] - g
        ok = (nl >= least) & (rows[:, None] - nl >= least)
        if f >= numbers[target]:
            ok[:, 0] = False  # number 0 stands for values unseen in training
        for slot, (own_g, own_n) in enumerate(zip(sums.tolist(), rows.tolist())):
            split = own_g, own_n, 0.0, -1, 0, 0, 0
            at = np.flatnonzero(ok[slot])
            if len(at):
                a, m = gl[slot, at].astype(float), nl[slot, at].astype(float)
                base = float(own_g) ** 2 / own_n
                gain = a * a / m + (own_g - a) ** 2 / (own_n - m) - base
                best = int(np.argmax(gain))
                if gain[best] > 1e-12 * base:
                    cut = int(at[best])
                    split = own_g, own_n, float(gain[best]), f, cut, int(gl[slot, cut]), int(nl[slot, cut])
            out[target, slot] = _better(out.get((target, slot), split), split)
    yield from out.items()


def _better(a: _Split, b: _Split) -> _Split:
    """The split with the larger gain, of the earlier feature among equals."""
    return min(a, b, key=lambda s: (-s[2], s[3]))


@dataclass
class _Node:
    depth: int
    g: int
    n: int
    gain: float = 0.0
    feature: int = -1
    cut: int = 0
    #: Sums and rows of the left side of the split.
    left: tuple[int, int] = (0, 0)
    children: tuple[int, int] | None = None


class _Grower:
    """One tree of one target, from the best splits of its nodes."""

    def __init__(self, binning: Binning, shape: Shape) -> None:
        self.binning, self.shape = binning, shape
        self.nodes: list[_Node] = []
        #: Nodes whose splits are wanted.
        self.asked: list[int] = [0] if binning.width else []

    def tree(self, chosen: set[int], scale: float | None = None) -> Tree:
        """The tree with the chosen splits; leaf values only if ``scale`` is given."""
        n = max(1, len(self.nodes))
        t = Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n))
        for i, node in enumerate(self.nodes):
            if i in chosen and node.children:
                t.feature[i], t.cut[i], (t.left[i], t.right[i]) = node.feature, node.cut, node.children
            if scale is not None and node.n:
                t.value[i] = self.shape.rate * node.g / (node.n * scale)
        return t

    def take(self, found: list[_Split]) -> None:
        """Best splits of the asked nodes; asks for the children that may be split in turn."""
        for i, (g, n, gain, feature, cut, *left) in zip(self.asked, found):
            if not self.nodes:
                self.nodes.append(_Node(0, g, n))
            if feature >= 0:
                node = self.nodes[i]
                node.gain, node.feature, node.cut, node.left = gain, feature, cut, tuple(left)
        self.asked = []
        for i in sorted(self.chosen()):
            node = self.nodes[i]
            if node.children:
                continue
            (gl, nl), at = node.left, len(self.nodes)
            node.children = at, at + 1
            self.nodes += [_Node(node.depth + 1, gl, nl), _Node(node.depth + 1, node.g - gl, node.n - nl)]
            if node.depth + 1 < self.shape.depth:
                self.asked += [k for k in node.children if self.nodes[k].n >= 2 * self.shape.least_rows]

    def chosen(self) -> set[int]:
        """Splits that best-first growth takes among those known; one left out now is left out for good."""
        heap = [(-self.nodes[0].gain, 0)] if self.nodes and self.nodes[0].gain > 0 else []
        out: set[int] = set()
        while heap and len(out) < self.shape.leaves - 1:
            _, i = heapq.heappop(heap)
            out.add(i)
            for k in self.nodes[i].children or ():
                if self.nodes[k].gain > 0:
                    heapq.heappush(heap, (-self.nodes[k].gain, k))
        return out


def binning(frame: Frame, bins: int = 255) -> tuple[Binning, dict[str, float]]:
    """Bins of all columns, and n, mean and reach of the truth, from one pass each over numbers and texts.

    Cuts are quantiles and the smallest value; a column with few values gets a bin for each of them.
    """
    grid = F.array(*[F.lit(k / (bins - 1)) for k in range(1, bins - 1)])
    cuts = [F.array_distinct(F.concat(F.array(F.min(c)), F.percentile_approx(F.col(c).cast("double"), grid, bins * 400))).alias(f"_{i}") for i, c in enumerate(frame.nums)]
    y = F.col(frame.y)
    row = frame.rows.agg(F.count("*").alias("n"), F.avg(y).alias("mean"), F.min(y).alias("low"), F.max(y).alias("high"), *cuts).first()
    values: list[dict[str, int]] = [{} for _ in frame.cats]
    if frame.cats:
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(frame.cats)]))
        for r in frame.rows.select(cells.alias("e")).select("e.*").where("v IS NOT NULL").distinct().orderBy("i", "v").collect():
            values[r.i][r.v] = len(values[r.i]) + 1
    found = [np.array(sorted(v for v in (row[f"_{i}"] or []) if v is not None), float) for i in range(len(frame.nums))]
    mean = float(row["mean"] or 0.0)
    reach = max(abs(float(row["low"] or 0.0) - mean), abs(float(row["high"] or 0.0) - mean)) if row["n"] else 0.0
    return Binning(frame.cats, frame.nums, found, values), {"n": row["n"], "mean": mean, "reach": reach}


_BLOCK = "target int, n int, x binary, c binary, y binary"


def _blocked(frame: Frame, b: Binning, target: int) -> DataFrame:
    """The rows as blocks of binned columns."""
    n_cats, n_nums = len(b.cats), len(b.nums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            c = b.codes([batch.column(i).to_pylist() for i in range(n_cats)], n)
            x = b.numeric([batch.column(n_cats + i).to_numpy(zero_copy_only=False) for i in range(n_nums)], n)
            y = batch.column(n_cats + n_nums).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([target], pa.int32()), pa.array([n], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (x, c, y)]], ["target", "n", "x", "c", "y"])

    cols = [*[F.col(f"`{c}`").cast("string") for c in b.cats], *[F.col(f"`{c}`").cast("double") for c in b.nums], F.col(frame.y).cast("double")]
    return frame.rows.select(*[c.alias(f"_{i}") for i, c in enumerate(cols)]).mapInArrow(run, _BLOCK)


def _spread(frame: Frame, n: int) -> Frame:
    """The rows in as many partitions as they are worth while cores are idle."""
    parts = min(frame.rows.sparkSession.sparkContext.defaultParallelism, n // PARTITION_ROWS)
    return replace(frame, rows=frame.rows.repartition(parts)) if parts > frame.rows.rdd.getNumPartitions() else frame


def fit(frames: dict[str, Frame], shape: Shape = Shape()) -> dict[str, Boosted]:
    """A model for every target. A target without rows gets none."""
    found = {name: binning(frame, shape.bins) for name, frame in frames.items()}
    names = [name for name, (_, s) in found.items() if s["n"]]
    if not names:
        return {}
    table, rows = None, sum(found[name][1]["n"] for name in names)
    for t, name in enumerate(names):
        # few files hold many rows here, and one task a level would scan them all
        own = _spread(frames[name], found[name][1]["n"])
        part = _blocked(own, found[name][0], t)
        table = part if table is None else table.unionByName(part)
    bins = [found[name][0] for name in names]
    means = [found[name][1]["mean"] for name in names]
    scales = [SCALE / (found[name][1]["reach"] or 1.0) for name in names]
    sizes = [(len(b.nums), len(b.cats)) for b in bins]

    def decoded(r) -> tuple:
        f, c = sizes[r.target]
        return r.target, np.frombuffer(r.x, np.uint8).reshape(f, r.n), np.frombuffer(r.c, np.int32).reshape(c, r.n), np.frombuffer(r.y, float), np.full(r.n, means[r.target])

    raw = cut_lineage(table).rdd
    blocks = raw.map(decoded).coalesce(max(1, min(raw.getNumPartitions(), rows // PARTITION_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
    models = [Boosted(b, mean, []) for b, mean in zip(bins, means)]
    offsets = [[*range(0, SLOTS * len(b.nums), SLOTS), *np.cumsum([SLOTS * len(b.nums), *[len(v) + 1 for v in b.values]])[:-1].tolist()] for b in bins]
    recent: list[list[tuple]] = [[] for _ in names]
    for done in range(shape.rounds):
        growers = [_Grower(b, shape) for b in bins]
        while any(g.asked for g in growers):
            _grow(blocks, growers, recent, offsets, scales)
        for t, g in enumerate(growers):
            tree = _packed(g.tree(g.chosen(), scales[t]))
            models[t].trees.append(tree)
            recent[t].append(tree.arrays())
        if (done + 1) % SNAPSHOT == 0 and done + 1 < shape.rounds:
            blocks = _caught_up(blocks, recent)
            recent = [[] for _ in names]
    blocks.unpersist()
    return dict(zip(names, models))


def _grow(blocks: RDD, growers: list[_Grower], recent: list[list[tuple]], offsets: list[list[int]], scales: list[float]) -> None:
    """One level of the trees of all targets: a single job."""
    work = {}
    for t, g in enumerate(growers):
        if g.asked:
            tree = g.tree({i for i, node in enumerate(g.nodes) if node.children})
            slots = np.full(max(1, len(g.nodes)), -1, np.int32)
            for k, i in enumerate(g.asked):
                slots[i] = k
            work[t] = recent[t], tree.arrays(), slots, len(g.asked), offsets[t], g.binning.width, scales[t]
    numbers, least = {t: len(growers[t].binning.nums) for t in work}, growers[0].shape.least_rows
    parts = -(-sum(growers[t].binning.width for t in work) // TASK_BINS)
    sums = blocks.mapPartitions(lambda own: _sums(work, own)).reduceByKey(_merged, parts, sum)
    found: dict[tuple[int, int], _Split] = {}
    for place, split in sums.mapPartitions(lambda own: _splits(numbers, least, own)).collect():
        found[place] = _better(found.get(place, split), split)
    for t in work:
        if (t, 0) in found:
            growers[t].take([found[t, k] for k in range(len(growers[t].asked))])
        else:
            growers[t].asked = []


def _caught_up(blocks: RDD, recent: list[list[tuple]]) -> RDD:
    """The blocks with predictions that count the latest trees."""
    new = blocks.map(lambda b: (*b[:4], _added(b[4], recent[b[0]], b[1], b[2]))).persist(StorageLevel.MEMORY_AND_DISK)
    new.count()
    blocks.unpersist()
    return new


def _packed(tree: Tree) -> Tree:
    """The tree without nodes that were looked at but not chosen, children after their parents."""
    order, at = [0], 0
    while at < len(order):
        i = order[at]
        if tree.feature[i] >= 0:
            order += [int(tree.left[i]), int(tree.right[i])]
        at += 1
    new = {old: k for k, old in enumerate(order)}
    split = tree.feature[order] >= 0
    follow = lambda side: np.array([new[int(side[i])] if s else 0 for i, s in zip(order, split)], np.int32)
    return Tree(tree.feature[order], tree.cut[order], follow(tree.left), follow(tree.right), np.where(split, 0.0, tree.value[order]))


@dataclass
class Boosted:
    """Bins, the mean of the truth, and the trees whose values add up to it."""

    binning: Binning
    base: float
    trees: list[Tree]

    def predict(self, cats: Sequence[Sequence[str]], nums: Sequence[np.ndarray], n: int) -> np.ndarray:
        x, c = self.binning.numeric(nums, n), self.binning.codes(cats, n)
        return _added(np.full(n, self.base), [t.arrays() for t in self.trees], x, c)

    def predicted(self, cats: Sequence[Column], nums: Sequence[Column]) -> Column:
        """Prediction as a column, over Arrow batches; the columns in the order of the bins."""
        n_cats = len(cats)

        @F.pandas_udf("double")
        def run(*cols: pd.Series) -> pd.Series:
            return pd.Series(self.predict([c.tolist() for c in cols[:n_cats]], [c.to_numpy(float) for c in cols[n_cats:-1]], len(cols[-1])))

        return run(*[c.cast("string") for c in cats], *[c.cast("double") for c in nums], F.lit(0))

    def rows(self) -> list[tuple]:
        return [(k, i, int(f), int(c), int(a), int(b), float(v)) for k, t in enumerate(self.trees) for i, (f, c, a, b, v) in enumerate(zip(*t.arrays()))]

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        spark.createDataFrame(self.rows(), "tree int, node int, feature int, cut int, left int, right int, value double").write.mode("overwrite").parquet(f"{path}/trees")
        b = self.binning
        bins = json.dumps({"cats": b.cats, "nums": b.nums, "cuts": [c.tolist() for c in b.cuts], "values": b.values, "base": self.base})
        spark.createDataFrame([(bins,)], "bins string").write.mode("overwrite").parquet(f"{path}/bins")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        d = json.loads(spark.read.parquet(f"{path}/bins").first().bins)
        b = Binning(d["cats"], d["nums"], [np.array(c, float) for c in d["cuts"]], d["values"])
        nodes = spark.read.parquet(f"{path}/trees").orderBy("tree", "node").toPandas()
        trees = [Tree(*(g[c].to_numpy(t) for c, t in (("feature", np.int32), ("cut", np.int32), ("left", np.int32), ("right", np.int32), ("value", float)))) for _, g in nodes.groupby("tree")]
        return Boosted(b, d["base"], trees)
