"""Exact top-k search by inner product over a pivot-distance index.

A vector x gets one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and a query gets 0.
Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the highest inner products are the nearest vectors, and the
triangle inequality holds. The index keys every vector by its nearest pivot and its distance to it;
sorted by both, runs of vectors form annuli. A query's distance to an annulus is at least the gap
between its own distance to the pivot and the annulus' range. Annuli are expanded in order of that
bound: the first ones of a query group give each query a k-th best score, and of the others only
those whose bound can still reach it are searched.

Pivots are chosen on a bounded sample (``SAMPLE`` vectors by hash of their id), farthest first. They
decide only how much is pruned; scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.llm import common

SAMPLE = 4096
PIVOTS = 32
#: Vectors in an annulus and queries in a group, at most.
ANNULUS = 1024
GROUP = 256
FIRST = 4
_INT64 = 2**63 - 1


def prepared(df: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, without vectors that are null or hold null or non-finite components."""
    v = F.col(vector)
    sound = v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return df.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where every sum stays below 2^53."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in vectors], object).T
    return np.clip(exact, -_INT64, _INT64).astype(np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


def _distances(vectors: np.ndarray, last: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors with their added coordinate to the pivots, which carry theirs at the end."""
    full = np.concatenate([vectors, last[:, None]], axis=1)
    square = (full**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest first, from the sample's first vector; equal vectors are chosen once."""
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


class Index:
    """Written annuli: (annulus, pivot, lo, hi, n, ids, vectors), and what a search needs to bound them."""

    def __init__(self, vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, annulus: int = ANNULUS) -> None:
        whole = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
        size = vectors.agg(F.max(whole).alias("m"), F.max(F.size("v")).alias("dim")).first()
        self.empty = size["dim"] is None
        if self.empty:
            return
        self.most, self.dim = float(size["m"]), max(1, size["dim"])
        rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").collect()
        some = np.array([r[0] + [0.0] * (self.dim - len(r[0])) for r in rows]).reshape(len(rows), self.dim)
        last = np.sqrt(np.maximum(self.most - (some**2).sum(1), 0))
        self.pivots = choose_pivots(np.concatenate([some, last[:, None]], axis=1), pivots)
        self.annuli = common.stored(self._build(vectors, annulus), "annuli")

    def _build(self, vectors: DataFrame, annulus: int) -> DataFrame:
        dim, most, pivots = self.dim, self.most, self.pivots

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                m = _matrix(b.column(1), dim)
                d = _distances(m, np.sqrt(np.maximum(most - (m**2).sum(1), 0)), pivots)
                near = d.argmin(1) if len(m) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(near, pa.int32()), pa.array(d[np.arange(len(m)), near]), pa.array([r.astype("<f8").tobytes() for r in m], pa.binary())], ["vec_id", "pivot", "dist", "bytes"])

        def ringed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, made, held = TaskContext.get().partitionId(), 0, []

            def out() -> pa.RecordBatch:
                nonlocal made, held
                ids, piv, dist, raw = zip(*held, strict=True)
                row = {"annulus": (task << 32) + made, "pivot": piv[0], "lo": dist[0], "hi": dist[-1], "n": len(ids), "ids": np.array([i if i is not None else 0 for i in ids], "<i8").tobytes(), "vectors": b"".join(raw)}
                made, held = made + 1, []
                return pa.RecordBatch.from_pylist([row], schema)

            for b in batches:
                for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                    if held and (len(held) == annulus or held[0][1] != row[1]):
                        yield out()
                    held.append(row)
            if held:
                yield out()

        schema = pa.schema([("annulus", pa.int64()), ("pivot", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64()), ("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
        index = vectors.select("vec_id", "v").mapInArrow(keyed, "vec_id bigint, pivot int, dist double, bytes binary")
        # a common vector is spread by its ids: the range takes pivot, distance and id
        ordered = index.repartitionByRange("pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id").select("vec_id", "pivot", "dist", "bytes")
        return ordered.mapInArrow(ringed, "annulus bigint, pivot int, lo double, hi double, n bigint, ids binary, vectors binary")

    def _groups(self, queries: DataFrame, group: int) -> DataFrame:
        """Queries, close ones together: (grp, n, qids, qvectors, dists, near, far, norm)."""
        dim, most, pivots = self.dim, self.most, self.pivots

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, made, ids, rows = TaskContext.get().partitionId(), 0, [], []

            def out() -> pa.RecordBatch:
                nonlocal made, ids, rows
                m = np.stack(rows)
                d = _distances(m, np.zeros(len(m)), pivots)
                row = {"grp": (task << 32) + made, "n": len(ids), "qids": np.array(ids, "<i8").tobytes(), "qvectors": m.astype("<f8").tobytes(), "dists": d.tobytes(),
                       "near": d.min(0).tolist(), "far": d.max(0).tolist(), "norm": float((m**2).sum(1).max())}
                made, ids, rows = made + 1, [], []
                return pa.RecordBatch.from_pylist([row], schema)

            for b in batches:
                for i, r in zip(b.column(0).to_pylist(), _matrix(b.column(1), dim), strict=True):
                    ids.append(i)
                    rows.append(r)
                    if len(ids) == group:
                        yield out()
            if ids:
                yield out()

        schema = pa.schema([("grp", pa.int64()), ("n", pa.int64()), ("qids", pa.binary()), ("qvectors", pa.binary()), ("dists", pa.binary()), ("near", pa.list_(pa.float64())), ("far", pa.list_(pa.float64())), ("norm", pa.float64())])
        one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
        # as few parts as groups, so that small query sets make full groups
        parts = max(1, -(-one.count() // group))
        return one.repartitionByRange(parts, "v", "vec_id").sortWithinPartitions("v", "vec_id").select("vec_id", "v").mapInArrow(
            packed, "grp bigint, n bigint, qids binary, qvectors binary, dists binary, near array<double>, far array<double>, norm double")

    def _scored(self, pairs: DataFrame, groups: DataFrame, k: int) -> DataFrame:
        """(query_id, vec_id, score): the k best of each annulus for each query that it can still serve."""
        dim, most, width = self.dim, self.most, len(self.pivots)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for pivot, lo, hi, raw_ids, raw, raw_q, raw_qv, raw_d, floors in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    ids, qids = np.frombuffer(raw_ids, "<i8"), np.frombuffer(raw_q, "<i8")
                    x, q = np.frombuffer(raw, "<f8").reshape(-1, dim), np.frombuffer(raw_qv, "<f8").reshape(-1, dim)
                    d = np.frombuffer(raw_d, "<f8").reshape(-1, width)[:, pivot]
                    least = np.maximum(np.maximum(lo - d, d - hi), 0)
                    reach = ((q**2).sum(1) + most - least**2) / 2
                    floor = np.full(len(qids), -np.inf)
                    for f in floors or []:
                        floor[qids == f["query_id"]] = f["floor"]
                    floor -= np.where(np.isfinite(floor), np.abs(floor), 0) * 1e-15
                    slack = 1 + 1e-9 * np.abs(reach)
                    use = np.flatnonzero(reach + slack >= floor)
                    if not len(use):
                        continue
                    found = scores(q[use], x)
                    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                    for i, u in enumerate(use):
                        fit = np.flatnonzero((found[i] >= floor[u]) & (ids != qids[u]))
                        best = fit[np.lexsort((ids[fit], -found[i][fit]))[:k]]
                        out.append((np.full(len(best), qids[u]), ids[best], found[i][best]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

        joined = pairs.select("grp", "annulus").join(self.annuli, "annulus").join(groups.drop("n", "near", "far", "norm", "lowest"), "grp")
        floors = F.col("floors") if "floors" in groups.columns else F.lit(None).cast("array<struct<query_id:bigint,floor:bigint>>")
        return joined.select("pivot", "lo", "hi", "ids", "vectors", "qids", "qvectors", "dists", floors.alias("floors")).mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")

    def search(self, queries: DataFrame, k: int, group: int = GROUP, first: int = FIRST) -> DataFrame:
        """(query_id, rank, vec_id, score): the k best other vectors of each query, ties to the smaller id."""
        groups = common.stored(self._groups(queries, group), "query-groups")
        side = F.posexplode(F.arrays_zip("near", "far")).alias("pivot", "d")
        reach = groups.select("grp", "norm", side).select("grp", "norm", "pivot", "d.near", "d.far")
        gap = F.greatest(F.col("lo") - F.col("far"), F.col("near") - F.col("hi"), F.lit(0.0))
        pairs = reach.join(self.annuli.select("annulus", "pivot", "lo", "hi", "n"), "pivot").select("grp", "annulus", "n", ((F.col("norm") + self.most - gap * gap) / 2).alias("reach"))
        order = Window.partitionBy("grp").orderBy(F.desc("reach"), "annulus")
        start = common.stored(pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= first).select("grp", "annulus"), "first-annuli")
        held = common.lookup(groups, most_bytes=8 << 20)
        found = common.stored(self._scored(start, held, k), "first-scores")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        floors = found.withColumn("place", F.row_number().over(best)).where(F.col("place") == k).select("query_id", F.col("score").alias("floor"))
        # a query's group, to bring its floor to the group's row
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for grp, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    ids = np.frombuffer(raw, "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), grp)), pa.array(ids)], ["grp", "query_id"])

        member = groups.select("grp", "qids").mapInArrow(listed, "grp bigint, query_id bigint")
        by_group = member.join(floors, "query_id", "left").groupBy("grp").agg(
            F.collect_list(F.when(F.col("floor").isNotNull(), F.struct("query_id", "floor"))).alias("floors"),
            F.when(F.count("floor") == F.count("*"), F.min("floor")).alias("lowest"))
        with_floors = common.stored(groups.join(by_group, "grp"), "query-floors")
        rest = pairs.join(start, ["grp", "annulus"], "left_anti").join(with_floors.select("grp", "lowest"), "grp")
        rest = rest.where(F.col("lowest").isNull() | (F.col("reach") * (1 + 1e-9) + 1 >= F.col("lowest")))
        more = self._scored(rest, common.lookup(with_floors.drop("lowest"), most_bytes=8 << 20), k)
        ranked = found.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")


def search(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The k best other rows of every query row, among all rows.

    Vectors that are null or hold null or non-finite components take no part; shorter ones are padded
    with zeros. Rows without an id take no part either. A repeated id is searched once, with its
    smallest vector, and every row of it is a candidate for the others. Scores beyond a long are cut to
    its range. An empty table gives no rows.
    """
    chosen = df.select(id_col, vector, F.coalesce(is_query, F.lit(False)).alias("_q")).where(F.col(id_col).isNotNull())
    vectors = prepared(chosen, id_col, vector, scale)
    index = Index(vectors)
    if index.empty:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return index.search(prepared(chosen.where("_q"), id_col, vector, scale), k)
