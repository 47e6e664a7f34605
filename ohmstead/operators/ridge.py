"""Ridge regression from sufficient statistics, for any number of targets in one aggregate.

A row's terms are a one, its numbers, a one for the value of each text column, and the truth. Tasks add up
the products of all pairs of terms, block by block; Spark sums them by (target, pair); the small systems
that come back are solved as they are. Rows are read once however many targets there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of the constant term and of the truth.
ONE, TRUTH = "(one)", "(truth)"


@dataclass(frozen=True)
class Ridge:
    cats: list[str]
    nums: list[str]
    #: Weight of every value of each text column; a value unseen in training weighs nothing.
    weights: list[dict[str, float]]
    slopes: list[float]
    intercept: float

    def predicted(self, cats: Sequence[Column], nums: Sequence[Column]) -> Column:
        """Prediction from the columns, in the order of ``cats`` and ``nums``."""
        out = F.lit(self.intercept)
        for c, known in zip(cats, self.weights, strict=True):
            if known:
                pairs = F.create_map(*[F.lit(x) for v, w in known.items() for x in (v, w)])
                out = out + F.coalesce(F.try_element_at(pairs, c.cast("string")), F.lit(0.0))
        for c, slope in zip(nums, self.slopes, strict=True):
            out = out + c.cast("double") * F.lit(slope)
        return out

    def save(self, path: str) -> None:
        SparkSession.active().createDataFrame([(json.dumps(asdict(self)),)], "model string").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ridge:
        return Ridge(**json.loads(spark.read.parquet(path).first().model))


def products(rows: DataFrame, target: str, cats: Sequence[str], nums: Sequence[str], y: str) -> DataFrame:
    """(target, a, b, v): sum over the rows of the product of terms a and b, each pair once, zeros left out.

    The term of a text column's value is ``column=value``. Numbers must not be null; a null text has no term.
    """
    n_cats, names = len(cats), [ONE, *nums, TRUTH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense: dict[str, np.ndarray] = {}
        by_value: dict[tuple[str, int, str], np.ndarray] = {}
        pairs: dict[tuple[str, int, str, int, str], int] = {}
        for batch in batches:
            who = np.array(batch.column(0).to_pylist(), object)
            text = [np.array(["\0" if v is None else v for v in batch.column(1 + i).to_pylist()], object) for i in range(n_cats)]
            x = np.column_stack([np.ones(len(who)), *[batch.column(1 + n_cats + i).to_numpy(zero_copy_only=False) for i in range(len(nums) + 1)]])
            for t in set(who):
                at = who == t
                own = x[at]
                dense[t] = dense.get(t, 0) + own.T @ own
                coded = [np.unique(c[at], return_inverse=True) for c in text]
                for i, (values, code) in enumerate(coded):
                    sums = np.zeros((len(values), x.shape[1]))
                    np.add.at(sums, code, own)
                    for v, s in zip(values, sums):
                        by_value[t, i, v] = by_value.get((t, i, v), 0) + s
                    for j in range(i + 1, n_cats):
                        others, code2 = coded[j]
                        cell, n = np.unique(code * len(others) + code2, return_counts=True)
                        for c, k in zip(cell.tolist(), n.tolist()):
                            key = t, i, values[c // len(others)], j, others[c % len(others)]
                            pairs[key] = pairs.get(key, 0) + k
        out = [(t, names[i], names[j], float(m[i, j])) for t, m in dense.items() for i in range(len(names)) for j in range(i, len(names))]
        for (t, i, v), s in by_value.items():
            if v != "\0":
                # a value's term times itself is its number of rows
                out.append((t, f"{cats[i]}={v}", f"{cats[i]}={v}", float(s[0])))
                out += [(t, names[k], f"{cats[i]}={v}", float(s[k])) for k in range(len(names))]
        out += [(t, f"{cats[i]}={v}", f"{cats[j]}={w}", float(n)) for (t, i, v, j, w), n in pairs.items() if "\0" not in (v, w)]
        out = [r for r in out if r[3]]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.float64() if k == 3 else pa.string()) for k in range(4)], ["target", "a", "b", "v"])

    cols = [F.col(f"`{target}`").cast("string"), *[F.col(f"`{c}`").cast("string") for c in cats], *[F.col(f"`{c}`").cast("double") for c in (*nums, y)]]
    found = rows.select(*[c.alias(f"_{i}") for i, c in enumerate(cols)]).mapInArrow(run, "target string, a string, b string, v double")
    return found.groupBy("target", "a", "b").agg(F.sum("v").alias("v"))


def solve(sums: Mapping[tuple[str, str], float], cats: Sequence[str], nums: Sequence[str], alpha: float) -> Ridge:
    """The model from one target's products; the intercept is not shrunk."""
    values = [sorted(a[len(c) + 1 :] for a, b in sums if a == b and a.startswith(f"{c}=") and a not in nums) for c in cats]
    terms = [*[f"{c}={v}" for c, own in zip(cats, values) for v in own], *nums]
    both = lambda a, b: sums.get((a, b), sums.get((b, a), 0.0))
    n = both(ONE, ONE)
    mean = np.array([both(ONE, t) for t in terms]) / n
    mean_y = both(ONE, TRUTH) / n
    gram = np.array([[both(a, b) for b in terms] for a in terms]).reshape(len(terms), len(terms)) - n * np.outer(mean, mean)
    right = np.array([both(TRUTH, t) for t in terms]) - n * mean * mean_y
    found = np.linalg.lstsq(gram + alpha * np.eye(len(terms)), right, rcond=None)[0] if terms else np.empty(0)
    slope = dict(zip(terms, found.tolist()))
    return Ridge(list(cats), list(nums), [{v: slope[f"{c}={v}"] for v in own} for c, own in zip(cats, values)], [slope[c] for c in nums], float(mean_y - mean @ found))


def fit(rows: DataFrame, target: str, cats: Sequence[str], nums: Mapping[str, Sequence[str]], y: str, alpha: float = 1.0) -> dict[str, Ridge]:
    """A model for every value of ``target``, each with its own numbers; one aggregate over all rows."""
    every = list(dict.fromkeys(c for own in nums.values() for c in own))
    sums: dict[str, dict[tuple[str, str], float]] = {}
    for r in products(rows, target, cats, every, y).collect():
        sums.setdefault(r.target, {})[r.a, r.b] = r.v
    return {t: solve(s, cats, nums[t], alpha) for t, s in sums.items() if t in nums}
