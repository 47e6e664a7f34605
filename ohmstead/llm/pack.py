"""Best-fit packing with certified bounds.

Documents are cut into pieces of at most ``capacity`` tokens, and pieces are packed into sequences.
Pieces are dealt into bounded packing groups by hash, and each group is packed by best-fit decreasing.
Dual-feasible functions give a lower bound on a group's bins. A group that meets its bound is
certified and final. The others have gaps: their full bins stay, the documents of all other bins are
dealt anew into fewer groups and packed again, until every group is certified, one group is left, or
a round saves no bin.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ohmstead.llm import common, tokens

CAPACITY = 2048
GROUP_PIECES = 16_384
#: Texts that are Python objects at a time.
STEP = 512
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, which must be in decreasing order, and the space left per bin.

    Bins stand in lists by free space; the set of free spaces is a bit mask, so the tightest bin that
    fits is the mask's lowest bit at or above the length.
    """
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins, offsets, free = 0, [], [], []
    for n in lengths.tolist():
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            at = by_free[space].pop()
            if not by_free[space]:
                mask &= ~(1 << space)
        else:
            space, at = capacity, len(free)
            free.append(capacity)
        bins.append(at)
        offsets.append(capacity - space)
        left = space - n
        free[at] = left
        if left:
            by_free[left].append(at)
            mask |= 1 << left
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(free, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int, folds: int = 64) -> int:
    """Least number of bins, by two families of dual-feasible functions.

    For every k up to half the capacity: lengths above capacity - k count as whole, those below k as
    nothing. For every p: floor((p + 1) x / capacity) / p, and x itself where that is exact. In both, no
    set that fits a bin sums to more than one, so the sum over all lengths is a bound.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    n_from = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    sum_from = np.concatenate([np.cumsum((count * size)[::-1])[::-1], [0]])
    k = np.arange(0, capacity // 2 + 1)
    whole = n_from[capacity - k + 1]
    middle = sum_from[k] - sum_from[capacity - k + 1]
    best = int((whole + -(-middle // capacity)).max())
    for p in range(1, folds + 1):
        up = (p + 1) * size
        # in units of 1 / (p * capacity)
        value = np.where(up % capacity == 0, size * p, up // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (p * capacity)))
    return best


def cut(docs: DataFrame, tokenizer: str, pieces: str = "whole", capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces; null text counts as empty.

    A document's ids end with ``end_id``, so an empty one has one piece of one token.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end, step = int(end_id).to_bytes(4, "little"), capacity * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(tokenizer, pieces)
        # a batch holds thousands of texts, of which few at a time become Python objects
        for b in (whole.slice(at, STEP) for whole in batches for at in range(0, whole.num_rows, STEP)):
            rows = []
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = coder.encode(body or "") + end
                for i in range(0, len(ids), step):
                    own = ids[i : i + step]
                    rows.append((doc_id, i // step, i // 4, len(own) // 4, zlib.crc32(own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id bigint, {PIECES}")


def _packed(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy().astype(np.int64)
        tie = [table[c].fill_null(-1).to_numpy() for c in ("ids_crc32", "piece", "doc_id")]
        order = np.lexsort((*tie, -lengths))
        bins, offsets, free = best_fit(lengths[order], capacity)
        bound = lower_bound(lengths, capacity)
        sequence = np.empty(len(lengths), np.int64)
        offset = np.empty(len(lengths), np.int64)
        sequence[order], offset[order] = bins, offsets
        certified = np.full(len(lengths), len(free) == bound)
        done = certified | (free[sequence] == 0)
        for name, values in (("bin", sequence), ("offset", offset), ("done", done), ("bins", np.full(len(lengths), len(free), np.int64)), ("bound", np.full(len(lengths), bound, np.int64))):
            table = table.append_column(name, pa.array(values))
        return table

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32 and others) with sequence_id and offset.

    Groups are dealt by a hash of the piece, so a hot source does not fill one. Repeated pieces are
    packed one by one, ties go by document, piece and checksum. Columns ``_group`` and ``_round`` of the
    input are replaced; other columns' names must not hold dots. An empty table gives no rows.
    """
    cols = [f"`{c}`" for c in pieces.columns if c not in ("_group", "_round", "sequence_id", "offset", "bin", "done", "bins", "bound")]
    pool = common.stored(pieces.select(*cols), "pieces")
    added = [T.StructField(c, T.BooleanType() if c == "done" else T.LongType()) for c in ("_group", "bin", "offset", "done", "bins", "bound")]
    schema = T.StructType([*pool.schema.fields, *added])
    final: list[DataFrame] = []
    before: DataFrame | None = None
    open_bins = round_no = 0
    while True:
        groups = max(1, -(-pool.count() // group_pieces))
        dealt = F.pmod(F.xxhash64("doc_id", "piece", "length", F.lit(round_no)), F.lit(groups)).cast("long")
        out = common.stored(pool.withColumn("_group", dealt).groupBy("_group").applyInArrow(_packed(capacity), schema), "packed")
        out = out.withColumn("sequence_id", F.lit(round_no << 56) + F.shiftleft(F.col("_group"), 26) + F.col("bin"))
        if before is not None and out.agg(F.count_distinct("_group", "bin")).first()[0] >= open_bins:
            final.append(before)
            break
        rest = out.where("NOT done")
        left = rest.agg(F.count_distinct("_group", "bin").alias("bins"), F.count_distinct("_group").alias("groups")).first()
        if left["groups"] <= 1:
            final.append(out)
            break
        final.append(out.where("done"))
        before, open_bins = rest, left["bins"]
        pool = rest.select(*cols)
        round_no += 1
    result = final[0]
    for more in final[1:]:
        result = result.unionByName(more)
    return result.select(*cols, "sequence_id", "offset")
