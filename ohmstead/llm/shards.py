"""Sharding by jump consistent hashing.

A document's stable key alone, with the number of shards, names its shard; there is no ring table.
When shards are appended, a document either stays or moves to a new shard, and only the share of the
new shards moves. Places inside a shard follow the document id, and are counted without gathering a
shard: rows are sorted by ranges, and a small table of counts says where each range starts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.llm import common

#: Multiplier of the generator that jump consistent hashing steps through.
STEP = np.uint64(2862933555777941757)
#: Documents a file holds at most, unless another number is asked for.
FILE_ROWS = 100_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; expected steps grow with the logarithm of ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * STEP + np.uint64(1)
        ahead = ((shard[live] + 1) * (2.0**31 / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        live, ahead = live[ahead < shards], ahead[ahead < shards]
        shard[live] = ahead
    return shard.astype(np.int32)


def stable_key(id_col: Column, text: Column) -> Column:
    """60 bits of the md5 of the id; of the text, with a mark before it, where the id is null."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.concat(F.lit("text|"), F.coalesce(text, F.lit(""))))), 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def found(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    return found(key)


def slots(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``slot``: the place in its shard from 0, in the order of ``by``, nulls first.

    ``rows`` must be a written table, as its rows are read twice. Sorted ranges are numbered where they
    lie; the start of a shard in a range is the sum of its counts in the ranges before. That window
    runs over one row per range and shard. Repeated rows are told apart by their place in the table, so
    no number of them fills one range.
    """
    order = [F.col(c).asc_nulls_first() for c in ("shard", *by, "_at")]
    ranges = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    here = F.monotonically_increasing_id()
    ranges = common.stored(ranges.drop("_at").withColumns({"_range": F.shiftright(here, 33), "_place": here.bitwiseAND((1 << 33) - 1)}), "shard-ranges")
    held = ranges.groupBy("_range", "shard").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = common.stored(held.select("_range", "shard", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start")), "shard-starts")
    return ranges.join(common.lookup(starts), ["_range", "shard"]).withColumn("slot", F.col("_place") + F.col("_start")).drop("_range", "_place", "_start")


def assign(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, grown_shard, slot) of every document.

    ``size`` is the text's UTF-8 bytes plus 1, ``grown_shard`` the shard once one more is appended.
    Null text: no bytes, crc32 of the empty text. Null id: the text decides. Equal ids, and so repeated
    rows, share a shard and get places of their own. An empty table gives no rows. Other columns play no part.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lean = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
                       stable_key(F.col(f"`{id_col}`"), body).alias("_key"))
    placed = lean.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), shard_of(F.col("_key"), shards).alias("shard"), shard_of(F.col("_key"), shards + 1).alias("grown_shard"))
    return slots(common.stored(placed, "shard-keys"), ["doc_id", "text_crc32", "size"])


def moved(assigned: DataFrame) -> DataFrame:
    """The documents that an appended shard takes."""
    return assigned.where("shard <> grown_shard")


def write(docs: DataFrame, folder: str, shards: int = 16, id_col: str = "doc_id", text: str = "text", file_rows: int = FILE_ROWS) -> DataFrame:
    """Writes the documents below ``folder``, one subfolder ``_shard=k`` per shard, and returns (shard, n_docs, n_bytes).

    A shard of any size is cut into files of about ``file_rows`` documents by a hash of the key, so no
    task holds a shard; a repeated id is spread by its row's place. ``docs`` needs no column of its own
    for this, and one named ``_shard`` or ``_part`` is refused. A shard without documents has no row.
    """
    if clash := {"_shard", "_part", "_key"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are taken")
    n_parts = max(1, -(-docs.count() // (shards * file_rows)))
    key = stable_key(F.col(f"`{id_col}`"), F.col(f"`{text}`"))
    placed = docs.withColumn("_key", key).withColumns({"_shard": shard_of(F.col("_key"), shards), "_part": F.pmod(F.xxhash64("_key", F.monotonically_increasing_id()), F.lit(n_parts))})
    placed.drop("_key").repartition("_shard", "_part").drop("_part").write.partitionBy("_shard").parquet(folder)
    size = F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long") + 1
    return docs.sparkSession.read.parquet(folder).groupBy(F.col("_shard").alias("shard")).agg(F.count("*").alias("n_docs"), F.sum(size).alias("n_bytes"))
