"""Token ids as binary shards with a fixed number of bits per id.

A shard file holds documents in ascending order of id. Layout, little-endian:

* 64 bytes: magic ``OHMBITS1``, then unsigned 64-bit: bits per id, ids per block, documents, ids,
  blocks, and two spare words,
* document ids (int64), a byte per document that is 1 where the id is null, first id of each document
  and the end (documents + 1 unsigned 64-bit), byte offset of each block in the payload and the end,
* payload: blocks of packed ids. A block starts on a byte, so ``n`` blocks unpack with one numpy call,
  and any id is found through its block's offset.

Tasks write through pyarrow's file systems into the shared folder. Every attempt writes a file of its
own, and the manifest, a Parquet table committed by Spark, names those of the attempts that count;
a lost or repeated task leaves at most an unnamed file. A shard is cut at ``shard_ids`` ids, which
bounds a writer's and a reader's memory; a longer document has a shard of its own.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.llm import common, tokens

MAGIC = b"OHMBITS1"
BLOCK_IDS = 4096
SHARD_IDS = 1 << 23
#: Pieces of a generation of the token cache. A writer has no other use for its worker's memory than one shard.
CACHE = 400_000
MANIFEST = "task bigint, part bigint, path string, n_docs bigint, n_ids bigint"
INDEX = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def bits_for(vocabulary: int) -> int:
    """Least bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(each[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = each
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def shard_bytes(doc_ids: list[int | None], ids: list[np.ndarray], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<u8")
    blocks = [pack(flat[i : i + block_ids], bits) for i in range(0, len(flat), block_ids)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = MAGIC + struct.pack("<7Q", bits, block_ids, len(doc_ids), len(flat), len(blocks), 0, 0)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), nulls.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class Shard:
    """Random access to one shard: document ids at once, token ids block by block."""

    def __init__(self, source) -> None:
        self.source = source
        head = source.read(64)
        if head[:8] != MAGIC:
            raise ValueError("not a shard")
        self.bits, self.block_ids, n, self.n_ids, blocks, _, _ = struct.unpack("<7Q", head[8:])
        ids = np.frombuffer(source.read(8 * n), "<i8").tolist()
        self.doc_ids = [None if null else d for d, null in zip(ids, source.read(n), strict=True)]
        self.starts = np.frombuffer(source.read(8 * (n + 1)), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(source.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.base = 64 + 8 * n + n + 8 * (n + 1) + 8 * (blocks + 1)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Token ids from ``start`` to ``end``, exclusive, reading only their blocks."""
        if start >= end:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        self.source.seek(self.base + int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        at = first * self.block_ids
        whole = self.block_ids * self.bits % 8 == 0
        if whole:
            flat = unpack(data, self.bits, min(self.n_ids, (last + 1) * self.block_ids) - at)
        else:
            cut = self.offsets[first : last + 2] - self.offsets[first]
            sizes = [min(self.block_ids, self.n_ids - b * self.block_ids) for b in range(first, last + 1)]
            flat = np.concatenate([unpack(data[a:b], self.bits, n) for a, b, n in zip(cut[:-1], cut[1:], sizes, strict=True)])
        return flat[start - at : end - at]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _at(path: str):
    """File system and path for a URI or a plain path."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, pieces: str = "whole", id_col: str = "doc_id", text: str = "text",
          end_id: int | None = 0, block_ids: int = BLOCK_IDS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes shards below ``folder`` and returns the manifest, one row per shard in document order.

    Null text counts as empty; a null document id comes first; repeated ids are ordered by text. An
    empty table gives no shard.
    """
    bits = bits_for(vocabulary)
    end = [] if end_id is None else [end_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(tokenizer, pieces, CACHE)
        task = TaskContext.get().partitionId()
        fs, root = _at(folder)
        rows, held = [], 0
        names: list = []
        ids: list = []

        def flush() -> None:
            nonlocal names, ids, held
            if not names:
                return
            name = f"shard-{task:05d}-{len(rows):05d}-{uuid.uuid4().hex}.bin"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(shard_bytes(names, ids, bits, block_ids))
            rows.append((task, len(rows), f"{folder}/{name}", len(names), held))
            names, ids, held = [], [], 0

        for b in batches:
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = np.concatenate([np.frombuffer(coder.encode(body or ""), "<u4"), np.array(end, "<u4")]).astype("<u2" if bits <= 16 else "<u4")
                if held and held + len(found) > shard_ids:
                    flush()
                names.append(doc_id)
                ids.append(found)
                held += len(found)
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()], strict=True)], ["task", "part", "path", "n_docs", "n_ids"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # ties on the id spread by text, so one repeated id cannot fill a partition
    tie = F.xxhash64("text")
    ordered = plain.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text")
    return common.stored(ordered.mapInArrow(run, MANIFEST), "shard-manifest")


def read(manifest: DataFrame, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shard files.

    ``start`` counts the ids of all documents before it; the window runs over one row per shard.
    """
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    digest = digest or (lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, name = _at(path)
                with fs.open_input_file(name) as source:
                    shard = Shard(source)
                    for i in range(0, len(shard.doc_ids), 256):
                        some = range(i, min(i + 256, len(shard.doc_ids)))
                        ids = [shard.document(k) for k in some]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([shard.doc_ids[k] for k in some], pa.int64()), pa.array([first + int(shard.starts[k]) for k in some], pa.int64()),
                             pa.array([len(x) for x in ids], pa.int64()), pa.array([digest(x) for x in ids], pa.int64())], schema=schema)

    return placed.select("path", "first").repartition("path").mapInArrow(run, INDEX)


def vocabulary_size(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(os.fspath(tokenizer)).get_vocab_size()
