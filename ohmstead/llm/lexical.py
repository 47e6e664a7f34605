"""Ranked lexical search of many queries at once, with shared partial sums.

Query items of a block share terms. Terms that occur in the same items equally often form one operand;
operands that items have in common are paired, round by round, into shared sums, which gives a graph
from terms to items. For a few documents at a time a task adds up each operand and each shared sum once
and combines them into the scores of all items, whose best documents it keeps.

Documents are read twice a block: once for the corpus counts (documents, terms, documents per query
term), once for the scores. Nothing of the documents is shuffled but counts and each task's best rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ohmstead.llm import common

#: Items and bytes of item texts in a block, on average; a block's graph is what tasks get.
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4 << 20
#: Sums that a task holds at a time: documents times operands and shared sums.
CELLS = 1 << 21
#: A term is a longest run of ASCII letters, digits and characters beyond ASCII.
_MAP = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

#: Counts of documents with terms and of all terms, beside the counts of the terms themselves.
N_DOCS, N_TERMS = -1, -2


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_MAP).split()


@dataclass
class Plan:
    """The sums of one block of items: operands, shared sums of two each, and the items' sums."""

    items: list
    vocabulary: dict[bytes, int]
    #: Operand of each term number, numbers from 1.
    operand: np.ndarray
    n_operands: int
    #: Rounds of (left, right): each pair makes the next shared sum; all of a round are independent.
    rounds: list[tuple[np.ndarray, np.ndarray]]
    #: Sums of an item, one item after the other, with how often each counts.
    parts: np.ndarray
    times: np.ndarray
    starts: np.ndarray

    @property
    def n_sums(self) -> int:
        return self.n_operands + sum(len(left) for left, _ in self.rounds)


def plan(items: dict) -> Plan:
    """Mines the term sets that items share.

    ``items`` maps an item to its terms, repeats included; items without terms take no part. An item is
    a list of (operand, times) by falling number of items that have it, so that common ones meet as
    neighbours. The neighbours that most items share become one sum; rounds go on until no two items
    share a pair, and each shortens the lists.
    """
    counts = {item: Counter(found) for item, found in items.items() if found}
    used: dict[bytes, list] = {}
    for i, (_, found) in enumerate(counts.items()):
        for term, n in found.items():
            used.setdefault(term, []).append((i, n))
    alike: dict[tuple, list[bytes]] = {}
    for term, where in used.items():
        alike.setdefault(tuple(where), []).append(term)
    vocabulary: dict[bytes, int] = {}
    operand = [0]
    lists: list[list[tuple[int, int]]] = [[] for _ in counts]
    for k, (where, same) in enumerate(sorted(alike.items(), key=lambda e: (-len(e[0]), e[1]))):
        for term in same:
            vocabulary[term] = len(operand)
            operand.append(k)
        for i, n in where:
            lists[i].append((k, n))
    n_sums = len(alike)
    rounds = []
    while True:
        pairs = Counter(pair for own in lists for pair in set(zip(own, own[1:])) if pair[0][1] == pair[1][1])
        shared = sorted((p for p, n in pairs.items() if n > 1), key=lambda p: (-pairs[p], p))
        if not shared:
            break
        rank = {p: r for r, p in enumerate(shared)}
        named: dict[tuple, int] = {}
        for at, own in enumerate(lists):
            # a pair is taken where no neighbouring pair is more common
            r = [rank.get(p, len(shared)) for p in zip(own, own[1:])]
            out, i = [], 0
            while i < len(own):
                if i < len(r) and r[i] < len(shared) and (i + 1 == len(r) or r[i] <= r[i + 1]):
                    new = named.setdefault((own[i][0], own[i + 1][0]), n_sums + len(named))
                    out.append((new, own[i][1]))
                    i += 2
                else:
                    out.append(own[i])
                    i += 1
            lists[at] = out
        left, right = zip(*named)
        rounds.append((np.array(left), np.array(right)))
        n_sums += len(named)
    sizes = [len(own) for own in lists]
    flat = [p for own in lists for p in own]
    return Plan(list(counts), vocabulary, np.array(operand), len(alike), rounds, np.array([p for p, _ in flat], np.int64),
                np.array([n for _, n in flat], np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if sizes else np.empty(0, np.int64))


def frequencies(texts: list[str | None], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (text, term number, frequency) of the query terms in them."""
    sizes, numbers = [], []
    for text in texts:
        found = terms(text)
        sizes.append(len(found))
        numbers.append(np.fromiter(map(vocabulary.get, found, repeat(0)), np.int64, len(found)))
    n = np.array(sizes, np.int64)
    if not n.sum():
        return n, *(np.empty(0, np.int64) for _ in range(3))
    number = np.concatenate(numbers)
    keys, tf = np.unique((np.repeat(np.arange(len(texts)), n) << 32 | number)[number > 0], return_counts=True)
    return n, keys >> 32, keys & 0xFFFFFFFF, tf


def scores(p: Plan, weights: np.ndarray, n_docs: int, n_terms: int, texts: list[str | None]) -> np.ndarray:
    """Scores of the plan's items, one row per item, one column per text."""
    n, doc, term, tf = frequencies(texts, p.vocabulary)
    m = np.array([75 + 25 * int(k) * n_docs // n_terms if n_terms else 75 for k in n], np.int64)
    value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
    sums = np.zeros((p.n_sums, len(texts)), np.int64)
    np.add.at(sums, (p.operand[term], doc), value)
    at = p.n_operands
    for left, right in p.rounds:
        np.add(sums[left], sums[right], out=sums[at : at + len(left)])
        at += len(left)
    return np.add.reduceat(sums[p.parts] * p.times[:, None], p.starts, axis=0)


class Best:
    """The best ``most`` rows (item, score, document) of what it was given, ties to smaller ids."""

    def __init__(self, most: int, n_items: int) -> None:
        self.most, self.rows, self.n = most, [], 0
        self.held = max(1 << 16, 4 * most * n_items)

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray, known: np.ndarray) -> None:
        self.rows.append((item, score, doc_id, known))
        self.n += len(item)
        if self.n > self.held:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, score, doc_id, known = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((doc_id, ~known, -score, item))
        item = item[order]
        first = np.concatenate([[True], item[1:] != item[:-1]]) if len(item) else np.empty(0, bool)
        place = np.arange(len(item)) - np.maximum.accumulate(np.where(first, np.arange(len(item)), 0))
        order = order[place < self.most]
        self.rows = [(item[place < self.most], score[order], doc_id[order], known[order])]
        self.n = len(order)
        return self.rows[0]


def _counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> dict[int, int]:
    """Documents with terms, all terms, and documents per query term; one row per number comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary) + 1, np.int64)
        with_terms = all_terms = 0
        for b in batches:
            for i in range(0, b.num_rows, 64):
                n, _, term, _ = frequencies(b.column(1).slice(i, 64).to_pylist(), vocabulary)
                with_terms += int((n > 0).sum())
                all_terms += int(n.sum())
                df += np.bincount(term, minlength=len(df))
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([found, [N_DOCS, N_TERMS]])), pa.array(np.concatenate([df[found], [with_terms, all_terms]]))], ["number", "n"])

    rows = docs.mapInArrow(run, "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n")).collect()
    return {r.number: r.n for r in rows}


def _block(docs: DataFrame, p: Plan, most: int, item_type: T.DataType) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents of the block's items."""
    spark = docs.sparkSession
    counts = _counts(docs, p.vocabulary)
    n_docs, n_terms = counts.get(N_DOCS, 0), counts.get(N_TERMS, 0)
    weights = np.array([0] + [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(k, 0) + 1))) for k in range(1, len(p.operand))], np.int64)
    # plain values, as the workers have no copy of this module
    sent = spark.sparkContext.broadcast((*[getattr(p, f.name) for f in fields(p)], weights))
    width = max(1, min(256, CELLS // max(1, p.n_sums + len(p.parts))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, weights = sent.value
        p = Plan(*parts)
        best = Best(most, len(p.items))
        floor = np.zeros(len(p.items), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, width):
                part = b.slice(i, width)
                found = scores(p, weights, n_docs, n_terms, part.column(1).to_pylist())
                # a score equal to an item's last one may still win by its id
                item, at = np.nonzero((found > 0) & (found >= floor[:, None]))
                ids = part.column(0)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                best.add(item, found[item, at], ids.fill_null(0).to_numpy()[at], known[at])
                if best.n <= len(p.items) * most:
                    item, score, _, _ = best.cut()
                    last = np.flatnonzero(np.append(item[1:] != item[:-1], np.ones(min(1, len(item)), bool)))
                    full = np.bincount(item, minlength=len(floor))[item[last]] == most
                    floor[item[last][full]] = score[last][full]
        if best.rows:
            item, score, doc_id, known = best.cut()
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc_id, pa.int64(), mask=~known), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    found = docs.mapInArrow(run, "item int, doc_id bigint, score bigint")
    names = F.broadcast(spark.createDataFrame(list(enumerate(p.items)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)])))
    return found.join(names, "item").select("item_id", "doc_id", "score")


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[dict, T.DataType]]:
    """Items with their terms, block by block; rows of one item are one item."""
    lean = common.stored(items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")), "search-items")
    n, size = lean.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks)))
    for k in range(blocks):
        out: dict = {}
        for row in lean.where(block == k).orderBy("item_id", "text").collect():
            out.setdefault(row.item_id, []).extend(terms(row.text))
        yield out, lean.schema["item_id"].dataType


def search(docs: DataFrame, items: DataFrame, most: int = 20, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best documents above 0 of every item, ties to smaller ids.

    A block of items has ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes on average, and is one pass of
    its own over all documents; its graph is sent to the tasks. Null or empty texts have no terms; items
    without terms, or whose terms no document has, give no rows. Rows that share an item id are one item,
    with the terms of all. Documents that share an id are ranked each for itself, a null id after the
    others. Empty tables give no rows. Other columns play no part.
    """
    lean = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([items.schema[item_id], T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = docs.sparkSession.createDataFrame([], T.StructType([T.StructField("item_id", schema[0].dataType), *schema[1:]]))
    for block, kind in _blocks(items, item_id, item_text):
        p = plan(block)
        if p.items:
            found = found.unionByName(_block(lean, p, most, kind))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # best of shares first, so that the last ranking reads few rows however many tasks there were
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    some = found.withColumn("_share", share).withColumn("_place", F.row_number().over(Window.partitionBy("item_id", "_share").orderBy(*order))).where(F.col("_place") <= most)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return some.select("item_id", "doc_id", "score").withColumn("rank", rank).where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")
