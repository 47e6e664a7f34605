"""Phrase collocations by the stripes pattern.

A stripe is a prefix of words with an associative counter of the words that follow it. Tasks count
stripes over blocks of whole texts, Spark merges them cell by cell, and the merged stripes give all
that a score needs: their cells are the extensions with their frequencies, their sums the frequency of
the prefix, their largest cells the longer phrases that may subsume it.

A stripe crosses the shuffle as one row with its next words and counts side by side. The stripe of a hot
prefix (a known frequency, so at most ``SLICES`` of a length are hot) is cut into slices by a hash of
the next word, the same in all tasks; the empty prefix is always cut.

Stripes are counted by length. The empty prefix comes first; a longer prefix is counted only where the
phrases inside it are frequent, as a phrase is no more frequent than its parts. Tasks learn that from a
bitmap of hashed frequent phrases, whose size has a bound. A false hit only counts a cell in vain, as
frequencies are compared again after the merge, so the result is exact for any size of the bitmap.
What follows a prefix and is no frequent word (the end of the piece, a rare word) is summed in a cell
without a word, so that a stripe always adds up to the frequency of its prefix.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.llm import common

#: Bytes that end a piece, and the mark that stands for them; UTF-8 never holds the mark.
ENDS = b".,;:!?\n\x0b\x0c\r"
MARK = b"\xff"
_MAP = bytes(0xFF if b in ENDS else 0x20 if b == 0x09 else b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Bytes of text that a task counts at a time, and bytes whose words are hashed at a time.
BLOCK, PART = 6 << 20, 1 << 20
#: Bits of a bitmap: 16 a frequent phrase, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Base of the hash of a word's bytes, and its inverse modulo 2**64.
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 1 << 64)

#: Slices of the empty prefix; a prefix with more than that share of all occurrences is hot.
SLICES = 1024

STRIPES = "lang string, prefix string, slice int, nexts string, counts array<int>"
_STRIPES = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("slice", pa.int32()), ("nexts", pa.string()), ("counts", pa.list_(pa.int32()))])


def words_in(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of mapped bytes, and whether a piece ends between a word and the one before."""
    mark = data == MARK[0]
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~(mark | (data == 0x20))
    step = np.diff(word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    pieces = np.searchsorted(np.flatnonzero(mark), starts)
    return starts, ends, np.diff(pieces, prepend=pieces[:1]) > 0


def word_hashes(lang: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words in bytes, the same in every process; alone they decide nothing.

    A word's bytes are digits of a number modulo 2**64: a difference of running sums, moved to its start.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PART, side="right")))
        part = data[starts[i] : ends[j - 1]]
        powers = np.full(len(part), _BASE, np.uint64)
        powers[:1] = 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(powers), out=sums[1:])
        powers[1:] = _BACK
        back = np.multiply.accumulate(powers)
        a, b = starts[i:j] - starts[i], ends[i:j] - starts[i]
        out[i:j] = (sums[b] - sums[a]) * back[a]
        i = j
    out = (out ^ (out >> np.uint64(31))) * _MIX + np.uint64(zlib.crc32(lang.encode()))
    return out ^ (out >> np.uint64(29))


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct word, and the number of each word among them.

    Words are told apart by their hashes, and then compared byte by byte with the word they are taken for.
    """
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    same, i = True, 0
    while same and i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PART, side="right")))
        size, stands = ends[i:j] - starts[i:j], first[number[i:j]]
        same = bool((size == ends[stands] - starts[stands]).all())
        if same:
            # all bytes of these words in a row, and those of the words they stand for
            at = np.arange(int(size.sum())) + np.repeat(starts[i:j] - np.cumsum(size) + size, size)
            same = bool((data[at] == data[at + np.repeat(starts[stands] - starts[i:j], size)]).all())
        i = j
    if same:
        return first, number
    body = data.tobytes()
    known: dict[bytes, int] = {}
    number = np.array([known.setdefault(body[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
    return np.unique(number, return_index=True)[1], number


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    h = (left ^ (right + (left << np.uint64(6)) + (left >> np.uint64(2)))) * _MIX
    return h ^ (h >> np.uint64(29))


class Bitmap:
    """Hashed frequent phrases; the number of bits is a power of two."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.shift = words, np.uint64(64 - (len(words) * 64).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes * _MIX) >> self.shift
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


@dataclass
class Block:
    """Words of texts, numbered from 1; 0 between pieces and for words that are not frequent."""

    x: np.ndarray
    names: list[bytes]
    langs: list[str]
    hashes: np.ndarray


def numbered(texts: dict[str, list[bytes]], frequent: Bitmap | None) -> Block:
    """The texts of each language, one piece after the other."""
    xs, hashes = [], [np.zeros(1, np.uint64)]
    names, langs = [b""], [""]
    for lang, bodies in texts.items():
        body = MARK.join(bodies).translate(_MAP)
        data = np.frombuffer(body, np.uint8)
        starts, ends, apart = words_in(data)
        if not len(starts):
            continue
        h = word_hashes(lang, data, starts, ends)
        first, number = distinct(data, starts, ends, h)
        held = np.ones(len(first), bool) if frequent is None else frequent.has(h[first])
        new = np.where(held, len(names) - 1 + np.cumsum(held), 0).astype(np.uint32)
        own = first[held]
        names += [body[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())]
        langs += [lang] * len(own)
        hashes.append(h[own])
        x = np.zeros(len(starts) + int(apart.sum()) + 1, np.uint32)
        x[np.arange(len(starts)) + np.cumsum(apart)] = new[number]
        xs.append(x)
    return Block(np.concatenate(xs) if xs else np.zeros(1, np.uint32), names, langs, np.concatenate(hashes))


def counted(x: np.ndarray, hashes: np.ndarray, size: int, maps: list[Bitmap]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the stripes whose prefix has ``size - 1`` words: (prefix words, next word or 0, count).

    ``x`` holds numbered words with 0 between pieces and for rare words; ``maps[k]`` knows the frequent
    phrases of k + 1 words. The cells of a prefix lie together.
    """
    # alive[i]: the phrase of the last `width` words from i on is frequent
    alive = x > 0
    h = hashes[x]
    grown = h
    for width in range(2, size):
        n = len(x) - width + 1
        if n < 1:
            return np.empty((0, size - 1), np.uint32), np.empty(0, np.uint32), np.empty(0, np.int64)
        grown = joined(grown[:n], h[width - 1 :])
        both = alive[:n] & alive[1 : n + 1]
        at = np.flatnonzero(both)
        both[at] = maps[width - 1].has(grown[at])
        alive = both
    at = np.flatnonzero(alive)
    # the phrase one word on must be frequent too, or the next word counts as any other
    after = np.append(alive, np.zeros(1, bool))[at + 1]
    nxt = np.where(after, np.append(x, np.zeros(1, x.dtype))[at + size - 1], 0)
    return _grouped([*[x[at + k] for k in range(size - 1)], nxt])


def _grouped(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of numbered words in order, their last word apart, with their counts."""
    bits = max(1, int(max((int(c.max()) for c in columns if len(c)), default=1)).bit_length())
    if bits * len(columns) <= 64:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = key << np.uint64(bits) | c.astype(np.uint64)
        key, n = np.unique(key, return_counts=True)
        parts = [(key >> np.uint64(bits * k) & np.uint64((1 << bits) - 1)).astype(np.uint32) for k in range(len(columns) - 1, -1, -1)]
    else:
        # the first words by their place among the distinct ones
        head, rank = np.unique(columns[0].astype(np.uint64) << np.uint64(32) | columns[1], return_inverse=True)
        words, last, n = _grouped([rank.astype(np.uint32), *columns[2:]])
        pair = head[words[:, 0]]
        parts = [(pair >> np.uint64(32)).astype(np.uint32), (pair & np.uint64(0xFFFFFFFF)).astype(np.uint32), *words[:, 1:].T, last]
    return np.stack(parts[:-1], axis=1), parts[-1], n


def _slices(prefix: np.ndarray, nxt: np.ndarray, hashes: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Slice of each cell: 0 unless its prefix is empty or hot."""
    if not prefix.shape[1]:
        return ((hashes[nxt] >> np.uint64(20)) % np.uint64(SLICES)).astype(np.int32)
    out = np.zeros(len(nxt), np.int32)
    if len(hot[0]):
        h = hashes[prefix[:, 0]]
        for k in range(1, prefix.shape[1]):
            h = joined(h, hashes[prefix[:, k]])
        place = np.minimum(np.searchsorted(hot[0], h), len(hot[0]) - 1)
        at = np.flatnonzero(hot[0][place] == h)
        out[at] = (hashes[nxt[at]] >> np.uint64(20)) % hot[1][place[at]]
    return out


def batches_of(known: Block, prefix: np.ndarray, nxt: np.ndarray, n: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The cells as stripes, one row per prefix and slice."""
    if not len(n):
        return
    names = pa.array(known.names, pa.binary()).cast(pa.string())
    codes = {lang: i for i, lang in enumerate(sorted(set(known.langs)))}
    code = np.fromiter((codes[lang] for lang in known.langs), np.int64, len(known.langs))
    langs = pa.array(list(codes), pa.string())
    part = _slices(prefix, nxt, known.hashes, hot)
    lang = code[prefix[:, 0]] if prefix.shape[1] else code[nxt]
    # cells come in the order of their prefix; slices, and languages of the empty prefix, are brought together
    if part.any() or not prefix.shape[1]:
        group = np.concatenate([[0], np.cumsum((prefix[1:] != prefix[:-1]).any(axis=1))])
        order = np.lexsort((part, lang, group))
        lang, part, prefix, nxt, n = lang[order], part[order], prefix[order], nxt[order], n[order]
    new = (lang[1:] != lang[:-1]) | (part[1:] != part[:-1]) | (prefix[1:] != prefix[:-1]).any(axis=1)
    edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(n)]])
    at, offsets = edges[:-1], pa.array(edges, pa.int32())
    text = pa.array([""] * len(at), pa.string())
    if prefix.shape[1]:
        text = names.take(pa.array(prefix[at, 0]))
        for k in range(1, prefix.shape[1]):
            text = pc.binary_join_element_wise(text, names.take(pa.array(prefix[at, k])), " ")
    # word 0 is empty: the cell without a word
    nexts = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(nxt))), " ")
    counts = pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32()))
    out = pa.RecordBatch.from_arrays([langs.take(pa.array(lang[at])), text, pa.array(part[at]), nexts, counts], schema=_STRIPES)
    for i in range(0, len(at), 50_000):
        yield out.slice(i, 50_000)


def stripes(docs: DataFrame, size: int, maps: list[Broadcast], hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(lang, prefix, slice, next, n): merged stripes of prefixes of ``size - 1`` words, one row per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [Bitmap(b.value) for b in maps]
        held: dict[str, list[bytes]] = {}
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n_held
            block = numbered(held, bitmaps[0] if bitmaps else None)
            held, n_held = {}, 0
            if size == 1:
                n = np.bincount(block.x, minlength=1)[1:]
                nxt = np.flatnonzero(n).astype(np.uint32) + np.uint32(1)
                cells = np.empty((len(nxt), 0), np.uint32), nxt, n[n > 0]
            else:
                cells = counted(block.x, block.hashes, size, bitmaps)
            yield from batches_of(block, *cells, hot)

        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    body = text.encode()
                    held.setdefault(lang, []).append(body)
                    n_held += len(body) + 1
                    if n_held >= BLOCK:
                        yield from flush()
        if held:
            yield from flush()

    rows = docs.mapInArrow(run, STRIPES).repartition("lang", "prefix", "slice")
    cells = rows.select("lang", "prefix", "slice", F.inline(F.arrays_zip(F.split("nexts", " ").alias("next"), F.col("counts").alias("n"))))
    # cells of one prefix and slice are in one place, so this needs no other shuffle
    return cells.groupBy("lang", "prefix", "slice", F.when(F.col("next") != "", F.col("next")).alias("next")).agg(F.sum(F.col("n").cast("long")).alias("n"))


def folded(cells: DataFrame, least: int) -> DataFrame:
    """Stripes with their cells below ``least`` summed into the cell without a word, one a slice."""
    nxt = F.when(F.col("n") >= least, F.col("next"))
    return cells.groupBy("lang", "prefix", "slice", nxt.alias("next")).agg(F.sum("n").alias("n")).drop("slice")


def hot_prefixes(phrases: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and slices of the phrases with at least 1/``SLICES`` of all occurrences: no more than ``SLICES``."""
    rows = phrases.where(F.col("n") * SLICES >= total).collect() if total else []
    found = sorted((phrase_hash(r.lang, r.phrase), -(-r.n * SLICES // total)) for r in rows)
    return np.array([h for h, _ in found], np.uint64), np.array([k for _, k in found], np.uint64)


def phrase_hash(lang: str, phrase: str) -> int:
    data = np.frombuffer(phrase.encode(), np.uint8)
    starts, ends, _ = words_in(data)
    words = word_hashes(lang, data, starts, ends)
    h = words[:1]
    for k in range(1, len(words)):
        h = joined(h, words[k : k + 1])
    return int(h[0])


def bitmap(frequent: DataFrame) -> Broadcast:
    """Broadcast bitmap of (lang, phrase): at most ``MOST_BITS`` bits, whatever the number of phrases."""
    spark = frequent.sparkSession
    wanted = max(LEAST_BITS, 16 * frequent.count())
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    shift = np.uint64(64 - (bits - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [phrase_hash(lang, phrase) for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            slot = np.array(hashes, np.uint64) * _MIX >> shift
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (slot & np.uint64(63))).view(np.int64))], ["word", "bits"])

    words = frequent.select("lang", "phrase").mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(out)


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def score(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both), in decimals, as the product may pass 64 bits."""
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _exact(a), _exact(both))


def mine(docs: DataFrame, longest: int = 4, least: int = 30, covered_pct: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of 2 to ``longest`` words that stays.

    A phrase occurs ``a`` times, at least ``least``; cut where it scores lowest (ties: after fewer words),
    its parts occur ``l`` and ``r`` times. Phrases inside a longer one that occurs ``covered_pct`` percent
    as often go. A longer phrase by several words need not be looked at: the phrases between are at
    least as frequent. Null text counts as empty, null language as ``und``; repeated rows count each
    time; an empty table gives no rows. Other columns play no part.
    """
    plain = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    maps: list[Broadcast] = []
    merged: list[DataFrame] = []
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next")).alias("phrase")
    hot = np.empty(0, np.uint64), np.empty(0, np.uint64)
    for size in range(1, longest + 1):
        merged.append(common.stored(folded(stripes(plain, size, maps, hot), least), f"stripes-{size}"))
        if size < longest:
            frequent = merged[-1].where(F.col("next").isNotNull() & (F.col("n") >= least)).select("lang", phrase, "n")
            maps.append(bitmap(frequent))
            hot = hot_prefixes(frequent, merged[0].agg(F.sum("n")).first()[0] or 0)
    for m in maps:
        m.unpersist()
    return ranked_parts(merged, least, covered_pct)


def ranked_parts(merged: list[DataFrame], least: int, covered_pct: int) -> DataFrame:
    """Scores and subsumption from the merged stripes of the prefixes of 0, 1, 2, ... words."""
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    every = None
    for size, s in enumerate(merged, 1):
        part = s.select("lang", "prefix", "next", "n", phrase.alias("phrase"), F.lit(size).alias("size"))
        every = part if every is None else every.unionByName(part)
    cells = every.where(F.col("next").isNotNull() & (F.col("n") >= least))
    # sums of stripes: the empty prefix has all words of a language, the others their own frequency
    totals = every.groupBy("lang", "prefix").agg(F.sum("n").alias("total"), F.max(F.when(F.col("next").isNotNull() & (F.col("n") >= least) & (F.col("size") > 2), F.col("n"))).alias("longer"))
    totals = common.stored(totals.where((F.col("total") >= least) | (F.col("prefix") == "")), "stripe-sums")
    cells = common.stored(cells.select("lang", "phrase", "size", F.col("n").alias("a")), "stripe-cells")

    words = F.split("phrase", " ")
    cuts = cells.where("size > 1").select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    left = totals.select("lang", F.col("prefix").alias("first"), F.col("total").alias("l"))
    right = cells.where(F.col("size") < len(merged)).select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    lowest = cut.withColumn("score", score(F.col("a"), F.col("l") + F.col("r"))).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    # the longest cells of a stripe extend it to the right; the same cells without their first word, to the left
    to_left = cells.where("size > 2").select("lang", F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " ").alias("phrase"), F.col("a").alias("longer"))
    to_right = totals.where("longer IS NOT NULL").select("lang", F.col("prefix").alias("phrase"), "longer")
    longer = to_left.unionByName(to_right).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * covered_pct))
    all_words = common.lookup(totals.where("prefix = ''").select(F.col("lang").alias("_lang"), F.col("total").alias("n")))
    return kept.join(all_words, F.col("lang") == F.col("_lang")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")


def best(found: DataFrame, most: int = 2000) -> DataFrame:
    """The ``most`` highest scores of each language with their ``rank``; equal ones by ``a``, then by phrase.

    Phrases are ranked in shares of a language first, so that no task sorts one whole.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = found.withColumn("_share", share).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("_place") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return some.drop("_share", "_place").withColumn("rank", rank).where(F.col("rank") <= most)
