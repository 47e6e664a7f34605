"""N-gram Jaccard join with signature trees.

Documents with equal shingle sets form classes, so copies are never paired. Two classes that reach the
threshold must share an element of their prefixes, the first n - ceil(t n) + 1 shingles of each in one
common order. The order puts a quarter of all shingles, chosen by hash, first, rarest before common;
so only that quarter is counted over the corpus, and a prefix seldom reaches a passage that many
documents share. Classes that meet at a prefix shingle form a group.

Every group has a signature tree: members sorted by set size are the leaves; a node holds the OR of
its members' bitmaps, their range of sizes, the most that any of them has from the group's shingle on,
and their component if they have only one. A first wave
joins each member with the group's anchor. Then two trees (or a tree and itself) are walked together
from the roots, and a pair of nodes is dropped when its sizes cannot fit, when the bits that both
hold or what follows the group's shingle bound the overlap below the threshold, or when all its members
are linked already. A pair is due in the group of its first common shingle, where neither has a common
one before it: members know the last ``PAST`` shingles before the group's, pairs that share one of these
have met before, and a group whose members all have the same shingle before it is dropped whole. What is left
at the leaves is verified on the exact sets, while its two components are apart. Groups beyond ``CHUNK`` members are cut into parts by set
size and hash, each a tree in a task of its own; the pairs of trees whose sizes fit are dealt out by tree
and walked, so no task reads a whole group. The pairs found by a walk are one row; its members fetch their
exact sets once each, and a task links components by these until all that reach each other are joined. So
the rows are as many as the members of groups, never as their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmstead.llm import common

WIDTH = 5
PERCENT = 80
#: Bits of a member's bitmap; it comes with the exact set, so tables of prefixes do not hold it.
BITS = 2048
CHUNK = 1024
LEAF = 16
#: Anchors that the members of a cluster are joined with in the first wave.
ANCHORS = 16
FAN = 8
#: Prefix shingles before a group's that a member carries.
PAST = 6
#: Word hashes that a task keeps, about 170 bytes each.
WORDS = 1 << 18
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _Hashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, known: dict[bytes, int], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a whole text's shingles; A-Z lower-cased; fewer words than ``width`` make one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    w = min(width, len(words))
    n = len(ids) - w + 1
    total = np.full(n, w, np.uint64)
    for i in range(w):
        total += ids[i : i + n] * _PLACES[i]
    return np.unique(_mixed(total))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _first(h: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Shingles that can be in the prefix: the counted quarter and, if it is too short, the next ones; size of the quarter."""
    counted = (h & np.uint64(3)) == 0
    own = h[counted]
    lacking = prefix_length(len(h), percent) - len(own) if len(h) else 0
    return (np.concatenate([own, h[~counted][:lacking]]) if lacking > 0 else own), len(own)


def _signature(h: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[((h >> np.uint64(17)) % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _described(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known = _Hashes()
        for b in batches:
            rows = []
            for text in b.column(2).to_pylist():
                h = shingles(text, known, width)
                raw = h.tobytes()
                keys, counted = _first(h, percent)
                fp = [np.array([xxhash.xxh64_intdigest(raw, seed)], np.uint64).view(np.int64)[0] for seed in (1, 2)]
                rows.append((len(h), counted, *fp, keys.view(np.int64)))
            n, counted, fp, fp2, keys = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(counted, pa.int64()), pa.array(fp, pa.int64()), pa.array(fp2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "dk", "n", "counted", "fp", "fp2", "keys"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted (key, fp): rows of keys with two or more classes, and per such key a row (key, null, count).

    Holds one batch and the last class of an unfinished key.
    """
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("df", pa.int64())])

    def out(keys, fps, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fps, pa.int64()), pa.array(counts, pa.int64())], schema=schema)

    key = last = None
    count = 0
    for b in batches:
        k, f = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(k):
            continue
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (f[1:] != f[:-1])
        new[0] = key is None or k[0] != key or f[0] != last
        k, f = k[new], f[new]
        if not len(k):
            continue
        begins = np.ones(len(k), bool)
        begins[1:] = k[1:] != k[:-1]
        begins[0] = key is None or k[0] != key
        group = np.cumsum(begins)
        sizes = np.bincount(group, minlength=group[-1] + 1)
        emit = (sizes >= 2)[group]
        if sizes[0]:
            emit[group == 0] = True
            if count == 1:
                yield out([key], [last], [None])
            sizes[0] += count
        elif key is not None and count >= 2:
            yield out([key], [None], [count])
        ended = np.flatnonzero(sizes[:-1] >= 2)
        if emit.any():
            yield out(k[emit], f[emit], [None] * int(emit.sum()))
        if len(ended):
            heads = np.append(np.array([key], np.int64) if key is not None else np.zeros(1, np.int64), k[begins])
            yield out(heads[ended], [None] * len(ended), sizes[ended])
        key, last, count = k[-1], f[-1], int(sizes[-1])
    if count >= 2:
        yield out([key], [None], [count])


class Tree:
    """Levels of nodes over members sorted by size, from the leaves' members (level 0) to the root."""

    def __init__(self, fp: np.ndarray, n: np.ndarray, comp: np.ndarray, rest: np.ndarray, past: np.ndarray, sig: np.ndarray) -> None:
        self.fp = fp
        self.past = past
        excess = n - np.bitwise_count(sig).sum(1).astype(np.int64)
        self.levels = [(sig, n, n, rest, excess, comp, np.ones(len(n), bool))]
        fan = LEAF
        while len(self.levels[-1][1]) > 1:
            sig, low, high, rest, excess, comp, same = self.levels[-1]
            at = np.arange(0, len(low), fan)
            one = np.minimum.reduceat(comp, at) == np.maximum.reduceat(comp, at)
            self.levels.append((np.bitwise_or.reduceat(sig, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(rest, at), np.maximum.reduceat(excess, at), np.minimum.reduceat(comp, at), one & np.logical_and.reduceat(same, at)))
            fan = FAN


def walk(a: Tree, b: Tree, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the pairs of ``places``."""
    i, j = places(a, b, percent)
    return a.fp[i], b.fp[j]


def places(a: Tree, b: Tree, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Places of member pairs of two trees (or one tree twice) that may reach the threshold and are not linked."""
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def pruned(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        (sa, loa, hia, ra, ea, ca, ua), (sb, lob, hib, rb, eb, cb, ub) = a.levels[la], b.levels[lb]
        keep = (100 * hia[i] >= percent * lob[j]) & (100 * hib[j] >= percent * loa[i]) & ~(ua[i] & ub[j] & (ca[i] == cb[j]))
        if a is b:
            keep &= (i < j) if la == 0 and lb == 0 else (i <= j)
        keep &= (100 + percent) * np.minimum(ra[i], rb[j]) >= percent * (loa[i] + lob[j])
        i, j = i[keep], j[keep]
        common_bits = np.bitwise_count(sa[i] & sb[j]).sum(1).astype(np.int64)
        overlap = common_bits + np.minimum(ea[i], eb[j])
        fits = (100 + percent) * overlap >= percent * (loa[i] + lob[j])
        return i[fits], j[fits]

    # both trees stand at levels of equal height as far as they can; the frontier is cut into slices
    todo = [(la, lb, i, j)]
    while todo:
        la, lb, i, j = todo.pop()
        if len(i) > 1 << 14:
            half = len(i) // 2
            todo += [(la, lb, i[:half], j[:half]), (la, lb, i[half:], j[half:])]
            continue
        i, j = pruned(i, j)
        if not len(i):
            continue
        if la == 0 and lb == 0:
            pa_, pb = a.past[i], b.past[j]
            met = ((pa_[:, :, None] == pb[:, None, :]) & (pa_ != 0)[:, :, None]).any((1, 2))
            found.append((i[~met], j[~met]))
            continue
        down_a, down_b = la > 0 and la >= lb, lb > 0 and lb >= la

        def spread(tree: Tree, level: int, at: np.ndarray) -> tuple[np.ndarray, int]:
            fan = LEAF if level == 1 else FAN
            return at[:, None] * fan + np.arange(fan), len(tree.levels[level - 1][1])

        ii, na = spread(a, la, i) if down_a else (i[:, None], len(a.levels[la][1]))
        jj, nb = spread(b, lb, j) if down_b else (j[:, None], len(b.levels[lb][1]))
        ii, jj = np.repeat(ii, jj.shape[1], axis=1).ravel(), np.tile(jj, (1, ii.shape[1])).ravel()
        inside = (ii < na) & (jj < nb)
        todo.append((la - down_a, lb - down_b, ii[inside], jj[inside]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _member_bytes(fp, n, comp, rest, past, sig) -> bytes:
    """Rows of 64-bit numbers: the four, the shingles before (0 where there is none), the bitmap."""
    return np.concatenate([np.stack([fp, n, comp, rest], 1), past, sig.view(np.int64).reshape(len(fp), BITS // 64)], axis=1).tobytes()


def _tree(raw: bytes) -> Tree:
    rows = np.frombuffer(raw, np.int64).reshape(-1, 4 + PAST + BITS // 64)
    fp, n, comp, rest = (np.ascontiguousarray(rows[:, c]) for c in range(4))
    return Tree(fp, n, comp, rest, rows[:, 4 : 4 + PAST], np.ascontiguousarray(rows[:, 4 + PAST :]).view(np.uint64))


_UNIT = ["key", "part", "chunk", "part2", "chunk2"]
_WALKED = pa.schema([*[(c, pa.int64()) for c in (*_UNIT, "lo", "hi")], ("members", pa.binary()), ("fps", pa.list_(pa.int64())), ("comps", pa.list_(pa.int64())), ("pairs", pa.binary())])
_WALKED_DDL = "key bigint, part bigint, chunk bigint, part2 bigint, chunk2 bigint, lo bigint, hi bigint, members binary, fps array<bigint>, comps array<bigint>, pairs binary"


def _unit(name: tuple, a: Tree, b: Tree, percent: int) -> list[dict]:
    """The walk of two trees (or one twice) as one row: members that some pair needs, their components, and pairs of their places."""
    i, j = places(a, b, percent)
    if not len(i):
        return []
    fp, comp = (a.fp, a.levels[0][5]) if a is b else (np.concatenate([a.fp, b.fp]), np.concatenate([a.levels[0][5], b.levels[0][5]]))
    used, at = np.unique(np.concatenate([i, j if a is b else j + len(a.fp)]), return_inverse=True)
    ends = at.reshape(2, -1).T.astype(np.uint32)
    return [dict(zip(_UNIT, name)) | {"fps": fp[used].tolist(), "comps": comp[used].tolist(), "pairs": ends.tobytes()}]


def _grouped(percent: int, chunk: int):
    """From (key, part, n, comp, fp, rest, past, sig) sorted by key, part and size: a row of pairs within each tree, and the trees of groups that have several.

    Part 0 is a whole group, others are parts of one; a part beyond ``chunk`` members gives several trees.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, made = None, [], 0

        def closed(more: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            if held:
                n, comp, fp, rest, past, sig = zip(*held, strict=True)
                raw = _member_bytes(np.array(fp, np.int64), np.array(n, np.int64), np.array(comp, np.int64), np.array(rest, np.int64), np.array(past, np.int64).reshape(len(past), PAST), np.frombuffer(b"".join(sig), np.uint8).reshape(len(sig), -1))
                tree = _tree(raw)
                rows = _unit((*at, made, at[1], made), tree, tree, percent)
                if more or made or at[1]:
                    rows.append({"key": at[0], "part": at[1], "chunk": made, "lo": min(n), "hi": max(n), "members": raw})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _WALKED)
            held, made = [], made + 1 if more else 0

        for b in batches:
            for k, part, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (k, part) != at or len(held) == chunk:
                    yield from closed((k, part) == at)
                    at = k, part
                held.append(row)
        yield from closed(False)

    return run


def _across(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, *name in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows := _unit(tuple(name), _tree(x), _tree(y), percent):
                    yield pa.RecordBatch.from_pylist(rows, _WALKED)

    return run


def _spanning(percent: int):
    """From the rows of units, each its pairs (place -1) and then its members' exact sets by place: links that join components.

    A pair is only verified while its components are apart, so a unit gives fewer links than it has members.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(comps: list[int], pairs: bytes, sets: list[list[np.ndarray]]) -> list[tuple[int, int]]:
        up = {c: c for c in comps}

        def root(c: int) -> int:
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        def near(x: np.ndarray, y: np.ndarray) -> bool:
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                return False
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both)

        out = []
        for i, j in np.frombuffer(pairs, np.uint32).reshape(-1, 2).tolist():
            p, q = root(comps[i]), root(comps[j])
            if p != q and any(near(x, y) for x in sets[i] for y in sets[j]):
                up[p] = q
                out.append((comps[i], comps[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sets = None, []

        def closed() -> Iterator[pa.RecordBatch]:
            if head and (found := links(*head, sets)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

        for b in batches:
            place, comps, pairs, own = b.columns
            ends, hashes = own.offsets.to_numpy(), own.values.to_numpy(zero_copy_only=False)
            for k, at in enumerate(place.to_pylist()):
                if at < 0:
                    yield from closed()
                    head = comps[k].as_py(), pairs[k].as_py()
                    sets = [[] for _ in head[0]]
                else:
                    sets[at].append(hashes[ends[k] : ends[k + 1]].copy())
        yield from closed()

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes in links (a, b), ``comp`` the smallest node; by alternating star contraction."""
    edges = common.stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        before, edges = edges, common.stored(small.distinct(), "links")
        common.dropped(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _labelled(df: DataFrame, labels: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the component of ``col`` as ``out``; a class without links is its own."""
    side = labels.select(F.col("node").alias(col), F.col("comp").alias("_label"))
    return df.join(side, col, "left").withColumn(out, F.coalesce("_label", col)).drop("_label")


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, dk, n_shingles, component_id) per document; ``dk`` hashes the row's id and text.

    ``component_id`` is the smallest id among all documents reachable by links. Null or wordless texts
    have no shingles and no links; a null id is reachable, but names a component only if no other id is
    there. Repeated rows are copies. An empty table gives no rows. Inner tables are removed as soon as all
    that reads them is written. Cost does not depend on how often a
    text is copied beyond one row per copy.
    """
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text)).alias("dk"), F.col(text).alias("text"))
    described = common.stored(whole.mapInArrow(_described(percent, width), "doc_id bigint, dk bigint, n bigint, counted bigint, fp bigint, fp2 bigint, keys array<bigint>"), "described")
    members = common.stored(described.select("doc_id", "dk", "n", "fp", "fp2"), "members")
    # every class once; a first hash that two classes share only adds candidates, which are verified
    classes = common.stored(described.where("n > 0").groupBy("fp", "fp2").agg(F.min("doc_id").alias("first_id"), F.min("dk").alias("dk"), F.min("n").alias("n"), F.min("counted").alias("counted")), "classes")

    keyed = described.select("fp", F.explode("keys").alias("key")).select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    shared = common.stored(keyed.mapInArrow(_shared, "key bigint, fp bigint, df bigint"), "shared")
    common.dropped(described)
    counted = shared.where("fp IS NOT NULL").select("key", "fp").join(shared.where("fp IS NULL").select("key", "df"), "key")
    quarter = F.col("key").bitwiseAND(F.lit(3)) == 0
    per_class = Window.partitionBy("fp", "fp2")
    # beyond the quarter in the order by which _first chose them, unsigned; another one would understate "rest"
    place = F.row_number().over(per_class.orderBy(~quarter, F.when(quarter, F.col("df")), F.col("key") < 0, "key"))
    alone = F.col("counted") - F.sum(F.when(quarter, 1).otherwise(0)).over(per_class)
    # what a class has from a shingle on, itself included; beyond the quarter this is an upper bound
    prefix = counted.join(classes.select("fp", "fp2", "n", "counted"), "fp").withColumn("_place", place).withColumn("_alone", alone)
    prefix = prefix.withColumn("rest", F.col("n") - F.col("_alone") - F.col("_place") + 1)
    prefix = prefix.where(~quarter | (F.col("rest") * 100 >= F.col("n") * percent))
    in_order = per_class.orderBy("_place")
    past = F.array(*[F.coalesce(F.lag("key", i).over(in_order), F.lit(0).cast("long")) for i in range(1, PAST + 1)])
    prefix = common.stored(prefix.withColumn("past", past).select("key", "fp", "n", "rest", "past"), "prefix")
    common.dropped(shared)
    # of two sizes, the smaller one's rest must reach the overlap of two sets of its size
    small = F.col("rest") * (100 + percent) >= F.col("n") * (2 * percent)
    # groups of one cluster mostly have the same members: they choose among ANCHORS anchors, not each its own
    chance = F.xxhash64("fp", F.pmod(F.xxhash64("key"), F.lit(ANCHORS)))
    anchors = prefix.groupBy("key").agg(F.min_by(F.struct("fp", "n"), F.struct(chance, "fp")).alias("anchor"), F.count("*").alias("size"), F.min(F.when(small, F.col("n"))).alias("least"), F.min(F.col("past")[0]).alias("lo"), F.max(F.col("past")[0]).alias("hi"))
    anchors = anchors.where("size > 1 AND least IS NOT NULL AND (lo <> hi OR lo = 0)").drop("lo", "hi")
    partner = F.greatest(F.col("least") * 100, F.col("n") * percent)
    met = prefix.join(anchors, "key").where(F.col("rest") * ((100 + percent) * 100) >= (F.col("n") * 100 + partner) * percent)
    met = common.stored(met.select("key", "fp", "n", "rest", "past", F.col("anchor.fp").alias("anchor"), F.col("anchor.n").alias("anchor_n")), "groups")
    common.dropped(prefix)

    # exact sets and bitmaps of the classes that meet others, from one text each
    needed = common.stored(met.select("fp").distinct().join(classes.select("fp", "dk"), "fp").select("dk").distinct(), "needed")
    some = whole.join(common.lookup(needed, most_rows=200_000), "dk", "left_semi").select("text")
    sets = common.stored(some.mapInArrow(_sets(width), "fp bigint, fp2 bigint, set array<bigint>, sig binary").dropDuplicates(["fp", "fp2"]).select("fp", "set", "sig"), "sets")
    common.dropped(needed)

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("fp").alias("a"), F.col("set").alias("set_a")), "a").join(sets.select(F.col("fp").alias("b"), F.col("set").alias("set_b")), "b")
        one = F.size(F.array_intersect("set_a", "set_b"))
        return both.withColumn("_both", one).where(F.col("_both") * 100 >= (F.size("set_a") + F.size("set_b") - F.col("_both")) * percent).select("a", "b")

    fits = lambda x, y: (F.least(x, y) * 100 >= F.greatest(x, y) * percent)
    wave = met.where((F.col("fp") != F.col("anchor")) & fits(F.col("n"), F.col("anchor_n"))).select(F.least("fp", "anchor").alias("a"), F.greatest("fp", "anchor").alias("b")).distinct()
    first = common.stored(components(verified(wave)), "labels")

    # groups whose members are not all linked yet
    open_rows = _labelled(met.select("key", "fp", "n", "rest", "past"), first, "fp", "comp")
    open_rows = open_rows.withColumn("step", F.floor(F.log2("n")))
    sizes = open_rows.groupBy("key", "step").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    unlinked = sizes.groupBy("key").agg(F.sum("size").alias("size"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list(F.struct("step", F.ceil(F.col("size") / chunk).alias("slices"))).alias("steps"))
    unlinked = common.stored(unlinked.where("lo <> hi").select("key", "size", "steps"), "unlinked")
    large = unlinked.where(F.col("size") > chunk).select("key", F.explode("steps").alias("s")).select("key", "s.step", "s.slices")
    part = lambda step, cut: F.shiftleft(step, 40) + cut + 1
    parts = large.select("key", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("cut")).select("key", part(F.col("step"), F.col("cut")).alias("part"))
    whole_groups = unlinked.where(F.col("size") <= chunk).select("key", F.lit(0).cast("long").alias("part"))
    dealt = open_rows.join(common.lookup(large), ["key", "step"], "left").withColumn("part", F.coalesce(part(F.col("step"), F.pmod(F.xxhash64("fp"), F.col("slices"))), F.lit(0).cast("long")))
    rows = dealt.join(whole_groups.unionByName(parts), ["key", "part"], "left_semi").select("key", "part", "n", "comp", "fp", "rest", "past").join(sets.select("fp", "sig"), "fp")
    rows = rows.select("key", "part", "n", "comp", "fp", "rest", "past", "sig").repartition("key", "part").sortWithinPartitions("key", "part", "n", "comp", "fp")
    own = common.stored(rows.mapInArrow(_grouped(percent, chunk), _WALKED_DDL), "trees")
    common.dropped(met, unlinked)
    trees = own.where("members IS NOT NULL").withColumn("tree", F.struct("key", "part", "chunk"))
    # pairs of trees by name first; their members join them by tree, so a group's pairs are spread over the tasks
    named = trees.select("key", "tree", "lo", "hi")
    fitting = named.alias("x").join(named.alias("y"), "key").where("x.tree < y.tree").where((F.col("x.hi") * 100 >= F.col("y.lo") * percent) & (F.col("y.hi") * 100 >= F.col("x.lo") * percent))
    fitting = fitting.select(F.col("x.tree").alias("tree"), F.col("y.tree").alias("tree2"))
    across = fitting.join(trees.select("tree", "members"), "tree").join(trees.select(F.col("tree").alias("tree2"), F.col("members").alias("members2")), "tree2")
    across = across.select("members", "members2", "tree.key", "tree.part", "tree.chunk", F.col("tree2.part").alias("part2"), F.col("tree2.chunk").alias("chunk2"))
    kept = [*_UNIT, "fps", "comps", "pairs"]
    units = common.stored(own.where("pairs IS NOT NULL").select(*kept).unionByName(across.mapInArrow(_across(percent), _WALKED_DDL).select(*kept)), "units")
    # a unit fetches each of its members' sets once, however many pairs they are in
    asked = units.select(*_UNIT, F.posexplode("fps").alias("place", "fp")).join(sets.select("fp", "set"), "fp")
    asked = asked.select(*_UNIT, "place", F.lit(None).cast("array<bigint>").alias("comps"), F.lit(None).cast("binary").alias("pairs"), "set")
    heads = units.select(*_UNIT, F.lit(-1).alias("place"), "comps", "pairs", F.lit(None).cast("array<bigint>").alias("set"))
    ordered = heads.unionByName(asked).repartition(*_UNIT).sortWithinPartitions(*_UNIT, "place").select("place", "comps", "pairs", "set")
    walked = common.stored(ordered.mapInArrow(_spanning(percent), "a bigint, b bigint"), "walked")
    common.dropped(own, units, sets)
    second = components(walked)
    common.dropped(walked)

    comps = _labelled(_labelled(classes.select("fp", "fp2", "first_id"), first, "fp", "c1"), second, "c1", "c2")
    named = comps.groupBy("c2").agg(F.min("first_id").alias("component_id"))
    table = comps.join(named, "c2").select("fp", "fp2", "component_id")
    out = members.join(table, ["fp", "fp2"], "left")
    return out.select("doc_id", "dk", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known = _Hashes()
        for b in batches:
            found = [shingles(t, known, width) for t in b.column(0).to_pylist()]
            fps = [pa.array([np.array([xxhash.xxh64_intdigest(h.tobytes(), seed)], np.uint64).view(np.int64)[0] for h in found], pa.int64()) for seed in (1, 2)]
            yield pa.RecordBatch.from_arrays([*fps, pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())), pa.array(map(_signature, found), pa.binary())], ["fp", "fp2", "set", "sig"])

    return run


def one_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, then by a hash of its text.

    Documents without words stay. Of wholly repeated rows one stays.
    """
    found = common.stored(join(docs, id_col, text, **options).where("n_shingles > 0"), "joined")
    order = F.struct(F.isnull("doc_id").alias("last"), F.col("doc_id"), F.col("dk"))
    # the component of rows without any id is named null; the hash of the row stands for it
    best = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("dk")).alias("own")).agg(F.min(order).alias("best"))
    keep = best.select(F.col("best.dk").alias("dk"), F.lit(True).alias("_keep"))
    gone = common.lookup(common.stored(found.join(keep, "dk", "left").where("_keep IS NULL").select("dk").distinct(), "copies"), most_rows=200_000)
    again = common.stored(found.groupBy("dk").count().where("count > 1").select("dk"), "repeated")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(id_col), F.col(text)).alias("dk"))
    left = row.join(gone, "dk", "left_anti")
    if again.isEmpty():
        return left.select("row.*")
    once = left.join(common.lookup(again, most_rows=200_000), "dk", "left_semi").dropDuplicates(["dk"])
    return left.join(common.lookup(again, most_rows=200_000), "dk", "left_anti").unionByName(once).select("row.*")
