"""Sharding, phrases and lexical search against plain restatements, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohmstead.llm import lexical, shards, stripes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, slot string, item_id string, n string, phrase string, prefix string, score string"
LONG = ("a lot of words, and more " * 30_000) + "x" * 300_000 + " end"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, None, "en"), (2, "", "en"), (3, " \t\n.,", None), (4, LONG, "en"), (5, "Same words here, same words here", "fr"), (5, "Same words here, same words here", "fr"),
             (None, "no id at all", None), (None, None, None), (6, "émile ☕ 日本語 \x00 a\x1cb ÄB", "und"), (7, "a  b   c\n\n\nd", "")]
    return spark.createDataFrame([(i, t, lang, None, 1, *["c"] * 7) for i, t, lang in texts], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ---- sharding ------------------------------------------------------------------------------


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump():
    keys = np.array([0, 1, 2**64 - 1, *map(random.Random(2).getrandbits, [64] * 500)], np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert shards.jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    assert len(shards.jump(np.empty(0, np.uint64), 4)) == 0
    many = np.arange(40_000, dtype=np.uint64)
    old, new = shards.jump(many, 16), shards.jump(many, 20)
    assert set(new[old != new]) <= {16, 17, 18, 19} and abs((old != new).mean() - 0.2) < 0.02
    assert np.bincount(old).min() > 2200 and np.bincount(old).max() < 2800
    with pytest.raises(ValueError):
        shards.jump(keys, 0)


def test_assign(odd, none):
    assert shards.assign(none).count() == 0
    got = shards.assign(odd, 3).collect()
    assert len(got) == 10
    sizes = defaultdict(list)
    for r in got:
        sizes[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 3) and r.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in sizes.values())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by[1].size, by[1].text_crc32) == (1, 0) and by[4].size == len(LONG) + 1 and by[4].text_crc32 == zlib.crc32(LONG.encode())
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    assert {(r.doc_id, r.shard, r.slot) for r in shards.assign(odd.repartition(5), 3).collect()} == {(r.doc_id, r.shard, r.slot) for r in got}


def test_places_of_a_hot_id(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = shards.assign(rows, 4)
    for r in got.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect():
        assert r.s == list(range(len(r.s)))
    assert shards.moved(got).where("grown_shard <> 4").count() == 0


def test_written_shards(spark, odd, none, tmp_path):
    docs = odd.drop("shard", "slot")
    got = {r.shard: (r.n_docs, r.n_bytes) for r in shards.write(docs, str(tmp_path / "a"), 3, file_rows=1).collect()}
    want = defaultdict(lambda: [0, 0])
    for r in shards.assign(odd, 3).collect():
        want[r.shard][0] += 1
        want[r.shard][1] += r.size
    assert got == {k: tuple(v) for k, v in want.items()}
    back = spark.read.parquet(str(tmp_path / "a"))
    assert sorted(back.columns) == sorted([*docs.columns, "_shard"]) and back.drop("_shard").exceptAll(docs.select(back.drop("_shard").columns)).count() == 0
    with pytest.raises(ValueError):
        shards.write(odd.withColumnRenamed("n", "_shard"), str(tmp_path / "b"))


# ---- phrases -------------------------------------------------------------------------------


def plain_phrases(rows, longest, least, covered=80):
    f = defaultdict(Counter)
    for text, lang in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    out = set()
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        cand = {p: c for p, c in own.items() if len(p) > 1 and c >= least}
        longer = Counter()
        for p, c in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], c)
        for p, a in cand.items():
            if 100 * longer[p] < covered * a:
                score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                out.add((lang, " ".join(p), a, left, right, n, score))
    return out


def mined(df, **options):
    return {tuple(r) for r in stripes.mine(df, **options).select("lang", "phrase", "a", "l", "r", "n", "score").collect()}


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["Ä", "B"]
    return [(" ".join(rng.choice(words) if rng.random() < 0.7 else "new york city. hall" for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "fr", "und"])) for _ in range(150)]


@pytest.mark.parametrize("block,part,bits,slices", [(6 << 20, 1 << 20, 1 << 16, 1024), (50, 8, 64, 4)])
def test_mine(spark, prose, monkeypatch, block, part, bits, slices):
    """The same for small blocks, hashes of few bytes at a time, a bitmap that is full, and few slices."""
    for name, value in (("BLOCK", block), ("PART", part), ("LEAST_BITS", bits), ("MOST_BITS", bits), ("SLICES", slices)):
        monkeypatch.setattr(stripes, name, value)
    df = spark.createDataFrame(prose, "text string, lang string").repartition(3)
    assert mined(df, least=6) == plain_phrases(prose, 4, 6)
    assert mined(df, least=4, longest=3, covered_pct=50) == plain_phrases(prose, 3, 4, 50)


def test_words_are_told_apart_without_their_hashes():
    body = stripes.MARK.join([b"to be, or not to be", b"be\x00 b"]).translate(stripes._MAP)
    data = np.frombuffer(body, np.uint8)
    starts, ends, apart = stripes.words_in(data)
    words = [body[a:b] for a, b in zip(starts, ends)]
    assert words == [b"to", b"be", b"or", b"not", b"to", b"be", b"be\x00", b"b"] and np.flatnonzero(apart).tolist() == [2, 6]
    for hashes in (stripes.word_hashes("en", data, starts, ends), np.zeros(len(starts), np.uint64)):
        first, number = stripes.distinct(data, starts, ends, hashes)
        assert [words[first[n]] for n in number] == words and len(first) == 6


def test_mine_edges(odd, none):
    assert stripes.best(stripes.mine(none)).count() == 0
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert mined(odd, least=2) == plain_phrases(rows, 4, 2)


def test_score_is_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(big // 3, big), (big - 1, big), (1, big)], "a long, s long")
    assert [r[0] for r in df.select(stripes.score(F.col("a"), F.col("s"))).collect()] == [2_000_000 * a // s for a, s in ((big // 3, big), (big - 1, big), (1, big))]


def test_best(spark):
    rows = [("x", f"p{i:03d}", 30 + i % 3, 5 + i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, score long")
    got = [(r.rank, r.phrase) for r in stripes.best(df, 40).orderBy("rank").collect()]
    want = sorted(rows, key=lambda r: (-r[3], -r[2], r[1]))[:40]
    assert got == [(i + 1, r[1]) for i, r in enumerate(want)]


# ---- search --------------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, most):
    found = [(i, words_of(t)) for i, t in docs]
    some = [w for _, w in found if w]
    n_docs, n_terms = len(some), sum(map(len, some))
    df = Counter(t for w in some for t in set(w))
    asked = defaultdict(list)
    for i, t in items:
        asked[i] += words_of(t)
    out = []
    for item, terms in asked.items():
        scored = []
        for doc_id, w in found:
            tf = Counter(w)
            m = 75 + 25 * len(w) * n_docs // n_terms if n_terms else 75
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms if tf[t])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored)[:most])]
    return out


def ranked(docs, items, **options):
    key = lambda r: (str(r[0]), r[1])
    return sorted(map(tuple, lexical.search(docs, items, **options).collect()), key=key)


@pytest.mark.parametrize("block_items,cells", [(1024, 1 << 21), (3, 1)])
def test_search(spark, prose, monkeypatch, block_items, cells):
    """The same in blocks of few items, and for one document at a time."""
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block_items)
    monkeypatch.setattr(lexical, "CELLS", cells)
    docs = [(i // 2 if i % 5 else i, t) for i, (t, _) in enumerate(prose)] + [(9, "city hall"), (9, "city hall"), (8, None)]
    items = [(1, "New York, new!"), (2, "york hall w1 w2 w3"), (3, "w1 w2 w3 w4 w4"), (3, "hall"), (4, None), (5, "zebra"), (6, "w1 w2 w3 w4 w5 hall"), (7, "Ä ä Ä"), (None, "b w1 w2")]
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), most=7)
    assert got == sorted(plain_search(docs, items, 7), key=lambda r: (str(r[0]), r[1]))


def test_search_edges(spark, odd, none):
    items = spark.createDataFrame([("x", "words A émile 日本語"), ("y", "")], "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert ranked(odd, items) == sorted(plain_search(rows, [tuple(r) for r in items.collect()], 20), key=lambda r: (str(r[0]), r[1]))
    assert lexical.search(none, items).count() == 0 and lexical.search(odd, items.limit(0)).count() == 0


def test_plan_shares_sums():
    items = {i: [f"t{k}".encode() for k in range(20)] + [f"own{i}".encode()] + [b"twice"] * (1 + i % 2) for i in range(50)}
    p = lexical.plan(items)
    # twenty shared terms are one operand, and no item adds more than it and a few others
    assert p.n_operands == 1 + 50 + 1 and len(p.parts) <= 150
    sums = np.zeros((p.n_sums, 1), np.int64)
    for term, number in p.vocabulary.items():
        sums[p.operand[number]] += zlib.crc32(term)
    at = p.n_operands
    for left, right in p.rounds:
        sums[at : at + len(left)] = sums[left] + sums[right]
        at += len(left)
    got = np.add.reduceat(sums[p.parts] * p.times[:, None], p.starts, axis=0)[:, 0]
    assert got.tolist() == [sum(map(zlib.crc32, terms)) for terms in items.values()]
