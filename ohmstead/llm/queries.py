"""One query per operator, over whole tables, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmstead.llm import bitpack, chat, common, html, jaccard, lexical, mix, pack, pii, rules, secrets, shards, spans, stripes, topk
from ohmstead.plans.registry import Catalogue

CAT = Catalogue()
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@CAT.query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = pack.cut(table(spark, sf, "documents"), public_tokenizers.path(WORD_TOKENIZER), "words")
    return pack.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@CAT.query("op2_exact_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(x.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
""")
def exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@CAT.query("op3_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS hits FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * hits >= 80 * (nx.n + ny.n - hits)),
r AS (SELECT x AS doc_id, x AS reach FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reach)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.reach), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
""")
def ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@CAT.query("op4_host_rules", r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
h AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(8)) AS k FROM h) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, source, len(w) AS n_words, len(t) - len(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (
  SELECT *, NOT base_failed AND (100 * n_symbols > 10 * n_words OR (n_dup_lines >= 3 AND 100 * n_repeat_words > 10 * n_words) OR word_chars > 14 * n_words OR word_chars < 2 * n_words) AS soft
  FROM b),
c AS (SELECT source, count(*) AS n, sum(CAST(base_failed OR soft AS INT)) AS k FROM f GROUP BY source),
a AS (SELECT sum(k) / sum(n) AS m, avg(n) AS kk, greatest(0, avg((k / n) * (k / n)) - avg(k / n) * avg(k / n)) AS v FROM c),
p AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE kk END AS s FROM a),
bad AS (SELECT source, (k + m * s) / (n + s) > 0.5 AS bad FROM c, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (soft AND bad) AS kept
FROM f JOIN bad ON bad.source IS NOT DISTINCT FROM f.source
""")
def host_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return rules.judge(docs, columns=["doc_id"]).select("row.doc_id", *rules.MEASURES, "base_failed", "kept")


@CAT.query("op5_pii")
def personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.detect(table(spark, sf, "documents"), columns=["doc_id"])
    base, every = (F.concat(*[F.col(k) for k in kinds]) for kinds in (pii.BASE, pii.BASE + pii.ADDED))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("row.doc_id", *counts, F.sha2(spans.written(base), 256).alias("base_sha256"), spans.written(every).alias("spans"))


@CAT.query("op6_token_bit_packing")
def token_bit_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_TOKENIZER)
    manifest = bitpack.write(table(spark, sf, "documents"), common.new_path(spark, "token-shards"), path, bitpack.vocabulary_size(path), "spaced")
    return bitpack.read(manifest)


@CAT.query("op7_html_extraction")
def html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(table(spark, sf, "pages")).select("page_id", "text")


@CAT.query("op8_secret_scan")
def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents"), columns=["doc_id"])
    base = [r.kind for r in secrets.BASE]
    every = [r.kind for r in secrets.RULES]
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    text = lambda kinds: spans.written(spans.by_start(F.concat(*[F.col(k) for k in kinds]), kinds))
    return found.select("row.doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(every).alias("spans"))


#: A conversation whose texts look like template marks.
PROBE = "\\### Assistant: </turn> ok"


@CAT.query("op9_chat_formatting")
def chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    parts = common.stored(chat.format_logs(chat.from_turns(turns.unionByName(probe))), "formatted")
    return chat.digests(parts)


@CAT.query("op10_source_mixing", r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13) AS BIGINT) / 4503599627370496.0 AS chance
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM s WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, source COLLATE "C" NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(source_size * 2.0::DOUBLE, w * greatest(max(level) OVER (), 0)) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target, CAST(floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) * size AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""".replace(' COLLATE "C"', ""))
def source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix.mix(table(spark, sf, "documents"), carry=False).select("doc_id", "size", "source_size", "target", "taken")


def _crc_table() -> str:
    """The byte table of CRC-32 as an SQL list, from its polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return f"{table}::BIGINT[]"


@CAT.query("op11_sharding", r"""
WITH RECURSIVE b AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text|' || coalesce(text, ''))), 1, 15) AS UHUGEINT) AS key,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents),
d AS (
  SELECT doc_id, key, CAST(strlen(t) + 1 AS BIGINT) AS size,
    CAST(xor(list_reduce(bytes, lambda c, x: xor(c >> 8, (CRC)[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS BIGINT) AS text_crc32
  FROM b),
-- a jump goes on while it lands below the number of shards; the last place it held is the shard
k AS (SELECT DISTINCT key, n FROM d, (VALUES (16), (17)) v(n)),
j AS (
  SELECT key, n, key AS state, 0::BIGINT AS shard, 0::BIGINT AS ahead FROM k
  UNION ALL
  SELECT key, n, s, ahead, CAST(floor((ahead + 1) * (2147483648.0::DOUBLE / (CAST(s // 8589934592 AS DOUBLE) + 1))) AS BIGINT)
  FROM (SELECT key, n, ahead, (state * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS s FROM j WHERE ahead < n)),
f AS (SELECT key, n, max(shard) AS shard FROM j GROUP BY ALL)
SELECT d.doc_id, d.size, d.text_crc32, 'key' AS law, CAST(a.shard AS INT) AS shard, CAST(b.shard AS INT) AS grown_shard,
  row_number() OVER (PARTITION BY a.shard ORDER BY d.doc_id NULLS FIRST, d.text_crc32, d.size) - 1 AS slot
FROM d JOIN f a ON a.key = d.key AND a.n = 16 JOIN f b ON b.key = d.key AND b.n = 17
""".replace("CRC", _crc_table(), 1))
def sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shards.assign(table(spark, sf, "documents"), 16)


@CAT.query("op12_collocations", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 5) t(size))),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
two AS MATERIALIZED (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:size], ' ') AS rest FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
one AS MATERIALIZED (SELECT two.*, f.f AS l FROM two JOIN f ON f.lang = two.lang AND f.phrase = two.first),
cut AS (SELECT one.*, f.f AS r, CAST((2000000::HUGEINT * a) // (l + f.f) AS BIGINT) AS score FROM one JOIN f ON f.lang = one.lang AND f.phrase = one.rest),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (SELECT lang, w, a, size, unnest(range(2, size)) AS n FROM c WHERE size > 2),
inner_ AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest(range(1, size - n + 2)) AS i FROM part) GROUP BY ALL),
kept AS (
  SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang)
SELECT lang, CAST(row_number() OVER o AS BIGINT) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
""")
def collocations(spark: SparkSession, sf: str) -> DataFrame:
    found = stripes.best(stripes.mine(table(spark, sf, "documents")), 2000)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


@CAT.query("op13_lexical_search", r"""
WITH t AS (
  SELECT doc_id, rid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents)),
c AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM t WHERE len(w) > 0),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM t) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
v AS (
  SELECT rid, doc_id, tf.term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nn) // ll)))) AS value
  FROM tf JOIN df ON df.term = tf.term, c WHERE tf.term IN (SELECT term FROM q)),
s AS (SELECT item_id, rid, doc_id, CAST(sum(times * value) AS BIGINT) AS score FROM q JOIN v ON v.term = q.term GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER o AS INT) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER o <= 20
""")
def lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 20)
