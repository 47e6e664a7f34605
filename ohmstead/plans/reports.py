"""Queries over pages, notes and past reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmstead.functions import text as tx
from ohmstead.operators import pages as pg
from ohmstead.operators import reports as rp
from ohmstead.operators import routing as rt
from ohmstead.operators.keyed import sealed
from ohmstead.plans.base_sql import with_
from ohmstead.plans.registry import Catalogue
from ohmstead.sources import pages as src
from ohmstead.sources import tables as t

CAT = Catalogue()
query = CAT.query


def q(s: str) -> str:
    """SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def sql_any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {q(w)})" for w in words) + ")" if words else "false"


def sql_start(expr: str, words) -> str:
    return "(" + " OR ".join(f"starts_with({expr}, {q(w)})" for w in words) + ")"


def sql_norm(e: str) -> str:
    return f"trim(regexp_replace(lower({e}), '\\s+', ' ', 'g'))"


def sql_fold(e: str, plus: bool = False) -> str:
    keep = "+-" if plus else "-"
    return f"trim(regexp_replace(regexp_replace(translate(lower({e}), '{tx.FOLD_FROM}', '{tx.FOLD_TO}'), '[^a-z0-9\\s{keep}]', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_plain(e: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({e})), '\\s+', ' ', 'g'))"


def sql_tokens(e: str, plus: bool = False) -> str:
    return f"list_distinct(list_filter(string_split({sql_fold(e, plus)}, ' '), lambda x: x <> ''))"


def sql_strip_md(e: str) -> str:
    return (f"trim(replace(regexp_replace(regexp_replace(regexp_replace({e}, '\\*\\*(.*?)\\*\\*', '\\1', 'g'), '\\*(.*?)\\*', '\\1', 'g'), "
            f"'(?m)^\\s*#+\\s*', '', 'g'), '•', '-'), ' ' || chr(10))")


def sql_tidy(e: str) -> str:
    return f"trim(regexp_replace({e}, '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"


LINES = """ln AS (SELECT doc_id, source, lang, UNNEST(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)"""

BLK = LINES + """,
mdk AS (SELECT doc_id, lang, source, pos, CASE WHEN trim(line) = '' THEN [''] WHEN k = 0 THEN ['## ' || line] WHEN k = 3 THEN ['[[AUDIO RECORDING]] [Play](audio/' || doc_id || '_' || pos || '.mp3)', line]
   WHEN k = 5 THEN ['![](img/' || doc_id || '_' || pos || '.png)', line] WHEN k = 6 THEN ['[[IMAGE OCR]] ' || line] WHEN k = 7 THEN ['Légende: ' || line] ELSE [line] END AS ls FROM (SELECT *, (pos - 1) % 8 AS k FROM ln)),
mdu AS (SELECT doc_id, lang, source, pos, UNNEST(ls) AS l, generate_subscripts(ls, 1) AS part FROM mdk),
mdl AS (SELECT doc_id, lang, source, l, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos, part) AS pos FROM mdu),
ty AS (SELECT *, CASE WHEN regexp_matches(rtrim(l), '^(#{1,6})\\s+(.*)$') THEN 'heading' WHEN regexp_matches(l, '\\[\\[AUDIO RECORDING\\]\\]\\s*\\[Play\\]\\(([^)]+)\\)') THEN 'audio'
   WHEN regexp_matches(l, '!\\[\\]\\(([^)]+)\\)') THEN 'image' WHEN regexp_matches(l, '\\[?\\[IMAGE OCR\\]\\]?\\s*(.*)$') THEN 'image_ocr' ELSE 'paragraph' END AS t0 FROM mdl WHERE trim(l) <> ''),
nb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos) AS rn FROM ty),
li AS (SELECT *, MAX(CASE WHEN t0 = 'image' THEN rn END) OVER (PARTITION BY doc_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS im FROM nb),
blk AS (SELECT CAST(doc_id AS VARCHAR) AS page_id, doc_id, 'Note ' || doc_id AS title, lang AS notebook, source AS section, rn, 'b' || lpad(CAST(rn AS VARCHAR), 5, '0') AS block_id,
   CASE WHEN t0 = 'image_ocr' AND im IS NULL THEN 'paragraph' ELSE t0 END AS type,
   CASE WHEN t0 = 'heading' THEN trim(regexp_extract(rtrim(l), '^(#{1,6})\\s+(.*)$', 2)) WHEN t0 = 'image_ocr' AND im IS NOT NULL THEN trim(regexp_extract(l, '\\[?\\[IMAGE OCR\\]\\]?\\s*(.*)$', 1)) WHEN t0 IN ('paragraph', 'image_ocr') THEN trim(l) END AS text,
   CASE WHEN t0 = 'audio' THEN regexp_extract(l, '\\[Play\\]\\(([^)]+)\\)', 1) WHEN t0 = 'image' THEN regexp_extract(l, '!\\[\\]\\(([^)]+)\\)', 1) END AS path,
   CASE WHEN t0 = 'audio' AND pos % 16 <> 12 THEN 'enregistrement ' || pos END AS transcript,
   CASE WHEN t0 = 'image_ocr' AND im IS NOT NULL THEN 'b' || lpad(CAST(im AS VARCHAR), 5, '0') END AS image_block_id,
   CASE WHEN t0 = 'heading' THEN CAST(length(regexp_extract(rtrim(l), '^(#{1,6})\\s+(.*)$', 1)) AS INTEGER) END AS level, CAST(pos AS INTEGER) AS source_line FROM li)"""

_CAP = sql_start("lower(text)", tx.CAPTION_PREFIXES)
PTXT = """mt AS (SELECT page_id, """ + sql_norm("ANY_VALUE(title) || chr(10) || string_agg(CASE WHEN type IN ('heading','paragraph','image_ocr') THEN COALESCE(text, '') WHEN type = 'audio' THEN COALESCE(transcript, '') END, chr(10) ORDER BY rn)") + """ AS mtext, ANY_VALUE(doc_id) AS doc_id, ANY_VALUE(section) AS section FROM blk GROUP BY page_id),
pt0 AS (SELECT page_id, """ + sql_tidy(f"COALESCE(string_agg(CASE WHEN text <> '' AND NOT {_CAP} THEN text WHEN (text IS NULL OR text = '') AND type = 'audio' AND transcript IS NOT NULL THEN 'Note vocale : ' || transcript END, chr(10) ORDER BY rn), '')") + """ AS p,
  trim(COALESCE(string_agg(CASE WHEN type = 'audio' THEN 'Note vocale : ' || COALESCE(transcript, '(enregistrement présent, transcription absente)') END, chr(10) ORDER BY rn), '')) AS v FROM blk GROUP BY page_id),
pt AS (SELECT page_id, CASE WHEN p = '' THEN v ELSE p END AS raw_text FROM pt0)"""


def _notes(s, sf) -> DataFrame:
    return src.note_pages(s, sf)


# ---- scans and blocks ----------------------------------------------------------------------


@query("markdown_blocks", with_(BLK) + "SELECT page_id, title, notebook, section, block_id, type, text, path, transcript, image_block_id, COALESCE(level, 0) AS level, source_line FROM blk")
def markdown_blocks(s, sf):
    x = _notes(s, sf).select("page_id", "title", "notebook", "section", F.explode("blocks").alias("b")).select("page_id", "title", "notebook", "section", "b.*")
    return x.withColumn("level", F.coalesce("level", F.lit(0)))


@query("html_blocks")
def html_blocks(s, sf):
    x = src.html_pages(t.texts(s, sf, "pages"))
    return x.select("page_id", F.explode("blocks").alias("b")).select("page_id", "b.block_id", "b.type", "b.text", "b.level")


@query("block_repeats", with_(LINES) + """
, w AS (SELECT doc_id, pos, length(line) % 3 AS kind, LAG(length(line) % 3) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM ln)
SELECT doc_id, string_agg(CAST(kind AS VARCHAR), '' ORDER BY pos) AS kinds FROM w WHERE prev IS DISTINCT FROM kind GROUP BY 1""")
def block_repeats(s, sf):
    kinds = F.transform(F.split("text", "\n"), lambda x: (F.length(x) % 3).cast("string"))
    return t.texts(s, sf, "documents").select("doc_id", F.array_join(src.without_repeats(kinds), "").alias("kinds"))


_SHOUT = "(starts_with(lower(l), 'sommaire') OR (length(l) > 6 AND upper(replace(l, 'ß', 'x')) = l AND lower(l) <> l))"
RBLK = LINES + ",\nrl0 AS (SELECT doc_id, source, pos, trim(regexp_replace(trim(regexp_replace(line, '[ \\t]{2,}', ' ', 'g')), 'Page\\s+\\d+\\s+sur\\s+\\d+', '', 'gi')) AS l FROM ln),\nrb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos) AS rn, CASE WHEN " + _SHOUT + " THEN 'heading' ELSE 'paragraph' END AS type FROM rl0 WHERE l <> '')"


def _report_docs(s, sf) -> DataFrame:
    d = t.texts(s, sf, "documents")
    return d.withColumn("blocks", rp.text_blocks("text", F.concat(F.lit("p"), F.lpad(F.pmod("doc_id", F.lit(9)).cast("string"), 3, "0"))))


@query("report_blocks", with_(RBLK) + "SELECT doc_id, COUNT(*) AS n_blocks, COUNT(CASE WHEN type = 'heading' THEN 1 END) AS n_headings, md5(string_agg(type || ':' || l, chr(10) ORDER BY rn)) AS digest FROM rb GROUP BY 1")
def report_blocks(s, sf):
    x = sealed(_report_docs(s, sf)).where(F.size("blocks") > 0)
    heads = F.filter("blocks", lambda b: b["type"] == "heading")
    joined = F.array_join(F.transform("blocks", lambda b: F.concat(b["type"], F.lit(":"), b["text"])), "\n")
    return x.select("doc_id", F.size("blocks").cast("long").alias("n_blocks"), F.size(heads).cast("long").alias("n_headings"), F.md5(joined).alias("digest"))


@query("needs_ocr", "SELECT doc_id, length(trim(regexp_replace(text, '[ \\t]{2,}', ' ', 'g'), ' ' || chr(10))) < 500 AS needs_ocr FROM documents")
def needs_ocr(s, sf):
    return t.texts(s, sf, "documents").select("doc_id", (F.length(tx.clean_text("text")) < 500).alias("needs_ocr"))


@query("manifest_pages", with_(BLK) + """
, m AS (SELECT CAST(doc_id * 3 AS VARCHAR) AS page_id, MIN(doc_id) AS seq FROM labels GROUP BY 1), n AS (SELECT page_id, COUNT(*) AS n, ANY_VALUE(title) AS title FROM blk GROUP BY 1)
SELECT m.page_id, COALESCE(title, m.page_id) AS title, COALESCE(n, 0) AS n_blocks FROM m LEFT JOIN n ON m.page_id = n.page_id""")
def manifest_pages(s, sf):
    m = t.table(s, sf, "labels").select((F.col("doc_id") * 3).alias("page_id"), F.col("doc_id").alias("seq"))
    x = src.from_manifest(m, _notes(s, sf).select("page_id", "title", "blocks"))
    return x.select("page_id", "title", F.size("blocks").cast("long").alias("n_blocks"))


@query("page_metadata", with_(BLK) + "SELECT page_id, ANY_VALUE(title) AS title, ANY_VALUE(section) AS section, COUNT(CASE WHEN type = 'image' THEN 1 END) AS n_images, COUNT(CASE WHEN type = 'audio' THEN 1 END) AS n_audio FROM blk GROUP BY 1")
def page_metadata(s, sf):
    return _notes(s, sf).select("page_id", "title", "section", F.size("images").cast("long").alias("n_images"), F.size("audio").cast("long").alias("n_audio"))


# ---- page text, bullets, pictures ----------------------------------------------------------


@query("page_matching_text", with_(BLK, PTXT) + "SELECT page_id, md5(mtext) AS digest, length(mtext) AS n FROM mt")
def page_matching_text(s, sf):
    x = _notes(s, sf).select("page_id", pg.matching_text().alias("m"))
    return x.select("page_id", F.md5("m").alias("digest"), F.length("m").cast("long").alias("n"))


@query("page_client_text", with_(BLK, PTXT) + "SELECT page_id, md5(raw_text) AS digest, length(raw_text) AS n FROM pt")
def page_client_text(s, sf):
    x = _notes(s, sf).select("page_id", pg.full_text().alias("m"))
    return x.select("page_id", F.md5("m").alias("digest"), F.length("m").cast("long").alias("n"))


_DIRTY_SQL = "dirty AS (SELECT doc_id, string_agg(CASE (pos - 1) % 8 WHEN 1 THEN '**' || line || '**' WHEN 2 THEN 'Preuve: ' || line WHEN 4 THEN 'Note vocale : ' || line WHEN 6 THEN 'Légende: ' || line WHEN 7 THEN '- ' || line ELSE line END, chr(10) ORDER BY pos) AS d FROM ln GROUP BY 1)"
_BODY_SQL = f"""bl AS (SELECT doc_id, UNNEST(string_split({sql_tidy(sql_strip_md("d"))}, chr(10))) AS x, generate_subscripts(string_split({sql_tidy(sql_strip_md("d"))}, chr(10)), 1) AS i FROM dirty),
bk AS (SELECT doc_id, i, CASE WHEN starts_with(lower(trim(x)), 'note vocale :') THEN nullif(trim(substr(trim(x), instr(trim(x), ':') + 1)), '') WHEN trim(x) = '' THEN ''
  WHEN contains(lower(x), 'page_id=') OR contains(lower(x), 'preuve:') OR {sql_start("lower(trim(x))", tx.CAPTION_PREFIXES)} THEN NULL ELSE x END AS y FROM bl),
body AS (SELECT doc_id, {sql_tidy("COALESCE(string_agg(y, chr(10) ORDER BY i), '')")} AS b FROM bk GROUP BY 1)"""


def _dirty(s, sf) -> DataFrame:
    def line(ln, i):
        k = i % 8
        return (F.when(k == 1, F.concat(F.lit("**"), ln, F.lit("**"))).when(k == 2, F.concat(F.lit("Preuve: "), ln)).when(k == 4, F.concat(F.lit("Note vocale : "), ln))
                .when(k == 6, F.concat(F.lit("Légende: "), ln)).when(k == 7, F.concat(F.lit("- "), ln)).otherwise(ln))

    return t.texts(s, sf, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), line), "\n").alias("d"))


@query("client_body", with_(LINES, _DIRTY_SQL, _BODY_SQL) + "SELECT doc_id, md5(b) AS digest, length(b) AS n FROM body")
def client_body(s, sf):
    x = _dirty(s, sf).select("doc_id", tx.client_body("d").alias("b"))
    return x.select("doc_id", F.md5("b").alias("digest"), F.length("b").cast("long").alias("n"))


_BUL_SQL = f"""bb AS (SELECT doc_id, list_filter(list_transform(string_split({sql_tidy(sql_strip_md("b"))}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM body),
bc AS (SELECT doc_id, list_transform(l, lambda x: CASE WHEN length(trim(regexp_replace(x, '^(?:- \\s*)+', ''))) > 190 THEN rtrim(substr(trim(regexp_replace(x, '^(?:- \\s*)+', '')), 1, 187)) || '…' ELSE trim(regexp_replace(x, '^(?:- \\s*)+', '')) END) AS l FROM bb),
bul AS (SELECT doc_id, array_to_string(list_transform(CASE WHEN len(l) > 10 THEN list_concat(l[1:9], ['…']) ELSE l END, lambda x: '- ' || x), chr(10)) AS bullets FROM bc)"""


@query("text_bullets", with_(LINES, _DIRTY_SQL, _BODY_SQL, _BUL_SQL) + "SELECT doc_id, COALESCE(bullets, '') AS bullets FROM bul")
def text_bullets(s, sf):
    return _dirty(s, sf).select("doc_id", tx.bullets("d").alias("bullets"))


@query("keyword_extraction", f"""
SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(u, range(1, len(u) + 1)), lambda z: list_position(u, z[1]) = z[2])[1:18], lambda z: z[1]), ' ') AS kw FROM (
 SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(lower('Note ' || text), '[^a-z0-9àâäéèêëîïôöùûüçœ\\s-]', ' ', 'g'), '\\s+'), lambda w: trim(w, '-')), lambda w: length(w) >= 3 AND NOT list_contains({sql_list(tx.STOP_WORDS)}, w)) AS u FROM documents)""")
def keyword_extraction(s, sf):
    return t.texts(s, sf, "documents").select("doc_id", F.array_join(tx.keywords(F.lit("Note"), F.col("text")), " ").alias("kw"))


_IMG = """ims AS (SELECT page_id, path, MIN(rn) AS rn, MIN(block_id) AS block_id FROM blk WHERE type = 'image' GROUP BY 1, 2),
nx AS (SELECT i.page_id, i.path, i.rn AS irn, b.rn, b.text, b.type, """ + _CAP.replace("text", "b.text") + """ AS cap FROM ims i JOIN blk b ON b.page_id = i.page_id AND b.rn BETWEEN i.rn + 1 AND i.rn + 3 WHERE trim(COALESCE(b.text, '')) <> ''),
fs AS (SELECT page_id, path, ARG_MIN(CASE WHEN cap THEN trim(substr(text, 9), ' :-') ELSE '' END, rn) AS expl FROM nx WHERE cap OR type IN ('paragraph', 'heading') GROUP BY 1, 2),
oc AS (SELECT i.page_id, i.path, ARG_MIN(b.text, b.rn) AS ocr FROM ims i JOIN blk b ON b.page_id = i.page_id AND b.image_block_id = i.block_id AND trim(b.text) <> '' GROUP BY 1, 2),
caps AS (SELECT ims.page_id, ims.path, ims.rn, COALESCE(nullif(expl, ''), substr(ocr, 1, 120), '') AS caption FROM ims LEFT JOIN fs ON fs.page_id = ims.page_id AND fs.path = ims.path LEFT JOIN oc ON oc.page_id = ims.page_id AND oc.path = ims.path)"""


@query("image_captions", with_(BLK, _IMG) + "SELECT page_id, path, caption FROM caps")
def image_captions(s, sf):
    x = sealed(_notes(s, sf).select("page_id", pg.captioned_images().alias("im"))).select("page_id", F.explode("im").alias("im"))
    return x.select("page_id", "im.path", "im.caption")


_RANKED = f"""kwd AS (SELECT page_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(lower(title || ' ' || COALESCE(bullets, '')), '[^a-z0-9àâäéèêëîïôöùûüçœ\\s-]', ' ', 'g'), '\\s+'), lambda w: trim(w, '-')), lambda w: length(w) >= 3 AND NOT list_contains({sql_list(tx.STOP_WORDS)}, w)) AS u FROM cards),
kw AS (SELECT page_id, list_transform(list_filter(list_zip(u, range(1, len(u) + 1)), lambda z: list_position(u, z[1]) = z[2])[1:18], lambda z: z[1]) AS ks FROM kwd),
sc AS (SELECT caps.*, list_sum(list_transform(ks, lambda k: CASE WHEN contains({sql_fold('caption', True)}, k) THEN 3 WHEN contains({sql_fold('path', True)}, k) THEN 1 ELSE 0 END)) AS score FROM caps JOIN kw ON caps.page_id = kw.page_id),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY -COALESCE(score, 0), length(path), rn) AS place FROM sc)"""
_CARDS = _DIRTY_SQL.replace("dirty AS (SELECT doc_id, string_agg(", "dirty AS (SELECT page_id AS doc_id, raw_text AS d FROM pt), unused AS (SELECT doc_id, string_agg(") + ", " + _BODY_SQL + ", " + _BUL_SQL + ", cards AS (SELECT pt.page_id, 'Note ' || pt.page_id AS title, COALESCE(bullets, '') AS bullets, raw_text FROM pt JOIN bul ON bul.doc_id = pt.page_id)"


@query("page_cards", with_(BLK, PTXT, _CARDS, _IMG, _RANKED) + """
SELECT cards.page_id, title, CASE WHEN n IS NULL THEN 'CONTENT_TEXT' ELSE 'CONTENT_TEXT_IMAGES' END AS type, bullets, COALESCE(images, '') AS images, md5(raw_text) AS digest FROM cards
LEFT JOIN (SELECT page_id, COUNT(*) AS n, string_agg(path || '=' || caption, ';' ORDER BY place) AS images FROM rk WHERE place <= 4 GROUP BY 1) i ON i.page_id = cards.page_id WHERE bullets <> '' OR n IS NOT NULL""")
def page_cards(s, sf):
    x = pg.page_cards(_notes(s, sf))
    images = F.array_join(F.transform("images", lambda i: F.concat(i["path"], F.lit("="), i["caption"])), ";")
    return x.select("page_id", "title", "type", "bullets", images.alias("images"), F.md5("raw_text").alias("digest"))


@query("caption_fill", with_(BLK, _IMG) + "SELECT page_id, path, CASE WHEN trim(caption) = '' THEN 'Note ' || page_id ELSE caption END AS caption FROM caps")
def caption_fill(s, sf):
    x = sealed(_notes(s, sf).select("page_id", pg.fill_captions(pg.captioned_images(), F.col("title")).alias("im"))).select("page_id", F.explode("im").alias("im"))
    return x.select("page_id", "im.path", "im.caption")


# ---- sections ------------------------------------------------------------------------------


@query("section_pages", with_(BLK) + "SELECT page_id, section, COUNT(*) AS n FROM blk WHERE section = 'src3' GROUP BY 1, 2")
def section_pages(s, sf):
    x = pg.first_pages(pg.in_section(_notes(s, sf), "src3"), "doc_id")
    return x.select("page_id", "section", F.size("blocks").cast("long").alias("n"))


TITLE_WORDS = ["CTA", "Extracteur", "TGBT", "Supervision", "TD", "Local", "Chaudière"]
_TITLED = "tl AS (SELECT CAST(doc_id AS VARCHAR) AS page_id, doc_id, source AS section, " + sql_list(TITLE_WORDS) + "[doc_id % 7 + 1] || ' ' || doc_id AS title FROM documents),\nfam AS (SELECT *, CASE " + " ".join(
    "WHEN " + " OR ".join((f"regexp_matches({sql_norm('title')}, {q(w)})" if w.startswith("\\b") else f"contains({sql_norm('title')}, {q(w)})") for w in words) + f" THEN {q(name)}"
    for words, name in pg.FAMILIES) + f" ELSE {q(pg.OTHER_FAMILY)} END AS family FROM tl)"


def _titled(s, sf) -> DataFrame:
    word = F.element_at(F.array(*[F.lit(w) for w in TITLE_WORDS]), (F.col("doc_id") % 7 + 1).cast("int"))
    return t.texts(s, sf, "documents").select(
        F.col("doc_id").cast("string").alias("page_id"), "doc_id", F.col("source").alias("section"), F.concat(word, F.lit(" "), F.col("doc_id").cast("string")).alias("title"))


@query("equipment_inventory", with_(_TITLED) + """
, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY section, family ORDER BY doc_id) AS rn FROM fam)
SELECT section, family, COUNT(*) AS count, string_agg(CASE WHEN rn <= 30 THEN title END, '; ' ORDER BY rn) AS titles FROM r GROUP BY 1, 2""")
def equipment_inventory(s, sf):
    return pg.inventory(_titled(s, sf), ["section"], "doc_id").withColumn("titles", F.array_join("titles", "; "))


@query("section_context", with_(_TITLED) + """
, c AS (SELECT section, family, COUNT(*) AS n FROM fam GROUP BY 1, 2),
ord AS (SELECT f.section, f.title, ROW_NUMBER() OVER (PARTITION BY f.section ORDER BY c.n DESC, f.family, f.doc_id) AS k FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section, family ORDER BY doc_id) AS rn FROM fam) f JOIN c ON c.section = f.section AND c.family = f.family WHERE rn <= 30 AND (contains(lower(title), 'cta') OR contains(lower(title), 'tgbt'))),
inv AS (SELECT section, string_agg('- ' || family || ': ' || n || ' élément(s)', chr(10) ORDER BY n DESC, family) AS inv FROM c GROUP BY 1)
SELECT inv.section, inv, COALESCE(t, '') AS titles FROM inv LEFT JOIN (SELECT section, string_agg('- ' || title, chr(10) ORDER BY k) AS t FROM ord WHERE k <= 12 GROUP BY 1) x ON x.section = inv.section""")
def section_context(s, sf):
    inv = pg.inventory(_titled(s, sf), ["section"], "doc_id")
    g = inv.groupBy("section").agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("neg"), "family", "titles"))).alias("f"))
    line = F.transform(F.slice("f", 1, 12), lambda x: F.concat(F.lit("- "), x["family"], F.lit(": "), (-x["neg"]).cast("string"), F.lit(" élément(s)")))
    hit = F.filter(F.flatten(F.transform("f", lambda x: x["titles"])), lambda n: tx.any_in(tx.norm(n), ["cta", "tgbt"]))
    picked = F.transform(F.slice(hit, 1, 12), lambda n: F.concat(F.lit("- "), n))
    return g.select("section", F.array_join(line, "\n").alias("inv"), F.array_join(picked, "\n").alias("titles"))


_PARTS = "prt AS (SELECT page_id, doc_id, section, 0 AS rn, 'title' AS type, ANY_VALUE(title) AS text FROM blk GROUP BY 1, 2, 3 UNION ALL SELECT page_id, doc_id, section, rn, CASE type WHEN 'audio' THEN 'audio_transcript' ELSE type END, trim(COALESCE(CASE WHEN type = 'audio' THEN transcript ELSE text END, '')) FROM blk WHERE type IN ('heading','paragraph','image_ocr','audio') AND trim(COALESCE(CASE WHEN type = 'audio' THEN transcript ELSE text END, '')) <> '')"


def _with_parts(s, sf) -> DataFrame:
    return sealed(_notes(s, sf).withColumn("parts", pg.text_parts()))


@query("section_lines", with_(BLK, _PARTS) + "SELECT page_id, COUNT(*) AS n_lines, md5(string_agg(text, chr(10) ORDER BY rn)) AS digest FROM prt WHERE rn > 0 GROUP BY 1")
def section_lines(s, sf):
    x = sealed(_with_parts(s, sf).withColumn("lines", pg.page_lines(F.filter("parts", lambda p: p["type"] != "title")))).where(F.size("lines") > 0)
    return x.select("page_id", F.size("lines").cast("long").alias("n_lines"), F.md5(F.array_join("lines", "\n")).alias("digest"))


@query("equipment_items", with_(BLK, _PARTS) + f"""
, pg AS (SELECT page_id, section, ANY_VALUE(doc_id) AS doc_id, 'Note ' || page_id AS title, list(text ORDER BY rn) FILTER (WHERE rn > 0) AS ls FROM prt GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN contains({sql_fold('title')}, 'note 99') THEN 0 WHEN contains({sql_fold("array_to_string(ls, ' ')")}, 'the') THEN 1 END AS rank FROM pg),
b AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY rank, doc_id) AS k FROM r WHERE rank IS NOT NULL) WHERE k = 1),
it AS (SELECT section, page_id, UNNEST(ls) AS x, generate_subscripts(ls, 1) AS i FROM b),
cl AS (SELECT section, page_id, i, regexp_replace(trim(regexp_replace(x, '^[-•]+', '')), '^[0-9]+[).-]\\s*', '') AS x FROM it),
u AS (SELECT section, page_id, ARG_MIN(x, i) AS x, MIN(i) AS i FROM cl WHERE length(x) BETWEEN 2 AND 140 GROUP BY section, page_id, {sql_fold('x')})
SELECT b.section, b.page_id, COALESCE(string_agg(x, ' | ' ORDER BY i), '') AS items FROM b LEFT JOIN u ON u.section = b.section GROUP BY 1, 2""")
def equipment_items(s, sf):
    x = _with_parts(s, sf).withColumn("lines", pg.page_lines(F.filter("parts", lambda p: p["type"] != "title")))
    out = pg.equipment_list(x, ["section"], "doc_id", words=("note 99", "the"))
    return out.select("section", "page_id", F.array_join("items", " | ").alias("items"))


@query("section_pictures", with_(BLK) + """
, a AS (SELECT section, doc_id, page_id, path, rn, title, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY rn) AS i FROM blk WHERE type = 'image'),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY doc_id, i) AS rank FROM a WHERE i <= 2)
SELECT section, CAST(rank AS INTEGER) AS rank, page_id, path, title AS caption FROM b WHERE rank <= 6""")
def section_pictures(s, sf):
    return pg.pictures_in_order(_notes(s, sf), ["section"], ["doc_id"], 2, 6)


@query("preferred_order", with_(BLK, PTXT) + "SELECT section, page_id, CAST(CASE WHEN contains(mtext, 'token') THEN 0 ELSE 1 END AS INTEGER) AS tier, doc_id FROM mt")
def preferred_order(s, sf):
    out = pg.preferred_first(_notes(s, sf), ["section"], F.contains(pg.matching_text(), F.lit("token")), "doc_id")
    return out.select("section", "page_id", "place.*").withColumnRenamed("_tier", "tier")


# ---- routing -------------------------------------------------------------------------------

# Keywords and report types for the invented prose of the test corpus.
TYPES = (
    rt.ReportType("STATE_AUDIT", ("token", "les", "donde"), ("password", "der"), (
        rt.Bucket("SITE_CONTEXT", 1, ("the", "of", "and", "with by")), rt.Bucket("ARCHITECTURE", 2, ("les", "des", "eaux", "dans")),
        rt.Bucket("COMMUNICATIONS", 2, ("token", "http", "les", "@")), rt.Bucket("DIAGNOSTICS", 3, ("und", "der", "token", "token")))),
    rt.ReportType("SCORING", ("der", "und", "the"), ("license",), (
        rt.Bucket("CONTEXT", 1, ("the", "that", "was")), rt.Bucket("SCORE_NOW", 2, ("der", "die", "sch")),
        rt.Bucket("SCORE_LATER", 3, ("und", "die", "token", "the")), rt.Bucket("ANNEX", 3, ("license", "copyright", "qqqq")))),
)
ALL_BUCKETS = tuple(b for ty in TYPES for b in ty.buckets)
ALL_WORDS = [w for ty in TYPES for w in (*ty.positive, *ty.negative, *[k for b in ty.buckets for k in b.keywords])]
_BK = "bk_def(report_type, bucket, part, place, kws) AS (VALUES " + ", ".join(
    f"({q(ty.name)}, {q(b.name)}, {b.part}, {i}, {sql_list(b.keywords)})" for ty in TYPES for i, b in enumerate(ty.buckets)) + ")"
_HITS = _BK + """,
hit AS (SELECT page_id, doc_id, section, bucket, part, len(list_filter(kws, lambda k: contains(mtext, k))) AS hits FROM mt CROSS JOIN bk_def),
ranked AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section, bucket ORDER BY hits DESC, doc_id) AS rank FROM hit WHERE hits > 0) WHERE rank <= 5)"""


def _hits(s, sf) -> DataFrame:
    x = _notes(s, sf)
    return rt.bucket_hits(x.select("page_id", "doc_id", "section", pg.matching_text().alias("m")), F.col("m"), ALL_BUCKETS).drop("m")


def _ranked(s, sf) -> DataFrame:
    return rt.rank_pages(_hits(s, sf), ["section"], "doc_id", 5)


@query("bucket_pages", with_(BLK, PTXT, _HITS) + "SELECT section, bucket, CAST(part AS INTEGER) AS part, page_id, doc_id, CAST(hits AS INTEGER) AS hits, CAST(rank AS INTEGER) AS rank FROM ranked")
def bucket_pages(s, sf):
    return _ranked(s, sf).select("section", "bucket", "part", "page_id", "doc_id", "hits", "rank")


_SEEN = _BK + """,
sw AS (SELECT section, w, BOOL_OR(contains(mtext, w)) AS seen FROM mt CROSS JOIN (SELECT UNNEST(""" + sql_list(dict.fromkeys(ALL_WORDS)) + """) AS w) GROUP BY 1, 2),
bs AS (SELECT section, report_type, bucket, part, place, COUNT(CASE WHEN seen THEN 1 END) AS score FROM (SELECT *, UNNEST(kws) AS w FROM bk_def) d JOIN sw USING (w) GROUP BY ALL),
tp(report_type, place, sgn, w) AS (VALUES """ + ", ".join(
    f"({q(ty.name)}, {i}, {sg}, {q(w)})" for i, ty in enumerate(TYPES) for sg, ws in ((2, ty.positive), (-1, ty.negative)) for w in ws) + """),
ts AS (SELECT section, report_type, place, SUM(CASE WHEN seen THEN sgn ELSE 0 END) AS score FROM tp JOIN sw USING (w) GROUP BY ALL),
best AS (SELECT section, report_type, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY score DESC, place) AS k FROM ts) WHERE k = 1),
sel AS (SELECT * FROM (SELECT bs.*, ROW_NUMBER() OVER (PARTITION BY bs.section, part ORDER BY bs.score DESC, place) AS rank FROM bs JOIN best ON best.section = bs.section AND best.report_type = bs.report_type WHERE bs.score >= 2 OR part IN (1, 2)) WHERE rank <= 8)"""


def _typed(s, sf) -> DataFrame:
    x = _notes(s, sf)
    return rt.detect_type(rt.keyword_presence(x, pg.matching_text(), ["section"], ALL_WORDS), ["section"], TYPES)


def _selected(s, sf) -> DataFrame:
    return rt.bucket_scores(_typed(s, sf), ["section"], TYPES)


@query("report_type", with_(BLK, PTXT, _SEEN) + "SELECT section, report_type, CAST(score AS INTEGER) AS type_score FROM best")
def report_type(s, sf):
    return _typed(s, sf).drop("seen")


@query("bucket_selection", with_(BLK, PTXT, _SEEN) + "SELECT section, report_type, bucket, CAST(part AS INTEGER) AS part, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM sel")
def bucket_selection(s, sf):
    return _selected(s, sf).select("section", "report_type", "bucket", "part", "score", "rank")


def _plan(s, sf) -> dict[str, DataFrame]:
    return rt.build_plan(_notes(s, sf), pg.matching_text(), ["section"], "doc_id", TYPES)


@query("plan_slots")
def plan_slots(s, sf):
    return _plan(s, sf)["slots"].withColumn("buckets", F.array_join("buckets", ","))


@query("plan_routing")
def plan_routing(s, sf):
    return _plan(s, sf)["slot_routing"]


@query("slot_pages", with_(BLK, PTXT, _HITS) + """
, g AS (SELECT section, 'P' || part AS slot, page_id, doc_id, MAX(hits) AS score FROM ranked GROUP BY ALL)
SELECT section, slot, page_id, doc_id, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section, slot ORDER BY score DESC, doc_id) AS rank FROM g) WHERE rank <= 5""")
def slot_pages(s, sf):
    ranked = _ranked(s, sf)
    slots = ranked.groupBy("section", F.concat(F.lit("P"), F.col("part").cast("string")).alias("slot")).agg(F.collect_set("bucket").alias("buckets"))
    return rt.route_slots(slots, ranked, ["section"], "doc_id", 5)


@query("spared_pages", with_(BLK, PTXT, _HITS) + """
, f AS (SELECT r.*, u.page_id IS NULL AS fresh FROM ranked r LEFT JOIN (SELECT DISTINCT section, page_id FROM ranked WHERE part = 1) u ON u.section = r.section AND u.page_id = r.page_id),
n AS (SELECT *, COUNT(*) OVER p AS n, SUM(CASE WHEN fresh THEN 1 ELSE 0 END) OVER p AS fr FROM f WINDOW p AS (PARTITION BY section, bucket))
SELECT section, bucket, page_id FROM n WHERE NOT (part = 3 AND n > 2 AND fr >= 2 AND NOT fresh)""")
def spared_pages(s, sf):
    return rt.spare_reused(_ranked(s, sf), ["section"]).select("section", "bucket", "page_id")


@query("bucket_similarity", """
WITH w AS (SELECT part_b.p_partkey AS a, list_distinct(string_split(part_b.p_name || ' ' || p_type, ' ')) AS wa FROM part part_b)
SELECT a, ROUND(CAST(len(list_intersect(wa, ['red', 'small', 'widget', 'PROMO'])) AS DOUBLE) / len(list_distinct(list_concat(wa, ['red', 'small', 'widget', 'PROMO']))), 6) AS similarity FROM w""")
def bucket_similarity(s, sf):
    wa = F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_type"), " "))
    fixed = F.array(*[F.lit(w) for w in ("red", "small", "widget", "PROMO")])
    return t.table(s, sf, "part").select(F.col("p_partkey").alias("a"), F.round(rt.jaccard(wa, fixed), 6).alias("similarity"))


_REQ = f"(contains(text, '?') OR {sql_start(sql_norm('text'), tx.REQUEST_STARTS)} OR {sql_start(sql_norm('text'), tx.DUTY_STARTS)})"
_SNIP = "sn AS (SELECT page_id, rn, type, CASE WHEN " + _REQ + " THEN 'request' ELSE 'fact' END AS kind, substr(text, 1, 900) AS text FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY rn) AS k FROM prt WHERE " + sql_any(sql_norm("text"), ["the", "les", "token"]) + ") WHERE k <= 14)"


@query("page_snippets", with_(BLK, _PARTS, _SNIP) + "SELECT page_id, type, kind, text FROM sn")
def page_snippets(s, sf):
    x = sealed(_with_parts(s, sf).select("page_id", rt.snippets(F.col("parts"), ["the", "les", "token"], 14, 900).alias("_e"))).select("page_id", F.explode("_e").alias("e"))
    return x.select("page_id", "e.type", "e.kind", "e.text")


_EVB = _PARTS + f""",
rp AS (SELECT r.section, r.bucket, r.rank, r.page_id, r.hits, kws FROM ranked r JOIN bk_def USING (bucket)),
pk AS (SELECT rp.section, bucket, rank, rp.page_id, rn, type, text, {_REQ} AS req, ROW_NUMBER() OVER (PARTITION BY rp.section, bucket, rp.page_id ORDER BY rn) AS k FROM rp JOIN prt ON prt.page_id = rp.page_id WHERE len(list_filter(kws, lambda w: contains({sql_norm('text')}, w))) > 0),
pf AS (SELECT section, bucket, page_id, string_agg(CASE WHEN NOT req THEN CASE WHEN type <> 'paragraph' THEN '- (' || type || ') ' ELSE '- ' END || substr(text, 1, 900) || chr(10) END, '' ORDER BY rn) AS facts, COUNT(*) AS n FROM pk WHERE k <= 14 GROUP BY ALL),
pb AS (SELECT rp.section, bucket, string_agg('## Page: Note ' || rp.page_id || ' (page_id=' || rp.page_id || ', score=' || hits || ')' || chr(10) || CASE WHEN COALESCE(n, 0) = 0 THEN '(Aucun extrait direct trouvé; vérifier la page complète.)' || chr(10) ELSE COALESCE(facts, '') END, chr(10) ORDER BY rank) AS body FROM rp LEFT JOIN pf USING (section, bucket, page_id) GROUP BY ALL),
qs AS (SELECT section, bucket, string_agg('- Question: ' || substr(text, 1, 900) || chr(10) || '  Preuve: page_id=' || page_id, chr(10) ORDER BY rank, rn) AS asks FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section, bucket ORDER BY rank, rn) AS qn FROM pk WHERE k <= 14 AND req) WHERE qn <= 30 GROUP BY ALL)
SELECT pb.section, pb.bucket, md5(trim('- Bucket: ' || pb.bucket || chr(10) || '- Mots-clés: ' || array_to_string(kws, ', ') || chr(10) || chr(10) || body || CASE WHEN asks IS NULL THEN '' ELSE chr(10) || {q("## Questions / demandes présentes dans les notes (non factuelles)")} || chr(10) || {q("⚠️ À traiter comme 'Points à confirmer' (ne pas les transformer en faits).")} || chr(10) || chr(10) || asks END, ' ' || chr(10))) AS digest
FROM pb JOIN bk_def USING (bucket) LEFT JOIN qs ON qs.section = pb.section AND qs.bucket = pb.bucket"""


@query("evidence_blocks", with_(BLK, PTXT, _HITS, _EVB))
def evidence_blocks(s, sf):
    x = rt.evidence_block(_ranked(s, sf), _with_parts(s, sf), ["section"], ALL_BUCKETS, 14, 900, 30)
    return x.select("section", "bucket", F.md5("evidence").alias("digest"))


# ---- past reports --------------------------------------------------------------------------

HEAD_WORDS = ["Contexte et objectifs", "Présentation du site", "État des lieux", "Conformité BACS", "Scoring ISO 52120", "Budget", "Travaux", "Conclusion", "Annexe", "Divers points", "Mars 2024", "Généralités"]
FOLDER_WORDS = ["Audits BACS", "Audit Etat GTB", "Depannages", "Etats d'avancement", "Archives"]
_FILES = "pk AS (SELECT doc_id, source, CAST(substr(source, 4) AS BIGINT) AS sn, " + sql_list(FOLDER_WORDS) + "[CAST(substr(source, 4) AS BIGINT) % 5 + 1] || '/' || source || '/' || CASE WHEN doc_id % 9 = 0 THEN 'libre' ELSE 'P0' || (doc_id % 5) || lpad(CAST(doc_id // 3 % 10000 AS VARCHAR), 4, '0') END || ' v' || doc_id || ['.pptx', '.docx', '.pdf'][doc_id % 3 + 1] AS file FROM documents)"
_PARTSQL = "CASE " + " ".join(f"WHEN {sql_any('lower(l)', ws)} THEN {n}" for ws, n in rp.PART_WORDS) + " END"


def _packs(s, sf) -> DataFrame:
    d = t.texts(s, sf, "documents")
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    pick = lambda words, i: F.element_at(F.array(*[F.lit(w) for w in words]), (i + 1).cast("int"))
    name = F.when(F.col("doc_id") % 9 == 0, F.lit("libre")).otherwise(F.concat(
        F.lit("P0"), (F.col("doc_id") % 5).cast("string"), F.lpad((F.floor(F.col("doc_id") / 3) % 10000).cast("string"), 4, "0")))
    file = F.concat_ws("/", pick(FOLDER_WORDS, n % 5), "source", F.concat(name, F.lit(" v"), F.col("doc_id").cast("string"), pick([".pptx", ".docx", ".pdf"], F.col("doc_id") % 3)))
    ls = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda e: tx.strip(e["x"]) != "")
    title = F.transform(ls, lambda e: F.struct(
        F.when((F.col("doc_id") + e["i"]) % 13 == 12, e["x"]).otherwise(pick(HEAD_WORDS, (F.col("doc_id") + e["i"]) % 12)).alias("title"),
        F.lit("p001").alias("ref"), F.lit(None).cast("int").alias("suggested_part")))
    return d.select("doc_id", file.alias("file"), title.alias("outline"))


_OUT = LINES + ",\n" + _FILES + ",\nol AS (SELECT doc_id, pos, CASE WHEN (doc_id + pos - 1) % 13 = 12 THEN line ELSE " + sql_list(HEAD_WORDS) + "[(doc_id + pos - 1) % 12 + 1] END AS title FROM ln WHERE trim(line) <> '')"
_NOISE = "(length(n) < 4 OR NOT regexp_matches(n, '\\p{L}') OR " + " OR ".join(f"regexp_matches(n, {q('(?i)' + p)})" for p in tx.NOISE_PATTERNS) + ")"
_DECORSQL = f"(n = '' OR list_contains({sql_list(tx.DECOR)}, n) OR regexp_matches(n, {q('^(' + '|'.join(tx.MONTHS) + ') [0-9]+$')}))"
_TITLES = _OUT + f""",
tn AS (SELECT doc_id, pos, trim(title) AS title, {sql_plain('title')} AS n FROM ol),
tt AS (SELECT doc_id, ARG_MIN(title, pos) AS title, MIN(pos) AS pos, n FROM tn WHERE title <> '' AND NOT {_NOISE} AND NOT {_DECORSQL} AND (length(n) >= 8 OR {sql_any('n', ['etat', 'plan', 'bacs', 'gtb', 'tri'])}) GROUP BY doc_id, n)"""


@query("structure_titles", with_(_TITLES) + "SELECT doc_id, COUNT(*) AS n, md5(string_agg(title, chr(10) ORDER BY pos)) AS digest FROM tt GROUP BY 1")
def structure_titles(s, sf):
    x = sealed(_packs(s, sf).withColumn("titles", rp.structure_titles("outline"))).where(F.size("titles") > 0)
    return x.select("doc_id", F.size("titles").cast("long").alias("n"), F.md5(F.array_join("titles", "\n")).alias("digest"))


_CASE_SQL = _FILES + ",\ncs AS (SELECT *, nullif(upper(regexp_extract(file, '(?i)\\b(P0(\\d)(\\d{4}))\\b', 1)), '') AS ck FROM pk),\ncw AS (SELECT *, COALESCE(ck, 'NOCASE::' || regexp_extract(file, '([^/]*)$', 1)) AS case_key, CASE WHEN ck IS NULL THEN 1.0 ELSE POW(1.25, CAST(substr(ck, 3, 1) AS DOUBLE) + CAST(substr(ck, 4) AS DOUBLE) / 10000) END AS weight FROM cs),\ncd AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY case_key ORDER BY CASE WHEN file LIKE '%.pptx' THEN 0 WHEN file LIKE '%.docx' THEN 1 ELSE 2 END, file) AS k FROM cw) WHERE k = 1)"


@query("canonical_reports", with_(_CASE_SQL) + "SELECT case_key, file, ROUND(weight, 6) AS weight, CASE " + " ".join(f"WHEN {sql_any('lower(file)', ws)} THEN {q(n)}" for ws, n in rp.FOLDERS) + " ELSE 'Autre' END AS family FROM cd")
def canonical_reports(s, sf):
    x = rp.canonical_docs(_packs(s, sf).select("doc_id", "file"))
    return x.select("case_key", "file", F.round("weight", 6).alias("weight"), rp.folder_family(F.col("file")).alias("family"))


def _sec_sql(family):
    return "CASE " + " ".join("WHEN " + " AND ".join(sql_any("n", ws) for ws in groups) + f" THEN {q(sec)}" for groups, sec in rp.SECTIONS[family]) + " END"


_SKEL = _TITLES.replace(_FILES, _CASE_SQL) + f""",
mp AS (SELECT case_key, weight, pos, title, {_sec_sql('BACS')} AS section FROM tt JOIN cd USING (doc_id) WHERE starts_with(file, 'Audits BACS') AND NOT {_NOISE} AND NOT {_DECORSQL}),
pc AS (SELECT section, case_key, MAX(weight) AS weight, ARG_MIN(title, pos) AS title FROM mp WHERE section IS NOT NULL GROUP BY 1, 2),
ex AS (SELECT section, string_agg(title, ' | ' ORDER BY case_key) AS examples FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY case_key) AS k FROM pc) WHERE k <= 3 GROUP BY 1),
sk AS (SELECT section, SUM(weight) AS score, COUNT(*) AS cases FROM pc GROUP BY 1)"""


def _skeleton(s, sf) -> DataFrame:
    x = _packs(s, sf).where(rp.folder_family(F.col("file")) == "BACS").withColumn("titles", rp.structure_titles("outline")).drop("outline")
    return rp.skeleton(x, "BACS")


@query("section_skeleton", with_(_SKEL.replace("FROM pk),\ncw", "FROM pk WHERE starts_with(file, 'Audits BACS')),\ncw")) + "SELECT section, ROUND(score, 5) AS score, cases, examples, score >= 1 AS selected, CAST(ROW_NUMBER() OVER (ORDER BY score DESC, section) AS INTEGER) AS rank FROM sk JOIN ex USING (section)")
def section_skeleton(s, sf):
    return _skeleton(s, sf).select("section", F.round("score", 5).alias("score"), "cases", "examples", "selected", "rank")


@query("skeleton_summary", with_(_SKEL.replace("FROM pk),\ncw", "FROM pk WHERE starts_with(file, 'Audits BACS')),\ncw")) + "SELECT 'BACS' AS family, MAX(cases) AS max_cases, COUNT(*) AS num_candidates, BOOL_OR(score >= 1) AS has_selected FROM sk")
def skeleton_summary(s, sf):
    return rp.skeleton_summary(_skeleton(s, sf).withColumn("family", F.lit("BACS")))


@query("carried_parts", with_(LINES, _FILES) + f"""
, b0 AS (SELECT doc_id, pos, CASE WHEN (doc_id + pos) % 3 = 0 THEN [{sql_list(HEAD_WORDS)}[(doc_id + pos) % 12 + 1], line] ELSE [line] END AS ls FROM ln WHERE trim(line) <> ''),
b1 AS (SELECT doc_id, pos, len(ls) AS k, UNNEST(ls) AS l, generate_subscripts(ls, 1) AS half FROM b0), b AS (SELECT doc_id, pos * 2 + half AS pos, l, k = 2 AND half = 1 AS head FROM b1),
m AS (SELECT *, CASE WHEN head THEN {_PARTSQL} END AS mark FROM b),
c AS (SELECT *, LAST_VALUE(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM m)
SELECT doc_id, CAST(part AS INTEGER) AS part, COUNT(*) AS n, md5(string_agg(l, chr(10) ORDER BY pos)) AS digest FROM c WHERE part IN (1, 2, 3) GROUP BY 1, 2""")
def carried_parts(s, sf):
    x = _headed(s, sf).withColumn("part", rp.carried_parts(F.col("blocks")))
    one = x.select("doc_id", F.posexplode(F.arrays_zip("blocks", "part")).alias("pos", "z")).select(
        "doc_id", F.format_string("%08d", "pos").alias("chunk_id"), F.col("z.blocks.text").alias("text"), F.col("z.part").alias("part"))
    out = rp.parts_of_report(one, "doc_id")
    return out.select("doc_id", "part", "n", F.md5("text").alias("digest"))


def _headed(s, sf) -> DataFrame:
    """Report blocks with a known heading before every third line."""
    words = F.array(*[F.lit(w) for w in HEAD_WORDS])
    ls = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("p"))), lambda e: tx.strip(e["x"]) != "")

    def block(e):
        head = (F.col("doc_id") + e["p"]) % 3 == 0
        word = F.element_at(words, ((F.col("doc_id") + e["p"]) % 12 + 1).cast("int"))
        one = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"), F.format_string("p%03d", F.floor(e["p"] / 20).cast("int")).alias("ref"))
        return F.when(head, F.array(one("heading", word), one("paragraph", e["x"]))).otherwise(F.array(one("paragraph", e["x"])))

    return t.texts(s, sf, "documents").select("doc_id", F.flatten(F.transform(ls, block)).alias("blocks"))


def _sql_clean(e: str) -> str:
    return f"trim(regexp_replace(trim(regexp_replace({e}, '[ \\t]{{2,}}', ' ', 'g'), ' ' || chr(10) || chr(9)), 'Page\\s+\\d+\\s+sur\\s+\\d+', '', 'gi'), ' ' || chr(10) || chr(9))"


_NOW, _FULL = "COALESCE(x.mark, a.part)", "length(a.buf) + length(x.text) + 2 > 1200"
_CHUNK = f"""cb0 AS (SELECT doc_id, pos, CASE WHEN (doc_id + pos) % 3 = 0 THEN [{sql_list(HEAD_WORDS)}[(doc_id + pos) % 12 + 1], line] ELSE [line] END AS ls FROM ln WHERE trim(line) <> ''),
cb1 AS (SELECT doc_id, pos, len(ls) AS k, UNNEST(ls) AS l, generate_subscripts(ls, 1) AS half FROM cb0),
cb AS (SELECT doc_id, pos * 2 + half AS pos, l, k = 2 AND half = 1 AS head, 'p' || lpad(CAST(pos // 20 AS VARCHAR), 3, '0') AS ref FROM cb1),
ce AS (SELECT doc_id, list({{'outs': CAST([] AS STRUCT(text VARCHAR, refs VARCHAR[], part INTEGER)[]), 'buf': '', 'refs': CAST([] AS VARCHAR[]), 'part': CAST(NULL AS INTEGER), 'text': l, 'ref': ref, 'mark': CASE WHEN head THEN CAST({_PARTSQL} AS INTEGER) END}} ORDER BY pos) AS e FROM cb GROUP BY 1),
cr AS (SELECT doc_id, list_reduce(list_prepend({{'outs': CAST([] AS STRUCT(text VARCHAR, refs VARCHAR[], part INTEGER)[]), 'buf': '', 'refs': CAST([] AS VARCHAR[]), 'part': CAST(NULL AS INTEGER), 'text': '', 'ref': '', 'mark': CAST(NULL AS INTEGER)}}, e), lambda a, x: {{
  'outs': CASE WHEN {_FULL} AND {_sql_clean('a.buf')} <> '' THEN list_append(a.outs, {{'text': {_sql_clean('a.buf')}, 'refs': list_sort(list_distinct(a.refs)), 'part': {_NOW}}}) ELSE a.outs END,
  'buf': CASE WHEN {_FULL} THEN CASE WHEN length(a.buf) > 150 THEN right(a.buf, 150) || chr(10) ELSE '' END ELSE a.buf END || x.text || chr(10),
  'refs': CASE WHEN {_FULL} THEN [x.ref] ELSE list_append(a.refs, x.ref) END, 'part': {_NOW}, 'text': '', 'ref': '', 'mark': CAST(NULL AS INTEGER)}}) AS s FROM ce),
cf AS (SELECT doc_id, CASE WHEN {_sql_clean('s.buf')} <> '' THEN list_append(s.outs, {{'text': {_sql_clean('s.buf')}, 'refs': list_sort(list_distinct(s.refs)), 'part': s.part}}) ELSE s.outs END AS o FROM cr),
ck AS (SELECT doc_id, UNNEST(o) AS c, generate_subscripts(o, 1) AS i FROM cf)"""


@query("report_chunks", with_(LINES, _CHUNK) + "SELECT doc_id, 'c' || lpad(CAST(i AS VARCHAR), 5, '0') AS chunk_id, COALESCE(c.part, 0) AS part, array_to_string(c.refs, ',') AS refs, md5(c.text) AS digest, CAST(length(c.text) AS INTEGER) AS n FROM ck")
def report_chunks(s, sf):
    x = rp.chunked(_headed(s, sf), "doc_id")
    return x.select("doc_id", "chunk_id", F.coalesce("part", F.lit(0)).alias("part"), F.array_join("refs", ",").alias("refs"), F.md5("text").alias("digest"), F.length("text").alias("n"))


@query("chunk_manifest", with_(LINES, _FILES, _CHUNK) + "SELECT pk.doc_id, file, COUNT(i) AS n_chunks, CASE WHEN COUNT(i) = 0 THEN 'no text' END AS error FROM pk LEFT JOIN ck ON ck.doc_id = pk.doc_id GROUP BY 1, 2")
def chunk_manifest(s, sf):
    return rp.chunk_manifest(_packs(s, sf).select("doc_id", "file"), rp.chunked(_headed(s, sf), "doc_id"), "doc_id")


@query("chunks_by_ref", with_(LINES) + """
, c AS (SELECT doc_id, pos, trim(line) AS line, ['p' || (pos % 4), 'p' || (pos % 3)] AS refs FROM ln), w AS (SELECT doc_id, ['p' || (doc_id % 3)] AS wanted FROM documents)
SELECT c.doc_id, COUNT(*) AS n FROM c JOIN w ON c.doc_id = w.doc_id WHERE list_has_any(refs, wanted) AND line <> '' GROUP BY 1""")
def chunks_by_ref(s, sf):
    d = t.texts(s, sf, "documents")
    ref = lambda n: F.concat(F.lit("p"), n.cast("string"))
    c = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "text")).withColumn("refs", F.array(ref((F.col("p") + 1) % 4), ref((F.col("p") + 1) % 3)))
    w = d.select("doc_id", F.array(ref(F.col("doc_id") % 3)).alias("wanted"))
    return rp.chunks_for_refs(c, w, "doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))


_WANT = {"CONTEXT": ["the of", "and the"], "SCORING": ["token", "der und"], "WORKS": ["les des", "que"]}
_EXN = sql_norm("text")


@query("style_exemplars", "WITH w(bucket, term, wt) AS (VALUES " + ", ".join(f"({q(b)}, {i}, {q(x)})" for b, ws in _WANT.items() for i, x in enumerate(ws)) + f"""),
m AS (SELECT doc_id, bucket, term, text, instr({_EXN}, wt) AS ps FROM documents, w WHERE instr({_EXN}, wt) > 0),
p AS (SELECT doc_id, bucket, term, substr(regexp_replace(trim(substr(text, GREATEST(ps - 1 - 380, 0) + 1, ps - 1 + 950 - GREATEST(ps - 1 - 380, 0)), ' ' || chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), 1, 850) AS passage FROM m),
u AS (SELECT bucket, passage, MIN(doc_id * 10 + term) AS o FROM p WHERE passage <> '' GROUP BY 1, 2)
SELECT bucket, CAST(rank AS INTEGER) AS rank, o // 10 AS doc_id, passage FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY o) AS rank FROM u) WHERE rank <= 2""")
def style_exemplars(s, sf):
    return rp.exemplars(t.texts(s, sf, "documents").select("doc_id", "text"), "doc_id", _WANT)


# ---- evidence texts ------------------------------------------------------------------------

_EVT = """ek AS (SELECT doc_id, source, pos, CASE (pos - 1) % 8 WHEN 0 THEN ['## Page: ' || trim(line) || ' (page_id=' || (doc_id % 50) || '_' || pos || ', score=2)'] WHEN 5 THEN ['## Questions / demandes', '- ' || line] WHEN 6 THEN ['- Question: ' || line] WHEN 7 THEN ['  Preuve: page_id=' || doc_id || 'x', '- ' || line] ELSE ['- ' || line] END AS ls FROM ln),
el AS (SELECT doc_id, source, pos, UNNEST(ls) AS l0, generate_subscripts(ls, 1) AS part FROM ek),
e1 AS (SELECT doc_id, source, trim(l0) AS l, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos, part) AS i FROM el WHERE trim(l0) <> ''),
e2 AS (SELECT *, CASE WHEN starts_with(l, '## Questions') THEN 'q' WHEN regexp_matches(l, '^##\\s+Page:\\s*(.*?)\\s*\\(page_id=([^,)]+)') THEN 'p' END AS m, LEAD(l) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM e1),
e3 AS (SELECT *, MAX(CASE WHEN m IS NOT NULL THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM e2),
ei AS (SELECT a.doc_id, a.source, a.i AS pos, b.m AS kind, trim(regexp_replace(a.l, '^[-•]\\s+', '')) AS text,
  CASE WHEN b.m = 'q' THEN COALESCE(nullif(regexp_extract(a.l, 'page_id=([^\\s,]+)', 1), ''), nullif(regexp_extract(a.nx, '^Preuve:.*page_id=([^\\s,]+)', 1), '')) ELSE trim(regexp_extract(b.l, '^##\\s+Page:\\s*(.*?)\\s*\\(page_id=([^,)]+)', 2)) END AS page_id,
  CASE WHEN b.m = 'p' THEN trim(regexp_extract(b.l, '^##\\s+Page:\\s*(.*?)\\s*\\(page_id=([^,)]+)', 1)) END AS page_title FROM e3 a JOIN e3 b ON a.doc_id = b.doc_id AND b.i = a.h WHERE regexp_matches(a.l, '^[-•]\\s+'))"""


def _evidence(s, sf) -> DataFrame:
    def line(x, i):
        k = i % 8
        pid = F.concat((F.col("doc_id") % 50).cast("string"), F.lit("_"), (i + 1).cast("string"))
        return (F.when(k == 0, F.concat(F.lit("## Page: "), F.trim(x), F.lit(" (page_id="), pid, F.lit(", score=2)")))
                .when(k == 5, F.concat(F.lit("## Questions / demandes\n- "), x)).when(k == 6, F.concat(F.lit("- Question: "), x))
                .when(k == 7, F.concat(F.lit("  Preuve: page_id="), F.col("doc_id").cast("string"), F.lit("x\n- "), x)).otherwise(F.concat(F.lit("- "), x)))

    return t.texts(s, sf, "documents").select("doc_id", "source", F.array_join(F.transform(F.split("text", "\n"), line), "\n").alias("evidence"))


def _items(s, sf) -> DataFrame:
    return rp.evidence_items(_evidence(s, sf), ["doc_id", "source"], "evidence")


@query("evidence_items", with_(LINES, _EVT) + "SELECT doc_id, CAST(pos AS INTEGER) AS pos, kind, text, page_id, page_title FROM ei")
def evidence_items(s, sf):
    return _items(s, sf).drop("source")


TOPICS = ["Contexte that with", "Token entre thand", "Anat there tion"]
_CLS = f"""CASE WHEN {sql_norm('text')} = '' THEN 'empty' WHEN contains(text, '?') OR {sql_start(sql_norm('text'), tx.REQUEST_STARTS)} THEN 'request'
 WHEN {sql_any(sql_norm('text'), rp.NORMATIVE)} OR regexp_matches({sql_norm('text')}, '\\bclasse\\s*[a-d]\\b') OR {sql_start(sql_norm('text'), tx.DUTY_STARTS)} THEN 'normative'
 WHEN len(string_split({sql_norm('text')}, ' ')) <= 6 AND NOT {sql_any(sql_norm('text'), rp.VERBS)} THEN 'heading' ELSE 'fact' END"""


def _topic_words(tp):
    return [w for w in tp.lower().split() if len(w) > 3]


_TOPIC = ", ".join(f"len(list_filter({sql_list(_topic_words(tp))}, lambda w: contains({sql_norm('text')}, w))) AS s{i}" for i, tp in enumerate(TOPICS))
_TOPICSEL = "CASE WHEN GREATEST(s0, s1, s2) = 0 THEN NULL WHEN s0 >= s1 AND s0 >= s2 THEN " + q(TOPICS[0]) + " WHEN s1 >= s2 THEN " + q(TOPICS[1]) + " ELSE " + q(TOPICS[2]) + " END"


@query("snippet_classes", with_(LINES, _EVT) + f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, {_CLS} AS class, {_TOPICSEL} AS topic FROM (SELECT *, {_TOPIC} FROM ei)")
def snippet_classes(s, sf):
    x = _items(s, sf)
    return x.select("doc_id", "pos", rp.snippet_class(F.col("text")).alias("class"), rp.topic_of(F.col("text"), TOPICS).alias("topic"))


@query("evidence_pack", with_(LINES, _EVT) + f"""
, c AS (SELECT doc_id, pos, page_id, text, {_CLS} AS class, {_TOPICSEL} AS topic FROM (SELECT *, {_TOPIC} FROM ei WHERE kind = 'p' AND text <> '')),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id, topic, CASE WHEN topic IS NULL THEN 'unassigned' ELSE class END ORDER BY pos) AS rank FROM c WHERE class <> 'empty')
SELECT doc_id, CAST(pos AS INTEGER) AS pos, page_id, text, class, topic, CAST(rank AS INTEGER) AS rank FROM r WHERE (topic IS NULL AND rank <= 40) OR rank <= 12""")
def evidence_pack(s, sf):
    return rp.evidence_pack(_items(s, sf), ["doc_id"], TOPICS, 12, 40).select("doc_id", "pos", "page_id", "text", "class", "topic", "rank")


@query("evidence_digest", with_(LINES, _EVT) + """
, p AS (SELECT * FROM ei WHERE kind = 'p'), f AS (SELECT source, page_id, ARG_MIN(page_title, doc_id * 100000 + pos) AS title, MIN(doc_id * 100000 + pos) AS o FROM p GROUP BY 1, 2),
g AS (SELECT *, o // 100000 AS doc_id, ROW_NUMBER() OVER (PARTITION BY source ORDER BY o) AS page_rank FROM f),
l AS (SELECT g.source, page_rank, g.page_id, title, ROW_NUMBER() OVER (PARTITION BY g.source, g.page_id ORDER BY pos) AS line_rank, substr(text, 1, 240) AS line FROM g JOIN p ON p.source = g.source AND p.page_id = g.page_id AND p.doc_id = g.doc_id WHERE page_rank <= 20)
SELECT source, CAST(page_rank AS INTEGER) AS page_rank, page_id, title, CAST(line_rank AS INTEGER) AS line_rank, line FROM l WHERE line_rank <= 12""")
def evidence_digest(s, sf):
    return rp.digest(_items(s, sf), ["source"], "doc_id", 20, 12, 240)


@query("proof_trace", """
WITH c AS (SELECT conv_id, turn, UNNEST(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations),
p AS (SELECT conv_id, turn, i, trim(CASE WHEN i % 2 = 1 THEN '- Preuve : ' || l WHEN i % 5 = 0 THEN l || ' page_id = 7' ELSE l END) AS raw FROM c)
SELECT conv_id, turn, 'P' || ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, i) AS ref, raw FROM p WHERE regexp_matches(raw, '(?i)^(\\s*[-•]?\\s*)?(preuve\\s*:|.*\\bpage_id\\s*=)')""")
def proof_trace(s, sf):
    return rp.trace(_marked_turns(s, sf), ["conv_id"], ["turn"], "text")


def _marked_turns(s, sf) -> DataFrame:
    def line(x, i):
        return F.when((i + 1) % 2 == 1, F.concat(F.lit("- Preuve : "), x)).when((i + 1) % 5 == 0, F.concat(x, F.lit(" page_id = 7"))).otherwise(x)

    return t.texts(s, sf, "conversations").select("conv_id", "turn", "role", F.array_join(F.transform(F.split("text", "\n"), line), "\n").alias("text"))


@query("client_text", """
WITH c AS (SELECT conv_id, turn, UNNEST(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations),
p AS (SELECT conv_id, turn, i, CASE WHEN i % 2 = 1 THEN '- Preuve : ' || l WHEN i % 5 = 0 THEN l || ' page_id = 7' ELSE l END AS raw FROM c)
SELECT conv_id, turn, trim(COALESCE(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE NOT regexp_matches(trim(raw), '(?i)^(\\s*[-•]?\\s*)?(preuve\\s*:|.*\\bpage_id\\s*=)')), ''), ' ' || chr(10)) AS text FROM p GROUP BY 1, 2""")
def client_text(s, sf):
    return _marked_turns(s, sf).select("conv_id", "turn", rp.client_text("text").alias("text"))


@query("plan_scaffold", with_(LINES) + """
, p0 AS (SELECT doc_id, pos, CASE WHEN pos = 2 THEN ['### Plan attendu', line] WHEN pos > 2 AND pos % 3 = 0 THEN ['#### ' || line] WHEN pos % 7 = 0 THEN ['', line] ELSE [line] END AS ls FROM ln),
p1 AS (SELECT doc_id, pos, UNNEST(ls) AS l, generate_subscripts(ls, 1) AS part FROM p0), p AS (SELECT doc_id, l, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos, part) AS pos FROM p1),
h AS (SELECT *, pos > 2 AND regexp_matches(trim(l), '^####\\s+(.*)$') AS head FROM p WHERE pos > 2), f AS (SELECT doc_id, MIN(pos) AS first FROM h WHERE head GROUP BY 1),
b AS (SELECT h.doc_id, MIN(pos) AS stop FROM h JOIN f ON f.doc_id = h.doc_id WHERE trim(l) = '' AND pos > first GROUP BY 1)
SELECT h.doc_id, string_agg(trim(regexp_extract(trim(l), '^####\\s+(.*)$', 1)), ' | ' ORDER BY pos) AS scaffold FROM h LEFT JOIN b ON b.doc_id = h.doc_id WHERE head AND pos < COALESCE(stop, 1000000) GROUP BY 1""")
def plan_scaffold(s, sf):
    def line(x, i):
        p = i + 1
        return F.when(p == 2, F.concat(F.lit("### Plan attendu\n"), x)).when((p > 2) & (p % 3 == 0), F.concat(F.lit("#### "), x)).when(p % 7 == 0, F.concat(F.lit("\n"), x)).otherwise(x)

    x = t.texts(s, sf, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), line), "\n").alias("p"))
    x = sealed(x.withColumn("s", rp.scaffold("p"))).where(F.size("s") > 0)
    return x.select("doc_id", F.array_join("s", " | ").alias("scaffold"))


_BORDER = "(^|[^\\p{L}\\p{N}_])"


def _sql_word(e: str, word: str, new: str) -> str:
    return f"regexp_replace({e}, '{_BORDER}{word}{_BORDER.replace('^', '$', 1)}', '\\1{new}\\2', 'gi')"


POLITE = "replace(x0, ' ', '  ')"
for _word, _new in (("ton", "le"), ("ta", "la"), ("tes", "les"), ("tu", "le site")):
    POLITE = _sql_word(POLITE, _word, _new)
_THEME = f"""t0 AS (SELECT source, doc_id, pos, trim(regexp_replace(trim(regexp_replace(trim(line), '^(?:- |•+)', '')), '\\s+', ' ', 'g')) AS x0 FROM ln WHERE contains({sql_fold('line')}, 'token') OR contains({sql_fold('line')}, 'http')),
t1 AS (SELECT source, doc_id, pos, trim(regexp_replace({POLITE}, '\\s+', ' ', 'g')) AS x FROM t0 WHERE NOT regexp_matches({sql_fold('x0')}, '\\bje peux\\b|\\bje te\\b|\\boui\\b')),
t2 AS (SELECT source, list({{'s': '- ' || x, 't': {sql_tokens("'- ' || x").replace('lambda x: x', 'lambda y: y')}}} ORDER BY doc_id, pos) AS e FROM t1 WHERE x <> '' AND NOT regexp_matches({sql_fold('x')}, '\\btravaux a engager\\b|\\bcctp\\b') GROUP BY 1),
t3 AS (SELECT source, list_reduce(list_transform(e, lambda v: [v]), lambda a, v: CASE WHEN len(list_filter(a, lambda p: len(p.t) > 0 AND len(v[1].t) > 0 AND CAST(len(list_intersect(p.t, v[1].t)) AS DOUBLE) / LEAST(len(p.t), len(v[1].t)) >= 0.82)) > 0 THEN a ELSE list_concat(a, v) END) AS k FROM t2)"""


@query("theme_bullets", with_(LINES, _THEME) + "SELECT source, CAST(UNNEST(range(1, len(k) + 1)) AS INTEGER) AS rank, UNNEST(list_transform(k, lambda v: v.s)) AS line FROM t3")
def theme_bullets(s, sf):
    d = t.texts(s, sf, "documents").select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rp.theme_bullets(d, ["source"], ["doc_id", "pos"], "line", ["token", "http"])
