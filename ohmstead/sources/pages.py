"""Page packs: HTML and markdown pages as block tables, JSON packs, manifests, note adapters."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmstead.functions import text as tx
from ohmstead.operators.keyed import sealed
from ohmstead.sources.tables import texts

BLOCK = "struct<block_id:string,type:string,text:string,path:string,transcript:string,image_block_id:string,level:int,source_line:int>"
PAGE_SCHEMA = f"page_id string, title string, notebook string, section string, section_group string, section_path string, blocks array<{BLOCK}>, images array<string>, audio array<string>"
DOC_PACK_SCHEMA = "doc_id string, file string, file_type string, outline array<struct<title:string,ref:string,suggested_part:int>>"
CHUNK_SCHEMA = "doc_id string, chunk_id string, text string, refs array<string>, part int"

_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_SILENT = {"script", "style", "template", "rt", "rp"}


class _Blocks(HTMLParser):
    """Headings, paragraphs, list items, images and objects in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.open: list[tuple[str, dict | None]] = []
        self.pending: list[str] = []
        self.body_at: int | None = None
        self.title = ""

    def flush(self) -> None:
        piece = "".join(self.pending).strip()
        self.pending = []
        names = {n for n, _ in self.open}
        if piece and not names & _SILENT:
            if self.open and self.open[-1][0] == "title" and not self.title:
                self.title = piece
            for _, block in self.open:
                if block is not None:
                    block["parts"].append(piece)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.flush()
        block = None
        given = dict(attrs)
        if tag == "body" and self.body_at is None:
            self.body_at = len(self.found)
        if tag in _HEADINGS or tag in ("p", "li"):
            block = {"tag": tag, "parts": []}
            self.found.append(block)
        elif tag == "img":
            self.found.append({"tag": tag, "src": given.get("src") or ""})
        elif tag == "object":
            self.found.append({"tag": tag, "src": given.get("data") or given.get("src") or ""})
        if tag not in _VOID:
            self.open.append((tag, block))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()

    def blocks(self) -> list[dict]:
        out = []
        for b in self.found[self.body_at or 0:]:
            if "src" in b:
                if b["src"]:
                    out.append({"type": "image" if b["tag"] == "img" else "audio", "text": None, "path": b["src"], "level": None})
                continue
            words = " ".join(b["parts"])
            if not words:
                continue
            if b["tag"] in _HEADINGS:
                out.append({"type": "heading", "text": words, "path": None, "level": int(b["tag"][1])})
            else:
                out.append({"type": "paragraph", "text": f"- {words}" if b["tag"] == "li" else words, "path": None, "level": None})
        return out


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        titles, blocks = [], []
        for html in pdf["html"]:
            p = _Blocks()
            p.feed(html or "")
            p.close()
            p.flush()
            titles.append(p.title)
            blocks.append(p.blocks())
        yield pd.DataFrame({"page_id": pdf["page_id"].astype(str), "title": titles, "raw": blocks})


def without_repeats(blocks: Column) -> Column:
    """Blocks that differ from the one just before."""
    return F.filter(blocks, lambda b, i: (i == 0) | ~b.eqNullSafe(F.get(blocks, i - 1)))


def numbered(blocks: Column) -> Column:
    """Sequential block ids."""
    def one(b: Column, i: Column) -> Column:
        return F.struct(
            F.format_string("b%05d", i + 1).alias("block_id"), b["type"].alias("type"), b["text"].alias("text"), b["path"].alias("path"),
            F.lit(None).cast("string").alias("transcript"), F.lit(None).cast("string").alias("image_block_id"),
            b["level"].alias("level"), (i + 1).alias("source_line"),
        )

    return F.transform(blocks, one).cast(f"array<{BLOCK}>")


def html_pages(pages: DataFrame) -> DataFrame:
    """(page_id, html) to page packs; only the HTML walk itself runs in Python."""
    raw = pages.select(F.col("page_id").cast("string").alias("page_id"), "html").mapInPandas(
        _parse_batches, "page_id string, title string, raw array<struct<type:string,text:string,path:string,level:int>>"
    )
    x = sealed(raw.select("page_id", "title", numbered(without_repeats(F.col("raw"))).alias("blocks")))
    return x.select(
        "page_id", "title",
        "blocks",
        F.transform(F.filter("blocks", lambda b: b["type"] == "image"), lambda b: b["path"]).alias("images"),
        F.transform(F.filter("blocks", lambda b: b["type"] == "audio"), lambda b: b["path"]).alias("audio"),
    )


# ---- markdown ------------------------------------------------------------------------------

_OCR = r"\[?\[IMAGE OCR\]\]?\s*(.*)$"
_AUDIO = r"(?i)\[\[AUDIO RECORDING\]\]\s*\[Play\]\(([^)]+)\)"
_IMAGE = r"!\[\]\(([^)]+)\)"
_HEAD = r"^(#{1,6})\s+(.*)$"
META_KEYS = ("page_id", "title", "notebook", "section", "section_group", "section_path")


def markdown_pages(df: DataFrame, text: str, stem: str) -> DataFrame:
    """Front matter and typed blocks of markdown pages, all within the row of the page."""
    fence = r"^\s*---\s*$"
    x = df.withColumn("_all", tx.lines(text))
    closes = F.array_position(F.transform(F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(1))), lambda s: s.rlike(fence)), True)
    x = x.withColumn("_close", F.when(F.get("_all", F.lit(0)).rlike(fence), closes).otherwise(F.lit(0)))
    head = F.when(F.col("_close") > 1, F.slice("_all", F.lit(2), (F.col("_close") - 1).cast("int"))).otherwise(F.array().cast("array<string>"))
    body = F.when(F.col("_close") > 0, F.slice("_all", (F.col("_close") + 2).cast("int"), F.size("_all"))).otherwise(F.col("_all"))
    x = x.withColumn("_head", F.filter(head, lambda s: F.contains(s, F.lit(":")))).withColumn("_body", body)

    def meta(key: str) -> Column:
        mine = F.filter("_head", lambda s: tx.strip(F.split_part(s, F.lit(":"), F.lit(1))) == key)
        last = F.try_element_at(mine, F.lit(-1))
        return F.nullif(tx.strip(last.substr(F.instr(last, ":") + 1, F.length(last))), F.lit(""))

    def kind_of(ln: Column) -> Column:
        return (
            F.when(tx.strip(ln) == "", None).when(ln.rlike(_HEAD), "heading").when(ln.rlike(_AUDIO), "audio")
            .when(ln.rlike(_IMAGE), "image").when(ln.rlike(_OCR), "image_ocr").otherwise("paragraph")
        )

    def typed(ln: Column, kind: Column, i: Column) -> Column:
        ref = F.when(kind == "audio", tx.strip(F.regexp_extract(ln, _AUDIO, 1))).when(kind == "image", tx.strip(F.regexp_extract(ln, _IMAGE, 1)))
        words = (
            F.when(kind == "heading", tx.strip(F.regexp_extract(ln, _HEAD, 2)))
            .when(kind == "image_ocr", tx.strip(F.regexp_extract(ln, _OCR, 1))).when(kind == "paragraph", tx.strip(ln))
        )
        level = F.when(kind == "heading", F.length(F.regexp_extract(ln, _HEAD, 1)))
        return F.struct(kind.alias("type"), words.alias("text"), tx.strip(ln).alias("line"), ref.alias("path"), level.alias("level"), (i + 1).alias("source_line"))

    def block(b: Column, i: Column, before: Column) -> Column:
        ocr, loose = (b["type"] == "image_ocr") & before.isNotNull(), (b["type"] == "image_ocr") & before.isNull()
        return F.struct(
            F.format_string("b%05d", i + 1).alias("block_id"), F.when(loose, "paragraph").otherwise(b["type"]).alias("type"),
            F.when(loose, b["line"]).otherwise(b["text"]).alias("text"), b["path"].alias("path"), F.lit(None).cast("string").alias("transcript"),
            F.when(ocr, F.format_string("b%05d", before + 1)).alias("image_block_id"), b["level"].alias("level"), b["source_line"].alias("source_line"),
        )

    def linked(all_: Column) -> Column:
        at = F.filter(F.transform(all_, lambda b, i: F.when(b["type"] == "image", i)), lambda v: v.isNotNull())
        return tx.let(at, lambda pos: F.transform(all_, lambda b, i: tx.let(F.array_max(F.filter(pos, lambda p: p < i)), lambda before: block(b, i, before))))

    one = F.transform("_body", lambda s, i: tx.let(F.rtrim(s, F.lit("\n\r ")), lambda ln: tx.let(kind_of(ln), lambda kind: typed(ln, kind, i))))
    found = F.filter(one, lambda b: b["type"].isNotNull())
    x = x.withColumn("blocks", tx.let(found, linked).cast(f"array<{BLOCK}>"))
    keep = [c for c in df.columns if c not in META_KEYS and c != text]
    x = sealed(x.select(*dict.fromkeys([*keep, stem]), "_head", "blocks"))
    return sealed(x.select(
        *keep, F.coalesce(meta("page_id"), F.col(stem).cast("string")).alias("page_id"), F.coalesce(meta("title"), F.col(stem).cast("string")).alias("title"),
        *[meta(k).alias(k) for k in META_KEYS[2:]], "blocks",
        F.transform(F.filter("blocks", lambda b: b["type"] == "image"), lambda b: b["path"]).alias("images"),
        F.transform(F.filter("blocks", lambda b: b["type"] == "audio"), lambda b: b["path"]).alias("audio"),
    ))


# ---- packs on disk -------------------------------------------------------------------------


def read_page_packs(spark: SparkSession, path: str) -> DataFrame:
    """A folder of JSON page packs; unreadable files are skipped."""
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", True).option("mode", "DROPMALFORMED").json(path).where("page_id IS NOT NULL OR title IS NOT NULL")


def read_doc_packs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOC_PACK_SCHEMA).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of chunks; bad lines are skipped."""
    return spark.read.schema(CHUNK_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").json(path)


def from_manifest(manifest: DataFrame, pages: DataFrame) -> DataFrame:
    """Manifest ids in order, each once, with their page or an empty placeholder."""
    ids = manifest.select(tx.strip(F.col("page_id").cast("string")).alias("page_id"), "seq").where("page_id <> ''")
    ids = ids.groupBy("page_id").agg(F.min("seq").alias("seq"))
    x = ids.join(pages, "page_id", "left")
    return x.withColumn("title", F.coalesce("title", "page_id")).withColumn("blocks", F.coalesce("blocks", F.array().cast(f"array<{BLOCK}>")))


# ---- adapters ------------------------------------------------------------------------------


def report_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as exported markdown pages: every line gets a role by its position.

    Recordings and pictures stand on lines of their own before a line of text, so all text is kept.
    """
    d = texts(spark, sf, "documents").where(tx.strip("text") != "")
    pid = F.col("doc_id").cast("string")

    def line(s: Column, i: Column) -> Column:
        k = i % 8
        n = (i + 1).cast("string")
        return (
            F.when(tx.strip(s) == "", F.lit(""))
            .when(k == 0, F.concat(F.lit("## "), s))
            .when(k == 3, F.concat(F.lit("[[AUDIO RECORDING]] [Play](audio/"), pid, F.lit("_"), n, F.lit(".mp3)\n"), s))
            .when(k == 5, F.concat(F.lit("![](img/"), pid, F.lit("_"), n, F.lit(".png)\n"), s))
            .when(k == 6, F.concat(F.lit("[[IMAGE OCR]] "), s))
            .when(k == 7, F.concat(F.lit("Légende: "), s))
            .otherwise(s)
        )

    front = F.concat(
        F.lit("---\npage_id: "), pid, F.lit("\ntitle: Note "), pid, F.lit("\nnotebook: "), F.col("lang"), F.lit("\nsection: "), F.col("source"), F.lit("\n---\n")
    )
    body = F.array_join(F.transform(F.split("text", "\n"), line), "\n")
    return d.select("doc_id", F.concat(front, body).alias("md"))


def note_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Block table of the notes; the transcript of a recording is its page title and place."""
    x = markdown_pages(report_markdown(spark, sf), "md", "doc_id")
    spoken = F.transform("blocks", lambda b: b.withField("transcript", F.when(
        (b["type"] == "audio") & (b["source_line"] % 16 != 12), F.concat(F.lit("enregistrement "), b["source_line"].cast("string")))))
    return x.withColumn("blocks", spoken)
