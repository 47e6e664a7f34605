"""Page-level rules: matching text, client text, images, captions, cards, section views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmstead.functions import text as tx
from ohmstead.operators.keyed import keep_one, sealed, top_n

# Picture file types, and equipment families by page title.
IMAGE_TYPES = [".png", ".jpg", ".jpeg", ".gif", ".webp", ".bmp"]
FAMILIES = [
    ([r"\bcta\b", "centrale de traitement d'air", "centrale de traitement d air"], "CTA / Traitement d'air"),
    (["extracteur", "extraction"], "Extracteurs / Ventilation"),
    (["groupe froid", "groupefroid"], "Production froid"),
    (["chaudi"], "Production chaud"),
    (["tgbt"], "Électrique / TGBT"),
    ([r"\btd\b", "tableau divisionnaire"], "Électrique / TD"),
    (["supervision"], "Supervision"),
    (["automate", "regulateur", "régulateur", "local autocom"], "Automates / Régulation"),
    (["gtb", "gma"], "GTB (général)"),
]
OTHER_FAMILY = "Autres équipements"
READABLE = ("heading", "paragraph", "image_ocr")


def matching_text(title: str = "title", blocks: str = "blocks") -> Column:
    """Normalised title, readable blocks and transcripts of a page."""
    parts = F.transform(blocks, lambda b: F.when(b["type"].isin(*READABLE), F.coalesce(b["text"], F.lit(""))).when(
        b["type"] == "audio", F.coalesce(b["transcript"], F.lit(""))))
    return tx.norm(F.array_join(F.concat(F.array(F.coalesce(F.col(title), F.lit(""))), F.filter(parts, lambda p: p.isNotNull())), "\n"))


def page_text(blocks: str = "blocks") -> Column:
    """Readable page text with voice notes; captions are left out."""
    def part(b: Column, words: Column, spoken: Column) -> Column:
        return F.when((words != "") & ~tx.is_caption(words), b["text"]).when(
            (words == "") & (b["type"] == "audio") & (spoken != ""), F.concat(F.lit("Note vocale : "), spoken))

    trimmed = lambda v: tx.strip(F.coalesce(v, F.lit("")))
    parts = F.transform(blocks, lambda b: tx.let(trimmed(b["text"]), lambda w: tx.let(trimmed(b["transcript"]), lambda v: part(b, w, v))))
    return tx.tidy_newlines(F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n"))


def voice_fallback(blocks: str = "blocks") -> Column:
    audio = F.filter(blocks, lambda b: b["type"] == "audio")
    spoken = F.transform(audio, lambda b: F.concat(F.lit("Note vocale : "), F.coalesce(
        F.nullif(tx.strip(F.coalesce(b["transcript"], F.lit(""))), F.lit("")), F.lit("(enregistrement présent, transcription absente)"))))
    return tx.strip(F.array_join(spoken, "\n"))


def full_text(blocks: str = "blocks") -> Column:
    return tx.let(page_text(blocks), lambda t: F.when(t == "", voice_fallback(blocks)).otherwise(t))


def image_paths(blocks: str = "blocks", assets: str | None = "images", legacy: str | None = None) -> Column:
    """Picture paths of assets, older lists and blocks, each once, in order."""
    none = F.array().cast("array<string>")
    own = F.transform(F.filter(blocks, lambda b: b["type"] == "image"), lambda b: b["path"])
    every = F.concat(*[F.coalesce(F.col(c), none) for c in (assets, legacy) if c], F.coalesce(own, none))
    trimmed = F.transform(every, lambda p: tx.strip(F.coalesce(p, F.lit(""))))
    suffix = lambda p: F.lower(F.regexp_extract(p, r"[^/.][^/]*(\.[^./]+)$", 1))
    return F.array_distinct(F.filter(trimmed, lambda p: (p != "") & suffix(p).isin("", *IMAGE_TYPES)))


def captioned_images(blocks: str = "blocks", paths: Column | None = None) -> Column:
    """Pictures with the caption that follows them, else the first line read from the picture."""
    body = ("paragraph", "text", "heading", "list", "bullet")

    def caption(bs: Column, at: Column) -> Column:
        near = F.filter(F.slice(bs, (at + 1).cast("int"), F.lit(3)), lambda b: tx.strip(F.coalesce(b["text"], F.lit(""))) != "")
        stops = F.filter(near, lambda b: b["type"].isin(*body) | tx.is_caption(b["text"]))
        explicit = tx.let(F.get(stops, F.lit(0))["text"], lambda s: F.when(tx.is_caption(s), F.nullif(tx.caption_body(s), F.lit(""))))
        read = tx.let(F.get(bs, (at - 1).cast("int"))["block_id"], lambda mine: F.filter(
            bs, lambda b: (b["image_block_id"] == mine) & (b["type"] == "image_ocr") & (tx.strip(b["text"]) != "")))
        ocr = F.substring(tx.strip(F.split_part(tx.strip(F.get(read, F.lit(0))["text"]), F.lit("\n"), F.lit(1))), 1, 120)
        return F.when(at > 0, F.coalesce(explicit, ocr, F.lit(""))).otherwise(F.lit(""))

    def captioned(bs: Column) -> Column:
        kinds = F.transform(bs, lambda b: F.when(b["type"] == "image", tx.strip(F.coalesce(b["path"], F.lit("")))))
        return tx.let(kinds, lambda ks: F.transform(image_paths(blocks) if paths is None else paths, lambda p: F.struct(
            p.alias("path"), tx.let(F.array_position(ks, p), lambda at: caption(bs, at)).alias("caption"))))

    return tx.let(F.col(blocks), captioned)


def rank_images(images: Column, keywords: Column, most: int) -> Column:
    """Caption words count three, path words one; shorter paths first among equals."""
    def entry(im: Column, i: Column, cap: Column, path: Column, ks: Column) -> Column:
        score = F.aggregate(ks, F.lit(0), lambda a, k: a + F.when(F.contains(cap, k), 3).when(F.contains(path, k), 1).otherwise(0))
        return F.struct((-score).alias("neg"), F.length(im["path"]).alias("len"), i.alias("i"), im["path"].alias("path"), im["caption"].alias("caption"))

    folded = lambda v: tx.fold(v, plus=True)
    scored = tx.let(keywords, lambda ks: F.transform(images, lambda im, i: tx.let(folded(im["caption"]), lambda cap: tx.let(
        folded(im["path"]), lambda path: entry(im, i, cap, path, ks)))))
    return F.transform(F.slice(F.array_sort(scored), 1, most), lambda e: F.struct(e["path"].alias("path"), e["caption"].alias("caption")))


def fill_captions(images: Column, fallback: Column) -> Column:
    """Pictures without a caption take the fallback."""
    return F.transform(images, lambda im: F.struct(
        im["path"].alias("path"), F.when(tx.strip(F.coalesce(im["caption"], F.lit(""))) == "", fallback).otherwise(im["caption"]).alias("caption")))


def page_cards(pages: DataFrame, max_bullets: int = 10, max_images: int = 4) -> DataFrame:
    """Title, bullets, chosen pictures and full text per page; empty pages are skipped."""
    x = sealed(pages.select("page_id", tx.strip(F.coalesce("title", F.lit("Page"))).alias("title"), full_text().alias("raw_text"), captioned_images().alias("images")))
    x = sealed(x.withColumn("bullets", tx.bullets("raw_text", max_bullets)))
    x = sealed(x.withColumn("images", rank_images(F.col("images"), tx.keywords(F.col("title"), F.col("bullets")), max_images)))
    kind = F.when(F.size("images") > 0, "CONTENT_TEXT_IMAGES").otherwise("CONTENT_TEXT")
    return x.where((F.col("bullets") != "") | (F.size("images") > 0)).select("page_id", "title", kind.alias("type"), "bullets", "images", "raw_text")


def in_section(pages: DataFrame, name: str) -> DataFrame:
    """Pages of a section, or of its group when they have one; a page without section passes. First per id."""
    grp, sec = F.coalesce("section_group", F.lit("")), F.coalesce("section", F.lit(""))
    own = F.when(grp != "", grp == name).otherwise((sec == "") | (sec == name))
    return pages.where(own)


def first_pages(pages: DataFrame, order: str) -> DataFrame:
    return keep_one(pages, ["page_id"], [order])


def family(title: Column) -> Column:
    """Equipment family by title words, first rule wins."""
    def test(n: Column, w: str) -> Column:
        return n.rlike("(?U)" + w) if w.startswith("\\b") else F.contains(n, F.lit(w))

    return tx.let(tx.norm(title), lambda n: F.coalesce(
        *[F.when(tx.any_of(test(n, w) for w in words), F.lit(name)) for words, name in FAMILIES], F.lit(OTHER_FAMILY)))


def inventory(pages: DataFrame, keys: Sequence[str], order: str, most: int = 30) -> DataFrame:
    """Pages per equipment family: count and the first titles, capped before they are gathered."""
    x = pages.withColumn("family", family(F.col("title")))
    counts = x.groupBy(*keys, "family").agg(F.count("*").alias("count"))
    first = top_n(x.select(*keys, "family", "title", order), [*keys, "family"], [F.col(order)], most)
    titles = first.groupBy(*keys, "family").agg(F.sort_array(F.collect_list(F.struct("rank", "title"))).alias("_t"))
    return counts.join(titles, [*keys, "family"]).select(*keys, "family", "count", F.transform("_t", lambda s: s["title"]).alias("titles"))


def text_parts(blocks: str = "blocks", title: str = "title") -> Column:
    """(type, text) of title, readable blocks and transcripts."""
    head = F.filter(F.array(F.struct(F.lit("title").alias("type"), F.coalesce(F.col(title), F.lit("")).alias("text"))), lambda t: t["text"] != "")
    body = F.transform(blocks, lambda b: F.when(b["type"].isin(*READABLE), F.struct(b["type"].alias("type"), tx.strip(F.coalesce(b["text"], F.lit(""))).alias("text"))).when(
        b["type"] == "audio", F.struct(F.lit("audio_transcript").alias("type"), tx.strip(F.coalesce(b["transcript"], F.lit(""))).alias("text"))))
    return F.concat(head, F.filter(body, lambda t: t.isNotNull() & (t["text"] != "")))


def page_lines(parts: Column) -> Column:
    return F.filter(F.transform(F.flatten(F.transform(parts, lambda p: tx.lines(p["text"]))), tx.strip), lambda s: s != "")


def equipment_list(pages: DataFrame, keys: Sequence[str], order: str, lines: str = "lines", words: tuple[str, str] = ("liste des equipements", "equipement")) -> DataFrame:
    """Items of the page that lists the equipment, else of the first page that speaks of it."""
    titled = F.contains(tx.fold(F.col("title")), F.lit(words[0]))
    spoken = F.contains(tx.fold(F.array_join(lines, " ")), F.lit(words[1]))
    rank = F.when(titled, 0).when(spoken, 1)
    x = sealed(pages.select(*keys, order, "page_id", lines, rank.alias("_rank")))
    best = x.where("_rank IS NOT NULL").groupBy(*keys).agg(
        F.min_by(F.struct("page_id", lines), F.struct("_rank", order)).alias("_p"))
    item = F.transform(F.col(f"_p.{lines}"), lambda s: F.regexp_replace(tx.strip(F.regexp_replace(tx.strip(s), "^[-•]+", "")), r"^[0-9]+[).-]\s*", ""))
    items = F.transform(F.filter(item, lambda s: F.length(s).between(2, 140)), lambda s: F.struct(s.alias("s"), tx.fold(s).alias("n")))
    return best.select(*keys, F.col("_p.page_id").alias("page_id"), tx.first_by_key(items).alias("items"))


def pictures_in_order(pages: DataFrame, keys: Sequence[str], order: Sequence[str], per_page: int, most: int) -> DataFrame:
    """First pictures of pages taken in a stated order, capped per page and per group."""
    capped = pages.select(*keys, *order, "page_id", "title", F.posexplode(F.slice("images", 1, per_page)).alias("pos", "path"))
    best = top_n(capped, keys, [F.col(c) for c in (*order, "pos")], most)
    return best.select(*keys, "rank", "page_id", "path", tx.short_caption("title").alias("caption"))


def preferred_first(pages: DataFrame, keys: Sequence[str], preferred: Column, order: str) -> DataFrame:
    """Pages once each, preferred ones first, then in their own order."""
    x = pages.withColumn("_tier", F.when(preferred, 0).otherwise(1))
    return x.groupBy(*keys, "page_id").agg(F.min(F.struct("_tier", order)).alias("place"))
