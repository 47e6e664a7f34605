import json

import pytest
from pyspark.sql import functions as F

from ohmstead.functions import text as tx
from ohmstead.operators import pages as pg
from ohmstead.operators import reports as rp
from ohmstead.operators import routing as rt
from ohmstead.operators import scoring as sc
from ohmstead.sources import csv as cs
from ohmstead.sources import drawings as dr
from ohmstead.sources import pages as src


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("raw,want", [
    ("cta 12 - Hall", "CTA 12  –  Hall"), ("CTA3", "CTA 3"), ("td rdc niveau 2", "Tableau divisionnaire – RDC Niveau 2"), ("TD", "Tableau divisionnaire"),
    ("vrv", "Système VRV"), ("pac", "PAC"), ("local gtb r+2", "Local GTB R+2"), ("ge ??", "Groupe électrogène"), ("", ""),
])
def test_titles(spark, raw, want):
    assert one(spark, raw, tx.normal_title) == want


def test_terms_and_slugs(spark):
    assert one(spark, "la jtb et les  GTBS au r+1", tx.fix_terms) == "la GTB et les GTB au R+1"
    assert one(spark, " État des lieux ", tx.slug) == "tat-des-lieux"
    assert one(spark, "???", lambda c: tx.slug(c, "_", "section")) == "section"
    assert one(spark, "École – Forêt", tx.plain) == "ecole – foret"
    assert one(spark, "Site — osny ", lambda c: tx.section_name(c, {"osny": "OSNY"})) == "Site - OSNY"
    assert one(spark, "Site-osny", tx.section_variants) == ["Site-osny", "Site - osny", "Site - OSNY", "Site - Osny"]


def test_greedy_distinct(spark):
    ls = ["a b c d", "a b c e x", "a b c d e", "z y", "a b c d"]
    got = spark.createDataFrame([(ls,)], "v array<string>").select(tx.greedy_distinct(F.col("v"), 0.75, 8).alias("r")).first().r
    assert got == ["a b c d", "z y"]


def test_facts_and_choice(spark):
    notes = "Titre\nNote vocale : la chaudière est en panne. Le local est humide et sombre.\npage_id=3\n- la chaudière est en panne\nok"
    df = spark.createDataFrame([(notes, "Titre", "- rien à signaler")], "n string, t string, c string")
    r = df.select(tx.facts("n", "t").alias("f"), tx.best_bullets(tx.facts("n", "t"), F.col("c")).alias("b")).first()
    assert r.f == ["la chaudière est en panne.", "Le local est humide et sombre."]
    assert r.b == "- la chaudière est en panne\n- Le local est humide et sombre"


def test_candidate_parts(spark):
    text = "Voici les puces:\nTitre: tgbt sud\n- La pompe tourne bien\n• Le filtre est sale\nContrainte: x\n- Note : ignorée"
    title, body = tx.candidate_parts("v")
    r = spark.createDataFrame([(text,)], "v string").select(title.alias("t"), body.alias("b")).first()
    assert r.t == "TGBT Sud" and r.b == "- La pompe tourne bien\n- Le filtre est sale"


def test_chat_and_requests(spark):
    assert one(spark, "- 👉 tu vois ta pompe", lambda c: tx.clean_bullets(F.array(c))) == ["- le site vois la pompe"]
    assert one(spark, "oui je peux", lambda c: tx.clean_bullets(F.array(c))) == []
    assert one(spark, "Merci de vérifier", tx.is_request) and one(spark, "Il faut voir", tx.is_request) and not one(spark, "La pompe", tx.is_request)


def test_toc(spark):
    text = "Sommaire\n1 - Contexte et objectifs 3\n2 Présentation du site  4\nMars 2024\nPage 3\n3 - CONTEXTE ET OBJECTIFS\nBla"
    assert one(spark, text, tx.toc_entries) == ["Contexte et objectifs", "Présentation du site"]


def test_chunks_overlap_without_refs(spark):
    rows = [("d", [("paragraph", "a" * 900, "p1"), ("heading", "Contexte", "p2"), ("paragraph", "b" * 900, "p2"), ("paragraph", "c" * 900, "p3")])]
    df = spark.createDataFrame(rows, "doc_id string, blocks array<struct<type:string,text:string,ref:string>>")
    out = rp.chunked(df, "doc_id").orderBy("chunk_id").collect()
    assert [r.refs for r in out] == [["p1", "p2"], ["p2"], ["p3"]]
    assert [r.part for r in out] == [1, 1, 1]
    assert out[1].text.startswith("a" * 140) and out[1].text.endswith("b" * 900) and len(out[0].text) == 909


def test_caption_stops_at_body_text(spark):
    blk = lambda i, t, text=None, path=None, img=None: (f"b{i:05d}", t, text, path, None, img, None, i)
    good = [blk(1, "image", path="a.png"), blk(2, "paragraph", "Légende: la pompe"), blk(3, "paragraph", "corps")]
    stop = [blk(1, "image", path="a.png"), blk(2, "paragraph", "corps"), blk(3, "paragraph", "Légende: non"), blk(4, "image_ocr", "lu\nplus", img="b00001")]
    df = spark.createDataFrame([(0, good, ["a.png"]), (1, stop, ["a.png", "x.pdf"])], f"k int, blocks array<{src.BLOCK}>, images array<string>")
    got = [r.c for r in df.orderBy("k").select(F.transform(pg.captioned_images(), lambda i: i["caption"]).alias("c")).collect()]
    assert got == [["la pompe"], ["lu"]]


def test_rule_classes(spark):
    rules = [sc.Rule("1", "A", "x", (("C", 1), ("B", 2), ("A", 3))), sc.Rule("2", "B", "y", ()), sc.Rule("3", "C", "z", (("C", 1),))]
    levels = spark.createDataFrame([("r", "1", 2), ("r", "2", None)], "report string, rule_id string, level int")
    g = {r.grp: r for r in sc.group_classes(sc.judged(levels, rules, ["report"]), ["report"]).collect()}
    assert (g["A"].achieved_class, g["B"].achieved_class, g["C"].achieved_class) == ("B", "A", "D")
    assert g["A"].blockers_A == 1 and g["A"].blockers_B == 0


def test_gate(spark):
    df = spark.createDataFrame([("État des lieux GTB", "Classe B"), ("Scoring GTB actuel", "des travaux"), ("Scoring projeté", "classe"), ("autre", "iso")], "n string, t string")
    got = [r.s for r in df.select(sc.gate(F.col("n"), F.col("t"))["status"].alias("s")).collect()]
    assert got == ["rejected", "warning", "passed", "passed"]


def test_slots_merge_by_similarity(spark):
    ty = rt.ReportType("T", ("a",), (), (rt.Bucket("ONE", 1, ("a", "b")), rt.Bucket("TWO", 1, ("c", "d")), rt.Bucket("THREE", 1, ("c", "z"))))
    sel = spark.createDataFrame([("s", "T", "ONE", 1, 3.0, 1), ("s", "T", "TWO", 1, 2.0, 2), ("s", "T", "THREE", 1, 1.0, 3)], "section string, report_type string, bucket string, part int, score double, rank int")
    routed = spark.createDataFrame([("s", b, str(i)) for b in ("ONE", "TWO", "THREE") for i in range(2)], "section string, bucket string, page_id string")
    out = {r.slot: r.buckets for r in rt.build_slots(sel, routed, ["section"], (ty,)).collect()}
    assert out == {"MP01_S01": ["ONE"], "MP01_S02": ["THREE", "TWO"]}


def test_evidence_is_whole_without_caps(spark):
    text = "the " + "long " * 300
    parts = spark.createDataFrame([("p", "T", [("paragraph", f"{i} {text}") for i in range(20)] + [("paragraph", f"the {i}?") for i in range(40)])], "page_id string, title string, parts array<struct<type:string,text:string>>")
    got = parts.select(rt.snippets(F.col("parts"), ["the"]).alias("a"), rt.snippets(F.col("parts"), ["the"], 14, 900).alias("b")).first()
    assert [r.text for r in got.a] == [f"{i} {text}".strip() for i in range(20)] + [f"the {i}?" for i in range(40)]
    assert [r.text for r in got.b] == [f"{i} {text}".strip()[:900] for i in range(14)]
    routed = spark.createDataFrame([("s", "B", "p", 1, 9)], "section string, bucket string, page_id string, rank int, hits int")
    block = rt.evidence_block(routed, parts, ["section"], [rt.Bucket("B", 1, ("the",))]).first().evidence
    assert block.count("- Question: ") == 40 and block.count("long") == 20 * 300
    assert rt.evidence_block(routed, parts, ["section"], [rt.Bucket("B", 1, ("the",))], 60, 900, 30).first().evidence.count("- Question: ") == 30


def test_pack_and_digest_are_whole_without_caps(spark):
    rows = [("r", 1, i, "p", f"{'Contexte' if i % 2 else 'Rien'} est {'x' * 300} {i}", str(i // 60), "t") for i in range(1800)]
    items = spark.createDataFrame(rows, "r string, doc_id int, pos int, kind string, text string, page_id string, page_title string")
    counts = lambda df: {k["topic"]: k["count"] for k in df.groupBy("topic").count().collect()}
    assert counts(rp.evidence_pack(items, ["r"], ["Contexte site"])) == {None: 900, "Contexte site": 900}
    assert counts(rp.evidence_pack(items, ["r"], ["Contexte site"], 12, 40)) == {None: 40, "Contexte site": 12}
    assert counts(rp.evidence_pack(items, ["r"], ["Contexte site"], 50, 40)) == {None: 40, "Contexte site": 50}
    assert counts(rp.evidence_pack(items, ["r"], ["Contexte site"], 12)) == {None: 900, "Contexte site": 12}
    assert sorted(r.line for r in rp.digest(items, ["r"], "doc_id").collect()) == sorted(x[4] for x in rows)
    cut = rp.digest(items, ["r"], "doc_id", 20, 12, 240).collect()
    assert len(cut) == 240 and {len(r.line) for r in cut} == {240}


def test_greedy_rounds_equal_plain_greedy(spark):
    import random

    rnd = random.Random(4)
    words = "alpha beta gamma delta eps zeta eta theta".split()
    rows = [(g, i, " ".join(rnd.choices(words, k=rnd.randint(1, 4)))) for g in "ab" for i in range(60)]

    def plain(ls):
        out = []
        for s in ls:
            t = set(s.split())
            if len(out) < 6 and not any(len(t & p) / min(len(t), len(p)) >= 0.8 for p, _ in out):
                out.append((t, s))
        return [s for _, s in out]

    df = spark.createDataFrame(rows, "g string, i int, line string").repartition(5)
    got = rp.greedy_by_rounds(df, ["g"], ["i"], "line", 0.8, 6).orderBy("g", "rank").collect()
    for g in "ab":
        assert [r.line for r in got if r.g == g] == plain([s for k, _, s in rows if k == g])


def brute_distinct(rows, threshold):
    out = {}
    for g, _, s in sorted(rows, key=lambda r: r[1]):
        t = set((s or "").split())
        if all(len(t & p) < threshold * min(len(t), len(p)) or not (t and p) for p, _ in out.setdefault(g, [])):
            out[g].append((t, s))
    return {g: [s for _, s in v] for g, v in out.items()}


def test_near_repeats_of_whole_groups(spark):
    """A hot group, a family of like lines, chains, null keys and lines, blank lines; in batches of several sizes."""
    import random

    rnd = random.Random(9)
    names = [f"w{i}" for i in range(40)]
    rows = [("hot", i, " ".join(rnd.choices(names, k=rnd.randint(1, 9)))) for i in range(400)]
    rows += [("hot", 1000 + i, f"this line of a family has number n{i}") for i in range(200)]
    rows += [("chain", i, " ".join(f"c{j}" for j in range(i, i + 10))) for i in range(60)]
    rows += [(None, 1, "one two"), (None, 2, "two one"), (None, 3, None), (None, 4, ""), ("one", 7, "same"), ("one", 8, "same")]
    df = spark.createDataFrame(rows, "g string, i int, line string").repartition(6)
    for threshold, batch in ((0.82, 16), (0.8, 512)):
        got = rp.greedy_by_rounds(df, ["g"], ["i"], "line", threshold, batch=batch).orderBy("g", "rank").collect()
        want = brute_distinct(rows, threshold)
        assert {g: [r.line for r in got if r.g == g] for g in want} == want
        assert all([r.rank for r in got if r.g == g] == list(range(1, len(want[g]) + 1)) for g in want)
    assert rp.greedy_by_rounds(df.limit(0), ["g"], ["i"], "line", 0.8).count() == 0


def test_group_tree(spark, monkeypatch):
    """Repeated ids, loops, missing parents, null names; rounds of a long chain."""
    rows = [("a", None, "A"), ("b", "a", "B"), ("c", "b", None), ("d", "c", "D"), ("e", "b", "E"), ("e", "a", "E2"), ("a", "d", "A"),
            ("x", "y", "X"), ("y", "x", "Y"), ("z", "y", "Z"), ("s", "s", "S"), ("m", "none", "M"), ("n", "m", "N"), (None, "a", "O")]
    df = spark.createDataFrame(rows, "group_id string, parent_id string, name string")
    got = {r.group_id: (r.path, r.depth) for r in sc.group_paths(df).collect()}
    assert got == {"a": ("A", 1), "b": ("A / B", 2), "c": ("A / B", 3), "d": ("A / B / D", 4), "e": ("A / E2", 2)}
    assert sc.group_paths(df.limit(0)).count() == 0
    made, cut = [], sc.cut_lineage
    monkeypatch.setattr(sc, "cut_lineage", lambda d: made.append(1) or cut(d))
    chain = spark.range(10_000).selectExpr("id AS group_id", "nullif(id, 0) - 1 AS parent_id", "CAST(id AS string) AS name")
    assert sc.group_depths(chain).where("depth = group_id + 1").count() == 10_000
    assert len(made) <= 2 + 15
    short = {r.group_id: r.path for r in sc.group_paths(chain.where("group_id < 300")).collect()}
    assert short == {i: " / ".join(map(str, range(i + 1))) for i in range(300)}


HTML = """<html><head><title>T &amp; x</title><script>p("<p>no</p>")</script></head><body><h2> Un <b>deux</b></h2>
<p>a<br>b<!-- c -->d</p><p>same</p><p>same</p><ul><li><p>item</p></li></ul><img src="i.png"><object data="s.mp3"></object><p> </p><style>p{}</style></body></html>"""


def test_html_blocks(spark):
    df = src.html_pages(spark.createDataFrame([("1", HTML)], "page_id string, html string"))
    r = df.first()
    assert r.title == "T & x"
    assert [(b.type, b.text or b.path) for b in r.blocks] == [
        ("heading", "Un deux"), ("paragraph", "a b d"), ("paragraph", "same"), ("paragraph", "- item"), ("paragraph", "item"), ("image", "i.png"), ("audio", "s.mp3")]
    assert r.blocks[0].level == 2 and r.blocks[6].block_id == "b00007" and r.images == ["i.png"]


def test_markdown_without_front_matter(spark):
    md = "[[IMAGE OCR]] seul\n\n# H\n![](a.png)\n[IMAGE OCR] lu\n[[AUDIO RECORDING]] [Play](s.mp3)"
    r = src.markdown_pages(spark.createDataFrame([("f", md)], "stem string, md string"), "md", "stem").first()
    assert r.page_id == "f" and [b.type for b in r.blocks] == ["paragraph", "heading", "image", "image_ocr", "audio"]
    assert r.blocks[3].image_block_id == "b00003" and r.blocks[3].source_line == 5


def test_tables_from_text_files(spark, tmp_path):
    (tmp_path / "hist.csv").write_text("﻿siteId;dtUpdate;v\n1;2020-01-02 10:00:00;NULL\nx;2020-01-02;3\n2;bad;4\n2;2020-01-05;4\n", encoding="utf-8")
    df = cs.with_keys(cs.read_table(spark, str(tmp_path / "hist.csv")), ["siteId"])
    assert [(r.siteId, str(r.date), r.v) for r in df.orderBy("siteId").collect()] == [(1, "2020-01-02", None), (2, "2020-01-05", "4")]
    (tmp_path / "u.csv").write_text("id,name\n1,Bve\nx,Bad\n3,Cvc\n")
    assert [r.id for r in cs.read_lookup(spark, str(tmp_path / "u.csv")).orderBy("id").collect()] == [1, 3]
    (tmp_path / "one.csv").write_text("only\n1\n")
    with pytest.raises(ValueError):
        cs.read_table(spark, str(tmp_path / "one.csv"))
    (tmp_path / "sites.csv").write_text("ID,Surface,Activité,Contexte\n1,,A,\n1,250,B,c\n2,9,,\n")
    got = {r.siteId: (r.surface_m2, r.activity, r.context) for r in cs.load_sites(spark, str(tmp_path / "sites.csv")).collect()}
    assert got == {1: (250.0, "A", "c"), 2: (9.0, None, None)}


def test_packs_and_sinks(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"page_id": "a", "title": "A", "blocks": [{"block_id": "b1", "type": "paragraph", "text": "x"}], "images": ["i.png"], "audio": []}))
    (folder / "b.json").write_text("{broken")
    pages = src.read_page_packs(spark, str(folder))
    assert [r.page_id for r in pages.collect()] == ["a"]
    cs.write_page_index(pages, str(tmp_path / "index"))
    assert spark.read.json(str(tmp_path / "index")).first().num_images == 1
    (tmp_path / "c.jsonl").write_text('{"doc_id":"d","chunk_id":"c1","text":"t","refs":["p1"],"part":1}\nnope\n')
    chunks = src.read_chunks(spark, str(tmp_path / "c.jsonl"))
    assert chunks.count() == 1
    src.write_chunks(chunks, str(tmp_path / "chunks"))
    assert src.read_chunks(spark, str(tmp_path / "chunks")).first().refs == ["p1"]
    ents = spark.createDataFrame([(1, [(0.0, 0.0)], "L")], "row_id int, points array<struct<x:double,y:double>>, layer string")
    cs.write_entities(ents, str(tmp_path / "ents"))
    assert spark.read.csv(str(tmp_path / "ents"), header=True).columns == ["row_id", "layer"]
    cs.write_scores(spark.createDataFrame([(1, 2.0)], "siteId int, yhat double"), "forecast", "site", "waterM3", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "forecast")).first().target == "waterM3"


def test_picture_status(spark, tmp_path):
    (tmp_path / "ok.png").write_bytes(b"\x89PNG\r\n\x1a\n0000")
    (tmp_path / "bad.png").write_bytes(b"\xff\xd8\xff0000000000")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    wanted = spark.createDataFrame([("img/ok.png",), ("img/bad.png",), ("img/none.png",)], "path string")
    assert {r.path: r.status for r in sc.picture_status(wanted, files).collect()} == {"img/ok.png": "ok", "img/bad.png": "format_mismatch", "img/none.png": "not_found"}


def test_geometry(spark):
    sq = [(0.0, 0.0), (3.0, 0.0), (3.0, 4.0)]
    df = spark.createDataFrame([(1, sq, True, "LWPOLYLINE"), (2, sq, False, "LINE"), (3, [], False, "INSERT")], "row_id int, points array<struct<x:double,y:double>>, closed boolean, entity_type string")
    g = {r.row_id: r for r in dr.with_geometry(df).collect()}
    assert (g[1].length, g[1].area, g[1].bbox_diag) == (12.0, 6.0, 5.0) and (g[2].length, g[2].area) == (7.0, 0.0) and g[3].length == 0.0
    c = spark.range(1).select(dr.circle_points(F.lit(0.0), F.lit(0.0), F.lit(2.0)).alias("p")).first().p
    assert len(c) == 96 and c[0].x == pytest.approx(2.0) and c[-1].x == pytest.approx(2.0)
