"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ohmstead.llm import bitpack, chat, common, html, jaccard, mix, pack, pii, rules, secrets, spans, tokens, topk

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, key string, row string, kinds string, _m string, target string, copies string"
LONG = "word " * 60_000 + "x" * 200_000 + " a@b.co " + "9" * 100_000 + " " + "1.2.3.4 " * 2_000


@pytest.fixture(scope="module")
def odd(spark):
    more = ("c1", "c2", "c3", "c4", "c5", "c6", "c7")
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "same words here again and again and again"), (5, "same words here again and again and again"),
             (None, "no id at all but some words"), (None, None), (6, "émile ☕ 日本語 password=hunter2hunter2 me@x.org"), (7, "a  b   c\n\n\nd")]
    return spark.createDataFrame([(i, t, None, random.Random(str(i)).choice([None, "s1", "s2"]), None if t is None else len(t), *more) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_rules_edges(odd, none):
    got = rules.judge(odd).select("row.*", *[F.col(c).alias(f"out_{c}") for c in rules.MEASURES], "base_failed", "kept")
    assert got.count() == 10 and rules.judge(none).count() == 0
    by = {(r.doc_id, r.text is None): r for r in got.collect()}
    assert by[1, True].out_n_words == 0 and by[1, True].base_failed and not by[1, True].kept
    assert by[4, False].out_n_words == 62_003 and by[4, False].base_failed


def test_rules_and_stages_with_odd_column_names(odd):
    named = odd.withColumnRenamed("key", "a column, with: marks").withColumnRenamed("kinds", "a.b")
    got = rules.judge(named).select("row.*")
    assert got.columns == named.columns and got.count() == named.count()
    for stage in (jaccard.one_each, pii.redact, mix.emit):
        out = stage(named)
        assert out.columns == named.columns and out.collect()
    pieces = named.selectExpr("coalesce(doc_id, 0L) AS doc_id", "0 AS piece", "length(coalesce(text, '')) % 2000 + 1L AS length", "1L AS ids_crc32", "`a column, with: marks`", "struct(1 AS `x y`) AS s")
    assert pack.pack(pieces).count() == named.count()


def test_rules_hosts(spark):
    """A bad host loses its soft failures only; a good host keeps even those."""
    clean = " ".join(f"word{i}" for i in range(40))
    odd = clean + " # # # # # # # #"
    rows = [(i, odd if i % 10 else clean, "bad") for i in range(200)] + [(i, clean if i % 50 else odd, "good") for i in range(200, 1200)]
    got = rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), columns=["doc_id", "source"]).select("row.*", "kept")
    out = {(s, k): n for s, k, n in got.groupBy("source", "kept").count().collect()}
    assert out == {("bad", True): 20, ("bad", False): 180, ("good", True): 1000}


def test_repeated_words_by_hand():
    words = [w.encode() for w in "a b c d e f g h x a b c d e f g h y".split()]
    assert rules.repeated_words(words) == 16 and rules.repeated_words(words[:8]) == 0
    assert rules.repeated_words([b"z"] * 20) == 20


def test_pii_edges(odd, none):
    got = pii.detect(odd).select("row.doc_id", "row.text", "email", "ip", "card").collect()
    assert len(got) == 10 and pii.detect(none).count() == 0
    long = next(r for r in got if r.doc_id == 4)
    assert len(long.email) == 1 and len(long.ip) == 2000 and LONG[long.email[0].start : long.email[0].end] == "a@b.co"
    clean = pii.redact(odd)
    assert clean.columns == odd.columns
    texts = {r.doc_id: r for r in clean.where("doc_id in (1, 4, 6)").collect()}
    assert texts[1].text is None and texts[6].text.endswith("[EMAIL]") and texts[6].n_chars == len(texts[6].text) and "[IP] [IP]" in texts[4].text


def test_pii_added_kinds(spark):
    text = "my iban GB82WEST12345698765432 and GB82WEST12345698765433, ssn 123-45-6789, part 123-45-6789" + " " * 80 + "321-54-9876"
    r = pii.detect(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [text[s.start : s.end] for s in r.iban] == ["GB82WEST12345698765432"]
    assert [text[s.start : s.end] for s in r.ssn] == ["123-45-6789", "123-45-6789"]


def test_pii_grouped_ibans_and_words_after(spark):
    ibans = ["DE89 3704 0044 0532 0130 00", "ES91-2100-0418-4502-0005-1332", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    texts = [f"{v} {tail}" for v in ibans for tail in ("BIC COBADEFF", "PLUS 2023", "00", "")] + ["DE89 3704 0044 0532 0130 01 DE89  3704 0044 0532 0130 00 ADE89 3704 0044 0532 0130 00"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [s.value for s in r.iban] for r in pii.detect(docs).select("row.doc_id", "iban").collect()}
    assert [got[i] for i in range(17)] == [[v] for v in ibans for _ in range(4)] + [[]]
    assert [r.text for r in pii.redact(docs.where("doc_id < 4")).orderBy("doc_id").collect()] == ["[IBAN] BIC COBADEFF", "[IBAN] PLUS 2023", "[IBAN] 00", "[IBAN] "]
    ssn = spark.createDataFrame([(1, "123-45-6789 (SSN)"), (2, "123-45-6789" + " " * 60 + "SSN")], "doc_id bigint, text string")
    assert {r.doc_id: len(r.ssn) for r in pii.detect(ssn).select("row.doc_id", "ssn").collect()} == {1: 1, 2: 0}


def test_masking_overlaps(spark):
    df = spark.createDataFrame([("mail 4111111111111111@x.org now", )], "text string")
    assert pii.redact(df).first().text == "mail [EMAIL] now" or "4111" not in pii.redact(df).first().text


def test_secret_edges(odd, none):
    got = secrets.scan(odd).select("row.doc_id", "row.key", "assign", "hex").collect()
    assert len(got) == 10 and secrets.scan(none).count() == 0 and {r.key for r in got} == {"c2"}
    six = next(r for r in got if r.doc_id == 6)
    assert [(s.start, s.value) for s in six.assign] == [(12, "password=hunter2hunter2")]


def test_secret_no_retry(spark):
    """A dropped match uses up its characters."""
    df = spark.createDataFrame([("token: secret:abcdefgh12 token=ab secret=abcdefgh",)], "text string")
    assert [s.value for s in secrets.scan(df).first().assign] == ["secret=abcdefgh"]


def test_mix_edges(spark, odd, none):
    got = mix.mix(odd).select("row.doc_id", "row.size", F.col("size").alias("words"), "source_size", "target", "copies", "taken").collect()
    assert len(got) == 10 and mix.mix(none).count() == 0 and {r.size for r in got} == {"c1"}
    assert all(r.taken == r.copies * r.words and r.copies <= 2 for r in got)
    assert mix.emit(odd).columns == odd.columns and mix.emit(none).count() == 0


def test_mix_near_target(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), "ABCD"[i % 4] if i % 5 else None) for i in range(20_000)], "doc_id bigint, text string, source string")
    got = mix.mix(df).groupBy("row.source", "target", "source_size").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) < 0.05 * r.target for r in got)
    assert abs(sum(r.target for r in got) - 1.5 * sum(r.source_size for r in got)) < 1
    assert all(r.target <= 2 * r.source_size + 1e-6 for r in got)


def brute_bins(lengths, capacity):
    """Least bins by search over small inputs."""
    best = len(lengths)

    def go(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= rest[0] and bins[i] not in bins[:i]:
                go(rest[1:], [*bins[:i], bins[i] - rest[0], *bins[i + 1 :]])
        go(rest[1:], [*bins, capacity - rest[0]])

    go(sorted(lengths, reverse=True), [])
    return best


def test_bounds_hold():
    rnd = random.Random(5)
    for _ in range(200):
        lengths = np.array([rnd.randint(1, 30) for _ in range(rnd.randint(1, 9))])
        least = brute_bins(lengths.tolist(), 30)
        order = np.sort(lengths)[::-1]
        bins, offsets, free = pack.best_fit(order, 30)
        assert pack.lower_bound(lengths, 30) <= least <= len(free)
        assert all((order[bins == b].sum() == 30 - free[b]) for b in range(len(free)))


def check_packing(rows, capacity):
    df = pd.DataFrame([r.asDict() for r in rows])
    for _, seq in df.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        ends = (seq.offset + seq.length).tolist()
        assert seq.offset.tolist() == [0, *ends[:-1]] and ends[-1] <= capacity
    return df


def test_pack_edges(spark, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = pack.pack(pack.cut(odd, path, "words", capacity=64), capacity=64, group_pieces=50).collect()
    df = check_packing(got, 64)
    assert df[df.doc_id == 2].length.tolist() == [1] and len(df[df.doc_id == 5]) == 2
    assert pack.pack(pack.cut(none, path, "words")).count() == 0


def test_pack_exchanges(spark):
    """Small groups leave gaps; exchange comes near the bound of all pieces."""
    rnd = random.Random(3)
    rows = [(i, 0, 0, rnd.randint(1, 2048), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    out = check_packing(pack.pack(df, group_pieces=500).collect(), 2048)
    assert sorted(out.doc_id) == list(range(3000))
    bound = pack.lower_bound(np.array([r[3] for r in rows]), 2048)
    assert out.sequence_id.nunique() <= bound * 1.02 + 1


def test_bits():
    rnd = np.random.default_rng(1)
    for bits in (1, 3, 7, 8, 11, 16, 17, 24, 32):
        ids = rnd.integers(0, 1 << bits, 5001, dtype=np.uint64).astype("<u4")
        assert (bitpack.unpack(bitpack.pack(ids, bits), bits, len(ids)) == ids).all()
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize(("bits", "block"), [(16, 7), (17, 7), (17, 8), (13, 100)])
def test_shard_access(tmp_path, bits, block):
    rnd = np.random.default_rng(2)
    docs = [rnd.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4") for n in (0, 1, 20, 7, 333)]
    (tmp_path / "s").write_bytes(bitpack.shard_bytes([None, 1, 2, 3, 9], docs, bits, block))
    with open(tmp_path / "s", "rb") as f:
        shard = bitpack.Shard(f)
        assert shard.doc_ids == [None, 1, 2, 3, 9]
        for i in (4, 0, 2, 3, 1):
            assert (shard.document(i) == docs[i]).all()


def test_bitpack_edges(spark, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = bitpack.read(bitpack.write(odd, common.new_path(spark, "t"), path, 50257, "spaced", shard_ids=50)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert got[2].n_tokens == 1 and got[2].ids_crc32 == zlib.crc32(bytes(4))
    assert bitpack.read(bitpack.write(none, common.new_path(spark, "t"), path, 50257, "spaced")).count() == 0


ODD = ["a  b", "a   b", " a", "a ", "a \n b", "a\t b\n\n c", "", " ", "don't 'S  we'll <|endoftext|> a<|endoftext|> b", "é ́a İstanbul ΣΑΣ ΟΔΟΣ b\r\n c", "a\x1cb 12 345",
       "x \U0001f600\U0001f600", "ǅa Ǆ ŉ ß ẞ ſ ĸ ı", "Ħħ,. a., b.. ., A. B, 'll 's don't.", "İ. İa Éa. x### y*** a. b&&&\nc$$$ d| e\nf\ng", "a-b a'b 'a a' a.'s "]


@pytest.mark.parametrize(("name", "pieces"), [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "words")])
def test_cached_ids_equal_whole_encoding(data, name, pieces, monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(name))
    coder = tokens.Coder(public_tokenizers.path(name), pieces)
    monkeypatch.setattr(tokens, "CACHE", 300)
    for text in ODD + pd.read_parquet(f"{data}/documents.parquet").text.tolist():
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text[:80]


def test_chat_fold(spark):
    events = [
        (1, 0, 0, "message", "user", "helo"), (1, 0, 5, "edit", "user", "hello"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", "assistant", "bad"),
        (1, 1, 3, "regenerate", "assistant", None), (1, 1, 4, "delta", "assistant", "go"), (1, 1, 6, "delta", "assistant", "od"), (2, 0, 0, None, None, None),
        (None, 0, 0, "message", "user", "x"), (2, 0, 0, "delta", "user", "alone"), (3, 0, 0, "message", "user", "twice"), (3, 0, 0, "message", "user", "twice")]
    parts = chat.format_logs(spark.createDataFrame(events, chat.EVENTS)).orderBy("conv_id", "part").collect()
    said = [(p.conv_id, p.part, *chat.parse(p.formatted)) for p in parts]
    assert said == [(None, 0, "user", "x"), (1, 0, "user", "hello"), (1, 1, "assistant", "good"), (2, 0, "", "alone"), (3, 0, "user", "twice"), (3, 1, "user", "twice")]
    assert chat.digests(chat.format_logs(spark.createDataFrame([], chat.EVENTS))).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "<turn user>\nx\n</turn>\n", "a\\<b>\\\\", "\n</turn>\n<turn assistant>\n", "\\n" * 5000])
def test_chat_round_trip(text):
    formatted, loss = chat.render("assistant", text)
    assert chat.parse(formatted) == ("assistant", text)
    assert chat.unescape("".join(formatted[s["start"] : s["end"]] for s in loss)) == text
    assert formatted.count("<turn ") - formatted.count("\\<turn ") == 1


def test_html_rendering():
    page = "<head><title>t</title></head><p>Hi <b>you</b> there<p>two<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul><table><tr><th>A<th>Bee<tr><td>longer<td>1</table>" \
           "<div style='display: none'>no</div><p hidden>no</p><pre>x\n  y</pre>tail&amp;<br>end<script>if (a<b) no</script>"
    assert html.rendered(page) == "Hi you there\n\ntwo\n\n- a\n- b\n  3. c\n  4. d\n\nA      | Bee\nlonger | 1\n\nx\n  y\n\ntail&\nend"


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></p>", "<a <b>", "<!--", "<script>", "a<b", "<td>x<table><tr><td>", "<li>" * 500, "&#xD800;&bogus;", "<p title='a>b'>ok</p>"])
def test_html_odd_pages(page):
    assert isinstance(html.rendered(page), str)


def test_html_hidden_by_attributes_only():
    page = """<p class="a hidden b">one</p><p title='x display:none y'>two</p><p data-style="display:none">three</p><p hidden>four</p>
    <p HIDDEN="">five</p><p style='color:red;Display : None'>six</p><p style=visibility:hidden>seven</p><p aria-hidden="true">eight</p><p aria-hidden=false>nine</p>"""
    assert html.rendered(page).split() == ["one", "two", "three", "nine"]


@pytest.mark.parametrize("page, want", [
    ("<table><colgroup><col><col><tr><td>a<td>b<tr><td>c<td>d</table>", "a | b\nc | d"),
    ("<table><colgroup> <col> <thead><tr><th>a</thead><tbody><tr><td>c</table>", "a\nc"),
    ("<table><colgroup><col><td>a</table>z", "a\n\nz"),
    ("<table><caption>c<colgroup><col><colgroup><col>loose<tr><td>a</table>", "c\na\nloose"),
    ("<head><title>t</title><h1>a</h1><p>b", "a\n\nb"),
    ("<html><head><html><head> <meta charset=x><basefont size=2><style>s</style><noscript>n</noscript><title>t</title>&nbsp;a<p>b", "\xa0a\n\nb"),
    ("<head><title>t</title><script>s</script>\n</head><body>a", "a"),
])
def test_html_optional_end_tags(page, want):
    assert html.rendered(page) == want


@pytest.mark.parametrize("page, want", [
    ("<table><tbody><td>A<td>B</tbody></table>", "A | B"),
    ("<table><td>A<th>B<tr><td>longer<td>C</table>", "A      | B\nlonger | C"),
    ("<table><tbody><form><tr><td>A<td>B</tr><tr><td>C</tr></form></tbody></table>z", "A | B\nC\n\nz"),
    ("<table><tbody>text<div>block</div><tr><td>A</tbody></table>", "A\ntext\nblock"),
    ("<table><tfoot><tr><td>A</tr><p>one<p>two</tfoot></table>", "A\n\none\n\ntwo"),
    ("<table><tr><div><td>A</td></div><td>B</table>", "A | B"),
    ("<table><tbody hidden>no<td>no</tbody><tbody>yes</table>", "yes"),
    ("<table><form><tbody><tr><td>A<td>B</tbody></form></table>", "A | B"),
    ("<table><tr><td>A<table><td>B<td>C</table><td>D</table>", "A B | C | D"),
    ("<table><thead><caption>cap</caption><tr><td>A</table>", "cap\nA"),
])
def test_html_row_groups(page, want):
    assert html.rendered(page) == want


@pytest.mark.parametrize("page, want", [
    ("<a title=it's>text</a> more, don't <b>stop</b>", "text more, don't stop"),
    ('<img alt="x"">one <b>two</b> "three"', 'x one two "three"'),
    ("<p class='a''>one</p class='>two</p>'>three", "one\n\nthree"),
    ('<a href=x?a="b>one</a> "two"', 'one "two"'),
    ('<a ="b>one</a> "two"', 'one "two"'),
    ('<a b = = "c>one</a> "two"', 'one "two"'),
    ('<a b=>one</a> "two"', 'one "two"'),
    ('<p title = "a > b" class=\'c > d\'>one', "one"),
    ('<p title=">"hidden>no</p>one', "one"),
    ("<p a\"hidden>one", "one"),
    ("<img title=\"no alt='no'\" alt=yes>", "yes"),
])
def test_html_stray_quotes(page, want):
    assert html.rendered(page) == want


def test_html_many_quotes():
    assert html.rendered("<a b='" * 200_000) == ""
    assert html.rendered("<a " + "\"' " * 200_000 + ">x") == "x"
    assert html.rendered("<a " + "b " * 400_000 + " " * 400_000) == ""


@pytest.mark.parametrize("page, want", [
    ("<p>Pick <select><optgroup label=g><option>one<option selected>two<optgroup><option>three</select> now</p>after", "Pick\none\ntwo\nthree\nnow\n\nafter"),
    ("<p>so <math><mfrac><mn>1</mn><mn>2</mn></mfrac><mo>+</mo><mi>x</mi></math>.</p>", "so 1 2 +x."),
    ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr><mtr><mtd>3</mtd></mtr></mtable></math>", "1 2 3"),
    ("<svg><script href=a /><style>no</style><path d='m'/><text>A &amp; B</text><text>C<tspan>D</tspan></text><text><![CDATA[a > <b>]]></text></svg> end", "A & B CD a > <b> end"),
    ("<object data=x><param name=a>fall <b>back</b></object>", "fall back"),
    ("a<xmp><b>x</b> &amp;\n  y</xmp>c", "a\n\n<b>x</b> &amp;\n  y\n\nc"),
    ("<datalist id=d><option>no</datalist><noscript>no</noscript><iframe>no</iframe><noembed>no</noembed><noframes>no</noframes>yes", "yes"),
    ("<select hidden><option>no</select><svg style='display:none'><text>no</text></svg>yes", "yes"),
])
def test_html_drawn_elements(page, want):
    assert html.rendered(page) == want


def test_html_deep_and_long():
    assert html.rendered("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert "x" in html.rendered("<table><tr><td>" * 3_000 + "x")
    assert html.rendered("<p>" + "word " * 200_000).count("word") == 200_000
    assert html.rendered(None) is None


def test_html_frame(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "<b>z</b>", "y")], "page_id bigint, html string, text string")
    assert sorted((r.page_id, r.text) for r in html.extract(df).collect() if r.text is not None) == [(2, ""), (2, "z")]
    assert html.extract(df.limit(0)).count() == 0


def brute_top(rows, k):
    import math

    ok = {}
    cand = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * x) for x in v]
        cand.append((i, w))
        ok[i] = min(ok.get(i, w), w)
    out = []
    for i, v in ok.items():
        if i % 3 == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in cand if j != i))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_topk_edges(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(300)] + [(i, [0.5] * 6) for i in range(300, 420)]
    rows += [(420, None), (421, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (423, [float("nan")] * 6), (426, [float("inf")] * 6), (None, [9.0] * 6), (3, [0.25] * 6), (429, [1.0, 2.0]), (432, []), (435, [1e12, -1e12, 1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.search(df, F.col("vec_id") % 3 == 0, 5).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 5)
    assert topk.search(df.limit(0), F.col("vec_id") % 3 == 0, 5).count() == 0
    two = topk.search(df.where("vec_id in (0, 1)"), F.col("vec_id") % 3 == 0, 5).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in two] == [(0, 1, 1)]


def test_topk_annuli_and_groups(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(800, 3)))]
    vectors = topk.prepared(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding", 256)
    index = topk.Index(vectors, pivots=5, annulus=16)
    got = index.search(vectors.where("vec_id % 3 = 0"), 5, group=10, first=2).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 5)


def near_copies(n, seed, words=60, changes=2):
    rnd = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rnd.randint(0, changes)):
            copy[rnd.randrange(words)] = f"n{rnd.random()}"
        out.append(" ".join(copy))
    return out


def brute_components(texts):
    def shingle_set(t):
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [shingle_set(t) for t in texts]
    at = list(range(len(texts)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                at[y] = x
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("chunk", [8, 1024])
def test_jaccard_against_all_pairs(spark, chunk):
    line = "this very line stands in many of the documents and it is long enough to be a passage " * 3
    texts = [None, "", " ", "one", "One", "two words", "Two WORDS", "a b c d", "a b c d e", "a b c d e f"]
    for seed in range(6):
        texts += near_copies(25, seed, 40 + 30 * seed, 1 + seed)
    texts += [line + f" tail {i} of its own" for i in range(40)] + [line + " ".join(f"z{i}y{j}" for j in range(100)) for i in range(40)] + [line] * 10
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, chunk=chunk).collect()}
    assert got == brute_components(texts)


def uncounted_pairs(cases):
    """Pairs of short linked texts without a counted shingle, the longer one with two shingles before all others in the order,
    and texts that make the second prefix shingle of the shorter one rarer than its first."""
    rnd, known, texts = random.Random(17), jaccard._Hashes(), []
    word = lambda: f"u{rnd.getrandbits(40)}"

    def longer(words, below=2**64):
        while True:
            more = [*words, word()]
            h = int(jaccard.shingles(" ".join(more[-5:]), known)[0])
            if h & 3 and h < below:
                return more, h

    while len(texts) < 5 * cases:
        words, hashes = [word() for _ in range(4)], []
        for _ in range(8):
            words, h = longer(words)
            hashes.append(h)
        one, two = sorted(range(8), key=hashes.__getitem__)[:2]
        if min(hashes) < 2**60:
            continue
        more, _ = longer(words, min(hashes))
        more, _ = longer(more, min(hashes))
        first, second = " ".join(words[one : one + 5]), " ".join(words[two : two + 5])
        texts += [" ".join(words), " ".join(more), first, second, first]
    return texts


def test_jaccard_short_texts_without_counted_shingles(spark):
    texts = uncounted_pairs(40)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    assert got == brute_components(texts)


def test_jaccard_chains(spark):
    """A long chain of links is one component."""
    words = [f"c{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 104]) for i in range(0, 240, 6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    assert got == brute_components(texts) and {c for _, c in got.values()} == {0}


def test_walk_keeps_every_link():
    rnd = np.random.default_rng(8)
    base = [rnd.integers(0, 2**63, 120, dtype=np.uint64) for _ in range(4)]
    sets = []
    for i in range(150):
        h = base[i % 4].copy()
        cut = rnd.integers(0, 30)
        h[:cut] = rnd.integers(0, 2**63, cut, dtype=np.uint64)
        sets.append(np.unique(h))
    sig = np.frombuffer(b"".join(jaccard._signature(h) for h in sets), np.uint8).reshape(len(sets), -1)
    n = np.array([len(h) for h in sets])
    order = np.argsort(n, kind="stable")
    past = np.zeros((150, jaccard.PAST), np.int64)
    tree = jaccard.Tree(order.astype(np.int64), n[order], order.astype(np.int64), n[order], past, np.ascontiguousarray(sig[order]).view(np.uint64))
    found = {tuple(sorted(p)) for p in zip(*jaccard.walk(tree, tree), strict=True)}
    for a in range(150):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (n[a] + n[b] - both):
                assert (b, a) in found
    half = jaccard.Tree(order[:70].astype(np.int64), n[order[:70]], order[:70].astype(np.int64), n[order[:70]], past[:70], np.ascontiguousarray(sig[order[:70]]).view(np.uint64))
    rest = jaccard.Tree(order[70:].astype(np.int64), n[order[70:]], order[70:].astype(np.int64), n[order[70:]], past[70:], np.ascontiguousarray(sig[order[70:]]).view(np.uint64))
    both_ways = {tuple(sorted(p)) for t in ((half, half), (rest, rest), (half, rest)) for p in zip(*jaccard.walk(*t), strict=True)}
    assert both_ways == found
    # pairs with a shingle before this group's in common have met before; others stay
    past[:, 0] = np.arange(150) % 3
    met = jaccard.Tree(order.astype(np.int64), n[order], order.astype(np.int64), n[order], past[order], np.ascontiguousarray(sig[order]).view(np.uint64))
    left = {tuple(sorted(p)) for p in zip(*jaccard.walk(met, met), strict=True)}
    assert left == {(a, b) for a, b in found if a % 3 != b % 3 or a % 3 == 0}


def test_jaccard_shared_passage_pairs_met_once(spark, monkeypatch):
    """Texts with many shingles in common: every pair is found, and few of them in more than one group."""
    rnd = np.random.default_rng(3)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for i in range(60):
        t = list(base)
        for at in rnd.integers(0, 300, 4):
            t[at] = f"x{i}_{at}"
        texts.append(" ".join(t))
    seen = []
    stored = common.stored

    def noted(df, name):
        out = stored(df, name)
        if name == "walked":
            pairs = out.where("a IS NOT NULL").select("a", "b")
            seen.append((pairs.count(), pairs.distinct().count()))
        return out

    monkeypatch.setattr(common, "stored", noted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}
    assert got == brute_components(texts)
    assert len(seen) == 1 and seen[0][0] <= 2 * seen[0][1]


def test_jaccard_edges(spark, odd, none):
    got = jaccard.join(odd).collect()
    assert len(got) == 10 and jaccard.join(none).count() == 0
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id == 5] == [(4, 5)] * 2
    left = jaccard.one_each(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7] and ids.count(None) == 2
    assert jaccard.one_each(none).count() == 0


def test_spans_positions(spark):
    df = spark.createDataFrame([("日本 ab ☕ab", ), ("", ), ("xx", )], "text string")
    got = [r[0] for r in df.select(spans.written(spans.found(F.col("text"), "ab", "k"))).collect()]
    assert got == ["k:3:5,k:7:9", "", ""]


def test_cache_keeps_common_pieces_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    coder = tokens.Coder(public_tokenizers.path("word_bpe_49k.json"), "words")
    merged, seen = coder.known._merged, []
    monkeypatch.setattr(coder.known, "_merged", lambda word, lead: seen.append(word) or merged(word, lead))
    letters = "abcdefghijklmnopqrst"
    for a in letters:
        for b in letters:
            coder.encode(f"common {a}{b}x common {b}{a}y")
            assert len(coder.known) + len(coder.known.older) <= 101
    assert seen.count("common") == 1


@pytest.mark.parametrize(("name", "pieces"), [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
def test_bare_words_are_merged_without_a_pattern(monkeypatch, name, pieces):
    path = public_tokenizers.path(name)
    text = "one " + " ".join([a + b for a in ("zor", "quax", "plim") for b in ("ting", "berung", "ol")])
    want = tokens.Coder(path, "whole").encode(text)
    coder = tokens.Coder(path, pieces)
    monkeypatch.setattr(tokens, "_LETTERS", None)
    assert coder.encode(text) == want


def test_a_coder_keeps_as_many_pieces_as_asked(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 10)
    coder = tokens.Coder(public_tokenizers.path("byte_bpe_50k.json"), "spaced", 40)
    text = " ".join([f"w{'abcdefghij'[i % 10] * (i // 10 + 1)}ß" for i in range(400)])
    got = coder.encode(text)
    assert len(coder.known.older) == 40 and len(coder.known) <= 40
    assert got == tokens.Coder(public_tokenizers.path("byte_bpe_50k.json"), "whole").encode(text)
