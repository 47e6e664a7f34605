"""Queries over text rules, rule tables, policy gates and report quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmstead.functions import text as tx
from ohmstead.operators import reports as rp
from ohmstead.operators import scoring as sc
from ohmstead.operators.keyed import sealed
from ohmstead.plans.base_sql import with_
from ohmstead.plans.registry import Catalogue
from ohmstead.plans.reports import LINES, POLITE, q, sql_any, sql_fold, sql_list, sql_norm, sql_plain, sql_start, sql_tidy, sql_tokens
from ohmstead.sources import tables as t

CAT = Catalogue()
query = CAT.query


def _lines(s, sf) -> DataFrame:
    return t.texts(s, sf, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("p", "line")).withColumn(
        "pos", (F.col("p") + 1).cast("long")).drop("p")


# ---- normalisation -------------------------------------------------------------------------


@query("text_norm", with_(LINES) + f"""SELECT doc_id, pos, {sql_norm('line')} AS norm, {sql_fold('line')} AS folded, {sql_fold('line', True)} AS folded_plus, {sql_plain('line')} AS plain FROM ln""")
def text_norm(s, sf):
    return _lines(s, sf).select("doc_id", "pos", tx.norm("line").alias("norm"), tx.fold("line").alias("folded"), tx.fold("line", True).alias("folded_plus"), tx.plain("line").alias("plain"))


@query("slugs", """SELECT item, COALESCE(nullif(trim(regexp_replace(lower(trim(item)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'page') AS page_slug,
 COALESCE(nullif(trim(regexp_replace(lower(trim(item)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'section') AS section_slug, CASE WHEN item = '' THEN 'layer' ELSE substr(regexp_replace(item, '[^\\p{L}\\p{N}_\\-.]+', '_', 'g'), 1, 180) END AS file_name
FROM (SELECT DISTINCT trim(UNNEST(string_split(text, chr(10)))) AS item FROM documents)""")
def slugs(s, sf):
    # an aggregate would take the names into its own output and evaluate them at every mention
    x = sealed(_lines(s, sf).select(F.trim("line").alias("item")).distinct())
    return x.select("item", tx.slug("item").alias("page_slug"), tx.slug("item", "_", "section").alias("section_slug"), tx.safe_name("item").alias("file_name"))


@query("section_names", """
WITH n AS (SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN '—' WHEN 1 THEN ' - ' WHEN 2 THEN '  –' ELSE ' ' END || p_type || ' ' AS name FROM part),
x AS (SELECT p_partkey, trim(name) AS raw, trim(regexp_replace(regexp_replace(trim(name), '\\s*[‒–—−-]+\\s*', ' - ', 'g'), '\\s+', ' ', 'g')) AS x FROM n),
p AS (SELECT *, list_filter(list_transform(string_split(x, ' - '), lambda v: trim(v)), lambda v: v <> '') AS parts FROM x),
f AS (SELECT *, CASE WHEN len(parts) >= 2 THEN parts[1] || ' - ' || CASE WHEN lower(parts[2]) = 'promo' THEN 'PROMO' ELSE parts[2] END ELSE x END AS name FROM p)
SELECT p_partkey, name, CASE WHEN raw = name THEN 1 ELSE 2 END + CASE WHEN len(parts) >= 2 THEN 1 ELSE 0 END AS n_min FROM f""")
def section_names(s, sf):
    k = F.col("p_partkey") % 4
    dash = F.when(k == 0, "—").when(k == 1, " - ").when(k == 2, "  –").otherwise(" ")
    x = t.table(s, sf, "part").select("p_partkey", F.concat("p_name", dash, "p_type", F.lit(" ")).alias("raw"))
    name = tx.section_name("raw", {"promo": "PROMO"})
    two = F.contains(name, F.lit(" - ")).cast("int")
    return x.select("p_partkey", name.alias("name"), (F.when(tx.strip("raw") == name, 1).otherwise(2) + two).alias("n_min"))


@query("section_variants", """
SELECT p_partkey, UNNEST(list_distinct([p_name || '–' || p_type, p_name || ' - ' || p_type, p_name || ' - ' || upper(p_type), p_name || ' - ' || upper(p_type[1]) || lower(p_type[2:])])) AS variant FROM part""")
def section_variants(s, sf):
    x = t.table(s, sf, "part").select("p_partkey", F.concat("p_name", F.lit("–"), "p_type").alias("raw"))
    return x.select("p_partkey", F.explode(tx.section_variants("raw")).alias("variant"))


_TERMS = [(r"\bthe\b", "THE"), (r"\bund\b", "UND"), (r"\bles\b", "LES")]


def _sql_term(e: str, word: str, new: str) -> str:
    return f"regexp_replace({e}, '(^|[^\\p{{L}}\\p{{N}}_]){word}($|[^\\p{{L}}\\p{{N}}_])', '\\1{new}\\2', 'gi')"


@query("term_fixes", with_(LINES) + "SELECT doc_id, pos, trim(regexp_replace(" + _sql_term(_sql_term(_sql_term("replace(line, ' ', '  ')", "the", "THE"), "und", "UND"), "les", "LES") + ", '\\s+', ' ', 'g')) AS fixed FROM ln")
def term_fixes(s, sf):
    return _lines(s, sf).select("doc_id", "pos", tx.fix_terms("line", _TERMS).alias("fixed"))


@query("sentence_split", """
WITH l AS (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS x FROM conversations),
c AS (SELECT conv_id, turn, list_filter(list_transform(string_split(regexp_replace(x, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)), lambda v: trim(v)), lambda v: v <> '') AS cs FROM l),
f AS (SELECT conv_id, turn, flatten(list_transform(cs, lambda v: CASE WHEN length(v) > 320 THEN list_filter(list_transform(string_split(regexp_replace(v, '(?i)\\s+(?:et|mais|tandis que|ce qui|donc|dans ce cadre|par conséquent)\\s+', chr(10), 'g'), chr(10)), lambda p: trim(p, ' ,;')), lambda p: p <> '') ELSE [v] END)) AS ss FROM c)
SELECT conv_id, turn, array_to_string(ss, ' | ') AS sentences FROM f""")
def sentence_split(s, sf):
    x = t.texts(s, sf, "conversations")
    return x.select("conv_id", "turn", F.array_join(tx.sentences(F.col("text")), " | ").alias("sentences"))


_N = sql_plain("line")
_NOISE = "(length(n) < 4 OR NOT regexp_matches(n, '\\p{L}') OR " + " OR ".join(f"regexp_matches(n, {q('(?i)' + p)})" for p in tx.NOISE_PATTERNS) + ")"
_DECOR = f"(n = '' OR list_contains({sql_list(tx.DECOR)}, n) OR regexp_matches(n, {q('^(' + '|'.join(tx.MONTHS) + ') [0-9]+$')}))"
_NL = f"(f = '' OR list_contains({sql_list(tx.NOISE_LINES)}, f) OR contains(f, 'page_id') OR starts_with(f, 'preuve') OR {sql_any('f', tx.INSUFFICIENT)})"


@query("line_checks", with_(LINES) + f"""
, x AS (SELECT *, {_N} AS n, {sql_fold('line', True)} AS f, {sql_norm('line')} AS m FROM (SELECT doc_id, pos, UNNEST(CASE pos % 9 WHEN 1 THEN ['Mars 2024', line] WHEN 2 THEN ['Rien à signaler : ' || line] WHEN 3 THEN ['AMO GTB - 12', line] WHEN 4 THEN ['Merci de ' || line] WHEN 5 THEN ['Légende: ' || line] ELSE [line] END) AS line FROM ln))
SELECT doc_id, pos, {_NL} AS noise_line, {_NOISE} AS noise, {_DECOR} AS decor, regexp_matches(n, {q('^(' + '|'.join(tx.MONTHS) + ') [0-9]+$')}) AS month_year,
 (contains(line, '?') OR {sql_start('m', tx.REQUEST_STARTS + tx.DUTY_STARTS)}) AS request, {sql_start("lower(trim(line))", tx.CAPTION_PREFIXES)} AS caption FROM x""")
def line_checks(s, sf):
    k, ln = F.col("pos") % 9, F.col("line")
    made = (F.when(k == 1, F.array(F.lit("Mars 2024"), ln)).when(k == 2, F.array(F.concat(F.lit("Rien à signaler : "), ln))).when(k == 3, F.array(F.lit("AMO GTB - 12"), ln))
            .when(k == 4, F.array(F.concat(F.lit("Merci de "), ln))).when(k == 5, F.array(F.concat(F.lit("Légende: "), ln))).otherwise(F.array(ln)))
    x = _lines(s, sf).withColumn("line", F.explode(made))
    n = tx.plain("line")
    return x.select("doc_id", "pos", tx.is_noise_line(F.col("line")).alias("noise_line"), tx.is_noise(n).alias("noise"), tx.is_decor(n).alias("decor"),
                    tx.is_month_year(n).alias("month_year"), tx.is_request(F.col("line")).alias("request"), tx.is_caption(F.col("line")).alias("caption"))


@query("equipment_facts", with_(LINES) + """
, x AS (SELECT doc_id, pos, CASE pos % 5 WHEN 0 THEN 'Chaudière hors communication ' || line WHEN 1 THEN 'CTA et TGBT ' || line WHEN 2 THEN 'luminaires sans retour ' || line ELSE line END AS line FROM ln)
SELECT doc_id, pos, UNNEST(CASE pos % 5 WHEN 0 THEN ['chaudiere'] WHEN 1 THEN ['cta', 'tgbt'] ELSE ['eclairage'] END) AS equipment, CASE pos % 5 WHEN 1 THEN 'mentioned' ELSE 'not_connected_or_missing' END AS status FROM x WHERE pos % 5 IN (0, 1, 2)""")
def equipment_facts(s, sf):
    k, ln = F.col("pos") % 5, F.col("line")
    made = F.when(k == 0, F.concat(F.lit("Chaudière hors communication "), ln)).when(k == 1, F.concat(F.lit("CTA et TGBT "), ln)).when(
        k == 2, F.concat(F.lit("luminaires sans retour "), ln)).otherwise(ln)
    x = sealed(_lines(s, sf).select("doc_id", "pos", rp.equipment_facts(made).alias("e")))
    return x.select("doc_id", "pos", F.explode("e").alias("e")).select("doc_id", "pos", "e.*")


@query("token_overlap", f"""
WITH p AS (SELECT conv_id, turn, text, LEAD(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations),
k AS (SELECT conv_id, turn, {sql_tokens('text')} AS a, {sql_tokens('nxt')} AS b FROM p WHERE nxt IS NOT NULL)
SELECT conv_id, turn, ROUND(CASE WHEN len(a) > 0 AND len(b) > 0 THEN CAST(len(list_intersect(a, b)) AS DOUBLE) / LEAST(len(a), len(b)) ELSE 0 END, 6) AS overlap FROM k""")
def token_overlap(s, sf):
    x = _turn_pairs(s, sf)
    return x.select("conv_id", "turn", F.round(tx.overlap(tx.tokens(F.col("raw_notes")), tx.tokens(F.col("candidate_text"))), 6).alias("overlap"))


def _turn_pairs(s, sf) -> DataFrame:
    """Each turn with the next one of its conversation."""
    c = t.texts(s, sf, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("candidate_text"))
    return c.select("conv_id", "turn", F.col("text").alias("raw_notes")).join(after, ["conv_id", "turn"])


_GREEDY = f"""it AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents),
tk AS (SELECT doc_id, list_transform(ls, lambda x: {{'s': x, 't': {sql_tokens('x').replace('lambda x:', 'lambda y:').replace("x <> ''", "y <> ''")}}}) AS e FROM it WHERE len(ls) > 0),
gr AS (SELECT doc_id, list_reduce(list_transform(e, lambda x: [x]), lambda a, x: CASE WHEN len(a) >= 12 OR len(list_filter(a, lambda p: len(p.t) > 0 AND len(x[1].t) > 0 AND CAST(len(list_intersect(p.t, x[1].t)) AS DOUBLE) / LEAST(len(p.t), len(x[1].t)) >= 0.82)) > 0 THEN a ELSE list_concat(a, x) END) AS k FROM tk)"""


@query("greedy_distinct", with_(_GREEDY) + "SELECT doc_id, array_to_string(list_transform(k, lambda x: x.s), chr(10)) AS kept FROM gr")
def greedy_distinct(s, sf):
    ls = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    x = sealed(t.texts(s, sf, "documents").select("doc_id", tx.greedy_distinct(ls, 0.82, 12).alias("k"))).where(F.size("k") > 0)
    return x.select("doc_id", F.array_join("k", "\n").alias("kept"))


def _toks(e: str, plus: bool = True) -> str:
    return sql_tokens(e, plus).replace("lambda x: x", "lambda w: w")


def _greedy(name: str, source: str, items: str, threshold: float, most: int | None, plus: bool = True) -> str:
    """``name``: rows of ``source`` with ``kept``, the greedily distinct strings of list ``items``."""
    full = f"len(a) >= {most} OR " if most else ""
    return f"""{name}_0 AS (SELECT * EXCLUDE ({items}), list_transform({items}, lambda s: [{{'s': s, 't': {_toks('s', plus)}}}]) AS e FROM {source}),
{name} AS (SELECT * EXCLUDE (e), CASE WHEN len(e) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform(list_reduce(e, lambda a, x: CASE WHEN {full}len(list_filter(a, lambda p: len(p.t) > 0 AND len(x[1].t) > 0
  AND CAST(len(list_intersect(p.t, x[1].t)) AS DOUBLE) / LEAST(len(p.t), len(x[1].t)) >= {threshold})) > 0 THEN a ELSE list_concat(a, x) END), lambda p: p.s) END AS kept FROM {name}_0)"""


def _noise_of(e: str) -> str:
    return _NL.replace("f = ''", f"{e} = ''").replace(", f)", f", {e})").replace("(f,", f"({e},")


_PAIRS = "pr AS (SELECT * FROM (SELECT conv_id, turn, role, text, LEAD(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations) WHERE nxt IS NOT NULL)"
_LINKED = "(?i)\\s+(?:et|mais|tandis que|ce qui|donc|dans ce cadre|par conséquent)\\s+"
_FACTS = _PAIRS + f""",
fl AS (SELECT conv_id, turn, UNNEST(string_split({sql_tidy('text')}, chr(10))) AS l, generate_subscripts(string_split({sql_tidy('text')}, chr(10)), 1) AS pos FROM pr),
fb AS (SELECT conv_id, turn, pos, trim(regexp_replace(regexp_replace(regexp_replace(trim(l), '^(?:- \\s*)+', ''), '^•+', ''), '\\s+', ' ', 'g')) AS s FROM fl),
fc AS (SELECT conv_id, turn, pos, list_filter(list_transform(string_split(regexp_replace(s, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)), lambda v: trim(v)), lambda v: v <> '') AS cs FROM (SELECT *, {sql_fold('s', True)} AS f FROM fb) WHERE NOT {_NL}),
fs AS (SELECT conv_id, turn, pos, flatten(list_transform(cs, lambda v: CASE WHEN length(v) > 320 THEN list_filter(list_transform(string_split(regexp_replace(v, '{_LINKED}', chr(10), 'g'), chr(10)), lambda p: trim(p, ' ,;')), lambda p: p <> '') ELSE [v] END)) AS ss FROM fc),
fu AS (SELECT conv_id, turn, pos, UNNEST(ss) AS x, generate_subscripts(ss, 1) AS k FROM fs),
fg AS (SELECT *, {sql_fold('x', True)} AS f FROM (SELECT conv_id, turn, pos, k, trim(x, ' -•' || chr(9)) AS x FROM fu)),
fh AS (SELECT pr.conv_id, pr.turn, ANY_VALUE(pr.nxt) AS nxt, COALESCE(list(x ORDER BY pos, k) FILTER (WHERE x <> '' AND NOT {_NL} AND length(f) >= 12), CAST([] AS VARCHAR[])) AS items FROM pr LEFT JOIN fg ON fg.conv_id = pr.conv_id AND fg.turn = pr.turn GROUP BY 1, 2),
""" + _greedy("fk", "fh", "items", 0.88, None) + ",\nfa AS (SELECT conv_id, turn, nxt, kept[1:10] AS facts FROM fk)"


@query("atomic_facts", with_(_FACTS) + "SELECT conv_id, turn, array_to_string(facts, ' | ') AS facts FROM fa")
def atomic_facts(s, sf):
    x = _turn_pairs(s, sf)
    return x.select("conv_id", "turn", F.array_join(tx.facts("raw_notes"), " | ").alias("facts"))


_CAND = _PAIRS + f""",
cl AS (SELECT conv_id, turn, list_transform(list_filter(list_transform(string_split(nxt, chr(10)), lambda v: trim('- ' || v)), lambda v: starts_with(v, '- ')), lambda v: trim(regexp_replace(v, '^(- |•+)', ''))) AS b FROM pr),
cm AS (SELECT conv_id, turn, list_transform(list_filter(b, lambda v: v <> '' AND NOT regexp_matches(v, '^[A-Za-zÀ-ÿ ''\\-]+\\s*:\\s+')), lambda v: '- ' || CASE WHEN length(v) > 230 THEN rtrim(substr(v, 1, 229)) || '…' ELSE v END) AS items FROM cl),
""" + _greedy("cg", "cm", "items", 0.86, 8)


@query("candidate_parts", with_(_CAND) + "SELECT conv_id, turn, 'CTA 3  –  hall' AS title, array_to_string(kept, chr(10)) AS bullets FROM cg")
def candidate_parts(s, sf):
    x = _turn_pairs(s, sf).withColumn("c", F.concat(F.lit("Titre: cta3 - hall\n- "), F.array_join(F.split("candidate_text", "\n"), "\n- ")))
    title, body = tx.candidate_parts("c")
    return x.select("conv_id", "turn", title.alias("title"), body.alias("bullets"))


@query("fact_coverage", f"""
WITH p AS (SELECT conv_id, turn, role, text, LEAD(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations),
k AS (SELECT conv_id, turn, list_transform(list_filter(list_transform(string_split(text, '. '), lambda v: trim(v)), lambda v: v <> ''), lambda x: {sql_tokens('x', True).replace('lambda x:', 'lambda y:').replace("x <> ''", "y <> ''")}) AS fs,
  list_transform(list_filter(list_transform(string_split(nxt, chr(10)), lambda v: trim(v)), lambda v: v <> ''), lambda x: {sql_tokens('x', True).replace('lambda x:', 'lambda y:').replace("x <> ''", "y <> ''")}) AS bs FROM p WHERE nxt IS NOT NULL)
SELECT conv_id, turn, ROUND(CASE WHEN len(fs) = 0 THEN 1.0 WHEN len(bs) = 0 THEN 0.0 ELSE CAST(len(list_filter(fs, lambda f: len(list_filter(bs, lambda b: len(f) > 0 AND len(b) > 0 AND CAST(len(list_intersect(f, b)) AS DOUBLE) / LEAST(len(f), len(b)) >= 0.28)) > 0)) AS DOUBLE) / len(fs) END, 6) AS coverage FROM k""")
def fact_coverage(s, sf):
    src = F.filter(F.transform(F.split("raw_notes", r"\. "), tx.strip), lambda v: v != "")
    return _turn_pairs(s, sf).select("conv_id", "turn", F.round(tx.coverage(src, tx.bullet_payloads("candidate_text")), 6).alias("coverage"))


_CHOSEN = _FACTS + f""",
xo AS (SELECT *, list_filter(list_transform(string_split({sql_tidy('nxt')}, chr(10)), lambda v: trim(regexp_replace(regexp_replace(trim(v), '^(?:- \\s*)+', ''), '^•+', ''))), lambda v: v <> '') AS outs, {sql_fold('nxt', True)} AS nf FROM fa),
xt AS (SELECT *, list_transform(facts, lambda v: {_toks('v')}) AS ft, list_transform(outs, lambda v: {_toks('v')}) AS ot FROM xo),
xc AS (SELECT *, CASE WHEN len(facts) = 0 THEN 1.0 WHEN len(outs) = 0 THEN 0.0 ELSE CAST(len(list_filter(ft, lambda p: len(list_filter(ot, lambda b: len(p) > 0 AND len(b) > 0 AND CAST(len(list_intersect(p, b)) AS DOUBLE) / LEAST(len(p), len(b)) >= 0.28)) > 0)) AS DOUBLE) / len(facts) END AS cov FROM xt),
xp AS (SELECT conv_id, turn, nxt, len(facts) AS nfacts, trim(nxt, ' ' || chr(10)) = '' OR ({sql_any('nf', tx.INSUFFICIENT)} AND len(facts) >= 2) OR (len(facts) >= 3 AND (len(outs) <= 1 OR cov < 0.35)) AS poor,
  list_transform(list_filter(list_transform(facts, lambda v: CASE WHEN length(trim(v, ' .')) > 230 THEN rtrim(substr(trim(v, ' .'), 1, 229)) || '…' ELSE trim(v, ' .') END), lambda v: v <> '')[1:8], lambda v: '- ' || v) AS items FROM xc),
""" + _greedy("xg", "xp", "items", 0.88, 8)


@query("chosen_bullets", with_(_CHOSEN) + "SELECT conv_id, turn, CAST(nfacts AS INTEGER) AS n_facts, poor AS too_poor, CASE WHEN NOT poor AND nxt <> '' THEN nxt WHEN len(kept) = 0 THEN '- Rien à signaler (notes insuffisantes).' ELSE array_to_string(kept, chr(10)) END AS bullets FROM xg")
def chosen_bullets(s, sf):
    x = sealed(_turn_pairs(s, sf).withColumn("f", tx.facts("raw_notes")))
    return x.select("conv_id", "turn", F.size("f").alias("n_facts"), tx.too_poor(F.col("f"), F.col("candidate_text")).alias("too_poor"),
                    tx.best_bullets(F.col("f"), F.col("candidate_text")).alias("bullets"))


_CAPS = "array_to_string(list_transform(string_split(raw, ' '), lambda w: CASE WHEN lower(w) IN ('tgbt', 'r+2') THEN upper(w) ELSE upper(w[1]) || w[2:] END), ' ')"


@query("title_forms", f"""
WITH r AS (SELECT p_partkey, p_partkey % 6 AS k, p_name, ['cta12 - ', 'td niveau ', 'vrv', 'tgbt ', 'local r+2 ', 'ge'][p_partkey % 6 + 1] || CASE WHEN p_partkey % 6 < 5 THEN p_name ELSE '' END AS raw FROM part)
SELECT p_partkey, raw, CASE k WHEN 0 THEN 'CTA 12  –  ' || p_name WHEN 1 THEN 'Tableau divisionnaire – Niveau ' || p_name WHEN 5 THEN 'Groupe électrogène' ELSE {_CAPS} END AS title FROM r""")
def title_forms(s, sf):
    heads = F.array(*[F.lit(w) for w in ("cta12 - ", "td niveau ", "vrv", "tgbt ", "local r+2 ", "ge")])
    x = t.table(s, sf, "part").select("p_partkey", F.concat(F.element_at(heads, (F.col("p_partkey") % 6 + 1).cast("int")), F.when(F.col("p_partkey") % 6 < 5, F.col("p_name")).otherwise("")).alias("raw"))
    return x.select("p_partkey", "raw", tx.normal_title("raw").alias("title"))


_CHAT = f"""h0 AS (SELECT conv_id, turn, UNNEST(string_split(text, chr(10))) AS v, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM conversations),
h1 AS (SELECT conv_id, turn, p, trim(regexp_replace(CASE (p - 1) % 3 WHEN 0 THEN 'tu ' || v WHEN 1 THEN 'oui ' || v ELSE trim(regexp_replace(trim(v), '^(?:- |•+)', '')) END, '\\s+', ' ', 'g')) AS x0 FROM h0),
h2 AS (SELECT conv_id, turn, p, trim(regexp_replace({POLITE}, '\\s+', ' ', 'g')) AS x FROM h1 WHERE NOT regexp_matches({sql_fold('x0')}, '\\bje peux\\b|\\bje te\\b|\\boui\\b')),
h3 AS (SELECT c.conv_id, c.turn, COALESCE(list('- ' || x ORDER BY p) FILTER (WHERE x <> '' AND NOT regexp_matches({sql_fold('x')}, '\\btravaux a engager\\b|\\bcctp\\b')), CAST([] AS VARCHAR[])) AS items FROM conversations c LEFT JOIN h2 ON h2.conv_id = c.conv_id AND h2.turn = c.turn GROUP BY 1, 2),
""" + _greedy("h4", "h3", "items", 0.82, 12, False)


@query("chat_cleaning", with_(_CHAT) + "SELECT conv_id, turn, array_to_string(kept, chr(10)) AS bullets FROM h4")
def chat_cleaning(s, sf):
    x = t.texts(s, sf, "conversations")
    ls = F.transform(F.split("text", "\n"), lambda v, i: F.when(i % 3 == 0, F.concat(F.lit("- 👉 tu "), v)).when(i % 3 == 1, F.concat(F.lit("oui "), v)).otherwise(v))
    return x.select("conv_id", "turn", F.array_join(tx.clean_bullets(ls), "\n").alias("bullets"))


_TOC = f"""r0 AS (SELECT doc_id, pos, CASE (pos - 1) % 3 WHEN 0 THEN ['1 - Contexte ' || line] WHEN 1 THEN ['Sommaire', line] ELSE [line] END AS ls FROM ln),
r1 AS (SELECT doc_id, pos * 2 + generate_subscripts(ls, 1) AS pos, UNNEST(ls) AS line FROM r0),
r AS (SELECT doc_id, pos, trim(regexp_replace(trim(line || '  12'), '\\s+\\d{{1,3}}$', '')) AS s0 FROM r1),
e0 AS (SELECT doc_id, pos, trim(regexp_replace(trim(regexp_replace(s0, '^\\s*\\d{{1,2}}\\s*[-–]?\\s*', '')), 'slides?\\s+\\d+\\s*(a|à)\\s*\\d+', '', 'gi')) AS s FROM r WHERE s0 <> '' AND NOT regexp_matches(s0, '(?i)(slides?\\s+\\d+|page\\s+\\d+|^\\d+$)')),
e1 AS (SELECT *, {sql_plain('s')} AS n FROM e0),
e2 AS (SELECT doc_id, ARG_MIN(s, pos) AS s, MIN(pos) AS pos FROM e1 WHERE NOT {_NOISE} AND NOT {_DECOR} AND ({sql_any('n', tx.TOC_WORDS)} OR length(n) >= 18) GROUP BY doc_id, n)"""


@query("toc_titles", with_(LINES, _TOC) + "SELECT d.doc_id, COALESCE(string_agg(s, ' | ' ORDER BY pos), '') AS entries FROM documents d LEFT JOIN e2 ON e2.doc_id = d.doc_id GROUP BY 1")
def toc_titles(s, sf):
    ls = F.transform(F.split("text", "\n"), lambda v, i: F.concat(F.when(i % 3 == 0, F.lit("1 - Contexte ")).when(i % 3 == 1, F.lit("Sommaire  12\n")).otherwise(F.lit("")), v, F.lit("  12")))
    x = t.texts(s, sf, "documents").select("doc_id", F.array_join(ls, "\n").alias("t"))
    return x.select("doc_id", F.array_join(tx.toc_entries("t"), " | ").alias("entries"))


@query("lenient_json", """
SELECT event_id, COALESCE(CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM (
 SELECT event_id, props FROM events)""")
def lenient_json(s, sf):
    k, p = F.col("event_id") % 5, F.col("props")
    raw = F.when(k == 0, p).when(k == 1, F.concat(F.lit("Voici: "), p, F.lit(" fin"))).when(k == 2, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(k == 3, F.concat(F.lit("  "), p)).otherwise(F.concat(F.lit("réponse = "), p, F.lit(";")))
    return t.table(s, sf, "events").select("event_id", F.coalesce(tx.lenient_json(raw, "k long")["k"], F.lit(-1)).cast("long").alias("k"))


@query("phrase_hits", f"""SELECT doc_id, {' + '.join(f"CAST((length(m) - length(replace(m, {q(p)}, ''))) / {len(p)} AS BIGINT)" for p in ('the', 'de la', 'und'))} AS hits FROM (SELECT doc_id, {sql_norm('text')} AS m FROM documents)""")
def phrase_hits(s, sf):
    return t.texts(s, sf, "documents").select("doc_id", tx.phrase_count(tx.norm("text"), ["the", "de la", "und"]).alias("hits"))


@query("file_ids", """
SELECT o_orderkey, regexp_replace(replace(o_orderpriority, ' ', '_'), '[^a-zA-Z0-9_-]+', '_', 'g') || '_' || o_orderkey || '-' || substr(sha1('in/' || o_orderpriority || ' ' || o_orderkey || '.pdf'), 1, 12) AS doc_id, md5(CAST(o_orderkey AS VARCHAR)) AS asset
FROM orders""")
def file_ids(s, sf):
    k = F.col("o_orderkey").cast("string")
    return t.table(s, sf, "orders").select("o_orderkey", tx.file_id(F.concat(F.lit("in/"), "o_orderpriority", F.lit(" "), k, F.lit(".pdf"))).alias("doc_id"), F.md5(k).alias("asset"))


@query("short_captions", with_(LINES) + "SELECT doc_id, pos, CASE WHEN length(trim(line)) > 60 THEN rtrim(substr(trim(line), 1, 57)) || '…' ELSE trim(line) END AS caption FROM ln")
def short_captions(s, sf):
    return _lines(s, sf).select("doc_id", "pos", tx.short_caption("line").alias("caption"))


@query("file_extensions", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.mp3' WHEN 2 THEN '' ELSE '.pdf' END AS ext FROM events""")
def file_extensions(s, sf):
    k = F.col("event_id") % 4
    ct = F.when(k == 0, "image/JPEG; charset=x").when(k == 1, " audio/mpeg ").when(k == 2, F.col("event_type")).otherwise("application/pdf")
    return t.table(s, sf, "events").select("event_id", tx.extension_of(ct).alias("ext"))


# ---- rule classes --------------------------------------------------------------------------

# A small rule table with the level each class asks for.
RULES = [
    sc.Rule("1.1", "Chauffage", "Régulation émission", (("C", 2), ("B", 3), ("A", 4))), sc.Rule("1.2", "Chauffage", "Régulation distribution", (("C", 1), ("B", 2), ("A", 2))),
    sc.Rule("1.3", "Chauffage", "Pompes", (("C", 1), ("B", 2), ("A", 3))), sc.Rule("2.1", "ECS", "Stockage", (("C", 1), ("B", 1), ("A", 2))),
    sc.Rule("2.2", "ECS", "Bouclage", (("B", 1),)), sc.Rule("3.1", "Refroidissement", "Émission", (("C", 2), ("B", 3), ("A", 4))),
    sc.Rule("3.2", "Refroidissement", "Réseau", (("C", 1), ("B", 1), ("A", 1))), sc.Rule("3.3", "Refroidissement", "Interlock", (("A", 2),)),
    sc.Rule("4.1", "Ventilation", "Débit", (("C", 1), ("B", 2), ("A", 3))), sc.Rule("4.2", "Ventilation", "Récupération", (("C", 0), ("B", 1), ("A", 1))),
    sc.Rule("4.3", "Ventilation", "Nuit", ()), sc.Rule("4.4", "Ventilation", "Consigne", (("C", 1), ("B", 2), ("A", 3))),
]
_RULESQL = "rl(i, rule_id, grp, title, nc, nb, na) AS (VALUES " + ", ".join(
    f"({i}, {q(r.rule_id)}, {q(r.group)}, {q(r.title)}, {dict(r.needs).get('C', 'NULL')}, {dict(r.needs).get('B', 'NULL')}, {dict(r.needs).get('A', 'NULL')})" for i, r in enumerate(RULES)) + """),
lv AS (SELECT doc_id, i, rule_id, grp, title, nc, nb, na, CASE WHEN (doc_id + i * 3 + n_chars) % 6 = 5 THEN NULL ELSE (doc_id + i * 3 + n_chars) % 6 END AS level FROM documents CROSS JOIN rl),
jg AS (SELECT *, nc IS NULL OR COALESCE(level >= nc, false) AS mc, nb IS NULL OR COALESCE(level >= nb, false) AS mb, na IS NULL OR COALESCE(level >= na, false) AS ma FROM lv)"""


def _levels(s, sf) -> DataFrame:
    d = t.table(s, sf, "documents")
    rows = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), ((F.col("doc_id") + i * 3 + F.col("n_chars")) % 6).cast("int").alias("level")) for i, r in enumerate(RULES)])
    x = d.select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.*")
    return x.withColumn("level", F.when(F.col("level") < 5, F.col("level")))


def _judged(s, sf) -> DataFrame:
    return sc.judged(_levels(s, sf), RULES, ["doc_id"])


_CLS = """gc AS (SELECT doc_id, grp, CASE MIN(CASE WHEN NOT mc THEN 0 WHEN ma THEN 3 WHEN mb THEN 2 ELSE 1 END) WHEN 0 THEN 'D' WHEN 1 THEN 'C' WHEN 2 THEN 'B' ELSE 'A' END AS achieved_class, COUNT(*) AS rules_count,
 COUNT(CASE WHEN NOT mc THEN 1 END) AS "blockers_C", COUNT(CASE WHEN NOT mb THEN 1 END) AS "blockers_B", COUNT(CASE WHEN NOT ma THEN 1 END) AS "blockers_A", COALESCE(string_agg(CASE WHEN NOT mb THEN rule_id END, ',' ORDER BY rule_id), '') AS "blocking_B" FROM jg GROUP BY 1, 2)"""


@query("group_classes", with_(_RULESQL, _CLS) + "SELECT * FROM gc")
def group_classes(s, sf):
    return sc.group_classes(_judged(s, sf), ["doc_id"])


@query("works_list", with_(_RULESQL) + """
SELECT doc_id, grp, rule_id, title, CAST(CASE WHEN grp = 'ECS' THEN na ELSE nb END AS DOUBLE) AS required_level, CAST(level AS DOUBLE) AS level FROM jg WHERE CASE WHEN grp = 'ECS' THEN NOT ma ELSE NOT mb END""")
def works_list(s, sf):
    x = sc.works(_judged(s, sf), ["doc_id"], {"ECS": "A"})
    return x.withColumns({"required_level": F.col("required_level").cast("double"), "level": F.col("level").cast("double")})


@query("score_slides", with_(_RULESQL, _CLS) + """
SELECT doc_id, grp, CASE WHEN "blockers_B" > 0 THEN 'Classe ' || achieved_class || ' : ' || "blockers_B" || ' exigence(s) minimales vers la classe B ne sont pas démontrées dans les preuves disponibles.' ELSE 'Classe ' || achieved_class || ' : les exigences minimales vers la classe B semblent satisfaites sur la base des preuves disponibles.' END
 || chr(10) || 'Classe atteinte : ' || achieved_class || CASE WHEN "blockers_B" > 0 THEN chr(10) || array_to_string(string_split("blocking_B", ','), chr(10)) ELSE '' END AS body FROM gc""")
def score_slides(s, sf):
    return sc.score_slides(sc.group_classes(_judged(s, sf), ["doc_id"]), ["doc_id"])


@query("bullet_slides", with_(LINES) + """
, b AS (SELECT doc_id, line, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos) AS rank FROM ln WHERE trim(line) <> '')
SELECT doc_id, CAST((rank - 1) // 8 + 1 AS INTEGER) AS slide, CAST(COUNT(*) AS INTEGER) AS n, string_agg(line, chr(10) ORDER BY rank) AS bullets FROM b GROUP BY 1, 2""")
def bullet_slides(s, sf):
    ls = F.filter(F.split("text", "\n"), lambda v: tx.strip(v) != "")
    x = t.texts(s, sf, "documents").select("doc_id", F.posexplode(ls).alias("p", "line")).withColumn("rank", F.col("p") + 1)
    return sc.bullet_slides(x, ["doc_id"])


# ---- gates ---------------------------------------------------------------------------------

_POL = {"user": (["the", "les", "token"], "reject", "Bloqué."), "assistant": (["und", "que"], "allow_with_warning", "Attention."), "system": ([], "allow", "")}
_FOUND = f"array_to_string(CASE role WHEN 'user' THEN list_filter(['the', 'les', 'token'], lambda w: contains(lower(text), w)) WHEN 'assistant' THEN list_filter(['und', 'que'], lambda w: contains(lower(text), w)) ELSE [] END, ', ')"
_GATED = f"""g AS (SELECT conv_id, turn, role, text, {_FOUND} AS terms FROM conversations),
gg AS (SELECT conv_id, turn, CASE WHEN terms = '' THEN 'passed' WHEN role = 'user' THEN 'rejected' ELSE 'warning' END AS status, terms,
 CASE WHEN terms = '' THEN text WHEN role = 'user' THEN {q(sc.BLOCKED)} || chr(10) || chr(10) || 'Bloqué.' || chr(10) || chr(10) || '(Termes interdits détectés : ' || terms || ')' ELSE {q(sc.WARNED)} || chr(10) || chr(10) || 'Attention.' || chr(10) || chr(10) || text END AS text FROM g)"""


@query("policy_gate", with_(_GATED) + "SELECT * FROM gg")
def policy_gate(s, sf):
    x = t.texts(s, sf, "conversations").select("conv_id", "turn", sc.gate(F.col("role"), F.col("text"), _POL).alias("g"))
    return x.select("conv_id", "turn", "g.status", "g.terms", "g.text")


@query("settled_attempts", with_(_GATED) + f"""
SELECT conv_id, COUNT(*) AS tries, COALESCE(MIN(CASE WHEN status <> 'rejected' THEN turn + 1 END), 0) AS won, COALESCE(ARG_MIN(status, turn) FILTER (WHERE status <> 'rejected'), 'failed') AS status,
 COALESCE(ARG_MIN(text, turn) FILTER (WHERE status <> 'rejected'), replace({q(sc.INCOMPLETE.replace(chr(10), '~'))}, '~', chr(10))) AS text FROM gg GROUP BY 1""")
def settled_attempts(s, sf):
    x = t.texts(s, sf, "conversations").withColumn("attempt", F.col("turn") + 1)
    return sc.settle_attempts(x, ["conv_id"], "attempt", "role", "text", policy=_POL)


@query("context_check", """
SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END, CASE WHEN c_custkey % 8 = 0 THEN c_mktsegment END) AS notebook, CASE WHEN c_custkey % 8 = 4 THEN 'notebook' ELSE '' END AS missing FROM customer""")
def context_check(s, sf):
    k = F.col("c_custkey")
    x = t.table(s, sf, "customer").select("c_custkey", F.when(k % 4 == 0, "").otherwise(F.col("c_name")).alias("notebook"), F.when(k % 8 == 0, F.col("c_mktsegment")).otherwise("").alias("old_notebook"))
    return sc.context_check(x, {"notebook": "old_notebook"}).select("c_custkey", "notebook", "missing")


@query("context_mismatch", "SELECT c_custkey FROM customer WHERE c_custkey % 10 = 3")
def context_mismatch(s, sf):
    x = t.table(s, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    y = x.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 3, "OTHER").otherwise(F.col("c_mktsegment")))
    return sc.context_mismatches(x, y, "c_custkey", ["c_name", "c_mktsegment"])


# ---- report quality ------------------------------------------------------------------------

_WORD = "[a-z0-9àâçéèêëîïôûùüÿñæœ\\-]+"
_CLAR = f"""wd AS (SELECT source, UNNEST(regexp_extract_all({sql_norm('text')}, '{_WORD}')) AS w FROM documents),
wc AS (SELECT source, w, COUNT(*) AS c, ROW_NUMBER() OVER (PARTITION BY source ORDER BY COUNT(*) DESC, w) AS k FROM wd WHERE length(w) > 2 GROUP BY 1, 2),
sh AS (SELECT source, SUM(c) AS n_tokens, SUM(CASE WHEN k <= 10 THEN c END) AS top10 FROM wc GROUP BY 1),
se AS (SELECT source, trim(x, ' ' || chr(10)) AS x FROM (SELECT source, UNNEST(regexp_split_to_array(text, '[.!?]+')) AS x FROM documents)),
sl AS (SELECT source, SUM(len(regexp_extract_all({sql_norm('x')}, '{_WORD}'))) AS n_words, COUNT(*) AS n_sentences FROM se WHERE x <> '' GROUP BY 1),
cl AS (SELECT source, top10 / n_tokens AS top_share, n_words / n_sentences AS mean_length, n_tokens FROM sh JOIN sl USING (source))"""


@query("text_clarity", with_(_CLAR) + "SELECT source, ROUND(top_share, 6) AS top_share, ROUND(mean_length, 6) AS mean_length FROM cl")
def text_clarity(s, sf):
    x = sc.clarity(t.texts(s, sf, "documents"), ["source"])
    return x.select("source", F.round("top_share", 6).alias("top_share"), F.round("mean_length", 6).alias("mean_length"))


_KW = ["the", "les", "token", "que"]
_SECT = f"""st AS (SELECT source, doc_id % 3 + 1 AS mp, text, {sql_norm('text')} AS m, ['p' || (doc_id % 17), 'p' || (n_chars % 11)] AS pages, CAST(n_chars % 13 AS DOUBLE) AS ssum FROM documents),
ft AS (SELECT source, mp, CASE WHEN trim(text, ' ' || chr(10)) <> '' THEN 1 ELSE 0 END AS ht, LEAST(1.0, ssum / 8) AS den, LEAST(1.0, CAST(len(list_filter({sql_list(_KW)}, lambda k: contains(m, k))) AS DOUBLE) / {len(_KW)} / 0.6) AS al,
 CASE mp WHEN 1 THEN {' + '.join(f"(length(m) - length(replace(m, {q(p)}, ''))) // {len(p)}" for p in sc.FORBIDDEN[1])} WHEN 2 THEN {' + '.join(f"(length(m) - length(replace(m, {q(p)}, ''))) // {len(p)}" for p in sc.FORBIDDEN[2])} ELSE 0 END AS fb,
 {' + '.join(f"(length(m) - length(replace(m, {q(p)}, ''))) // {len(p)}" for p in sc.PLACEHOLDERS)} AS ph, CASE mp WHEN 1 THEN {' + '.join(f"(length(m) - length(replace(m, {q(p)}, ''))) // {len(p)}" for p in sc.DUTIES)} ELSE 0 END AS du,
 regexp_matches(text, '\\{{\\{{.+?\\}}\\}}') OR contains(text, 'page_id=') AS leak FROM st),
ag AS (SELECT source, COUNT(*) AS n, SUM(ht) AS ht, SUM(den) AS den, SUM(al) AS al, SUM(fb) AS fb, SUM(ph) AS ph, SUM(du) AS du, COUNT(DISTINCT mp) AS nmp, BOOL_OR(leak) AS hard_fail FROM ft GROUP BY 1),
pp AS (SELECT source, p, MAX(CASE WHEN mp = 1 THEN 1 ELSE 0 END) AS a, MAX(CASE WHEN mp = 3 THEN 1 ELSE 0 END) AS b FROM (SELECT source, mp, UNNEST(pages) AS p FROM st) GROUP BY 1, 2),
ru AS (SELECT source, COALESCE(SUM(a * b) / nullif(SUM(GREATEST(a, b)), 0), 0) AS sh FROM pp GROUP BY 1),
qq AS (SELECT ag.source, 25 * 0.45 * nmp / 3.0 + 25 * 0.15 + 25 * 0.40 * ht / n AS structure, 25 * (0.40 + 0.35 * den / n + 0.25 * (1 - sh)) AS evidence_coverage, 20 * al / n AS evidence_alignment,
 GREATEST(0.0, 20.0 - LEAST(11.0, fb * 0.8) - LEAST(8.0, ph * 1.2) - LEAST(7.0, du * 0.9)) AS semantic_compliance,
 10 * GREATEST(0.0, LEAST(1.0, 1.0 - CASE WHEN top_share > 0.32 THEN LEAST(0.6, (top_share - 0.32) * 2) ELSE 0 END - CASE WHEN mean_length > 28 THEN LEAST(0.4, (mean_length - 28) * 0.02) ELSE 0 END)) AS clarity, hard_fail FROM ag JOIN ru USING (source) JOIN cl USING (source))"""


@query("report_quality", with_(_CLAR, _SECT) + """
SELECT source, ROUND(CAST(structure AS DOUBLE), 6) AS structure, ROUND(CAST(evidence_coverage AS DOUBLE), 6) AS evidence_coverage, ROUND(CAST(evidence_alignment AS DOUBLE), 6) AS evidence_alignment, ROUND(CAST(semantic_compliance AS DOUBLE), 6) AS semantic_compliance, ROUND(CAST(clarity AS DOUBLE), 6) AS clarity, hard_fail,
 ROUND(CAST(CASE WHEN hard_fail THEN 0 ELSE structure + evidence_coverage + evidence_alignment + semantic_compliance + clarity END AS DOUBLE), 6) AS total FROM qq""")
def report_quality(s, sf):
    d = t.texts(s, sf, "documents")
    ref = lambda n: F.concat(F.lit("p"), n.cast("string"))
    x = d.select("source", (F.col("doc_id") % 3 + 1).alias("macro_part"), F.array(*[F.lit(k) for k in _KW]).alias("keywords"),
                 F.array(ref(F.col("doc_id") % 17), ref(F.col("n_chars") % 11)).alias("page_ids"), (F.col("n_chars") % 13).cast("double").alias("score_sum"), "text")
    out = sc.quality(x, ["source"])
    return out.withColumns({c: F.round(c, 6) for c in [*sc.WEIGHTS, "total"]})


# ---- layouts and group paths ---------------------------------------------------------------


@query("layout_choice", """
SELECT p_partkey, CAST(CASE WHEN p_size % 9 <= 1 THEN 1 WHEN p_size % 9 <= 2 THEN 2 WHEN p_size % 9 <= 4 THEN 4 ELSE 6 END AS INTEGER) AS slots FROM part""")
def layout_choice(s, sf):
    return t.table(s, sf, "part").select("p_partkey", sc.layout_for((F.col("p_size") % 9), [4, 1, 6, 2]).cast("int").alias("slots"))


@query("group_paths", """
WITH RECURSIVE g AS (SELECT p_partkey AS group_id, CASE WHEN p_partkey < 7 THEN NULL ELSE p_partkey // 7 END AS parent_id, p_name AS name FROM part),
r AS (SELECT group_id, name AS path, 1 AS depth FROM g WHERE parent_id IS NULL UNION ALL SELECT g.group_id, r.path || ' / ' || g.name, r.depth + 1 FROM g JOIN r ON g.parent_id = r.group_id)
SELECT group_id, path, CAST(depth AS INTEGER) AS depth FROM r""")
def group_paths(s, sf):
    k = F.col("p_partkey")
    g = t.table(s, sf, "part").select(k.alias("group_id"), F.when(k >= 7, F.floor(k / 7)).alias("parent_id"), F.col("p_name").alias("name"))
    return sc.group_paths(g)
