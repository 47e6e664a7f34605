"""Text rules as column expressions; lists of lines are arrays, so a text is handled in its own row."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accents folded letter by letter, and the word lists of the rules below.
FOLD_FROM = "éèêëàâäîïôöûüç"
FOLD_TO = "eeeeaaaiioouuc"
CAPTION_PREFIXES = [
    "légende:", "legende:", "legend:", "caption:", "#legende", "#légende", "#legend", "[legende]", "[légende]", "[legend]",
]
STOP_WORDS = [
    "le", "la", "les", "des", "de", "du", "un", "une", "et", "ou", "à", "au", "aux", "dans", "sur", "pour", "avec", "sans", "en", "d", "l",
]
MONTHS = [
    "janvier", "fevrier", "février", "mars", "avril", "mai", "juin", "juillet", "aout", "août", "septembre", "octobre",
    "novembre", "decembre", "décembre",
]
DECOR = [
    "sommaire", "sommaire.", "version", "user flow", "global", "rapport d’audit", "rapport d'audit",
    "rapport d’inspection bacs", "rapport d'inspection bacs",
]
NOISE_PATTERNS = [
    r"^amo\s+(bacs|gtb)\s*-\s*\d+$", r"^non\s+applicable$", r"^–\s*non\s+applicable$", r"^\d{2}\.\d{2}\.\d{2}.*$",
    r"^\d+\s*€\s*ht$", r"^\d+€ht$", r"^[a-z]{1,4}\d{4,}$", r"^(r|ss)\d{1,2}\s+[a-z0-9_-]{3,}$",
]
TOC_WORDS = [
    "contexte", "objectif", "presentation", "etat", "diagnostic", "dysfonction", "scoring", "conformite", "travaux", "tri",
    "analyse", "conclusion", "annexe", "plan d", "prerequis", "actions",
]
NOISE_LINES = ["page", "texte", "texte detail", "info cle", "user flow"]
INSUFFICIENT = ["rien a signaler", "notes insuffisantes", "pas assez de sources", "source insuffisante"]
REQUEST_STARTS = ["peux-tu", "peux tu", "pouvez-vous", "pouvez vous", "merci de", "svp", "stp", "à faire", "todo"]
DUTY_STARTS = ["il faut", "il est nécessaire", "doit", "devra"]
META_PHRASES = [
    "voici les puces", "voici les bullets", "puces finales", "j'ai respecte", "j’ai respecte", "contraintes", "en sortie",
    "reponse", "je n'ai pas", "je n’ai pas",
]
TERMS = [
    (r"\bjtb\b", "GTB"), (r"\bgtbs\b", "GTB"), (r"\bgtb\b", "GTB"), (r"\btgbt\b", "TGBT"), (r"\bvrv\b", "VRV"), (r"\bcta\b", "CTA"),
    (r"\bbacs\b", "BACS"), (r"\ba[eé]roterm(?:e|es)?\b", "aérothermes"), (r"\ba[eé]rotherm(?:e|es)?\b", "aérothermes"),
    (r"\br-plus-1\b", "R+1"), (r"\br\+1\b", "R+1"), (r"\brez[- ]?de[- ]?chauss[ée]e\b", "rez-de-chaussée"),
]
TITLE_MAP = {
    "ge": "Groupe électrogène", "groupes froids": "Groupes froids", "vrv": "Système VRV", "tgbt": "TGBT",
    "local autocom": "Local autocom", "local eau": "Local eau", "extracteurs": "Extracteurs",
    "supervision": "Supervision GTB", "coffret gtb": "Coffret GTB",
}
EXTENSIONS = {
    "image/jpeg": ".jpg", "image/jpg": ".jpg", "image/png": ".png", "image/gif": ".gif", "image/webp": ".webp",
    "application/pdf": ".pdf", "audio/mpeg": ".mp3", "audio/mp4": ".m4a", "audio/x-m4a": ".m4a", "audio/wav": ".wav", "video/mp4": ".mp4",
}

WORD = "(?iuU)"  # case-blind, with Unicode word borders
BLANK = r"[\s\p{Z}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once; inside lambdas Spark would evaluate it at every mention."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"^{BLANK}+|{BLANK}+$", "")


def strip_chars(c: Column | str, chars: str) -> Column:
    return F.trim(col(c), F.lit(chars))


def rstrip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"{BLANK}+$", "")


def squash(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), f"{BLANK}+", " "))


def norm(c: Column | str) -> Column:
    """Lower case, single spaces."""
    return squash(F.lower(F.coalesce(col(c), F.lit(""))))


def fold(c: Column | str, plus: bool = False) -> Column:
    """Accents folded, anything but letters, digits and dashes blanked."""
    x = F.translate(F.lower(F.coalesce(col(c), F.lit(""))), FOLD_FROM, FOLD_TO)
    return squash(F.regexp_replace(x, r"[^a-z0-9\s+-]" if plus else r"[^a-z0-9\s-]", " "))


def _latin_letters() -> tuple[str, str]:
    """Letters of the Latin blocks whose compatibility decomposition is one plain letter."""
    src, dst = "", ""
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != chr(cp):
            src, dst = src + chr(cp), dst + plain
    return src, dst


LATIN_FROM, LATIN_TO = _latin_letters()


def plain(c: Column | str) -> Column:
    """Lower case without accents, single spaces."""
    x = F.translate(F.lower(F.coalesce(col(c), F.lit(""))), LATIN_FROM, LATIN_TO)
    return squash(F.regexp_replace(x, r"\p{M}", ""))


def lines(c: Column | str) -> Column:
    return F.split(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\r\n?", "\n"), "\n")


def any_of(tests: Iterable[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def any_in(c: Column, words: Sequence[str]) -> Column:
    return let(c, lambda v: any_of(F.contains(v, F.lit(w)) for w in words))


def any_start(c: Column, words: Sequence[str]) -> Column:
    return let(c, lambda v: any_of(F.startswith(v, F.lit(w)) for w in words))


def hits(c: Column, words: Sequence[str]) -> Column:
    """How many of the listed words occur; a word listed twice counts twice."""
    return let(c, lambda v: sum((F.contains(v, F.lit(w)).cast("int") for w in words if w), F.lit(0)))


def phrase_count(c: Column, phrases: Sequence[str]) -> Column:
    """Non-overlapping occurrences of all phrases."""
    return let(c, lambda v: sum(
        (((F.length(v) - F.length(F.replace(v, F.lit(p), F.lit("")))) / len(p)).cast("long") for p in phrases), F.lit(0).cast("long")
    ))


def slug(c: Column | str, sep: str = "-", default: str = "page") -> Column:
    # only the dashes put in differ between separators, so slugs of one text share the costly part
    x = F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "-"), F.lit("-"))
    x = x if sep == "-" else F.replace(x, F.lit("-"), F.lit(sep))
    return F.when(x == "", default).otherwise(x)


def _sides(name: Column) -> Column:
    return F.filter(F.transform(F.split(name, " - "), strip), lambda p: p != "")


def section_name(c: Column | str, upper_names: dict[str, str] | None = None) -> Column:
    """``left - right`` with plain dashes; known right-hand names take their fixed spelling."""
    def named(x: Column, parts: Column) -> Column:
        right = F.get(parts, F.lit(1))
        for low, fixed in (upper_names or {}).items():
            right = F.when(F.lower(right) == low, fixed).otherwise(right)
        return F.when(F.size(parts) >= 2, F.concat(F.get(parts, F.lit(0)), F.lit(" - "), right)).otherwise(x)

    spaced = squash(F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), r"\s*[‒–—−-]+\s*", " - "))
    return let(spaced, lambda x: let(_sides(x), lambda parts: named(x, parts)))


def section_variants(c: Column | str, upper_names: dict[str, str] | None = None) -> Column:
    def spelled(name: Column, parts: Column) -> Column:
        left, right = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        two = F.array(F.concat(left, F.lit(" - "), F.upper(right)), F.concat(left, F.lit(" - "), F.initcap(right)))
        base = F.filter(F.array(strip(col(c)), name), lambda v: v != "")
        return F.array_distinct(F.when(F.size(parts) >= 2, F.concat(base, two)).otherwise(base))

    return let(section_name(c, upper_names), lambda name: let(_sides(name), lambda parts: spelled(name, parts)))


def fix_terms(c: Column | str, terms: Sequence[tuple[str, str]] = TERMS) -> Column:
    x = F.coalesce(col(c), F.lit(""))
    for pattern, word in terms:
        x = F.regexp_replace(x, WORD + pattern, word)
    return squash(x)


def tidy_newlines(c: Column | str) -> Column:
    x = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\r\n?", "\n")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def strip_markdown(c: Column | str) -> Column:
    x = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\*\*(.*?)\*\*", "$1")
    x = F.regexp_replace(x, r"\*(.*?)\*", "$1")
    x = F.regexp_replace(x, r"(?m)^\s*#+\s*", "")
    return strip(F.replace(x, F.lit("•"), F.lit("-")))


def is_caption(c: Column) -> Column:
    return any_start(F.lower(strip(c)), CAPTION_PREFIXES)


def caption_body(c: Column) -> Column:
    def body(s: Column) -> Column:
        out = s
        for p in reversed(CAPTION_PREFIXES):
            out = F.when(F.startswith(F.lower(s), F.lit(p)), strip_chars(s.substr(F.lit(len(p) + 1), F.length(s)), " :-\t")).otherwise(out)
        return out

    return let(strip(c), body)


def after_colon(s: Column) -> Column:
    return strip(s.substr(F.instr(s, ":") + 1, F.length(s)))


def client_body(c: Column | str) -> Column:
    """Text without proof lines, ids and captions; the voice-note prefix goes, its text stays."""
    def one(ln: Column, s: Column, low: Column) -> Column:
        drop = F.contains(low, F.lit("page_id=")) | F.contains(low, F.lit("preuve:")) | is_caption(s)
        voice = F.startswith(low, F.lit("note vocale :"))
        return F.when(voice, F.nullif(after_colon(s), F.lit(""))).when(s == "", F.lit("")).when(~drop, ln)

    ls = lines(tidy_newlines(strip_markdown(c)))
    kept = F.transform(ls, lambda ln: let(strip(ln), lambda s: let(F.lower(s), lambda low: one(ln, s, low))))
    return tidy_newlines(F.array_join(F.filter(kept, lambda v: v.isNotNull()), "\n"))


def cut(c: Column, longest: int, keep: int) -> Column:
    """Ellipsis after ``keep`` characters when longer than ``longest``."""
    return let(c, lambda v: F.when(F.length(v) > longest, F.concat(rstrip(F.substring(v, 1, keep)), F.lit("…"))).otherwise(v))


def _strip_dash(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"^(?:- \s*)+", ""))


def bullet_lines(c: Column | str, max_lines: int = 10) -> Column:
    """Bullets of a text; a longer text ends with an ellipsis line."""
    ls = F.filter(F.transform(lines(tidy_newlines(strip_markdown(client_body(c)))), strip), lambda s: s != "")
    return let(F.transform(ls, lambda s: cut(_strip_dash(s), 190, 187)), lambda out: _first_lines(out, max_lines))


def _first_lines(ls: Column, most: int) -> Column:
    return F.when(F.size(ls) > most, F.concat(F.slice(ls, 1, most - 1), F.array(F.lit("…")))).otherwise(ls)


def bullets(c: Column | str, max_lines: int = 10) -> Column:
    return F.array_join(F.transform(bullet_lines(c, max_lines), lambda s: F.concat(F.lit("- "), s)), "\n")


def slide_lines(c: Column | str, max_lines: int = 12) -> Column:
    """Lines of a slide body without bullet dashes, capped with an ellipsis."""
    ls = F.transform(lines(tidy_newlines(strip_markdown(c))), lambda s: strip(F.regexp_replace(strip(s), r"^-", "")))
    return let(F.filter(ls, lambda s: s != ""), lambda out: _first_lines(out, max_lines))


def strip_bullet(c: Column) -> Column:
    return strip(F.regexp_replace(_strip_dash(strip(c)), "^•+", ""))


def is_insufficient(c: Column) -> Column:
    return any_in(fold(c, plus=True), INSUFFICIENT)


def is_noise_line(c: Column) -> Column:
    return let(fold(c, plus=True), lambda n: (
        (n == "") | n.isin(NOISE_LINES) | F.contains(n, F.lit("page_id")) | F.startswith(n, F.lit("preuve")) | any_in(n, INSUFFICIENT)))


def is_title_line(c: Column, title: Column) -> Column:
    """Whether a line only repeats a title that is already folded."""
    return (c != "") & (title != "") & (fold(strip_bullet(c), plus=True) == title)


def is_month_year(n: Column) -> Column:
    return n.rlike(r"^(" + "|".join(MONTHS) + r") \d+$")


def is_noise(n: Column) -> Column:
    """On normalised text: empty, short, without letters, or one of the known junk shapes."""
    return let(n, lambda v: (F.length(v) < 4) | ~v.rlike(r"\p{L}") | any_of(v.rlike("(?i)" + p) for p in NOISE_PATTERNS))


def is_decor(n: Column) -> Column:
    return let(n, lambda v: (v == "") | v.isin(DECOR) | is_month_year(v))


def is_request(c: Column) -> Column:
    return F.contains(c, F.lit("?")) | any_start(norm(c), [*REQUEST_STARTS, *DUTY_STARTS])


def sentences(c: Column) -> Column:
    """Sentences of a line; very long ones are also cut at connecting words."""
    parts = F.filter(F.transform(F.split(fix_terms(strip_bullet(c)), r"(?<=[.!?])\s+"), strip), lambda s: s != "")
    linked = r"(?iu)\s+(?:et|mais|tandis que|ce qui|donc|dans ce cadre|par conséquent)\s+"
    pieces = F.transform(parts, lambda s: F.when(
        F.length(s) > 320, F.filter(F.transform(F.split(s, linked), lambda p: strip_chars(p, " ,;")), lambda p: p != "")
    ).otherwise(F.array(s)))
    return F.flatten(pieces)


def tokens(c: Column, plus: bool = False) -> Column:
    return F.array_distinct(F.filter(F.split(fold(c, plus), " "), lambda t: t != ""))


def overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the smaller token set."""
    small = F.least(F.size(a), F.size(b))
    return F.when(small > 0, F.size(F.array_intersect(a, b)) / small).otherwise(F.lit(0.0))


def greedy_distinct(ls: Column, threshold: float, max_keep: int, plus: bool = False) -> Column:
    """Lines in order, each kept unless it overlaps one kept before; stops at ``max_keep``."""
    items = F.transform(ls, lambda s: F.struct(s.alias("s"), tokens(s, plus).alias("t")))
    none = F.array().cast("array<struct<s:string,t:array<string>>>")
    kept = F.aggregate(items, none, lambda acc, x: F.when(
        (F.size(acc) >= max_keep) | F.exists(acc, lambda p: overlap(p["t"], x["t"]) >= threshold), acc
    ).otherwise(F.concat(acc, F.array(x))))
    return F.transform(kept, lambda p: p["s"])


def facts(notes: Column | str, title: Column | str | None = None) -> Column:
    """Single statements of raw notes: split, noise dropped, near repeats dropped, ten at most."""
    def without_voice(s: Column) -> Column:
        voice = F.startswith(fold(s, plus=True), F.lit("note vocale")) & F.contains(s, F.lit(":"))
        return F.when(voice, after_colon(s)).otherwise(s)

    def split(s: Column, head: Column) -> Column:
        return F.when(is_noise_line(s) | is_title_line(s, head), F.array().cast("array<string>")).otherwise(sentences(s))

    def statements(head: Column) -> Column:
        ls = F.transform(lines(tidy_newlines(notes)), lambda ln: let(strip_bullet(ln), lambda s: let(without_voice(s), lambda v: split(v, head))))
        parts = F.transform(F.flatten(ls), lambda s: strip_chars(s, " -•\t"))
        return F.filter(parts, lambda s: (s != "") & ~is_noise_line(s) & ~is_title_line(s, head) & (F.length(fold(s, plus=True)) >= 12))

    head = fold(col(title), plus=True) if title is not None else F.lit("")
    return F.slice(greedy_distinct(let(head, statements), 0.88, 1 << 30, plus=True), 1, 10)


def bullet_payloads(c: Column | str) -> Column:
    return F.filter(F.transform(lines(tidy_newlines(c)), strip_bullet), lambda s: s != "")


def coverage(source: Column, payloads: Column, least: float = 0.28) -> Column:
    """Share of source statements that some output line covers."""
    def share(src: Column, out: Column) -> Column:
        covered = F.filter(src, lambda f: let(tokens(f, plus=True), lambda t: F.exists(out, lambda b: overlap(t, b) >= least)))
        return F.when(F.size(src) == 0, 1.0).when(F.size(out) == 0, 0.0).otherwise(F.size(covered) / F.size(src))

    return let(source, lambda src: let(F.transform(payloads, lambda b: tokens(b, plus=True)), lambda out: share(src, out)))


def is_rich(source: Column) -> Column:
    return F.size(source) >= 2


def too_poor(source: Column, candidate: Column) -> Column:
    """Whether candidate bullets lose too much of the source statements."""
    def poor(src: Column, out: Column) -> Column:
        return (
            (strip(F.coalesce(candidate, F.lit(""))) == "")
            | (is_insufficient(candidate) & is_rich(src))
            | ((F.size(src) >= 3) & ((F.size(out) <= 1) | (coverage(src, out) < 0.35)))
        )

    return let(source, lambda src: let(bullet_payloads(candidate), lambda out: poor(src, out)))


def fallback_bullets(source: Column, max_bullets: int = 8) -> Column:
    """Bullets straight from the source statements."""
    items = F.filter(F.transform(source, lambda f: cut(strip_chars(fix_terms(f), " ."), 230, 229)), lambda f: f != "")
    out = F.transform(F.slice(items, 1, max_bullets), lambda f: F.concat(F.lit("- "), f))
    return let(out, lambda ls: F.when(F.size(ls) == 0, F.lit("- Rien à signaler (notes insuffisantes).")).otherwise(
        F.array_join(greedy_distinct(ls, 0.88, max_bullets, plus=True), "\n")))


def best_bullets(source: Column, candidate: Column) -> Column:
    return let(source, lambda src: F.when(
        (F.coalesce(candidate, F.lit("")) != "") & ~too_poor(src, candidate), candidate).otherwise(fallback_bullets(src)))


def _unit_title(s: Column) -> Column:
    pattern = r"(?iu)^(cta)\s*([0-9]+)\s*(.*)$"
    tail = F.replace(F.replace(strip(F.regexp_extract(s, pattern, 3)), F.lit(" - "), F.lit(" – ")), F.lit("-"), F.lit(" – "))
    head = F.concat(F.lit("CTA "), F.regexp_extract(s, pattern, 2))
    joint = lambda v: F.when(F.contains(v, F.lit("–")), F.lit(" ")).otherwise(F.lit(" – "))
    return F.when(s.rlike(pattern), let(tail, lambda v: F.when(v == "", head).otherwise(F.concat(head, joint(v), v))))


def _board_title(s: Column) -> Column:
    pattern = r"(?iu)^(td)\s*(.*)$"
    rest = strip(F.regexp_extract(s, pattern, 2))
    for p, w in ((r"\brdc\b", "RDC"), (r"\bsous\s*sol\b", "Sous-sol"), (r"\bniveau\b", "Niveau")):
        rest = F.regexp_replace(rest, WORD + p, w)
    return F.when(s.rlike(pattern), let(rest, lambda v: F.when(v != "", F.concat(F.lit("Tableau divisionnaire – "), v)).otherwise(F.lit("Tableau divisionnaire"))))


def normal_title(c: Column | str) -> Column:
    """Fixed names, numbered units, boards and acronyms of page titles."""
    def word(w: Column) -> Column:
        known = F.lower(w).isin("gtb", "tgbt", "vrv", "knx") | F.lower(w).rlike(r"^r\+\d+$")
        return F.when(known, F.upper(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w))))

    def titled(s: Column) -> Column:
        names = F.create_map(*[F.lit(x) for kv in TITLE_MAP.items() for x in kv])
        fixed = F.try_element_at(names, fold(s, plus=True))
        short = F.when(F.length(s) <= 4, F.upper(s))
        words = strip(F.array_join(F.transform(F.split(s, " "), word), " "))
        return F.when(s == "", F.lit("")).otherwise(F.coalesce(fixed, _unit_title(s), _board_title(s), short, words))

    bare = strip(F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), r"\?{2,}", ""))
    return let(strip(F.regexp_replace(bare, r"\s{2,}", " ")), titled)


def candidate_parts(c: Column | str) -> tuple[Column, Column]:
    """Title line and cleaned bullets of a candidate text."""
    is_title = lambda s: any_start(F.lower(s), ["titre:", "title:"])
    ls = F.filter(F.transform(lines(tidy_newlines(c)), strip), lambda s: s != "")
    last = F.try_element_at(F.filter(ls, is_title), F.lit(-1))
    title = let(last, lambda s: F.when(s.isNotNull(), normal_title(after_colon(s))))
    body = F.transform(
        F.filter(ls, lambda s: ~is_title(s) & s.rlike("^(- |•)")), lambda s: strip(F.regexp_replace(s, "^(- |•+)", "")))
    kept = F.filter(body, lambda s: (s != "") & ~s.rlike(r"^[A-Za-zÀ-ÿ '\-]+\s*:\s+"))
    kept = F.transform(kept, lambda s: F.concat(F.lit("- "), cut(s, 230, 229)))
    kept = let(kept, lambda k: F.when(F.size(k) >= 2, F.filter(k, lambda s: ~is_insufficient(s))).otherwise(k))
    return title, F.array_join(greedy_distinct(kept, 0.86, 8, plus=True), "\n")


def without_chat(c: Column) -> Column:
    """A line without emojis and chat phrases; NULL when nothing usable is left."""
    def formal(s: Column) -> Column:
        out = s
        for p, w in ((r"\bton\b", "le"), (r"\bta\b", "la"), (r"\btes\b", "les"), (r"\btu\b", "le site")):
            out = F.regexp_replace(out, WORD + p, w)
        chat = fold(s).rlike(r"\bje peux\b|\bje te\b|\boui\b")
        return let(strip(out), lambda o: F.when(~chat & (o != "") & ~fold(o).rlike(r"\btravaux a engager\b|\bcctp\b"), o))

    return let(squash(F.regexp_replace(strip(c), "[\\x{1F300}-\\x{1FAFF}✔❌⚠\\x{FE0F}]", "")), formal)


def clean_bullets(ls: Column, threshold: float = 0.82, max_keep: int = 12) -> Column:
    bare = F.transform(ls, lambda s: without_chat(strip(F.regexp_replace(strip(s), r"^(?:- |•+)", ""))))
    return greedy_distinct(F.transform(F.filter(bare, lambda s: s.isNotNull()), lambda s: F.concat(F.lit("- "), s)), threshold, max_keep)


def keywords(title: Column, body: Column, most: int = 18) -> Column:
    x = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit(""))))
    x = F.regexp_replace(x, r"[^a-z0-9àâäéèêëîïôöùûüçœ\s-]", " ")
    toks = F.transform(F.split(x, r"\s+"), lambda w: F.trim(w, F.lit("-")))
    return F.slice(F.array_distinct(F.filter(toks, lambda w: (F.length(w) >= 3) & ~w.isin(STOP_WORDS))), 1, most)


def toc_entries(c: Column | str) -> Column:
    """Table-of-contents entries of a text block, first spelling of each kept in order."""
    def entry(s: Column) -> Column:
        s2 = strip(F.regexp_replace(s, r"^\s*\d{1,2}\s*[-–]?\s*", ""))
        s2 = strip(F.regexp_replace(s2, r"(?iu)slides?\s+\d+\s*(a|à)\s*\d+", ""))
        bad = (s == "") | s.rlike(r"(?i)(slides?\s+\d+|page\s+\d+|^\d+$)")
        return let(s2, lambda v: F.struct(v.alias("s"), plain(v).alias("n"), bad.alias("bad")))

    es = F.transform(lines(c), lambda raw: let(strip(F.regexp_replace(strip(raw), r"\s+\d{1,3}$", "")), entry))
    return first_by_key(F.filter(es, lambda e: ~e["bad"] & ~is_noise(e["n"]) & ~is_decor(e["n"]) & (any_in(e["n"], TOC_WORDS) | (F.length(e["n"]) >= 18))))


def first_by_key(es: Column) -> Column:
    """``s`` of the first element for each key ``n``, order kept."""
    def firsts(v: Column, names: Column) -> Column:
        return F.transform(F.filter(v, lambda e, i: F.array_position(names, e["n"]) == i + 1), lambda e: e["s"])

    return let(es, lambda v: let(F.transform(v, lambda e: e["n"]), lambda names: firsts(v, names)))


def short_caption(c: Column | str) -> Column:
    s = strip(F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), "[\\x{1F300}-\\x{1FAFF}]", ""))
    return cut(strip(F.split_part(s, F.lit("\n"), F.lit(1))), 60, 57)


def extension_of(content_type: Column | str) -> Column:
    key = F.lower(strip(F.split_part(F.coalesce(col(content_type), F.lit("")), F.lit(";"), F.lit(1))))
    out = F.lit("")
    for k, v in EXTENSIONS.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def file_id(path: Column | str) -> Column:
    """Readable stem plus a digest of the whole path."""
    p = col(path)
    name = F.regexp_extract(p, r"([^/]*)$", 1)
    stem = F.substring(F.regexp_replace(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), "[^a-zA-Z0-9_-]+", "_"), 1, 60)
    return F.concat(stem, F.lit("-"), F.substring(F.sha1(F.encode(p, "utf-8")), 1, 12))


def safe_name(c: Column | str) -> Column:
    x = F.substring(F.regexp_replace(col(c), r"(?U)[^\w\-.]+", "_"), 1, 180)
    return F.when(x == "", "layer").otherwise(x)


def lenient_json(c: Column | str, schema: str) -> Column:
    """Object parsed from the whole text, else from its first ``{`` to its last ``}``."""
    s = strip(F.coalesce(col(c), F.lit("")))
    inner = F.regexp_extract(s, r"(?s)(\{.*\})", 1)
    opts = {"mode": "PERMISSIVE"}
    whole = F.when(F.startswith(s, F.lit("{")) & F.endswith(s, F.lit("}")), F.from_json(s, schema, opts))
    return F.coalesce(whole, F.when(inner != "", F.from_json(inner, schema, opts)))


def clean_text(c: Column | str) -> Column:
    """Plain spaces, no page-number headers."""
    x = strip(F.regexp_replace(F.translate(F.coalesce(col(c), F.lit("")), "\u00a0", " "), r"[ \t]{2,}", " "))
    return strip(F.regexp_replace(x, r"(?i)Page\s+\d+\s+sur\s+\d+", ""))


def rule_choice(c: Column, rules: Sequence[tuple[Sequence[str], object]], default: object = None) -> Column:
    """Value of the first rule with a word contained in the text."""
    def choice(v: Column) -> Column:
        found = [F.when(any_of(F.contains(v, F.lit(w)) for w in words), F.lit(value)) for words, value in rules]
        return F.coalesce(*found, F.lit(default))

    return let(c, choice)
