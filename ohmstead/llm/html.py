"""Layout-aware rendering of HTML pages to text.

A tree is built with implied tags and every visible text is emitted: blocks stand apart, list items
carry marks or numbers and an indent, table cells are padded to columns.

Hidden and left out: ``script``, ``style``, ``template``, ``head`` (but not a title in the body),
``noscript``, ``iframe``, ``noembed``, ``noframes``, ``datalist``, comments, elements with the ``hidden`` attribute, ``aria-hidden="true"`` or a style with
``display:none`` or ``visibility:hidden``. A null page gives a null text, an empty page an empty one;
unknown, unclosed and misplaced tags never raise, and elements may nest to any depth.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An attribute: a quote opens a quoted value only right after '='; elsewhere it is an ordinary character.
_NAME = r"(?:=|[^ \t\n\f\r/>=])[^ \t\n\f\r/>=]*+"
_VALUE = r"[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^ \t\n\f\r>\"'][^ \t\n\f\r>]*+)|(?=>)|\Z)"
_ATTR = re.compile(rf"({_NAME})(?:{_VALUE})?+")
_ATTRS = rf"(?:[ \t\n\f\r/]++|{_NAME}(?:{re.sub(r'\((?!\?)', '(?:', _VALUE)})?+)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)({_ATTRS})(?:>|\Z)", re.S)
_MAY_HIDE = re.compile(r"hidden|none", re.I)
_UNSEEN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_START = re.compile(r"(?:^|\s)start\s*=\s*[\"']?(-?\d{1,9})", re.I)
_SPAN = re.compile(r"(?:^|\s)colspan\s*=\s*[\"']?(\d{1,3})", re.I)
_BLANK = re.compile(r"[ \t\n\f\r]+")

#: Fixed by the HTML standard.
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe noembed noframes xmp".split())
SILENT = frozenset("script style template head noscript iframe noembed noframes datalist".split())
BLOCK = frozenset("address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr td th caption ul textarea xmp".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure menu xmp".split())
#: Drawn on lines of their own, apart from their neighbours, and with their parts apart, though not blocks.
LISTED = frozenset({"option", "optgroup"})
PLACED = frozenset({"text", "mtr", "mtd"})
STACKED = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts".split())
#: In these, a slash ends any element, and marked sections are text.
FOREIGN = ("svg", "math")
#: An opening tag closes these open elements, up to a border.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "body": ({"head"}, set()),
    "colgroup": ({"caption"}, {"table"}), "col": ({"caption"}, {"table"}),
}
#: Without their end tag these end before anything but blanks and what may stand in them.
HOLDS = {
    "head": frozenset("base basefont bgsound link meta title noscript noframes style script template".split()),
    "colgroup": frozenset({"col", "template"}),
}
GROUPS = frozenset({"tbody", "thead", "tfoot"})
CELLS = frozenset({"td", "th"})
#: Tables inside cells are laid out as tables to this depth; deeper ones row by row, without recursion.
NESTED = 24
_SCOPE = frozenset({"table", "td", "th", "caption", "button", "html"})


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []


def tree(page: str) -> Node:
    root = Node("#root")
    stack = [root]
    opened: Counter[str] = Counter()

    def cut(i: int) -> None:
        opened.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close(tags: set[str] | frozenset[str], border: set[str] | frozenset[str]) -> None:
        """Closes the outermost open element of ``tags`` above the nearest border, and all inside it."""
        if not any(opened[t] for t in tags):
            return
        found = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in border:
                break
            if stack[i].tag in tags:
                found = i
        if found is not None:
            cut(found)

    def in_table(tag: str) -> None:
        """Closes what may not hold a row group, row or cell in a table, and opens the row a cell needs."""
        for i in range(len(stack) - 1, 0, -1) if opened["table"] else ():
            over = stack[i].tag
            if over == "table" or over in GROUPS and tag not in GROUPS or over == "tr" and tag in CELLS:
                cut(i + 1)
                if tag in CELLS and over != "tr":
                    start(Node("tr"))
                return

    def start(node: Node) -> None:
        stack[-1].kids.append(node)
        stack.append(node)
        opened[node.tag] += 1

    def add(text: str) -> None:
        raw(entities.unescape(text) if "&" in text else text)

    def raw(text: str) -> None:
        if text:
            if stack[-1].tag in HOLDS and not _BLANK.fullmatch(text):
                cut(len(stack) - 1)
            stack[-1].kids.append(text)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            return root
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA[") and any(opened[t] for t in FOREIGN):
                end = page.find("]]>", m.start())
                raw(page[m.start() + 9 : end if end >= 0 else len(page)])
                at = end + 3 if end >= 0 else len(page)
            continue
        tag = m[2].lower()
        if m[1]:
            # a stray end tag in a table cell does not close what holds the table
            border = frozenset() if tag in _SCOPE else frozenset({"table"})
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in border:
                    break
            continue
        if stack[-1].tag in HOLDS and tag not in HOLDS[stack[-1].tag]:
            if tag == "html" or tag == "head" == stack[-1].tag:
                continue
            cut(len(stack) - 1)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag == "tr" or tag in CELLS or tag in GROUPS:
            in_table(tag)
        if tag in BLOCK and opened["p"]:
            close({"p"}, _SCOPE)
        if tag == "a":
            close({"a"}, _SCOPE)
        node = Node(tag, m[3] or "")
        if tag in VOID or node.attrs.endswith("/") and (any(opened[t] for t in FOREIGN) or tag not in BLOCK and tag not in RAW):
            stack[-1].kids.append(node)
            continue
        if tag in RAW or tag in ("textarea", "title"):
            stack[-1].kids.append(node)
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            body = page[at : end.start()] if end else page[at:]
            if tag not in SILENT:
                node.kids.append(entities.unescape(body) if tag not in RAW else body)
            at = end.end() if end else len(page)
            continue
        start(node)


class _Out:
    """Lines of output with pending blank space between them."""

    __slots__ = ("lines", "line", "gap", "space")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.space = 0, False

    def text(self, s: str) -> None:
        words = _BLANK.split(s)
        if len(words) == 1 and not words[0]:
            return
        body = " ".join(w for w in words if w)
        if self.line and (self.space or words[0] == ""):
            if body:
                self.line.append(" ")
            else:
                self.space = True
        if body:
            self.line.append(body)
            self.space = words[-1] == ""

    def end(self, gap: int = 0) -> None:
        if self.line:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.lines.append("".join(self.line))
            self.line = []
        self.space = False
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.end()
        return self.lines


def _hides(attrs: str) -> bool:
    """Whether an element's own attributes hide it; words inside other attributes' values do not."""
    if not _MAY_HIDE.search(attrs):
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _UNSEEN.search(value):
            return True
    return False


def _parts(table: Node) -> tuple[list[Node], list[Node], list]:
    """Captions and rows of a table, and all else in it and in its row groups but columns."""
    captions, rows, loose, todo = [], [], [], list(reversed(table.kids))
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            loose.append(n)
        elif n.tag == "tr":
            rows.append(n)
        elif n.tag in GROUPS:
            if not _hides(n.attrs):
                todo.extend(reversed(n.kids))
        elif n.tag == "caption":
            captions.append(n)
        elif n.tag not in ("colgroup", "col"):
            loose.append(n)
    return captions, rows, loose


def _seen(n: Node) -> bool:
    return n.tag not in SILENT and not _hides(n.attrs)


def _flat(node: Node, nest: int = 0) -> list[str]:
    """Lines of a node's visible text, from an explicit stack of steps."""
    out = _Out()
    todo: list = [("kids", node, 0, False)]
    counters: list[list] = []
    while todo:
        what, n, depth, pre = todo.pop()
        if what == "text":
            if pre:
                for i, part in enumerate(n.split("\n")):
                    if i:
                        out.end()
                        if not part and out.lines:
                            out.lines.append("")
                    if part.strip():
                        out.line.append(part)
            else:
                out.text(n)
        elif what == "end":
            out.end(1 if n.tag in APART and not (n.tag in ("ul", "ol", "menu") and depth) else 0)
            if n.tag in ("ul", "ol", "menu"):
                counters.pop()
        elif what == "apart":
            out.text(" ")
        elif what == "kids":
            for k in reversed(n.kids):
                todo.append(("text", k, depth, pre) if isinstance(k, str) else ("node", k, depth, pre))
        elif _seen(n):
            if n.tag == "br":
                if out.line:
                    out.end()
                continue
            if n.tag == "img":
                alt = next((m for m in _ATTR.finditer(n.attrs) if m[1].lower() == "alt"), None)
                if alt:
                    out.text(" " + entities.unescape(alt[2] or alt[3] or alt[4] or "") + " ")
                continue
            if n.tag in BLOCK:
                out.end(1 if n.tag in APART and not (n.tag in ("ul", "ol", "menu") and depth) else 0)
            if n.tag == "table" and nest < NESTED:
                loose = Node("div")
                captions, rows, loose.kids = _parts(n)
                for c in captions:
                    if _seen(c):
                        for line in _flat(c, nest + 1):
                            out.line.append(line)
                            out.end()
                for line in _grid([r for r in rows if _seen(r)], nest + 1):
                    out.line.append(line)
                    out.end()
                todo.append(("end", n, depth, pre))
                todo.append(("kids", loose, depth, pre))
                continue
            if n.tag in ("ul", "ol", "menu"):
                first = _START.search(n.attrs)
                counters.append([n.tag == "ol", int(first[1]) if first else 1])
                todo.append(("end", n, depth, pre))
                todo.append(("kids", n, depth + 1, pre))
                continue
            if n.tag == "li":
                mark = "- "
                if counters and counters[-1][0]:
                    mark = f"{counters[-1][1]}. "
                    counters[-1][1] += 1
                out.line.append("  " * max(0, depth - 1) + mark)
                out.space = False
            if n.tag in LISTED:
                out.end()
            if n.tag in BLOCK or n.tag in LISTED:
                todo.append(("end", n, depth, pre))
            elif n.tag in PLACED:
                out.text(" ")
                todo.append(("apart", n, depth, pre))
            elif n.tag in STACKED:
                for k in reversed(n.kids):
                    todo.extend([("apart", n, depth, pre), ("text" if isinstance(k, str) else "node", k, depth, pre)])
                continue
            todo.append(("kids", n, depth, pre or n.tag in ("pre", "textarea", "xmp")))
    return out.done()


def _grid(rows: list[Node], nest: int) -> list[str]:
    """Rows of cells, each column padded to its widest cell; a cell's own lines are joined by spaces."""
    cells = []
    for r in rows:
        line = []
        for c in r.kids:
            if isinstance(c, str):
                if c.strip():
                    line.append(" ".join(c.split()))
            elif _seen(c):
                cell = " ".join(x.strip() for x in _flat(c, nest) if x.strip())
                if not cell and c.tag not in CELLS:
                    continue
                line.append(cell)
                span = _SPAN.search(c.attrs)
                line.extend([""] * (min(int(span[1]), 100) - 1 if span else 0))
        if any(line):
            cells.append(line)
    width = [max((len(line[i]) for line in cells if i < len(line)), default=0) for i in range(max(map(len, cells), default=0))]
    return [" | ".join(c.ljust(w) for c, w in zip(line, width, strict=False)).rstrip() for line in cells]


def rendered(page: str | None) -> str | None:
    """All visible text of a page."""
    if page is None:
        return None
    return "\n".join(line.rstrip() for line in _flat(tree(page)))


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the rendered text; a column of that name is replaced."""

    @F.pandas_udf("string")
    def render(col):
        return col.map(rendered, na_action="ignore")

    return pages.withColumn(out, render(F.col(html)))
