"""HTML extraction by layout: a small tree builder with implied tags, visibility rules, and block layout.

A page's markup is cut into tokens, a stack of open elements applies the implied-end rules (a
new ``p`` ends an open ``p``, ``li`` an ``li``, cells and rows each other, a cell opens a row, what is no part of
a table goes before it, ...).  Invisible subtrees (scripts, styles, ``hidden``, ``display:none``, ``aria-hidden``, the
content of a closed ``details`` or ``dialog``) are skipped, text of ``visibility:hidden`` elements too, but not that
of visible ones inside them.  What is left is laid out: one blank line between paragraphs-like blocks, one line break
between line blocks, list items with bullets or numbers and an indent by depth, tables as aligned columns (``colspan``
and ``rowspan`` keep their places), ``pre`` as written, controls by the text they show (button, text area, value,
chosen option).

Pages are independent rows: one scan, no shuffle; per-page work is about linear in the markup, at any depth of
nesting (an indent grows up to ``MAX_INDENT`` levels).

Defined results: null or empty html gives empty text and no blocks; broken markup never
fails; repeated rows are rendered each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html as entities
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_INDENT, MAX_SPAN = 64, 1000

# fixed values: element groups
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = set("head script style template noscript noembed noframes iframe title svg math canvas audio video object "
             "datalist map".split())
UNSHOWN_INPUT = set("hidden checkbox radio password file range color".split())  # their value is not text on the page
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr form fieldset article section xmp plaintext".split())
BLOCKS = SPACED | set("div li dt dd tr td th thead tbody tfoot caption header footer nav main aside address figcaption "
                      "body html center details summary legend menu hgroup search".split())
# an opening tag ends these open elements, unless one of the fences is met first
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
ENDS_P = BLOCKS - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "body", "html", "legend", "summary"}
P_FENCE = {"td", "th", "table", "caption", "button", "object", "body", "html"}

# head ends at the first tag that is none of these
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
SECTIONS, CELLS = {"thead", "tbody", "tfoot"}, {"td", "th", "caption"}
IN_TABLE = SECTIONS | CELLS | {"tr"}
TABLE_PARTS = SECTIONS | {"table", "tr"}  # anything but parts of the table in these goes before the table
FOREIGN = {"template", "svg", "math"}  # no table goes on inside

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                   r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLANK = re.compile(r"[ \t\n\f\r]+")
NONE_STYLE = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
GONE, BLIND, SEEN = 0, 1, 2  # not laid out, laid out without its text, shown


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTR.finditer(raw):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def state(tag: str, attrs: dict[str, str], around: int) -> int:
    """How an element shows inside one that shows like ``around``."""
    style = attrs.get("style", "")
    if around == GONE or tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or NONE_STYLE.search(style) \
            or tag == "dialog" and "open" not in attrs:
        return GONE
    own = VISIBILITY.search(style)
    return around if own is None else SEEN if own[1].lower() == "visible" else BLIND


def parse(source: str) -> Node:
    """Tree of the visible elements; text nodes are strings."""
    root = Node("html")
    stack, shown = [root], [SEEN]  # open elements, and how each of them shows
    places: dict[str, list[int]] = {}  # where in the stack a tag is open

    def last(tag: str) -> int:
        at = places.get(tag)
        return at[-1] if at else 0

    def last_of(tags: set[str]) -> int:
        return max(last(t) for t in tags) if tags else 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().tag].pop()
            shown.pop()

    def open_table() -> int:
        t = last("table")
        return t if t > last_of(FOREIGN) else 0

    def insert(kid: Node | str, t: int) -> None:
        """Into the open element, or before the table at ``t``."""
        kids = stack[t - 1 if t else -1].kids
        if t and kids and kids[-1] is stack[t]:
            kids.insert(len(kids) - 1, kid)
        else:
            kids.append(kid)

    def text(s: str) -> None:
        if not s:
            return
        solid = s.strip(" \t\n\f\r")
        if solid and stack[-1].tag == "head":
            close(len(stack) - 1)
        t = open_table() if stack[-1].tag in TABLE_PARTS else 0
        if shown[t - 1 if t else -1] == SEEN and (solid or not t):
            insert(entities.unescape(s), t)

    def push(tag: str, attrs: dict[str, str]) -> Node | None:
        """Adds an element and opens it if it has content; None if it is invisible."""
        t = open_table() if stack[-1].tag in TABLE_PARTS and tag not in IN_TABLE | IN_HEAD else 0
        up = t - 1 if t else len(stack) - 1
        on = state(tag, attrs, shown[up])
        node = Node(tag, attrs)
        leaf = tag in VOID or tag in RAW
        if on == SEEN or on == BLIND and not leaf:
            insert(node, t)
        if not leaf:
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
            shown.append(on)
        return node if on == SEEN else None

    def settle(tag: str, t: int) -> None:
        """Closes what a part of the table at ``t`` ends, and opens the row that a cell implies."""
        part = t + 1 if len(stack) > t + 1 and stack[t + 1].tag in SECTIONS else t
        if tag in SECTIONS or tag == "caption":
            close(t + 1)
        elif tag == "tr":
            close(part + 1)
        elif len(stack) > part + 1 and stack[part + 1].tag == "tr":
            close(part + 2)
        else:
            close(part + 1)
            push("tr", {})

    def imply(tag: str) -> None:
        if tag in ENDS:
            ends, fence = ENDS[tag]
            stop = last_of(fence)
            inner = [at[i] for at in (places.get(e, ()) for e in ends) if (i := bisect.bisect_right(at, stop)) < len(at)]
            if inner:
                close(min(inner))
        if tag in ENDS_P and last("p") > last_of(P_FENCE):
            close(last("p"))

    pos = 0
    while True:
        m = TOKEN.search(source, pos)
        if not m:
            text(source[pos:])
            return root
        text(source[pos:m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3])
            continue
        if m[1]:
            at = last(tag)
            # a table's content does not close what is open outside, nor does a template's
            if at and (at > last("table") or tag in ("table", "body", "html")) and (at > last("template") or tag == "template"):
                close(at)
            continue
        if tag == "html" or tag == "body" and last("body") or tag == "head" and (last("head") or last("body")):
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        t = open_table()
        if t and tag in ("col", "colgroup"):
            close(t + 1)
            continue
        if t and tag == "form" and stack[-1].tag in TABLE_PARTS:
            continue  # holds nothing there
        if t and tag in IN_TABLE:
            settle(tag, t)
        else:
            if t and tag == "table" and t > last_of(CELLS):
                close(t)
            imply(tag)
        node = push(tag, attributes(m[3]) if m[3] and m[3].strip(" /") else {})
        if tag in RAW:  # everything up to the matching end is text of the element
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, pos) if tag != "plaintext" else None
            if node:
                body = source[pos:end.start() if end else len(source)]
                node.kids.append(entities.unescape(body) if tag in ("textarea", "title") else body)
            pos = end.end() if end else len(source)


class Layout:
    """Lines of a page; ``gap`` is how many line ends the next text must be preceded by."""

    def __init__(self):
        self.parts: list[str] = []
        self.gap, self.blank, self.blocks, self.prefix = 0, False, 0, ""

    def need(self, lines: int) -> None:
        self.gap = max(self.gap, lines)

    def put(self, s: str) -> None:
        if self.gap or not self.parts:
            if self.parts:
                self.parts.append("\n" * self.gap)
            self.blocks += 1
            self.parts.append(self.prefix)
            self.gap, self.blank = 0, False
        elif self.blank:
            self.parts.append(" ")
            self.blank = False
        self.parts.append(s)

    def inline(self, s: str) -> None:
        body = BLANK.sub(" ", s)
        if body.startswith(" ") and self.parts and not self.gap:
            self.blank = True
        core = body.strip(" ")
        if core:
            self.put(core)
            self.blank = body.endswith(" ")


def plain(node: Node) -> str:
    """Text of a cell on one line."""
    inner = Layout()
    render(node, inner, 0)
    return BLANK.sub(" ", "".join(inner.parts)).strip()


def options(node: Node) -> list[Node]:
    return [x for kid in node.kids if not isinstance(kid, str) for x in ([kid] if kid.tag == "option" else options(kid))]


SHOWN = {"img", "input", "select"}


def shown_text(node: Node) -> str:
    """What an image or control shows: the replacing text, the value, or the chosen options (a list box shows all)."""
    a = node.attrs
    if node.tag == "img":
        return a.get("alt", "")
    if node.tag == "input":
        kind = a.get("type", "").lower()
        return "" if kind in UNSHOWN_INPUT else a.get("alt" if kind == "image" else "value", "")
    every = options(node)
    size = a.get("size", "")
    if "multiple" not in a and not (size.isascii() and size.isdigit() and int(size[:9]) > 1):
        every = [x for x in every if "selected" in x.attrs][-1:] or every[:1]
    words = [x.attrs.get("label") or plain(x) for x in every]
    return " ".join([w for w in words if w])


def content(node: Node) -> list:
    """What of an element's content is laid out: of a closed ``details`` its first summary."""
    if node.tag == "details" and "open" not in node.attrs:
        return [k for k in node.kids if not isinstance(k, str) and k.tag == "summary"][:1]
    return node.kids


def written(node: Node) -> str:
    """Text of an element as it stands, blanks and line breaks included; block elements start and end lines."""
    out: list[str] = []
    for kid in content(node):
        if isinstance(kid, str):
            out.append(kid)
        elif kid.tag == "br":
            out.append("\n")
        elif kid.tag in SHOWN:
            out.append(shown_text(kid))
        elif kid.tag == "hr":
            out.append("\n---\n")
        elif kid.tag == "table":
            inner = Layout()
            render_table(kid, inner)
            out += ["\n", "".join(inner.parts), "\n"]
        elif kid.tag in BLOCKS:
            out += ["\n" if out and not out[-1].endswith("\n") else "", written(kid), "\n"]
        else:
            out.append(written(kid))
    return "".join(out)


def _span(cell: Node, name: str) -> int:
    v = cell.attrs.get(name, "")
    return min(max(int(v[:9]), 1), MAX_SPAN) if v.isascii() and v.isdigit() else 1


def rows_of(table: Node) -> tuple[list[str], list[list[str]]]:
    """Captions and rows of cell texts; spanned places are empty cells, so that columns stay columns."""
    captions, rows = [], []
    below: dict[int, int] = {}  # column -> rows that a cell above still takes in it
    for kid in table.kids:
        if isinstance(kid, str):
            continue
        if kid.tag == "caption":
            captions.append(plain(kid))
        elif kid.tag == "tr":
            row: list[str] = []
            now: dict[int, int] = {}

            def skip():
                while below.get(len(row), 0):
                    row.append("")

            for cell in kid.kids:
                if not isinstance(cell, str) and cell.tag in ("td", "th"):
                    skip()
                    down = _span(cell, "rowspan") - 1
                    for k in range(_span(cell, "colspan")):
                        if down:
                            now[len(row)] = down
                        row.append(plain(cell) if k == 0 else "")
            skip()
            below = {c: n - 1 for c, n in below.items() if n > 1} | now
            rows.append(row)
        elif kid.tag in SECTIONS:
            more = rows_of(kid)
            captions += more[0]
            rows += more[1]
            below = {}
    return captions, rows


def render_table(node: Node, out: Layout) -> None:
    captions, rows = rows_of(node)
    rows = [r for r in rows if any(r)]
    for s in captions:
        if s:
            out.need(2)
            out.put(s)
    width: list[int] = []
    for r in rows:
        width += [0] * (len(r) - len(width))
        for i, s in enumerate(r):
            width[i] = max(width[i], len(s))
    out.need(2 if not captions else 1)
    for r in rows:
        out.put("  ".join(s.ljust(width[i]) for i, s in enumerate(r)).rstrip())
        out.need(1)


def _number(raw: str, default: int | None) -> int | None:
    sign, digits = (-1, raw[1:]) if raw[:1] == "-" else (1, raw)
    return sign * int(digits) if digits.isascii() and digits.isdigit() and len(digits) < 10 else default


def render(node: Node, out: Layout, depth: int, ordered: list[int] | None = None) -> None:
    for kid in content(node):
        if isinstance(kid, str):
            out.inline(kid)
            continue
        tag = kid.tag
        if tag == "br":
            if out.gap == 0:
                out.need(1)
            continue
        lines = 2 if tag in SPACED and not (tag in ("ul", "ol") and depth) else 1 if tag in BLOCKS else 0
        if lines:
            out.need(lines)
        if tag == "table":
            render_table(kid, out)
        elif tag in ("pre", "xmp", "plaintext"):
            body = written(kid).strip("\n")
            if body.strip():
                out.put(body)
        elif tag == "hr":
            out.put("---")
        elif tag in SHOWN:
            if (words := shown_text(kid)).strip():
                out.inline(words)
        elif tag in ("ul", "ol", "menu"):
            render(kid, out, depth + 1, [_number(kid.attrs.get("start", ""), 1)] if tag == "ol" else None)
        elif tag == "li":
            before = out.prefix
            mark = "- "
            if ordered is not None:
                ordered[0] = _number(kid.attrs.get("value", ""), ordered[0])
                mark, ordered[0] = f"{ordered[0]}. ", ordered[0] + 1
            out.prefix = "  " * min(max(depth - 1, 0), MAX_INDENT) + mark
            had = out.blocks
            render(kid, out, depth)
            out.prefix = before
            if out.blocks == had:  # an empty item shows nothing
                out.gap = max(out.gap, 1)
        else:
            render(kid, out, depth, ordered)
        if lines:
            out.need(lines)


def page_text(source: str | None) -> tuple[str, int]:
    """Text of a page and its number of blocks."""
    out = Layout()
    source = source or ""
    # layout recurses by plain Python calls, which need no C stack: the limit follows from the markup
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 4 * source.count("<")))
    render(parse(source), out, 0)
    return "".join(out.parts), out.blocks


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id, text, n_blocks of every page."""
    view = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    id_type = view.schema["page_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            done = [page_text(s) for s in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int32())],
                names=["page_id", "text", "n_blocks"])

    return view.mapInArrow(run, f"page_id {id_type}, text string, n_blocks int")
