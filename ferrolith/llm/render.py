"""Layout-aware rendering of HTML: all visible text with block spacing, lists and aligned tables."""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by behaviour.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head title template noscript iframe object audio video canvas datalist meta link".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr td th ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure".split())
#: A start tag of the key closes open elements of the value, up to the scope elements.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tr": {"tr", "td", "th", "caption", "colgroup"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"},
    "thead": {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"},
    "tfoot": {"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, "body": {"head"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "optgroup": {"select"}}
TABLE_SCOPE = {"table"}
#: A start tag of the key in a table closes all above the innermost of the value; elements that hold only such parts.
SECTIONS = {"tbody", "thead", "tfoot"}
TABLE_PARTS = {
    "caption": TABLE_SCOPE, "colgroup": TABLE_SCOPE, "col": {"table", "colgroup"}, **dict.fromkeys(SECTIONS, TABLE_SCOPE),
    "tr": {"table", *SECTIONS}, "td": {"table", "tr", *SECTIONS}, "th": {"table", "tr", *SECTIONS},
}
TABLE_FRAME = {"table", "tr", "colgroup", *SECTIONS}
TABLE_CELLS = {"td", "th", "caption"}
CLOSE_P = BLOCKS - {"body", "html", "li", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"} | {"hr"}
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())

SPACE = " \t\n\r\f"
#: A quote opens a value only after "="; one that is never closed is part of a name.
NAME = f"[^{SPACE}/>][^{SPACE}/>=]*+"
EQUALS = f"[{SPACE}]*+=[{SPACE}]*+"
BARE = f"[^{SPACE}\"'>][^{SPACE}>]*+"
TOKEN = re.compile(
    f"<!--.*?(?:-->|$)|<![^>]*>|<\\?[^>]*>|<(/?)([a-zA-Z][^{SPACE}/>]*+)"
    f"((?:[{SPACE}/]|{NAME}(?:{EQUALS}(?:\"[^\"]*+\"|'[^']*+'|{BARE}|(?=>)))?+)*+)>", re.DOTALL)
ATTRIBUTE = re.compile(f"({NAME})(?:{EQUALS}(?:\"([^\"]*+)\"|'([^']*+)'|({BARE})|$))?+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
WHITE = re.compile(f"[{SPACE}]+")
#: The content of deeper elements that are seen joins their ancestor at this depth, which bounds the layout.
MOST_DEPTH = 400
#: What is not drawn in svg and math, where text in them is drawn, elements in which HTML begins anew, tags that end both.
UNDRAWN = {
    "svg": frozenset("desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
FOREIGN = {"svg", "math"}
ANEW = frozenset("foreignobject mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span "
    "strong strike sub sup table tt u ul var".split())


class Node:
    __slots__ = ("tag", "attributes", "children", "apart", "seen", "deep")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []
        self.apart = False  # drawn at its own place
        self.seen, self.deep = True, False


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def build_tree(page: str) -> Node:
    """The element tree of a page; tags that HTML implies are supplied, stray end tags ignored.

    Content that a table may not hold outside its cells goes before the table, as
    in browsers; a form there holds nothing.
    """
    root = Node("html")
    stack = [root]
    places: defaultdict[str, list[int]] = defaultdict(list)
    at, last = 0, page.rfind(">")

    def top(tags: Iterable[str]) -> int:
        """Place of the innermost open element of ``tags``, 0 for none."""
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def cut(k: int) -> None:
        for _ in range(len(stack) - k):
            node = stack.pop()
            places[node.tag].pop()
            if node.deep and node.seen and node.tag in BLOCKS:
                node.children.append(Node("div"))

    def close(tags: set[str], scope: set[str]) -> None:
        """Close the outermost open element of ``tags`` inside ``scope``, with all in it."""
        least = top(scope)
        found = [places[t][k] for t in tags if places[t] and (k := bisect_right(places[t], least)) < len(places[t])]
        if found:
            cut(min(found))

    def foreign() -> str | None:
        """svg or math when its own rules hold here."""
        k = top(FOREIGN)
        return stack[k].tag if k > top(ANEW) else None

    def put(child: Node | str) -> None:
        """Add to the open element, or before the table where only rows and cells may be."""
        table = top(TABLE_SCOPE)
        if not table or stack[-1].tag not in TABLE_FRAME or not isinstance(child, str) and child.tag in TABLE_PARTS:
            stack[-1].children.append(child)
        elif not isinstance(child, str) or child.strip(SPACE):
            above = stack[table - 1].children
            above.insert(len(above) - (not stack[table].deep), child)

    def push(node: Node) -> None:
        """Open an element that has been put; deep down only its text and breaks stay, or nothing if it is not seen."""
        if node.deep:
            node.seen = visible(node)
            if node.seen:
                node.children = stack[-1].children
                if node.tag in BLOCKS:
                    node.children.append(Node("div"))
        places[node.tag].append(len(stack))
        stack.append(node)

    while at < len(page):
        m = TOKEN.search(page, at) if at <= last else None
        text = page[at:m.start()] if m else page[at:]
        if text and not (foreign() == "svg" and top({"text"}) < top({"svg"})):
            if stack[-1].tag == "head" and text.strip(SPACE):
                cut(len(stack) - 1)
            put(html.unescape(text))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if (k := top({tag})) > (0 if tag == "table" else top(TABLE_SCOPE)):
                cut(k)
            continue
        if tag in ("html", "body") and (tag == "html" or places["body"]):
            continue
        if tag == "head" and (len(stack) > 1 or any(not isinstance(c, str) or c.strip(SPACE) for c in root.children)):
            continue
        if foreign() and tag in BREAKOUT:
            while foreign():
                cut(top(FOREIGN))
        inside = foreign()
        table = top(TABLE_SCOPE)
        between = table > top(TABLE_CELLS)
        if tag == "table" and between:
            cut(table)
        elif table and tag in TABLE_PARTS:
            cut(top(TABLE_PARTS[tag]) + 1)
            if tag in ("td", "th") and stack[-1].tag != "tr":
                row = Node("tr")
                row.deep = len(stack) >= MOST_DEPTH
                if not row.deep:
                    put(row)
                push(row)
        elif tag in CLOSES:
            close(CLOSES[tag], SCOPE.get(tag, TABLE_SCOPE))
        if tag in CLOSE_P:
            close({"p"}, {"table", "td", "th", "li", "button", "div", "blockquote"})
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            cut(len(stack) - 1)
        node = Node(tag, _attributes(m[3]) if m[3].strip() else None)
        if inside and tag in UNDRAWN[inside]:
            node.attributes["hidden"] = ""
        node.apart = inside == "svg" and (tag == "text" or tag == "tspan" and not node.attributes.keys().isdisjoint(("x", "y", "dy")))
        leaf = tag in VOID or m[3].endswith("/") and (inside or tag not in BLOCKS and tag not in RAW) or tag == "form" and between
        node.deep = len(stack) >= MOST_DEPTH - (4 if tag == "table" else 0)  # a table is laid out with its cells or not at all
        if leaf or not node.deep or tag in RAW and not inside:
            put(node)
        if leaf:
            continue
        if tag in RAW and not inside:
            end = re.compile(f"</{tag}\\b[^>]*>", re.IGNORECASE).search(page, at)
            stop = end.start() if end else len(page)
            raw = page[at:stop]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = end.end() if end else len(page)
        else:
            push(node)
    return root


def visible(node: Node) -> bool:
    a = node.attributes
    if node.tag in HIDDEN or "hidden" in a or node.tag == "input" and a.get("type", "").lower() == "hidden":
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and UNSEEN.search(a["style"]))


def text_width(text: str) -> int:
    """Columns of a line in a fixed-width font."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Text lines under way: collapses white space, keeps one empty line between spaced blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = self.gap = False

    def text(self, text: str) -> None:
        words = WHITE.sub(" ", text)
        if words[:1] == " ":
            self.space = True
        body = words.strip(" ")
        if body:
            if self.space and self.now:
                self.now.append(" ")
            self.now.append(body)
            self.space = words[-1:] == " "

    def end(self) -> None:
        if self.now:
            self.put("".join(self.now))
            self.now = []
        self.space = False

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(line)

    def spaced(self) -> None:
        self.end()
        self.gap = True


def _render(node: Node, out: Lines, item: list[str | None]) -> None:
    for child in node.children:
        if isinstance(child, str):
            out.text(child)
        elif visible(child):
            _element(child, out, item)


def _element(node: Node, out: Lines, item: list[str | None]) -> None:
    tag = node.tag
    if tag == "br":
        if out.now:
            out.end()
        else:
            out.put("")
    elif tag == "hr":
        out.spaced()
        out.put("---")
        out.spaced()
    elif tag == "img":
        out.text(f" {node.attributes.get('alt', '')} ")
    elif tag == "pre":
        out.spaced()
        for line in _plain(node).strip("\n").split("\n"):
            out.put(line.rstrip())
        out.spaced()
    elif tag == "table":
        out.spaced()
        for line in _table(node):
            out.put(line)
        out.spaced()
    elif tag in ("ul", "ol", "menu", "dir"):
        nested = any(x is not None for x in item)
        out.end() if nested else out.spaced()
        number = int(node.attributes["start"]) if node.attributes.get("start", "").lstrip("-").isdigit() else 1
        for child in node.children:
            if isinstance(child, str):
                out.text(child)
            elif visible(child):
                if child.tag != "li":
                    _element(child, out, item)
                    continue
                out.end()
                mark = f"{number}. " if tag == "ol" else "- "
                number += 1
                inner = Lines()
                _render(child, inner, [*item, mark])
                inner.end()
                for k, line in enumerate(inner.lines or [""]):
                    out.put((mark if not k else " " * len(mark)) + line if line or not k else "")
        out.end() if nested else out.spaced()
    elif tag in BLOCKS:
        out.spaced() if tag in SPACED else out.end()
        if tag == "blockquote":
            inner = Lines()
            _render(node, inner, item)
            inner.end()
            for line in inner.lines:
                out.put(f"> {line}".rstrip())
        else:
            _render(node, out, item)
        out.spaced() if tag in SPACED else out.end()
    elif node.apart:
        out.text(" ")
        _render(node, out, item)
        out.text(" ")
    else:
        _render(node, out, item)


def _plain(node: Node) -> str:
    return "".join(c if isinstance(c, str) else "\n" if c.tag == "br" else _plain(c) if visible(c) else "" for c in node.children)


def _rows(table: Node) -> Iterator[tuple[int, Node]]:
    """(number of the section, row); rows outside sections are one section."""
    for k, child in enumerate(table.children):
        if not isinstance(child, str) and visible(child):
            if child.tag == "tr":
                yield -1, child
            elif child.tag in SECTIONS:
                yield from ((k, row) for row in child.children if not isinstance(row, str) and row.tag == "tr" and visible(row))


def _span(cell: Node, name: str, most: int) -> int:
    span = cell.attributes.get(name, "1").strip(SPACE)
    return min(int(span), most) if span.isascii() and span.isdecimal() and len(span) < 10 else most if span.isdecimal() else 1


def _table(node: Node) -> list[str]:
    """Caption, then rows with cells padded to the width of their column; spans take their columns and rows."""
    lines: list[str] = []
    stray = Lines()
    for child in node.children:
        if isinstance(child, str):
            stray.text(child)
        elif child.tag not in TABLE_FRAME and visible(child):
            _element(child, stray, [])
    stray.end()
    lines += stray.lines
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}  # the first row below the cell that reaches down in a column
    section = None
    for number, (part, row) in enumerate(_rows(node)):
        if part != section:
            section, taken = part, {}
        cells: dict[int, list[str]] = {}
        column = 0
        for cell in row.children:
            if isinstance(cell, str) or not visible(cell):
                continue
            while taken.get(column, 0) > number:
                column += 1
            inner = Lines()
            _render(cell, inner, [])
            inner.end()
            if inner.lines:
                cells[column] = inner.lines
            wide, high = max(1, _span(cell, "colspan", 1000)), _span(cell, "rowspan", 65534)
            if high != 1:
                taken.update(dict.fromkeys(range(column, column + wide), number + (high or 65534)))
            column += wide
        if cells:
            grid.append(cells)
    widths = [0] * (1 + max((max(cells) for cells in grid), default=-1))
    for cells in grid:
        for k, cell in cells.items():
            widths[k] = max(widths[k], *map(text_width, cell))
    starts = [0, *accumulate(w + 2 for w in widths)]
    for cells in grid:
        for k in range(max(map(len, cells.values()))):
            line, wide = [], 0
            for column, cell in cells.items():
                if k < len(cell) and cell[k]:
                    line += [" " * (starts[column] - wide), cell[k]]
                    wide = starts[column] + text_width(cell[k])
            lines.append("".join(line).rstrip())
    return lines


def render(page: str) -> str:
    """All visible text of a page, laid out in lines."""
    out = Lines()
    _render(build_tree(page), out, [])
    out.end()
    return "\n".join(out.lines).strip("\n")


def extract_text(pages: DataFrame, page: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with ``into``: the rendered text of ``page``, a row for each row.

    Null gives null, an empty page or one without visible text the empty string;
    broken markup is rendered as far as it can be told. A column named ``into`` is
    replaced. Each page is rendered where it is read.
    """
    kept = [c for c in pages.columns if c != into or c == page]
    source = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{page}`").alias("_page"))
    names = [c for c in kept if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if p is None else render(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(kept.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, into])

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names)
    return source.mapInArrow(run, f"{kinds}, `{into}` string" if kinds else f"`{into}` string")
