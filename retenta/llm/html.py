"""Visible text of web pages, laid out as a browser would space it.

A tolerant tokenizer feeds a tree builder that closes elements where the markup
implies it (the head, paragraphs, list items, table parts, options) and ignores
end tags without a start.  The tree is walked without recursion: blocks start
new lines, paragraphs, headings, lists and tables are set off by a blank line,
list items get marks and indents, table cells are aligned in columns, white
space collapses outside `pre`.  SVG and MathML give their text, but for what
they do not draw (descriptions, definitions, annotations).  Invisible are
comments, the head, scripts, styles and other raw content, and elements that
are hidden by attribute or inline style.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas datalist meta link base param source track".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul caption
tbody thead tfoot tr td th""".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure fieldset hr".split())
# What a start tag closes, and the elements that keep it from looking farther.
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt""".split())
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("td", "th", "tr", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "body": (("head",), ("html",)),
}
SCOPE = frozenset("table td th caption html template button".split())
# Start tags that leave an open head open; any other one, and text, closes it.
HEAD = frozenset("base link meta title style script noscript noframes template".split())
# In SVG and MathML: what is not drawn, the start tags that end such a part, and the elements in which HTML goes on.
FOREIGN = ("svg", "math")
UNDRAWN = frozenset("desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient annotation annotation-xml".split())
BREAKS_OUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr
ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
WITH_HTML = ("foreignobject", "desc", "annotation-xml", "mi", "mo", "mn", "ms", "mtext")

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>?|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|(?=<)|$)"
    r"|<(?P<odd>[a-zA-Z][^\s/>]*)[^>]*>?", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HIDE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(raw: str | None) -> dict[str, str]:
    if not raw or not raw.strip(" /\t\n\r\f"):
        return {}
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(raw):
        out.setdefault(name.lower(), entities.unescape(next((v for v in values if v), "")))
    return out


def parse(page: str) -> Node:
    """The tree of a page; children are nodes and strings."""
    root = Node("#root", {})
    stack = [root]
    opened: Counter[str] = Counter()  # tags on the stack, so that a search for an absent one costs nothing

    def cut(i: int) -> None:
        for x in stack[i:]:
            opened[x.tag] -= 1
        del stack[i:]

    def close(tags: tuple[str, ...], stops) -> None:
        """Close the outermost of the tags that is open below the nearest stop."""
        if not any(opened[t] for t in tags):
            return
        found = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in stops:
                break
            if stack[i].tag in tags:
                found = i
                if len(tags) == 1:
                    break
        if found:
            cut(found)

    def foreign() -> bool:
        return bool(opened["svg"] or opened["math"]) and not opened["foreignobject"]

    def write(text: str) -> None:
        if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
            cut(len(stack) - 1)
        stack[-1].children.append(text)

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else n]
        if text:
            write(entities.unescape(text) if "&" in text else text)
        if not m:
            break
        at = max(m.end(), m.start() + 1)
        if m["cdata"]:
            write(m["cdata"])
        elif m["end"]:
            tag = m["end"].lower()
            if tag in ("br", "p") and not opened[tag]:
                stack[-1].children.append(Node(tag, {}))
            stops = () if tag in SCOPE or tag in ("body", "tr", "tbody", "thead", "tfoot") else ("table", "td", "th", "template")
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in stops:
                    break
        elif m["start"] or m["odd"]:
            tag = (m["start"] or m["odd"]).lower()
            attrs = _attributes(m["attrs"])
            if tag in ENDS_P:
                close(("p",), SCOPE)
            if stack[-1].tag == "head" and tag not in HEAD:
                cut(len(stack) - 1)
            if tag in BREAKS_OUT:
                close(FOREIGN, WITH_HTML)
            if tag in CLOSES:
                close(*CLOSES[tag])
            node = Node(tag, attrs)
            stack[-1].children.append(node)
            if (tag in FOREIGN or foreign()) and (m["attrs"] or "").endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                inner = page[at:end.start() if end else n]
                node.children.append(entities.unescape(inner) if tag in ("textarea", "title") else inner)
                at = end.end() if end else n
            elif tag not in VOID:
                stack.append(node)
                opened[tag] += 1
    return root


def hidden(node: Node) -> bool:
    a = node.attrs
    return (node.tag in UNSEEN or "hidden" in a or node.tag == "dialog" and "open" not in a
            or node.tag == "input" or bool("style" in a and _HIDE.search(a["style"])))


def _width(text: str) -> int:
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text) if not text.isascii() else len(text)


class Page:
    """Lines of one block of text: the page, or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.blank = False
        self.indent = ""
        self.mark = ""

    def write(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        if text == " " or not text:
            self.space = self.space or bool(text and self.line)
            return
        if (self.space or text[0] == " ") and self.line:
            self.line.append(" ")
        self.space = text[-1] == " "
        self.line.append(text.strip(" "))

    def verbatim(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        if first:
            self.line.append(first)
        for part in rest:
            self.end(True)
            if part:
                self.line.append(part)

    def end(self, empty: bool = False) -> None:
        """End the line; an empty one counts only where asked for."""
        if self.line or (empty and self.lines):
            text = "".join(self.line).rstrip()
            if self.blank and self.lines and self.lines[-1]:
                self.lines.append("")
            self.blank = False
            self.lines.append((self.indent + self.mark + text) if text else "")
            if self.mark:
                self.mark = " " * len(self.mark)
        self.line, self.space = [], False

    def gap(self) -> None:
        self.end()
        self.blank = True

    def text(self) -> str:
        self.end()
        return re.sub(r"\n{3,}", "\n\n", "\n".join(self.lines)).strip("\n")


class Grid:
    """Rows of a table, as finished cell texts."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[str, int]]] = []

    def lines(self) -> list[str]:
        rows = [r for r in self.rows if any(text for text, _ in r)]
        if any("\n" in text for r in rows for text, _ in r) or max((len(r) for r in rows), default=0) < 2:
            return [line for r in rows for text, _ in r if text for line in text.split("\n")]  # a table used for layout
        widths: dict[int, int] = {}
        for r in rows:
            at = 0
            for text, span in r:
                if span == 1:
                    widths[at] = max(widths.get(at, 0), _width(text))
                at += span
        out = []
        for r in rows:
            at, line = 0, ""
            for text, span in r:
                room = sum(widths.get(c, 0) for c in range(at, at + span)) + 2 * (span - 1)
                line += text + " " * (max(0, room - _width(text)) + 2)
                at += span
            out.append(line.rstrip())
        return out


def render(root: Node) -> str:
    """Text of a tree; the walk keeps its own stack, so depth has no limit."""
    page = Page()
    pages, grids = [page], []
    lists: list[list] = []  # [ordered, next number, indent outside]
    pre = foreign = 0
    todo: list = [(root, 0)]
    while todo:
        node, leaving = todo.pop()
        out = pages[-1]
        if isinstance(node, str):
            (out.verbatim if pre else out.write)(node)
            continue
        tag = node.tag
        if not leaving:
            if hidden(node) or foreign and tag in UNDRAWN:
                continue
            if tag == "br":
                out.end(True)
                continue
            if tag == "wbr" or tag == "img":
                continue
            if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists):
                out.gap()
            elif tag in BLOCK or foreign and tag == "text":
                out.end()
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.attrs.get("start", "1")
                lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1, out.indent, out.mark])
                out.indent += " " * len(out.mark)
                out.mark = ""
            elif tag == "li":
                if lists and lists[-1][0]:
                    out.mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    out.mark = "- "
            elif tag in ("blockquote", "dd"):
                out.indent += "  "
            elif tag == "pre":
                pre += 1
            elif tag in FOREIGN:
                foreign += 1
            elif tag == "table":
                grids.append(Grid())
            elif tag == "tr" and grids:
                grids[-1].rows.append([])
            elif tag in ("td", "th"):
                if grids and grids[-1].rows:
                    pages.append(Page())
                else:
                    out.end()
            todo.append((node, 1))
            todo.extend((c, 0) for c in reversed(node.children))
            continue
        if tag in ("td", "th") and len(pages) > 1 and grids and grids[-1].rows:
            cell = pages.pop().text()
            span = node.attrs.get("colspan", "1")
            grids[-1].rows[-1].append((cell, min(1000, max(1, int(span))) if re.fullmatch(r"\d{1,6}", span) else 1))
            continue
        if tag == "table" and grids:
            out.gap()
            for line in grids.pop().lines():
                out.line = [line] if line else []
                out.end(True)
        elif tag == "pre":
            pre -= 1
        elif tag in FOREIGN:
            foreign -= 1
        elif tag in ("ul", "ol", "menu", "dir") and lists:
            out.end()
            _, _, out.indent, out.mark = lists.pop()
            out.mark = " " * len(out.mark)
        elif tag == "li":
            out.end()
            out.mark = ""
        if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists):
            out.gap()
        elif tag in BLOCK or foreign and tag == "text":
            out.end()
        if tag in ("blockquote", "dd"):
            out.indent = out.indent[:-2]
    return pages[0].text()


def extract_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, text.

    Null pages give null, empty pages or pages without visible text the empty
    text.  Whole pages are read, whatever their length or nesting.  Null and
    repeated ids stay; an empty table gives an empty one; other columns are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([extract_text(t.as_py()) for t in b.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), text], ["page_id", "text"])

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    return slim.mapInArrow(run, "page_id long, text string")
