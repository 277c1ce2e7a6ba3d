"""Web pages as the text a reader sees: blocks apart, lists marked, table cells aligned."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of HTML: which tags are empty, hold raw text, are not shown, end others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes object audio video "
                   "canvas svg datalist".split())
LINE_BLOCKS = frozenset("html body div section article main aside header footer nav address form fieldset legend "
                        "figcaption dt dd li summary details option center tr caption".split())
SPACED_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table pre blockquote figure hr".split())
BLOCKS = LINE_BLOCKS | SPACED_BLOCKS
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
LISTS = frozenset("ul ol menu dir".split())
#: Start tag -> the open tags it ends, and the ones beyond which it does not look.
ENDS = (
    {tag: ({"p"}, {"table", "td", "th", "button", "object"}) for tag in BLOCKS - TABLE_PARTS - {"li", "dt", "dd", "option"}}
    | {"table": ({"p"}, {"table", "td", "th", "button"}), "li": ({"li", "p"}, LISTS | {"table", "td", "th"}),
       "dt": ({"dt", "dd", "p"}, {"dl", "table", "td", "th"}), "dd": ({"dt", "dd", "p"}, {"dl", "table", "td", "th"}),
       "option": ({"option"}, {"select"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
       "tr": ({"tr", "td", "th"}, {"table"})}
    | {tag: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}) for tag in ("thead", "tbody", "tfoot")}
)
# A tag with its quoted values, or, if quotes do not match before the next "<", up to the next ">".
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?>(?:[^>"']|"[^"<]*"|'[^'<]*')*)|[^>]*)>""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and strings


class _Open:
    """The open nodes, and for each tag how deep it stands, so that no search takes long."""

    def __init__(self, root: Node) -> None:
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}

    def nearest(self, tags) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.depths[self.stack.pop().tag].pop()


def tree(html: str) -> Node:
    """The page's nodes, with the end tags that authors may leave out."""
    root = Node("html")
    opened, at = _Open(root), 0

    def text(part: str) -> None:
        if part:
            opened.stack[-1].children.append(unescape(part))

    while at < len(html):
        token = _TOKEN.search(html, at)
        if token is None:
            text(html[at:])
            break
        text(html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            # An end tag inside a cell ends nothing outside it, but for parts of tables.
            depth = opened.nearest((tag,))
            if depth and (tag in TABLE_PARTS or depth > opened.nearest(("td", "th", "table"))):
                opened.pop_to(depth)
            continue
        if tag in ENDS:
            ended, scope = ENDS[tag]
            limit = opened.nearest(scope)
            # The outermost of those it ends within the scope takes the others with it.
            inside = [d for t in ended for d in opened.depths.get(t, ())[-1:] if d > limit]
            if inside:
                opened.pop_to(min(inside))
        attributes = {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(token[3])}
        node = Node(tag, attributes)
        opened.stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
            node.children.append(html[at : end.start()])
            at = end.end()
        elif tag not in VOID:
            opened.push(node)
    return root


def hidden(node: Node) -> bool:
    own = node.attributes
    return (
        node.tag in UNSEEN or "hidden" in own or bool(_HIDING.search(own.get("style", "")))
        or (node.tag == "dialog" and "open" not in own)
    )


def visible(node: Node, above: bool) -> bool:
    """Whether text of a node is shown: as its own style says, else as that of the node above."""
    said = _VISIBILITY.findall(node.attributes.get("style", ""))
    return said[-1].lower() == "visible" if said else above


def shown_children(node: Node) -> list:
    """Of details that are not open the first summary."""
    if node.tag != "details" or "open" in node.attributes:
        return node.children
    return [c for c in node.children if not isinstance(c, str) and c.tag == "summary"][:1]


class Page:
    """Lines under way.  ``break_`` asks for a new line, or a blank one, before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.asked = 0
        self.space = False
        self.indent = ""
        self.mark = ""

    def break_(self, blank: bool) -> None:
        self.asked = max(self.asked, 2 if blank else 1)
        self.space = False

    def _start(self) -> None:
        if self.asked:
            self.end_line()
            if self.asked == 2 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.asked = 0
        if not self.line:
            self.line = [self.indent[: len(self.indent) - len(self.mark)] + self.mark if self.mark else self.indent]
            self.mark, self.space = "", False

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []

    def text(self, text: str, as_is: bool) -> None:
        if as_is:
            for n, part in enumerate(text.split("\n")):
                if n:
                    self._start()
                    self.end_line()
                if part:
                    self._start()
                    self.line.append(part)
            return
        words = _SPACES.sub(" ", text)
        if not words.strip(" "):
            self.space = self.space or bool(words and self.line and not self.asked)
            return
        before = (self.space or words[0] == " ") and self.line and not self.asked
        self._start()
        self.line.append((" " if before else "") + words.strip(" "))
        self.space = words[-1] == " "

    def new_line(self) -> None:
        self._start()
        self.end_line()

    def whole_lines(self, lines: list[str]) -> None:
        for line in lines:
            self._start()
            self.line.append(line)
            self.end_line()

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


@dataclass
class Cell:
    lines: list[str]
    columns: int
    rows: int
    at: int = 0  # the column it begins in


#: A column is no wider than this, and no cell stands further from the one before it; longer
#: text runs on.  So a table of much white space stays in proportion to its page.
WIDEST_COLUMN, WIDEST_GAP = 80, 240
#: More columns or rows are not spanned.
MOST_SPANNED = 1000


def _place(rows: list[list[Cell]]) -> None:
    """Tells each cell the first column that no cell, nor one of a row above, has taken."""
    taken: list[tuple[int, int, int]] = []  # from, to, up to which row
    for n, row in enumerate(rows):
        taken = sorted(t for t in taken if t[2] > n)
        column, k, new = 0, 0, []
        for cell in row:
            while k < len(taken) and taken[k][0] < column + cell.columns:
                column, k = max(column, taken[k][1]), k + 1
            cell.at = column
            column += cell.columns
            if cell.rows > 1:
                new.append((cell.at, column, n + cell.rows))
        taken += new


def _aligned(rows: list[list[Cell]]) -> list[str]:
    """The lines of a table: what is in one column begins at one place, where cells are not too wide."""
    _place(rows)
    widths: dict[int, int] = {}
    for cell in (c for row in rows for c in row if c.columns == 1):
        widths[cell.at] = max([widths.get(cell.at, 0), *map(len, cell.lines)])
    starts, offset = {}, 0
    for column in sorted({c.at for row in rows for c in row} | set(widths)):
        starts[column] = offset
        if column in widths:
            offset += min(widths[column], WIDEST_COLUMN) + 2
    out = []
    for row in rows:
        for n in range(max((len(c.lines) for c in row), default=0)):
            parts, length = [], 0
            for cell in row:
                if n < len(cell.lines) and cell.lines[n]:
                    gap = min(max(starts[cell.at] - length, 2 if length else 0), WIDEST_GAP)
                    parts.append(" " * gap + cell.lines[n])
                    length += len(parts[-1])
            out.append("".join(parts).rstrip())
    return out


def _span(node: Node, name: str) -> int:
    value = node.attributes.get(name, "1").strip()
    return min(max(int(value[:9]), 1), MOST_SPANNED) if value.isascii() and value.isdigit() else 1


def render(html: str) -> str:
    """All visible text.  Nodes are walked without recursion, so depth has no limit."""
    pages, tables, lists, as_is, seen = [Page()], [], [], 0, [True]
    todo: list = [(tree(html), False)]
    while todo:
        node, leaving = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if seen[-1]:
                page.text(node, as_is > 0)
            continue
        tag = node.tag
        if not leaving:
            if hidden(node):
                continue
            if tag == "br":
                if seen[-1]:
                    page.new_line()
                continue
            seen.append(visible(node, seen[-1]))
            if tag in BLOCKS:
                nested = tag in LISTS and lists
                page.break_(tag in SPACED_BLOCKS and not nested)
            if tag in LISTS:
                start = node.attributes.get("start", "1")
                lists.append([tag, int(start) if start.isascii() and start.isdigit() else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                page.mark = mark if seen[-1] else ""
                kind[1] += 1
                page.indent += " " * len(mark)
                node.attributes["-"] = str(len(mark))
            elif tag in ("dd", "blockquote"):
                page.indent += "  "
            elif tag == "pre":
                as_is += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                pages.append(Page())
            todo.append((node, True))
            todo.extend((child, False) for child in reversed(shown_children(node)))
            continue
        seen.pop()
        if tag in ("td", "th") and tables:
            cell = pages.pop().done()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append(Cell(cell, _span(node, "colspan"), _span(node, "rowspan")))
        elif tag == "table":
            page.whole_lines(_aligned(tables.pop()))
        elif tag in LISTS:
            lists.pop()
        elif tag == "li":
            page.indent = page.indent[: len(page.indent) - int(node.attributes["-"])]
            page.mark = ""
        elif tag in ("dd", "blockquote"):
            page.indent = page.indent[:-2]
        elif tag == "pre":
            as_is -= 1
        if tag in BLOCKS:
            page.break_(tag in SPACED_BLOCKS and not (tag in LISTS and lists))
    return "\n".join(pages[0].done())


@F.arrow_udf(StringType())
def rendered(pages: pa.Array) -> pa.Array:
    return pa.array([render(p.as_py() or "") for p in pages], pa.string())


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` and ``text_col``, the visible text of ``html_col``.

    A null or empty page has an empty text; a column of the name ``text_col`` is
    replaced; broken markup is read as far as it goes; repeated rows are rendered alike; an
    empty table gives no rows.  Time and text grow with the page's length, whatever its tables.
    """
    return pages.withColumn(text_col, rendered(F.col(html_col)))
