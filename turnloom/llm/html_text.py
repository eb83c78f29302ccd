"""Layout-aware text of HTML pages.

A scanner and a tree builder (html_tree) make a tree with HTML's implied tags, foster parenting and visibility; this
module lays it out as a browser would show it: white space collapses, blocks stand on lines of their own with a blank line around
paragraphs, headings, lists and tables, list items have bullets or numbers and an indent, and the cells of a table are
padded to columns, over column and row spans.

Everything takes time in proportion to the page. For that, what would grow with the square of the nesting is bounded by
rule: lists indent up to LIST_DEPTH levels; tables align up to TABLE_DEPTH levels (deeper ones show a cell per line) and
up to TABLE_WIDTH characters a line (in wider ones two blanks part the cells of a line), and row spans hold their places
in the first HELD_COLUMNS columns. No text is lost by that.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.html_tree import CELLS, HEADINGS, LISTS, Node, tree
from turnloom.llm.shared import portions
from turnloom.session import map_arrow

#: Fixed by HTML: blocks with a margin, and the largest spans.
SPACED = LISTS | HEADINGS | frozenset("p dl table blockquote pre figure fieldset hr xmp listing".split())
MOST_COLUMNS, MOST_ROWS = 1000, 65534
LIST_DEPTH, TABLE_DEPTH, TABLE_WIDTH, HELD_COLUMNS = 16, 6, 2000, 128

_SPACE = re.compile(r"[ \t\n\r\f]+")


class _Flow:
    """Laid-out lines of one flow: the page, or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []  # of the open line
        self.space = False  # whether white space is due before what comes next
        self.blank = False  # whether a blank line is due before the next line
        self.indents = [""]
        self.marker = ""  # of the list item whose first line comes next, with its indent

    def text(self, text: str) -> None:
        """Inline text; white space collapses."""
        collapsed = _SPACE.sub(" ", text)
        if collapsed == " ":
            self.space = True
            return
        if collapsed[0] == " ":
            self.space = True
        if self.space and self.line:
            self.line.append(" ")
        self.line.append(collapsed.strip(" "))
        self.space = collapsed[-1] == " "

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        prefix, self.marker = self.marker or self.indents[-1], ""
        self.lines.append((prefix + line).rstrip(" "))

    def end_line(self, margin: bool = False) -> None:
        """Ends the open line, if it has text; margin: a blank line is due."""
        if self.line:
            self.put("".join(self.line))
            self.line = []
        self.space = False
        self.blank |= margin and bool(self.lines)

    def line_break(self) -> None:
        if self.line:
            self.end_line()
        elif self.lines and self.lines[-1]:
            self.lines.append("")

    def verbatim(self, text: str) -> None:
        """Text in which white space counts."""
        if self.space and self.line:
            self.line.append(" ")
        self.space = False
        first, *rest = text.expandtabs(8).split("\n")
        self.line.append(first)
        for line in rest:
            self.put("".join(self.line))
            self.line = [line]
        if self.line == [""]:
            self.line = []

    def indent(self, more: str) -> None:
        self.indents.append(self.indents[-1] + more if len(self.indents) <= LIST_DEPTH else self.indents[-1])

    def item(self, marker: str) -> None:
        if self.marker:  # the item around has no text before this one: its marker stands on a line of its own
            self.put("")
        self.marker = self.indents[-1] + marker
        self.indent(" " * len(marker))

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(text: str, least: int, most: int, otherwise: int) -> int:
    """The number at the beginning of an attribute, within bounds."""
    m = re.match(r"[ \t\n\f\r]*+([+-]?[0-9]{1,9})(?![0-9])", text)
    return max(least, min(most, int(m[1]))) if m else otherwise


class _Table:
    """Rows of cells on a grid. A cell takes the first place in its row that no cell from a row above reaches into."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []  # cells as begin, end, lines
        self.caption: list[str] = []
        self.begin_rows()

    def begin_rows(self) -> None:
        """A row group: no cell reaches beyond its own."""
        self.reaching: list[tuple[int, int, int]] = []  # begin, end and first row below of cells that reach below their row
        self.taken: list[tuple[int, int, int]] = []  # of the open row
        self.earliest = 0

    def begin_row(self) -> None:
        row = len(self.rows)
        if self.taken or (self.reaching and self.earliest <= row):
            self.reaching = sorted(x for x in self.reaching + self.taken if x[2] > row)
            self.earliest = min((x[2] for x in self.reaching), default=0)
        self.taken, self.next, self.blocked = [], 0, 0
        self.rows.append([])

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        while self.blocked < len(self.reaching) and self.reaching[self.blocked][0] <= self.next:
            self.next = max(self.next, self.reaching[self.blocked][1])
            self.blocked += 1
        begin, end = self.next, self.next + columns
        self.rows[-1].append((begin, end, lines))
        if rows > 1 and begin < HELD_COLUMNS:
            self.taken.append((begin, end, len(self.rows) - 1 + rows))
        self.next = end

    def laid_out(self) -> list[str]:
        """The rows' lines, cells padded to their column; a cell of several columns counts for no column's width."""
        columns = sorted({begin for row in self.rows for begin, _, _ in row})
        widths = [0] * len(columns)
        for row in self.rows:
            for begin, end, lines in row:
                k = bisect_left(columns, begin)
                if lines and (k + 1 == len(columns) or columns[k + 1] >= end):
                    widths[k] = max(widths[k], *map(len, lines), 0)
        offsets, at = [], 0
        for width in widths:
            offsets.append(at)
            at += width + 2
        aligned = at <= TABLE_WIDTH
        out = list(self.caption)
        for row in self.rows:
            placed: list[list[tuple[int, str]]] = [[] for _ in range(max((len(lines) for _, _, lines in row), default=0))]
            for begin, _, lines in row:
                for k, line in enumerate(lines):
                    if line:
                        placed[k].append((offsets[bisect_left(columns, begin)] if aligned else 0, line))
            for parts in placed:
                pieces, length = [], 0
                for offset, line in parts:
                    gap = max(offset - length, 2 if length else 0)
                    pieces.append(" " * gap + line)
                    length += gap + len(line)
                out.append("".join(pieces).rstrip(" "))
        return out


class _Layout:
    """Lays out a tree without recursion: enter() on the way down, leave() on the way up."""

    def __init__(self):
        self.flows = [_Flow()]
        self.tables: list[_Table] = []
        self.depth = 0  # of open tables, those that are not aligned included
        self.counts: dict[int, int] = {}  # of numbered lists, by id of the node

    def render(self, root: Node) -> str:
        stack = [(root, iter(root.children if root.shown else ()))]
        while stack:
            node, children = stack[-1]
            for child in children:
                if type(child) is tuple:
                    text, verbatim = child
                    (self.flows[-1].verbatim if verbatim else self.flows[-1].text)(text)
                else:
                    stack.append((child, iter(self.enter(child))))
                    break
            else:
                stack.pop()
                if stack:
                    self.leave(node)
        return "\n".join(self.flows[0].done())

    def _aligned(self) -> bool:
        return 0 < self.depth <= TABLE_DEPTH

    def enter(self, node: Node) -> list:
        tag, flow = node.tag, self.flows[-1]
        if node.foreign:
            if node.block:
                flow.end_line()
        elif tag == "br":
            flow.line_break()
        elif tag == "table":
            flow.end_line(margin=True)
            self.depth += 1
            if self._aligned():
                self.tables.append(_Table())
        elif tag in ("tbody", "thead", "tfoot"):
            if self._aligned():
                self.tables[-1].begin_rows()
        elif tag == "tr":
            if self._aligned():
                self.tables[-1].begin_row()
        elif tag in CELLS or tag == "caption":
            if self._aligned():
                self.flows.append(_Flow())
            else:
                flow.end_line()
        elif tag in ("button", "textarea"):
            flow.space = True
        elif tag == "select":
            flow.space = True
            for option in _options(node):
                flow.text(option)
                if "multiple" in node.attributes:
                    flow.end_line()
            flow.space = True
            return []
        elif node.block:
            flow.end_line(margin=self._margin(node))
            if tag == "ol":
                self.counts[id(node)] = _number(node.attributes.get("start", ""), -(10**9), 10**9, 1)
            elif tag == "li":
                flow.item(self._marker(node))
            elif tag in ("blockquote", "dd"):
                flow.indent("  ")
            elif tag == "details" and "open" not in node.attributes:
                return [c for c in node.children if type(c) is Node and c.tag == "summary"][:1]
        return node.children

    def leave(self, node: Node) -> None:
        tag = node.tag
        if node.foreign:
            if node.block:
                self.flows[-1].end_line()
        elif tag == "table":
            if self._aligned():
                table = self.tables.pop()
                for line in table.laid_out():
                    self.flows[-1].put(line)
            self.depth -= 1
            self.flows[-1].end_line(margin=True)
        elif tag in ("button", "textarea"):
            self.flows[-1].space = True
        elif tag in CELLS or tag == "caption":
            if not self._aligned():
                self.flows[-1].end_line()
                return
            lines, table = self.flows.pop().done(), self.tables[-1]
            if tag == "caption":
                table.caption += lines
            else:
                table.cell(lines, _number(node.attributes.get("colspan", ""), 1, MOST_COLUMNS, 1), _number(node.attributes.get("rowspan", ""), 0, MOST_ROWS, 1) or MOST_ROWS)
        elif node.block:
            flow = self.flows[-1]
            flow.end_line(margin=self._margin(node))
            if tag in ("li", "blockquote", "dd"):
                flow.indents.pop()
                if tag == "li":
                    flow.marker = ""

    def _margin(self, node: Node) -> bool:
        return node.tag in SPACED and not (node.tag in LISTS and node.in_item)

    def _marker(self, node: Node) -> str:
        of = node.within
        if of is None or of.tag != "ol":
            return "- "
        number = _number(node.attributes.get("value", ""), -(10**9), 10**9, self.counts.get(id(of), 1))
        self.counts[id(of)] = number + (-1 if "reversed" in of.attributes else 1)
        return f"{number}. "


def _options(select: Node) -> list[str]:
    """What a select shows: all options of a list, else the one that is selected, which is the first if none is marked."""
    found: list[tuple[bool, bool, str]] = []
    todo = [(c, False) for c in reversed(select.children)]
    while todo:
        node, disabled = todo.pop()
        if type(node) is not Node or not node.shown:
            continue
        disabled = disabled or "disabled" in node.attributes
        if node.tag == "option":
            found.append(("selected" in node.attributes, disabled, node.attributes.get("label") or " ".join(_words(node))))
        else:
            todo += [(c, disabled) for c in reversed(node.children)]
    if "multiple" in select.attributes:
        return [text for _, _, text in found if text]
    chosen = [text for selected, _, text in found if selected][-1:] or [text for _, disabled, text in found if not disabled][:1]
    return [text for text in chosen if text]


def _words(node: Node) -> Iterator[str]:
    todo = list(reversed(node.children))
    while todo:
        child = todo.pop()
        if type(child) is tuple:
            yield from child[0].split()
        else:
            todo += reversed(child.children)


def text_of(html: str | None) -> str:
    """The visible text of a page, laid out in lines. Text in attributes (alt, value, placeholder) is none of it."""
    return _Layout().render(tree(html)) if html else ""


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, n_chars (code points of the text), n_lines, text.

    Defined results: a null or empty page has the empty text and no lines; null ids and repeated rows stay; pages are
    rendered whole, however long and however malformed; an empty table gives no rows; other columns, whatever their
    names, are not read.
    """
    schema = pa.schema([("page_id", pa.int64()), ("n_chars", pa.int64()), ("n_lines", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for portion in portions(batch.column(1), 8 << 20):
                texts = [text_of(html) for html in portion]
                counts = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [t.count("\n") + 1 if t else 0 for t in texts])]
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), *counts, pa.array(texts, pa.string())], schema=schema)
                at += len(texts)

    return map_arrow(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html")), run, "page_id long, n_chars long, n_lines long, text string")
