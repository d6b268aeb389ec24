"""Text of web pages as it is laid out: what a reader sees, in lines, lists and columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.common import blocks, in_batches, read_table
from skyledger.llm.html_style import Sheets, inline
from skyledger.llm.html_tree import CELLS, HEADINGS, ROW_GROUPS, Node, parse

#: Elements that are not shown, or whose content stands in for what is shown.
UNSEEN = frozenset(
    "head script style template title link meta base datalist noembed noframes iframe object audio video canvas"
    " param source track rp col colgroup area map".split()
)
#: Blocks with an empty line before and after them, and without.
SPACED = HEADINGS | frozenset("p blockquote pre ul ol menu dir dl table figure fieldset hr".split())
PLAIN_BLOCKS = frozenset(
    "address article aside body caption center dd details dialog div dt figcaption footer form header hgroup html"
    " legend li main nav option optgroup search section select summary tr".split()
)
BULLETS = ("* ", "- ", "+ ")
INDENT = "    "
GAP = "  "
WIDEST_SPAN = 1000
BLANKS = re.compile(r"[ \t\n\f\r]+")


class Flow:
    """Lines in the making: white space collapses, blocks end lines, margins do not add up."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.space = False

    def text(self, text: str) -> None:
        words = BLANKS.split(text)
        if words[0] == "":
            self.space = True
        words_seen = [w for w in words if w]
        for word in words_seen:
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(word)
            self.space = True
        if words_seen:
            self.space = words[-1] == ""

    def kept(self, text: str) -> None:
        """Text whose white space counts."""
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line.append(first)
        for part in rest:
            self.end_line(True)
            self.line.append(part)
        self.space = False

    def end_line(self, empty_too: bool = False) -> None:
        line = "".join(self.line).rstrip(" ")
        if line or empty_too:
            self._margin()
            self.lines.append(line)
        self.line, self.space = [], False

    def _margin(self) -> None:
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0

    def edge(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def block(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Lines made apart, with what stands before them."""
        if not lines:
            return
        self.end_line()
        self._margin()
        self.lines.append((first + lines[0]).rstrip(" "))
        self.lines.extend((rest + x).rstrip(" ") for x in lines[1:])

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Renderer:
    def __init__(self, root: Node):
        self.sheets = Sheets(root)
        self.root = root

    def render(self) -> list[str]:
        flow = Flow()
        self.children(self.root, flow, True, False, 0)
        return flow.done()

    def styled(self, node: Node, seen: bool) -> tuple[bool, bool]:
        """Whether the element is laid out at all, and whether its own text is seen."""
        raw, closed = node.raw, node.tag == "dialog"
        if not raw and not closed and not self.sheets.rules:
            return True, seen
        best = self.sheets.settled(node)
        if raw and "style" in raw.lower():
            for name, value, strong in inline(node.attributes.get("style", "")):
                if name not in best or strong >= best[name][0][0]:
                    best[name] = ((strong,), value)
        display = best["display"][1] if "display" in best else "revert"
        if display == "none":
            return False, False
        if display.startswith("revert"):  # what holds without a style
            if closed and "open" not in node.attributes:
                return False, False
            if raw and "hidden" in raw.lower() and "hidden" in node.attributes:
                return False, False
        visibility = best["visibility"][1] if "visibility" in best else "inherit"
        if visibility in ("hidden", "collapse"):
            return True, False
        return True, seen or visibility in ("visible", "initial")

    def children(self, node: Node, flow: Flow, seen: bool, pre: bool, depth: int, only: str | None = None) -> None:
        for child in node.children:
            if isinstance(child, str):
                if seen and only is None:
                    flow.kept(child) if pre else flow.text(child)
            elif only is None or child.tag == only:
                self.element(child, flow, seen, pre, depth)

    def element(self, node: Node, flow: Flow, seen: bool, pre: bool, depth: int) -> None:
        tag = node.tag
        if tag in UNSEEN:
            return
        laid_out, seen = self.styled(node, seen)
        if not laid_out:
            return
        if tag == "br":
            flow.end_line(True)
        elif tag == "input":
            kind = node.attributes.get("type", "text").lower()
            if seen and kind not in ("hidden", "password", "checkbox", "radio", "file", "image", "color", "range"):
                flow.text(node.attributes.get("value", ""))
        elif tag == "table":
            self.table(node, flow, seen, depth)
        elif tag in ("ul", "ol", "menu", "dir"):
            self.list(node, flow, seen, depth)
        elif tag in ("blockquote", "dd"):
            inner = Flow()
            self.children(node, inner, seen, False, depth)
            flow.edge(1 if tag == "blockquote" else 0)
            flow.block(inner.done(), INDENT, INDENT)
            flow.edge(1 if tag == "blockquote" else 0)
        elif tag in ("pre", "textarea"):
            inner = Flow()
            self.children(node, inner, seen, True, depth)
            lines = inner.done()
            if lines and not lines[0]:
                lines = lines[1:]  # the newline after the start tag
            flow.edge(1)
            flow.block(lines)
            flow.edge(1)
        elif tag in SPACED:
            flow.edge(1)
            self.children(node, flow, seen, pre, depth)
            flow.edge(1)
        elif tag in PLAIN_BLOCKS:
            flow.edge(0)
            closed = tag == "details" and "open" not in node.attributes
            self.children(node, flow, seen, pre, depth, "summary" if closed else None)
            flow.edge(0)
        elif tag in CELLS:  # outside of a table
            flow.space = True
            self.children(node, flow, seen, pre, depth)
            flow.space = True
        else:
            self.children(node, flow, seen, pre, depth)

    def list(self, node: Node, flow: Flow, seen: bool, depth: int) -> None:
        gap = 0 if depth else 1
        flow.edge(gap)
        items = [c for c in node.children if isinstance(c, Node) and c.tag == "li"]
        step = -1 if "reversed" in node.attributes else 1
        number = _whole(node.attributes.get("start"), len(items) if step < 0 else 1)
        for child in node.children:
            if not (isinstance(child, Node) and child.tag == "li"):
                if isinstance(child, Node):
                    self.element(child, flow, seen, False, depth + 1)
                elif seen and child.strip():
                    flow.text(child)
                continue
            laid_out, shown = self.styled(child, seen)
            if not laid_out:
                continue
            inner = Flow()
            self.children(child, inner, shown, False, depth + 1)
            if node.tag == "ol":
                number = _whole(child.attributes.get("value"), number)
                mark = f"{number}. "
                number += step
            else:
                mark = BULLETS[depth % len(BULLETS)]
            flow.edge(0)
            flow.block(inner.done(), mark, " " * len(mark))
        flow.edge(gap)

    def table(self, node: Node, flow: Flow, seen: bool, depth: int) -> None:
        """Rows in lines, columns aligned: a column is as wide as its widest line."""
        flow.edge(1)
        groups: dict[str, list[Node]] = {"thead": [], "tbody": [], "tfoot": []}
        state: list[tuple[Node, bool]] = []
        for child in node.children:
            if isinstance(child, str):
                if seen and child.strip():
                    flow.text(child)  # text between rows stands before the table
            elif child.tag in ROW_GROUPS or child.tag == "tr":
                groups[child.tag if child.tag in ROW_GROUPS else "tbody"].append(child)
            else:
                self.element(child, flow, seen, False, depth)
        flow.edge(0)
        for name in ("thead", "tbody", "tfoot"):
            for group in groups[name]:
                laid_out, shown = self.styled(group, seen)
                if laid_out and group.tag == "tr":
                    state.append((group, shown))
                elif laid_out:
                    for row in group.children:
                        if isinstance(row, Node) and row.tag == "tr":
                            row_out, row_shown = self.styled(row, shown)
                            if row_out:
                                state.append((row, row_shown))
                        elif isinstance(row, Node):
                            self.element(row, flow, shown, False, depth)
                        elif shown and row.strip():
                            flow.text(row)
        flow.edge(0)
        flow.block(_aligned(self.cells(state, depth)))
        flow.edge(1)

    def cells(self, rows: list[tuple[Node, bool]], depth: int) -> list[list[tuple[int, int, list[str]]]]:
        """For each row its cells: first column, columns spanned, lines."""
        taken: dict[int, int] = {}  # column: rows that a cell above still takes
        grid = []
        for i, (row, shown) in enumerate(rows):
            line, column = [], 0
            for cell in row.children:
                if isinstance(cell, str):
                    if not (shown and cell.strip()):
                        continue
                    wrapped = Node("td")
                    wrapped.children = [cell]
                    cell = wrapped
                laid_out, cell_shown = self.styled(cell, shown)
                if not laid_out or cell.tag in UNSEEN:
                    continue
                while taken.get(column, 0) > 0:
                    column += 1
                wide = min(max(_whole(cell.attributes.get("colspan"), 1), 1), WIDEST_SPAN) if cell.raw else 1
                high = _whole(cell.attributes.get("rowspan"), 1) if cell.raw else 1
                high = min(high if high > 0 else len(rows) - i, len(rows) - i)
                inner = Flow()
                if cell.tag in CELLS:
                    self.children(cell, inner, cell_shown, False, depth)
                else:
                    self.element(cell, inner, shown, False, depth)
                line.append((column, wide, inner.done()))
                for k in range(column, column + wide):
                    taken[k] = max(taken.get(k, 0), high)
                column += wide
            grid.append(line)
            taken = {k: v - 1 for k, v in taken.items() if v > 1}
        return grid


def _aligned(grid: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    widths: dict[int, int] = {}
    for row in grid:
        for column, wide, lines in row:
            if wide == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
    for row in grid:  # what a wide cell needs beyond its columns goes to the last of them
        for column, wide, lines in row:
            if wide > 1:
                have = sum(widths.get(k, 0) for k in range(column, column + wide)) + len(GAP) * (wide - 1)
                lack = max(map(len, lines), default=0) - have
                last = column + wide - 1
                widths[last] = widths.get(last, 0) + max(lack, 0)
    ordered = sorted(widths)
    starts, at = {}, 0
    for column in ordered:
        starts[column] = at
        at += widths[column] + (len(GAP) if widths[column] else 0)
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for column, _, lines in row:
                if k < len(lines):
                    begin = starts.get(column, next((starts[c] for c in ordered if c >= column), at))
                    line = line.ljust(begin) + lines[k]
            out.append(line)
    return out


def _whole(text: str | None, otherwise: int) -> int:
    """A whole number as browsers read it; beyond 32 bits it is none."""
    found = re.match(r"\s*([+-]?)0*(\d{1,10})(?!\d)", text or "")
    number = int(found.group(1) + found.group(2)) if found else otherwise
    return number if -(1 << 31) <= number < 1 << 31 else otherwise


def rendered(html: str | None) -> str:
    """The text of a page. Empty for a null or empty one."""
    if not html:
        return ""
    lines = Renderer(parse(html)).render()
    return "\n".join(lines).replace("\xa0", " ")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``text`` for every row of ``pages`` (``page_id``, ``html``).

    The page is parsed to a tree with implied tags, and all text that is seen is laid out:
    white space collapses but in ``pre``; blocks end lines, paragraphs, headings, lists
    and tables have one empty line around them; list items have bullets or their numbers
    and are indented by depth; cells of a table stand in columns as wide as their widest
    line, with spans. Not seen: heads, scripts, style, templates, closed dialogs and
    details, what ``hidden``, a style attribute or a style sheet hides, and what stands
    in for media. ``noscript`` is seen, as no scripts run. Rules count by the cascade on
    a desktop screen (:mod:`.html_style`): of those that match, the strongest and then
    the last decides, an inline style over them, so what is shown again is seen; media
    queries for print or narrower screens do not hold. Rules in container queries or
    ``@scope``, and selectors with ``:has``, are not followed.

    Null and empty html gives an empty text. Repeated rows are extracted each; a page of
    any length is read whole; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html"):
            texts = [rendered(x) for x in block.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("page_id"), pa.array(texts, type=pa.string())], names=["page_id", "text"])

    kind = dict(pages.dtypes)["page_id"]
    return in_batches(pages.select("page_id", "html")).mapInArrow(run, f"page_id {kind}, text string")


def op2_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
