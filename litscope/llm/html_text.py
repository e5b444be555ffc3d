"""Visible text of HTML pages, laid out as blocks, lists and aligned tables.

A page is built up as a stack of open elements, with the end tags that HTML
implies. An element is laid out when it closes and joins its parent, so nesting
may be as deep as it likes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.session import ship_package

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript datalist iframe object audio video canvas select textarea".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu pre blockquote table figure fieldset hr".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body caption center dd details dialog div dt figcaption footer form header hgroup html legend li main nav section summary tbody td tfoot th thead tr".split()
)
# An opening tag closes the nearest of these, unless one of the fences stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
# What may stand in a head; any other tag, and text, ends it.
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
# Parts of a drawing or formula that are not shown, and those that hold HTML.
UNDRAWN = {
    "svg": frozenset("title desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
HOLDS_HTML = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext annotation-xml".split())}
# HTML tags that end an open drawing or formula.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_HIDING = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))")
_BLANK = re.compile(r"[ \t\n\r\f]+")
# Wider cells are written whole, but no other cell is padded to their width.
WIDEST = 40
# Levels of a list that are set in further.
DEEPEST = 12


class _Box:
    """An open element: finished lines, the line being written, and table rows."""

    def __init__(self, tag: str, hidden: bool = False, pre: bool = False, kind: str = "", start: int = 1):
        self.tag, self.hidden, self.pre, self.kind = tag, hidden, pre, kind
        self.lines: list[str] = []
        self.pieces: list[str] = []
        self.gap, self.number = 0, start
        self.rows: list[list[tuple[list[str], int]]] = []
        self.cells: list[tuple[list[str], int]] = []
        self.span = 1

    def put(self, lines: list[str], gap: int) -> None:
        """Add finished lines, ``gap`` blank lines away from others."""
        if lines:
            if self.lines:
                self.lines.extend([""] * max(self.gap, gap))
                self.lines.extend(lines)
            else:
                self.lines = lines
            self.gap = gap

    def end_line(self) -> None:
        text = "".join(self.pieces)
        self.pieces = []
        if self.pre:
            lines = text.expandtabs().strip("\n").split("\n")
            self.put([x.rstrip() for x in lines] if text.strip() else [], 0)
        else:
            text = _BLANK.sub(" ", text).strip(" ")
            self.put([text] if text else [], 0)


def _table(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of cells (lines, columns spanned), every column as wide as its widest cell."""
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(WIDEST, max(map(len, lines), default=0)))
            at += span
    found = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            parts, at = [], 0
            for lines, span in row:
                wide = sum(widths.get(c, 0) for c in range(at, at + span)) + 2 * (span - 1)
                parts.append((lines[k] if k < len(lines) else "").ljust(wide))
                at += span
            found.append("  ".join(parts).rstrip())
    return found


class _Layout(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Open elements, each with its box if it is one.
        self.stack: list[tuple[str, _Box | None]] = []
        self.boxes = [_Box("")]
        self.open: dict[str, int] = {}
        # Whether anything but <html> has come; a <head> after that is ignored.
        self.seen = False
        # Open drawings and formulas and what holds HTML or text in them: place in the stack, kind.
        self.foreign: list[tuple[int, str]] = []

    def _inside(self) -> str:
        """svg, text (of a drawing) or math where those rules hold, else html."""
        return self.foreign[-1][1] if self.foreign else "html"

    def _end_head(self) -> None:
        if self.stack and self.stack[-1][0] == "head":
            self._close_to(len(self.stack) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own = dict(attrs)
        if tag == "head" and (self.seen or self.open.get("head")):
            return
        if tag not in HEAD:
            self._end_head()
        self.seen = self.seen or tag != "html"
        if tag in BREAKOUT and self._inside() != "html":
            k = len(self.foreign) - 1
            while k and self.foreign[k - 1][1] != "html":
                k -= 1
            self._close_to(self.foreign[k][0])
        inside = self._inside()
        drawing = "svg" if inside == "text" else inside
        if tag in IMPLIED:
            self._close_nearest(*IMPLIED[tag])
        if tag in BLOCKS and self.open.get("p"):
            self._close_nearest({"p"}, {"table", "td", "th", "li", "blockquote", "div", "section", "article"})
        if tag == "br":
            box = self.boxes[-1]
            if box.pre:
                box.pieces.append("\n")
            else:
                box.end_line()
            return
        hidden = tag in UNSEEN or tag in UNDRAWN.get(drawing, ()) or "hidden" in own or bool(_HIDING.search(own.get("style") or ""))
        hidden = hidden or tag == "dialog" and "open" not in own
        if tag in VOID:
            if tag == "hr":
                self.boxes[-1].end_line()
                self.boxes[-1].gap = 1
            return
        parent = self.boxes[-1]
        # What a closed <details> holds, but for its summary, is not seen.
        hidden = hidden or parent.tag == "details" and parent.kind == "closed" and tag != "summary"
        box = None
        # Browsers lay out each text of a drawing as a block.
        if hidden or tag in BLOCKS or drawing == "svg" and tag in ("text", "foreignobject"):
            if not hidden:
                parent.end_line()
            start = own.get("start") or "1"
            box = _Box(tag, hidden, tag == "pre" or parent.pre, "closed" if tag == "details" and "open" not in own else "", int(start) if re.fullmatch(r"[0-9]{1,9}", start) else 1)
            span = own.get("colspan") or "1"
            box.span = min(100, max(1, int(span))) if re.fullmatch(r"[0-9]{1,4}", span) else 1
            self.boxes.append(box)
        if tag in ("svg", "math"):
            self.foreign.append((len(self.stack), tag))
        elif tag in HOLDS_HTML.get(drawing, ()):
            self.foreign.append((len(self.stack), "html"))
        elif drawing == "svg" and tag == "text":
            self.foreign.append((len(self.stack), "text"))
        self.stack.append((tag, box))
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # In HTML a slash does not close an element, but in drawings and formulas it does.
        if tag in BREAKOUT or self._inside() == "html" and tag not in ("svg", "math"):
            self.handle_starttag(tag, attrs)
            return
        depth = len(self.stack)
        self.handle_starttag(tag, attrs)
        self._close_to(depth)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag in ("td", "th", "tr", "li", "dt", "dd", "p"):
            self._close_nearest({tag}, {"table"} if tag[0] == "t" else {"table", "td", "th"})
        elif tag == "html" or tag == "body":
            self._end_head()
        else:
            self._close_nearest({tag}, set() if tag in BLOCKS else {"td", "th", "table"})

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self._end_head()
            self.seen = True
        box = self.boxes[-1]
        # In a drawing only its texts are seen.
        if self._inside() == "svg":
            return
        # Between the cells and items of a structure only blanks are expected.
        if not (box.hidden or box.tag == "details" and box.kind == "closed"):
            box.pieces.append(data)

    def _close_nearest(self, tags: set[str], fences: set[str]) -> None:
        if not any(self.open.get(t) for t in tags):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                self._close_to(k)
                return
            if self.stack[k][0] in fences:
                return

    def _close_to(self, k: int) -> None:
        while len(self.stack) > k:
            tag, box = self.stack.pop()
            self.open[tag] -= 1
            if self.foreign and self.foreign[-1][0] == len(self.stack):
                self.foreign.pop()
            if box is not None:
                self.boxes.pop()
                if not box.hidden:
                    box.end_line()
                    self._join(box, self.boxes[-1])

    def _join(self, box: _Box, parent: _Box) -> None:
        tag, lines = box.tag, box.lines
        if tag in ("td", "th") and parent.tag == "tr":
            parent.cells.append((lines, box.span))
        elif tag == "tr":
            rows = [box.cells] if box.cells else []
            if parent.tag in ("table", "tbody", "thead", "tfoot"):
                parent.rows.extend(rows)
                parent.put(lines, 0)
            else:
                parent.put(lines + _table(rows), 0)
        elif tag in ("tbody", "thead", "tfoot") and parent.tag == "table":
            parent.rows.extend(box.rows)
            parent.put(lines, 0)
        elif tag in ("table", "tbody", "thead", "tfoot"):
            box.put(_table(box.rows), 0)
            parent.put(box.lines, 1)
        elif tag == "li":
            sign = "- "
            if parent.tag == "ol":
                sign, parent.number = f"{parent.number}. ", parent.number + 1
            deep = sum(self.open.get(t, 0) for t in ("ul", "ol", "menu")) > DEEPEST
            pad = "" if deep else " " * len(sign)
            parent.put([(sign if i == 0 else pad if x else "") + x for i, x in enumerate(lines)], 0)
        elif tag in ("dd", "blockquote"):
            parent.put([f"  {x}" if x else "" for x in lines] if len(self.stack) < 100 else lines, int(tag == "blockquote"))
        else:
            nested = tag in ("ul", "ol", "menu") and parent.tag == "li"
            parent.put(lines, int(tag in PARAGRAPHS and not nested))

    def text(self) -> str:
        self._close_to(0)
        self.boxes[0].end_line()
        return "\n".join(self.boxes[0].lines)


def visible_text(html: str | None) -> str:
    """All visible text of a page; null and empty pages have none."""
    layout = _Layout()
    layout.feed(html or "")
    layout.close()
    return layout.text()


def extract_text(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the visible text in place of the HTML.

    Blocks stand on lines of their own, paragraphs, headings, lists and tables a
    blank line apart; items carry a dash or their number and nested lists are set
    in; cells of a table are padded to their columns; text in ``pre`` keeps its
    blanks. Texts of drawings stand on lines of their own; a formula's text is
    written as it comes. Scripts, styles, the head, form fields (select, textarea),
    hidden elements and closed details are not seen. Broken markup is read as HTML reads it: unclosed elements
    end with their parent, stray end tags are ignored.

    A null or empty page gives an empty text. Rows are kept as they are, repeated
    ones too; a column named like ``out`` gives way. No rows give no rows.
    """
    ship_package(pages.sparkSession)
    rest = [c for c in pages.columns if c not in (html_column, out)]
    source = pages.select(*rest, F.col(html_column).cast("string").alias("_html"))
    names = [*rest, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([visible_text(x.as_py()) for x in batch.columns[-1]], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=names)

    return source.mapInArrow(run, T.StructType([*source.schema.fields[:-1], T.StructField(out, T.StringType())]))
