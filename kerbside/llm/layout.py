"""Visible text of web pages by layout-aware rendering.

A tree builder follows the tags with an explicit stack: void elements, raw text
elements, and tags that others imply (a new ``li`` ends the open one, a block
ends an open ``p``, a cell without a row opens one). The renderer writes what a
reader would see: paragraphs and headings are parted by a blank line, other
blocks by a line break, list items carry a bullet or their number and are
indented by depth, cells of a table are padded to common columns, ``pre`` keeps
its white space. Not visible: head, scripts, styles, templates, comments,
elements with the attribute ``hidden`` or a style that declares ``display:none``
or ``visibility:hidden``, a ``dialog`` that is not open, and the parts of drawings and formulas that are not
drawn (descriptions, definitions, annotations). Each ``text`` of a drawing is a line.

Work and output are linear in the page: an open element is found by its places on
the stack, a column wider than ``ALIGNED`` is not padded, blanks before a text are
at most ``INDENT`` of lists and ``PADDING`` of cells, and tables more than ``NESTED``
deep are rendered as blocks. Texts are always whole.

Defined results: null and empty pages give an empty text; an unclosed comment,
script or tag swallows the rest of the page, as in a browser; an unclosed quote
ends at the next ``>``. Equal pages give equal texts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import common

ALIGNED = 40
INDENT = 64
PADDING = 240
NESTED = 12
BLANK = " \t\n\f\r"

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe noembed noframes video audio canvas datalist".split()
)
FOREIGN = frozenset("svg math".split())
UNDRAWN = frozenset("desc metadata defs symbol annotation annotation-xml".split())  # inside FOREIGN
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol menu dl table figure hr".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside nav header footer main address form fieldset legend details summary"
    " li dt dd figcaption caption center dir option optgroup select textarea hgroup search dialog".split()
)
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset("td th".split())
GROUPS = frozenset("thead tbody tfoot".split())
# what the start of an element ends, and the elements that shield what is outside them
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (CELLS, frozenset(["table"])),
    "th": (CELLS, frozenset(["table"])),
    "tr": (CELLS | {"tr", "caption"}, frozenset(["table"])),
    **{group: (CELLS | {"tr", "caption"} | GROUPS, frozenset(["table"])) for group in GROUPS},
}
PARAGRAPH_SHIELD = CELLS | {"table", "caption", "button"}
TABLE_TAGS = CELLS | GROUPS | {"tr", "table", "caption"}

NAME = re.compile(r"[A-Za-z][^\s/>]*")
ATTRIBUTES_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>]*)))?")
MAYBE_HIDDEN = re.compile(r"hidden|style", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
NUMBER = {key: re.compile(rf"(?:^|\s){key}\s*=\s*[\"']?\s*(-?\d{{1,4}})", re.I) for key in ("start", "value", "colspan")}
SPACES = re.compile(r"[ \t\n\f\r]+")


def _number(attributes: str, key: str, default: int) -> int:
    match = NUMBER[key].search(attributes) if attributes else None
    return int(match[1]) if match else default


def _hides(attributes: str) -> bool:
    """Whether the attribute ``hidden`` or a declaration of ``style`` hides the element."""
    if not MAYBE_HIDDEN.search(attributes):
        return False
    seen = set()
    for match in ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        if name in seen:  # the first of a name counts
            continue
        seen.add(name)
        if name == "hidden":
            return True
        if name == "style":
            for declaration in COMMENT.sub("", unescape(match[2] or match[3] or match[4] or "")).split(";"):
                key, _, value = declaration.partition(":")
                value = value.partition("!")[0].strip().lower()
                if (key.strip().lower(), value) in (("display", "none"), ("visibility", "hidden")):
                    return True
    return False


def _named(attributes: str, name: str) -> bool:
    return any(match[1].lower() == name for match in ATTRIBUTE.finditer(attributes))


class Flow:
    """Lines of one block container."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.pieces: list[str] = []
        self.space = False
        self.gap = 0
        self.marker = ""
        self.indent = 0

    def text(self, content: str) -> None:
        flat = SPACES.sub(" ", content)
        if flat[0] == " ":
            self.space = True
            flat = flat[1:]
        if not flat:
            return
        if self.space and self.pieces:
            self.pieces.append(" ")
        self.space = flat[-1] == " "
        self.pieces.append(flat[:-1] if self.space else flat)

    def _put(self, line: str) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0
        self.lines.append(line)

    def end_line(self, forced: bool = False) -> None:
        if self.pieces or self.marker and not forced:
            indent = min(self.indent, INDENT)
            lead = " " * indent
            if self.marker:
                lead = " " * max(0, indent - len(self.marker) - 1) + self.marker + " " * bool(self.pieces)
            self._put(lead + "".join(self.pieces))
            self.pieces, self.marker = [], ""
        elif forced and self.lines:
            self.gap += 1
        self.space = False

    def block(self, gap: int) -> None:
        if self.pieces:
            self.end_line()
        self.gap = max(self.gap, gap)

    def verbatim(self, lines: list[str]) -> None:
        """Lines as they are, behind the indentation."""
        for line in lines:
            if self.marker:
                self.pieces = [line]
                self.end_line()
            else:
                self._put(" " * min(self.indent, INDENT) + line if line else line)

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int]]] = []

    def row(self) -> None:
        self.rows.append([])

    def cell(self, lines: list[str], columns: int) -> None:
        self.rows[-1].append((lines, columns))

    def render(self) -> list[str]:
        widths: Counter[int] = Counter()
        for row in self.rows:
            at = 0
            for lines, columns in row:
                wide = max(map(len, lines), default=0)
                if columns == 1 and wide <= ALIGNED:
                    widths[at] = max(widths[at], wide)
                at += columns
        places = sorted(widths)
        upto = [0]
        for place in places:
            upto.append(upto[-1] + widths[place])
        out = []
        for row in self.rows:
            # texts by line; what is before a text are the blanks of the cells since the last one
            texts: list[list[str]] = [[] for _ in range(max((len(lines) for lines, _ in row), default=0))]
            written = [0] * len(texts)
            at = begin = 0
            for lines, columns in row:
                room = upto[bisect_left(places, at + columns)] - upto[bisect_left(places, at)] + 2 * (columns - 1)
                for depth, line in enumerate(lines):
                    if line:
                        texts[depth].append(" " * min(begin - written[depth], PADDING) + line)
                        written[depth] = begin + min(len(line), room)
                at += columns
                begin += room + 2
            out.extend("".join(parts).rstrip() for parts in texts)
        return out


class Builder:
    """The stack of open elements and the flows they write to."""

    def __init__(self) -> None:
        self.stack: list[str] = []
        self.open: defaultdict[str, list[int]] = defaultdict(list)  # places on the stack
        self.flat = 0  # open tables that are rendered as blocks
        self.unseen = 0
        self.hides: list[bool] = []
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.spans: list[int] = []
        self.lists: list[int | None] = []
        self.pre = 0

    def text(self, content: str) -> None:
        if not content or self.unseen:
            return
        if self.tables and len(self.flows) == len(self.tables):  # text between cells
            if content.strip(BLANK):
                self.start("td", "")
            else:
                return
        if not self.pre:
            self.flows[-1].text(content)
            return
        first, *rest = content.split("\n")
        flow = self.flows[-1]
        if first:
            flow.pieces.append(first)
        for line in rest:
            if flow.pieces:
                flow.end_line()
            else:
                flow._put("")
            if line:
                flow.pieces.append(line)

    def start(self, tag: str, attributes: str) -> None:
        if tag in ENDS:
            self.imply(*ENDS[tag])
        elif tag in BLOCKS and tag not in ("html", "body") and self.open["p"]:
            self.imply(frozenset(["p"]), PARAGRAPH_SHIELD)
        if tag in CELLS and self.tables and not self.inside("tr"):
            self.start("tr", "")
        foreign = self.open["svg"] or self.open["math"]
        if foreign and attributes.endswith("/"):  # no content
            return
        hidden = tag in UNSEEN or foreign and tag in UNDRAWN or bool(attributes) and _hides(attributes) or tag == "dialog" and not _named(attributes, "open")
        if tag in VOID:
            if not self.unseen and not hidden and tag in ("br", "hr"):
                flow = self.flows[-1]
                if tag == "br":
                    flow.end_line(forced=True)
                else:
                    flow.block(2)
            return
        if not hidden and tag not in BLOCKS and tag not in TABLE_TAGS and tag not in RAW and tag not in FOREIGN and tag != "button" and not (foreign and tag == "text"):
            return  # other inline elements change nothing
        self.open[tag].append(len(self.stack))
        self.stack.append(tag)
        self.hides.append(hidden)
        self.unseen += hidden
        if not self.unseen:
            self.enter(tag, attributes)

    def inside(self, tag: str) -> bool:
        """Whether ``tag`` is open in the current table."""
        return self.last(tag) > self.last("table")

    def last(self, *tags: str) -> int:
        """The highest place on the stack of any of the tags, or -1."""
        return max(self.open[tag][-1] if self.open[tag] else -1 for tag in tags)

    def enter(self, tag: str, attributes: str) -> None:
        flow = self.flows[-1]
        if tag == "table" and len(self.tables) < NESTED:
            flow.block(2)
            self.tables.append(Table())
        elif tag == "table":
            flow.block(2)
            self.flat += 1
        elif self.flat and tag in TABLE_TAGS:
            flow.block(1)
        elif tag == "tr" and self.tables:
            self.tables[-1].row()
        elif tag in CELLS and self.tables:
            self.spans.append(min(max(_number(attributes, "colspan", 1), 1), 1000))
            self.flows.append(Flow())
        elif tag == "text":
            flow.block(1)
        elif tag in BLOCKS:
            nested = tag in LISTS and bool(self.lists)
            flow.block(2 if tag in SPACED and not nested else 1)
            if tag in LISTS:
                flow.indent += 4 if tag == "ol" else 2
                self.lists.append(_number(attributes, "start", 1) if tag == "ol" else None)
            elif tag == "li":
                if self.lists and self.lists[-1] is not None:
                    number = _number(attributes, "value", self.lists[-1])
                    self.lists[-1] = number + 1
                    flow.marker = f"{number}."
                else:
                    flow.marker = "-"
            elif tag in ("dd", "blockquote"):
                flow.indent += 4
            elif tag == "pre":
                self.pre += 1

    def leave(self, tag: str) -> None:
        flow = self.flows[-1]
        if self.flat and tag in TABLE_TAGS:
            flow.block(1)
            self.flat -= tag == "table"
        elif tag == "table":
            if self.tables:
                lines = self.tables.pop().render()
                self.flows[-1].verbatim(lines)
                self.flows[-1].block(2)
        elif tag in CELLS:
            if self.tables and len(self.flows) > len(self.tables):
                self.tables[-1].cell(self.flows.pop().finish(), self.spans.pop())
        elif tag == "text":
            flow.block(1)
        elif tag in BLOCKS:
            if tag == "li" and flow.marker:
                flow.end_line()
            flow.block(2 if tag in SPACED and not (tag in LISTS and len(self.lists) > 1) else 1)
            if tag in LISTS:
                self.lists.pop()
                flow.indent -= 4 if tag == "ol" else 2
            elif tag in ("dd", "blockquote"):
                flow.indent -= 4
            elif tag == "pre":
                self.pre -= 1

    def pop(self) -> None:
        tag = self.stack.pop()
        self.open[tag].pop()
        if not self.unseen:
            self.leave(tag)
        self.unseen -= self.hides.pop()

    def imply(self, ended: frozenset[str], shield: frozenset[str]) -> None:
        above = self.last(*shield)
        lowest = len(self.stack)
        for tag in ended:
            places = self.open[tag]
            at = bisect_right(places, above)
            if at < len(places):
                lowest = min(lowest, places[at])
        self.close(lowest)

    def close(self, place: int) -> None:
        while len(self.stack) > place:
            self.pop()

    def end(self, tag: str) -> None:
        if not self.open[tag]:
            if tag == "p" and not self.unseen:
                self.flows[-1].block(2)
            elif tag == "br":
                self.start("br", "")
            return
        place = self.last(tag)
        if place >= self.last("table", *(() if tag in TABLE_TAGS else CELLS)):
            self.close(place)

    def finish(self) -> str:
        while self.stack:
            self.pop()
        return "\n".join(line.rstrip() for line in self.flows[0].finish())


def render(page: str) -> str:
    """The visible text of a page."""
    builder, at, size, quotes = Builder(), 0, len(page), True
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            builder.text(unescape(page[at:]))
            break
        if tag > at:
            builder.text(unescape(page[at:tag]))
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        closing = page.startswith("/", tag + 1)
        name = NAME.match(page, tag + 1 + closing)
        if not name:
            if page[tag + 1 : tag + 2] in ("!", "?", "/") and tag + 1 < size:
                end = page.find(">", tag)
                at = size if end < 0 else end + 1
            else:
                builder.text("<")
                at = tag + 1
            continue
        found = ATTRIBUTES_END.match(page, name.end()) if quotes else None
        if found:
            end = found.end()
        else:
            quotes = False
            end = page.find(">", name.end()) + 1
            if not end:
                break
        element, attributes = name[0].lower(), page[name.end() : end - 1]
        at = end
        if closing:
            builder.end(element)
            continue
        empty = attributes.endswith("/") and (builder.open["svg"] or builder.open["math"])
        builder.start(element, attributes)
        if element in RAW and not empty:
            stop = re.compile(rf"</{element}(?=[\s/>])", re.I).search(page, at)
            raw = page[at : stop.start() if stop else size]
            if element == "textarea":
                builder.text(unescape(raw))
            at = stop.start() if stop else size
    return builder.finish()


@F.arrow_udf(T.StringType())
def _render(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([render(page.as_py() or "") for page in batch], pa.string())


def visible_text(html: str | Column = "html") -> Column:
    return _render(F.col(html) if isinstance(html, str) else html)


def op10_layout(spark: SparkSession, folder: str) -> DataFrame:
    """The visible text of every page."""
    pages = common.table(spark, folder, "pages")
    return pages.select("page_id", visible_text("html").alias("text")).select(
        "page_id", "text", F.char_length("text").cast("long").alias("n_chars")
    )
