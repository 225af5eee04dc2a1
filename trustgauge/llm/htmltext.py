"""HTML extraction that follows the layout: all visible text, in blocks, lists and tables."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.sources.shipping import ship_package

SLICE_BYTES = 8 << 20
# A longer cell does not widen its column; nested lists are indented no further; tables within as
# many others add their cells to the innermost of those.
COLUMN_WIDTH, MOST_INDENT, MOST_TABLES = 60, 24, 12

# Element names by their part in the layout, as the HTML standard's rendering
# section has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head title script style template noscript noframes noembed iframe canvas audio video "
    "datalist rp".split()
)
# Within svg and math: hidden elements, and those whose parts stand apart.
FOREIGN_HIDDEN = {
    "svg": frozenset(
        "title desc metadata defs symbol clippath mask pattern marker filter lineargradient "
        "radialgradient".split()
    ),
    "math": frozenset(("annotation", "annotation-xml", "mphantom")),
}
APART = frozenset(
    "mfrac msub msup msubsup mroot munder mover munderover mmultiscripts mtable mtr".split()
)
# What may stand in a head whose end tag was left out.
IN_HEAD = frozenset(
    "base basefont bgsound link meta title style script template noscript noframes".split()
)
RAW = frozenset("script style title textarea noscript noframes noembed iframe template xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table ul tr caption thead tbody tfoot".split()
)
# Blocks set off from their neighbours by an empty line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
# Displays of a style that make an element a block of its own, and blocks that an inline one unmakes.
BLOCK_DISPLAY = frozenset("block flex grid list-item table flow-root".split())
UNMADE = BLOCK - frozenset("ul ol menu dir dl li dt dd table caption thead tbody tfoot tr pre center hr".split())
CELL = frozenset(("td", "th"))
ROW, TABLE, PARAGRAPH = frozenset(("tr",)), frozenset(("table",)), frozenset(("p",))
ROUND_PARAGRAPH = frozenset((*CELL, "li", "table", "caption", "button", "div"))
# A start tag ends an open element of the first kind, up to an element of the second.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (CELL, frozenset(("tr", "table"))),
    "th": (CELL, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "thead": (frozenset(("thead", "tbody", "tfoot", "caption")), frozenset(("table",))),
    "tbody": (frozenset(("thead", "tbody", "tfoot", "caption")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot", "caption")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
    "body": (frozenset(("head",)), frozenset(("html",))),
}

# Name and value of an attribute; quotes open a value only right after the equals sign.
_NAME = r"[^\s/>][^\s/>=]*+"
_VALUE = r"\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+|(?=>|\Z)"
_PAIR = re.compile(rf"({_NAME})(?:\s*+=\s*+({_VALUE})|(?!\s*+=))", re.ASCII)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_NAME}(?:\s*+=\s*+(?>{_VALUE})|(?!\s*+=)))*+)>",
    re.DOTALL | re.ASCII,
)
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NUMBER = re.compile(r"\s*([+-]?\d+)", re.ASCII)


class _Table:
    """Cells of one table by row and column, the columns aligned."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, str]]] = []  # first column and text of each cell
        self.at = 0
        self.covered: list[list[int]] = []  # first and last column of cells from above, rows left
        self.opened: list[list[int]] = []

    def row(self) -> None:
        reach: list[list[int]] = []
        for first, end, left in sorted([c[0], c[1], c[2] - 1] for c in self.covered + self.opened if c[2] > 1):
            if reach and reach[-1][1] == first and reach[-1][2] == left:
                reach[-1][1] = end
            else:
                reach.append([first, end, left])
        self.covered, self.opened, self.at = reach, [], 0
        self.rows.append([])

    def cell(self, text: str, columns: int, rows: int) -> None:
        for first, end, _ in self.covered:
            if first <= self.at < end:
                self.at = end
        self.rows[-1].append((self.at, text))
        if rows > 1:
            self.opened.append([self.at, self.at + columns, rows])
        self.at += columns

    def lines(self) -> list[str]:
        """Aligned lines; plain ones if padding would make more than twice the text itself."""
        rows = [cells for cells in ([c for c in r if c[1]] for r in self.rows) if cells]
        column = {c: k for k, c in enumerate(sorted({c for r in rows for c, _ in r}))}
        width = [0] * len(column)
        for r in rows:
            for c, text in r:
                longest = max(map(len, text.split("\n")))
                if longest <= COLUMN_WIDTH:
                    width[column[c]] = max(width[column[c]], longest)
        place = [0]
        for w in width:
            place.append(place[-1] + w + 2)
        raw = sum(len(text) + 4 for r in rows for _, text in r)
        lines: list[str] = []
        size = 0
        for r in rows:
            cells = [(place[column[c]], text.split("\n")) for c, text in r]
            for k in range(max(len(own) for _, own in cells)):
                line = ""
                for at, own in cells:
                    if k < len(own) and own[k]:
                        line = (line.ljust(at) if len(line) + 2 <= at or not line else line + "  ") + own[k]
                lines.append(line)
                size += len(line)
                if size > 3 * raw:
                    return self.plain(rows)
        return lines

    @staticmethod
    def plain(rows: list[list[tuple[int, str]]]) -> list[str]:
        lines: list[str] = []
        for r in rows:
            if any("\n" in text for _, text in r):
                lines += [line for _, text in r for line in text.split("\n")]
            else:
                lines.append("  ".join(text for _, text in r))
        return lines


class _Choices:
    """Options of one select: text, and whether it is selected, disabled or hidden."""

    def __init__(self, attributes: dict[str, str]) -> None:
        size = _NUMBER.match(attributes.get("size", ""))
        # A list box shows all its options, a menu the chosen one.
        self.all = "multiple" in attributes or (size is not None and int(size[1]) > 1)
        self.options: list[list] = []
        self.off = False

    def shown(self) -> list[str]:
        if self.all:
            return [text for text, _, _, hidden in self.options if text and not hidden]
        chosen = [o[0] for o in self.options if o[1]][-1:]
        return chosen or [o[0] for o in self.options if not o[2]][:1]


class _Writer:
    """Text of one flow: lines with collapsed blanks, the gaps between them, and their indent."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = False
        self.base = ""  # indent of a line
        self.first: str | None = None  # indent and markers of the next line of an item
        self.fresh = False  # nothing of the item is written yet
        self.before = False  # the gap asked for before the item

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.split("\n")
            self.line += first
            for more in rest:
                self.end(force=True)
                self.line = more
            return
        text = _SPACE.sub(" ", text)
        if not self.line or self.line[-1] in " \n":
            text = text.lstrip(" ")
        self.line += text

    def end(self, gap: bool = False, force: bool = False) -> None:
        line = self.line.rstrip(" ")
        self.line = ""
        if line or force:
            if (self.before if self.fresh else self.gap) and self.lines:
                self.lines.append("")
            self.gap = self.fresh = False
            if line:
                self.lines.append((self.base if self.first is None else self.first) + line)
                self.first = None
            else:
                self.lines.append("")
        # An item begins and ends without a gap, whatever its first and last block ask for.
        self.gap = not self.fresh and (self.gap or gap)

    def enter(self, marker: str) -> tuple:
        """Begin a list item; what is returned ends it."""
        self.end()
        outer = (self.base, self.first, self.fresh, self.before, self.gap, len(self.lines))
        self.before = self.before if self.fresh else self.gap
        if len(self.base) + len(marker) <= MOST_INDENT:
            self.first = (self.base if self.first is None else self.first) + marker
            self.base += " " * len(marker)
        else:
            self.first = self.base + marker
        self.fresh, self.gap = True, False
        return outer

    def leave(self, outer: tuple) -> None:
        self.end()
        self.base, first, fresh, before, gap, written = outer
        if len(self.lines) > written:
            self.first, self.fresh, self.gap = None, False, False
        else:
            self.first, self.fresh, self.before, self.gap = first, fresh, before, gap

    def all(self) -> list[str]:
        self.end()
        return self.lines


def render(page: str) -> str:
    """Visible text of a page.

    Tags build a stack of open elements, with end tags that authors may leave out implied;
    hidden elements swallow what they hold. Blocks begin a line, spaced blocks an empty one,
    list items get a dash or their number and an indent, and table cells are aligned by column,
    those beside a cell of several rows and below one of several columns too.

    Hidden is what a browser with scripts does not show: heads, scripts, styles, templates,
    noscript, what stands in for frames, canvas, audio and video, closed dialogs, suggestions
    (datalist), objects with data that browsers show themselves, titles, descriptions and
    definitions within svg, annotations within math, and elements with the attribute hidden or
    a style attribute that hides them. Style sheets and scripts are not run. Text of svg and
    math, text areas, the chosen option of a menu, all options of a list box and what only
    screen readers skip (aria-hidden) are shown.
    """
    # Name, whether it hides what is in it, whether text round it is visible, whether its style makes
    # or unmakes a block, and what ends it.
    stack: list[tuple[str, bool, bool, bool | None, tuple | None]] = []
    places: dict[str, list[int]] = {}  # of the open elements of each name
    hidden = 0
    visible = True
    keep = 0
    writer = _Writer()
    writers: list[tuple[str, _Writer]] = []  # flows around an open cell, item or table
    tables: list[_Table] = []
    counters: list[int | None] = []
    choices: list[_Choices] = []
    foreign: list[str] = []  # open svg and math elements, and HTML parts within

    def close(name: str) -> None:
        """Close the innermost element, which has this name."""
        nonlocal hidden, keep, writer, visible
        stack_name, hides, visible, block, more = stack.pop()
        places[stack_name].pop()
        hidden -= hides
        if stack_name in ("svg", "math", "foreignobject") and foreign:
            foreign.pop()
        if hidden or hides:
            return
        if stack_name in CELL and writers and writers[-1][0] == "cell":
            lines = writer.all()
            writer = writers.pop()[1]
            if tables and tables[-1].rows:
                tables[-1].cell("\n".join(x for x in lines if x), *(more or (1, 1)))
        elif stack_name == "table" and more:
            outside = writer.all()
            lines = tables.pop().lines()
            writer = writers.pop()[1]
            writer.end(gap=True)
            for line in outside + lines:
                writer.line = line
                writer.end()
            writer.end(gap=True)
        elif stack_name == "li" and more:
            writer.leave(more)
        elif stack_name == "option" and writers and writers[-1][0] == "option":
            choices[-1].options[-1][0] = " ".join(x.strip() for x in writer.all() if x.strip())
            writer = writers.pop()[1]
        elif stack_name == "optgroup" and choices:
            choices[-1].off = False
        elif stack_name == "select" and writers and writers[-1][0] == "select":
            writer = writers.pop()[1]
            box = choices.pop()
            for text in box.shown():
                if box.all:
                    writer.end()
                writer.text(text, False)
            if box.all:
                writer.end()
        elif stack_name == "text" and foreign and foreign[-1] == "svg":
            writer.text(" ", False)
        elif stack_name in ("ul", "ol", "menu", "dir"):
            if counters:
                counters.pop()
            writer.end(gap=not counters)
        elif block or (block is None and stack_name in BLOCK):
            writer.end(gap=stack_name in SPACED)
            keep -= stack_name == "pre"
        elif stack_name == "q" and visible:
            writer.text('"', False)

    def innermost(names: frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close_to(names: frozenset[str], bounds: frozenset[str]) -> None:
        at = innermost(names)
        if at >= 0 and at >= innermost(bounds):
            while len(stack) > at:
                close(stack[-1][0])

    def start(name: str, attributes: str, alone: bool) -> None:
        nonlocal hidden, keep, writer, visible
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            close("head")
        if name == "select" and choices:
            # A second start tag only ends the first select.
            close_to(frozenset(("select",)), frozenset())
            return
        if name in IMPLIED:
            close_to(*IMPLIED[name])
        elif name in BLOCK:
            close_to(PARAGRAPH, ROUND_PARAGRAPH)
        if name in ("td", "th") and not hidden and tables and innermost(ROW) <= innermost(TABLE):
            start("tr", "", False)
        if name in VOID:
            if hidden or _look(name, attributes)[0]:
                return
            if name == "br":
                writer.end(force=True)
            elif name == "hr":
                writer.end(gap=True)
            return
        if foreign and alone and foreign[-1] != "foreignobject" and _alone(attributes):
            return
        off, seen, block = _look(name, attributes)
        hides = name in HIDDEN or off
        if foreign and name in FOREIGN_HIDDEN.get(foreign[-1], ()):
            hides = True
        if name in ("svg", "math") or (name == "foreignobject" and foreign):
            foreign.append(name)
        in_menu = name == "option" and choices and not hidden
        if in_menu:
            pairs = _attributes(attributes)
            choices[-1].options.append(["", "selected" in pairs, "disabled" in pairs or choices[-1].off, hides])
            # A menu shows its chosen option though the list leaves it out.
            hides = False
        elif foreign and not hidden and stack and stack[-1][0] in APART or name == "text" and foreign:
            if not hidden:
                writer.text(" ", False)
        more = None
        if not hidden and not hides:
            if name in CELL and attributes:
                pairs = _attributes(attributes)
                more = (_span(pairs.get("colspan", ""), 1000), _span(pairs.get("rowspan", ""), 65534))
            elif name == "li":
                number = counters[-1] if counters else None
                if number is not None and attributes:
                    given = _NUMBER.match(_attributes(attributes).get("value", ""))
                    number = int(given[1]) if given else number
                if number is not None:
                    counters[-1] = number + 1
                more = writer.enter("- " if number is None else f"{number}. ")
            elif name == "table" and len(tables) < MOST_TABLES:
                more = (name,)
        places.setdefault(name, []).append(len(stack))
        stack.append((name, hides, visible, block, more))
        hidden += hides
        visible = visible if seen is None else seen
        if hidden:
            return
        if name == "table" and more:
            writer.end(gap=True)
            writers.append(("table", writer))
            tables.append(_Table())
            writer = _Writer()
        elif name == "select":
            writers.append(("select", writer))
            choices.append(_Choices(_attributes(attributes)))
            writer = _Writer()
        elif in_menu:
            writers.append(("option", writer))
            writer = _Writer()
        elif name == "optgroup" and choices:
            choices[-1].off = "disabled" in _attributes(attributes)
        elif name == "tr":
            if tables:
                tables[-1].row()
        elif name in CELL:
            if tables:
                writers.append(("cell", writer))
                writer = _Writer()
        elif name in ("ul", "ol", "menu", "dir"):
            found = _NUMBER.match(_attributes(attributes).get("start", "")) if attributes else None
            writer.end(gap=not counters)
            counters.append((int(found[1]) if found else 1) if name == "ol" else None)
        elif name == "li":
            pass
        elif block or (block is None and name in BLOCK):
            writer.end(gap=name in SPACED)
            keep += name == "pre"
        elif name == "q" and visible:
            writer.text('"', False)

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        until = found.start() if found else size
        if until > at and stack and stack[-1][0] == "head" and page[at:until].strip():
            close("head")
        if until > at and not hidden and visible:
            text = html.unescape(page[at:until]) if "&" in page[at:until] else page[at:until]
            if not (tables and writers and writers[-1][0] == "table") or text.strip():
                writer.text(text, keep > 0)
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        name = tag.lower()
        if not found[1]:
            alone = found[3].endswith("/")
            start(name, found[3], alone)
            if name in RAW and name != "template":
                if not stack or stack[-1][0] != name:
                    continue
                ending = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                raw = page[at : ending.start() if ending else size]
                if name == "xmp" and not hidden and visible:
                    writer.text(raw, True)
                elif name == "textarea" and not hidden and visible:
                    writer.text(html.unescape(raw.removeprefix("\r").removeprefix("\n")), True)
                if not ending:
                    break
                at = ending.end()
                if stack and stack[-1][0] == name:
                    close(name)
            continue
        if name == "br" and not hidden:
            writer.end(force=True)
        elif name == "p" and not places.get("p"):
            writer.end(gap=True)
        elif name not in VOID:
            bound = frozenset(("table",)) if name != "table" else frozenset()
            if name not in CELL | {"tr", "thead", "tbody", "tfoot", "caption"}:
                bound = bound | CELL
            close_to(frozenset((name,)), bound)
    while stack:
        close(stack[-1][0])
    lines = writer.all()
    while lines and not lines[-1].strip():
        lines.pop()
    while lines and not lines[0].strip():
        lines.pop(0)
    return "\n".join(lines)


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; of equal names the first counts."""
    pairs: dict[str, str] = {}
    for name, value in _PAIR.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        pairs.setdefault(name.lower(), html.unescape(value))
    return pairs


def _style(text: str) -> dict[str, str]:
    """Declarations of a style attribute; the last counts, an important one before others."""
    found: dict[str, str] = {}
    firm = set()
    for part in _CSS_COMMENT.sub(" ", text).lower().split(";"):
        name, _, value = part.partition(":")
        value, mark, _ = value.partition("!")
        name = name.strip()
        if mark:
            firm.add(name)
        if mark or name not in firm:
            found[name] = value.strip()
    return found


def _alone(text: str) -> bool:
    """Does the slash at the end close the tag, not end an unquoted value?"""
    end = 0
    for pair in _PAIR.finditer(text):
        end = pair.end()
    return end < len(text)


def _span(text: str, most: int) -> int:
    """Columns or rows of a cell; no rows means all that follow."""
    found = _NUMBER.match(text)
    if not found:
        return 1
    return min(int(found[1]), most) or (most if most > 1000 else 1) if int(found[1]) >= 0 else 1


def _look(name: str, attributes: str) -> tuple[bool, bool | None, bool | None]:
    """Is the element hidden with all in it; is its text visible; is it a block? None: as usual."""
    if name == "dialog" and "open" not in _attributes(attributes):
        return True, None, None
    if name == "object":
        # Without data, or for a plug-in that no browser has any more, the fallback is shown.
        pairs = _attributes(attributes)
        if "data" in pairs and not pairs.get("type", "").lower().startswith("application/x-"):
            return True, None, None
    low = attributes.lower()
    if "hidden" not in low and "style" not in low:
        return False, None, None
    pairs = _attributes(attributes)
    style = _style(pairs.get("style", ""))
    seen = {"hidden": False, "collapse": False, "visible": True}.get(style.get("visibility", ""))
    display = style.get("display", "")
    block = None
    if display in BLOCK_DISPLAY and name not in BLOCK and name not in CELL:
        block = True
    elif display.startswith("inline") and name in UNMADE:
        block = False
    # A display in the style outranks the attribute named hidden.
    return display == "none" if display else "hidden" in pairs, seen, block


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column("_page")).to_pylist()
        at = 0
        while at < batch.num_rows:
            to, total = at, 0
            while to < batch.num_rows and (to == at or total + sizes[to] <= SLICE_BYTES):
                total += sizes[to]
                to += 1
            part = batch.slice(at, to - at)
            texts = [render(p) for p in part.column("_page").to_pylist()]
            names = part.schema.names
            kept = [i for i, c in enumerate(names) if c != "_page"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in kept), pa.array(texts, pa.string())],
                [*(names[i] for i in kept), "text"],
            )
            at = to


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Visible text of every page: (id, text).

    Pages are rendered where they are read, each whole, in slices of bounded size; nothing
    shuffles. A null or empty page gives an empty text, broken markup whatever text it shows,
    repeated rows equal texts; other columns are ignored.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(id_col), F.coalesce(F.col(html_col), F.lit("")).alias("_page"))
    kind = dict(rows.dtypes)[id_col]
    return rows.mapInArrow(_render_batches, f"`{id_col}` {kind}, text string")
