"""HTML extraction by layout: a tree with implied tags, visibility rules, and a plain-text rendering of what shows."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Generator
from html import unescape
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_arrow

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("title textarea".split())
NEVER_SHOWN = frozenset(
    "head script style template noscript title meta link base datalist iframe noembed noframes canvas audio video object rp area param source track".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html legend li main menu nav ol optgroup option p pre search section summary table ul caption tr td th thead tbody tfoot colgroup xmp".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table pre blockquote figure xmp".split())
CLOSES_P = BLOCKS - frozenset("html body li dd dt option optgroup caption tr td th thead tbody tfoot colgroup legend".split())
LISTS = frozenset("ul ol menu dir".split())
CELLS, SECTIONS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
TABLE_PARTS = frozenset(("table", "thead", "tbody", "tfoot", "tr"))
IN_TABLE = frozenset(("table",))
IN_CELL = CELLS | IN_TABLE
PARAGRAPH, AROUND_P = frozenset(("p",)), IN_CELL | frozenset(("button", "caption"))
# An element closes these, looked for no further up than those.
CLOSES: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(("li",)), LISTS), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))), "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
    "tr": (frozenset(("tr", "caption", "colgroup")), frozenset(("table",))), "td": (CELLS, frozenset(("table", "tr"))), "th": (CELLS, frozenset(("table", "tr"))),
    **{s: (frozenset(("thead", "tbody", "tfoot", "caption", "colgroup")), frozenset(("table",))) for s in ("thead", "tbody", "tfoot")},
    "body": (frozenset(("head",)), frozenset(("html",))),
}
IN_HEAD = frozenset("title meta link base script style template noscript head html".split())
LEVELS = 64  # lists, quotes and tables nested deeper are laid out as plain blocks, without more indentation or columns
COLUMN = 80  # cells are aligned up to this width; a longer line pushes on what stands beside it
LINE = 1000  # columns that would begin further right follow the cell before them
START = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
MARK = re.compile("[\"'>]")
WHOLE = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]{1,9})(?![0-9])")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TITLE, TITLE_END = re.compile(r"<title(?=[\s/>])", re.I), re.compile("</title", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")
HIDING = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def get(self, name: str) -> str | None:
        if name not in self.attrs.lower():
            return None
        for m in ATTRIBUTE.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


def number_of(text: str | None, default: int) -> int:
    """The whole number that an attribute starts with; ``default`` for anything else, and beyond nine digits."""
    m = WHOLE.match(text or "")
    return int(m[1]) if m else default


class TagEnds:
    """Finds the ``>`` of tags in one page in linear time: what a search has learned, later ones do not search again."""

    def __init__(self, html: str):
        self.html = html
        self.plain = (1, 0)  # the first quote or ``>`` at or after any place in this range is its end
        self.dead: set[int] = {len(html)}  # from here, outside of quotes, no ``>`` follows

    def after(self, at: int) -> int:
        """The place of the first ``>`` from ``at`` that no quotes enclose, or -1. A quote without a partner is a letter."""
        html, seen = self.html, []
        while True:
            if not self.plain[0] <= at <= self.plain[1]:
                m = MARK.search(html, at)
                self.plain = (at, m.start() if m else len(html))
            at = self.plain[1]
            if at in self.dead:
                self.dead.update(seen)
                return -1
            if html[at] == ">":
                return at
            seen.append(at)
            at = max(html.find(html[at], at + 1), at) + 1


class Open:
    """The open elements, innermost last, and where those of each kind are."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags: frozenset[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def close(self, tags: frozenset[str], limits: frozenset[str]) -> None:
        """Closes the innermost of ``tags`` and all in it, unless one of ``limits`` stands in between."""
        at = self.last(tags)
        if at and at >= self.last(limits):
            self.cut(at)


def build(html: str) -> Node:
    """The tree of a page. Unclosed and misplaced tags are mended as browsers mostly do; text is never lost."""
    root = Node("html")
    stack, ends = Open(root), TagEnds(html)
    at, end, last = 0, len(html), html.rfind(">")

    def text(raw: str) -> None:
        if raw:
            if stack.nodes[-1].tag == "head" and raw.strip():
                stack.cut(len(stack.nodes) - 1)
            stack.nodes[-1].children.append(unescape(raw) if "&" in raw else raw)

    done = 0  # text before this place is in the tree
    while (at := html.find("<", at)) >= 0:
        if html.startswith("<!--", at):
            text(html[done:at])
            stop = html.find("-->", at + 2)
            at = done = stop + 3 if stop >= 0 else end
            continue
        if at > last:
            break
        if html.startswith(("<!", "<?"), at):
            text(html[done:at])
            at = done = html.index(">", at) + 1
            continue
        m = START.match(html, at)
        stop = ends.after(m.end()) if m else -1
        if stop < 0:
            at += 1
            continue
        text(html[done:at])
        at = done = stop + 1
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not stack.places.get("p"):
                stack.nodes[-1].children.append(Node("p"))
            else:
                # An end tag does not reach out of the table or cell it stands in, unless it is theirs.
                stack.close(frozenset((tag,)), IN_TABLE if tag in TABLE_PARTS else IN_CELL)
            continue
        if tag == "html":
            continue
        if stack.nodes[-1].tag == "head" and tag not in IN_HEAD:
            stack.cut(len(stack.nodes) - 1)
        if tag in CLOSES_P:
            stack.close(PARAGRAPH, AROUND_P)
        if tag in CLOSES:
            stack.close(*CLOSES[tag])
        if tag in CELLS and stack.nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr")
            stack.nodes[-1].children.append(row)
            stack.push(row)
        node = Node(tag, html[m.end() : stop])
        stack.nodes[-1].children.append(node)
        if tag in RAW or tag in RCDATA:
            found = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            inner = html[at : found.start()] if found else html[at:]
            node.children.append(unescape(inner) if tag in RCDATA else inner)
            at = done = (html.find(">", found.start()) + 1 or end) if found else end
        elif tag not in VOID:
            stack.push(node)
    text(html[done:])
    return root


class Page:
    """Lines of text under way: words of the open line, and how much space is due before the next."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.blank = False  # the open line wants a space before its next word
        self.due = 0  # line breaks before the next line: 1 or 2

    def word(self, text: str) -> None:
        flat = SPACE.sub(" ", text)
        if flat == " " or not flat:
            self.blank = self.blank or bool(flat)
            return
        if self.open and (self.blank or flat[0] == " "):
            self.open.append(" ")
        self.open.append(flat.strip(" "))
        self.blank = flat[-1] == " "

    def flush(self) -> None:
        if self.open:
            if self.due > 1 and self.lines:
                self.lines.append("")
            self.lines.append("".join(self.open))
            self.open, self.due = [], 0
        self.blank = False

    def part(self, gap: int) -> None:
        """Ends the line; ``gap`` 2 leaves an empty line before what follows."""
        self.flush()
        self.due = max(self.due, gap)

    def add(self, lines: list[str]) -> None:
        self.flush()
        if lines:
            if self.due > 1 and self.lines:
                self.lines.append("")
            self.lines += lines
            self.due = 0

    def done(self) -> list[str]:
        self.flush()
        return self.lines


def shows(node: Node, shown: bool) -> tuple[bool, bool]:
    """Whether the element takes part in the layout, and whether its own text is visible."""
    if node.tag in NEVER_SHOWN:
        return False, False
    if node.attrs:
        if node.get("hidden") is not None or node.tag == "dialog" and node.get("open") is None:
            return False, False
        style = node.get("style")
        if style:
            if HIDING.search(style):
                return False, False
            if m := VISIBILITY.search(style):
                shown = m[1].lower() == "visible"
    elif node.tag == "dialog":
        return False, False
    return True, shown


Step = Generator["Step", object, object]


def run(step: Step) -> object:
    """What a step returns. Steps yield the steps they wait for, so a page may be nested to any depth."""
    waiting, value = [step], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(value))
            value = None
        except StopIteration as end:
            waiting.pop()
            value = end.value
    return value


def render(node: Node, page: Page, shown: bool, level: int) -> Step:
    closed = node.tag == "details" and node.get("open") is None
    number = number_of(node.get("start"), 1) if node.tag == "ol" else 1
    for child in node.children:
        if isinstance(child, str):
            if shown and not closed:
                page.word(child)
            continue
        tag = child.tag
        if closed and tag != "summary":
            continue
        laid, visible = shows(child, shown)
        if not laid:
            continue
        if tag == "br":
            if page.open:
                page.flush()
            page.due = max(page.due, 1)
        elif tag == "input":
            if visible and (child.get("type") or "text").lower() not in ("hidden", "checkbox", "radio", "password", "file", "image", "color", "range"):
                page.word(f" {child.get('value') or ''} ")
        elif tag in ("pre", "xmp", "textarea"):
            page.part(2 if tag != "textarea" else 1)
            page.add(preformatted(child, visible))
            page.part(2 if tag != "textarea" else 1)
        elif tag == "table" and level < LEVELS:
            page.part(2)
            page.add((yield table_lines(child, visible, level + 1)))
            page.part(2)
        elif tag == "li" and level < LEVELS:
            mark = "- "
            if node.tag == "ol":
                number = number_of(child.get("value"), number)
                mark, number = f"{number}. ", number + 1
            page.part(1)
            inner = yield lines_of(child, visible, level + 1)
            page.add([(mark if i == 0 else " " * len(mark) if line else "") + line for i, line in enumerate(inner)])
            page.part(1)
        elif tag in ("dd", "blockquote") and level < LEVELS:
            gap = 2 if tag == "blockquote" else 1
            page.part(gap)
            inner = yield lines_of(child, visible, level + 1)
            page.add(["  " + line if line else "" for line in inner])
            page.part(gap)
        elif tag in BLOCKS:
            gap = 2 if tag in SPACED and not (tag in LISTS and node.tag == "li") else 1
            page.part(gap)
            yield render(child, page, visible, level)
            page.part(gap)
        else:
            yield render(child, page, visible, level)


def lines_of(node: Node, shown: bool, level: int) -> Step:
    page = Page()
    yield render(node, page, shown, level)
    return page.done()


def preformatted(node: Node, shown: bool) -> list[str]:
    out: list[str] = []
    waiting = [(iter(node.children), shown)]
    while waiting:
        children, visible = waiting[-1]
        child = next(children, None)
        if child is None:
            waiting.pop()
        elif isinstance(child, str):
            if visible:
                out.append(child)
        elif child.tag == "br":
            out.append("\n")
        else:
            laid, own = shows(child, visible)
            if laid:
                waiting.append((iter(child.children), own))
    lines = [line.rstrip() for line in "".join(out).replace("\r\n", "\n").expandtabs(8).split("\n")]
    filled = [i for i, line in enumerate(lines) if line]
    return lines[filled[0] : filled[-1] + 1] if filled else []


class Grid:
    """The cells of a table by row and column. A cell that spans rows keeps its columns in them, to the end of its section."""

    def __init__(self) -> None:
        self.rows: list[dict[int, tuple[int, list[str]]]] = []
        self.held: list[tuple[int, int, int]] = []  # first column, end, rows still to come

    def section(self) -> None:
        self.held = []

    def row(self, cells: list[tuple[int, int, list[str]]]) -> None:
        """Cells are columns spanned, rows spanned (0: all that follow) and lines."""
        placed: dict[int, tuple[int, list[str]]] = {}
        taken, at, coming = sorted(self.held), 0, []
        i = 0
        for wide, tall, lines in cells:
            while i < len(taken) and taken[i][0] <= at:
                at = max(at, taken[i][1])
                i += 1
            if lines:
                placed[at] = (wide, lines)
            if tall != 1:
                coming.append((at, at + wide, tall - 1 if tall else 1 << 30))
            at += wide
        self.held = [(a, b, n - 1) for a, b, n in self.held if n > 1] + coming
        if placed:
            self.rows.append(placed)

    def lines(self) -> list[str]:
        """Columns two spaces apart. Those that hold nothing take no space, and a cell over several uses all of theirs."""
        used = sorted({c for row in self.rows for c in row})
        width = dict.fromkeys(used, 0)
        spanning = []
        for row in self.rows:
            for c, (wide, lines) in row.items():
                most = min(max(map(len, lines)), COLUMN)
                if wide == 1:
                    width[c] = max(width[c], most)
                else:
                    spanning.append((wide, c, most))
        for wide, c, most in sorted(spanning):
            under = used[bisect_left(used, c) : bisect_left(used, c + wide)]
            lack = most - sum(width[u] for u in under) - 2 * (len(under) - 1)
            width[under[-1]] += max(lack, 0)
        place, at = {}, 0
        for c in used:
            place[c] = min(at, LINE)
            at += width[c] + 2
        out = []
        for row in self.rows:
            columns = sorted(row)
            for parts in zip_longest(*[row[c][1] for c in columns], fillvalue=""):
                pieces, length = [], 0
                for c, part in zip(columns, parts):
                    if part:
                        gap = max(place[c] - length, 2 if length else 0)
                        pieces += [" " * gap, part]
                        length += gap + len(part)
                out.append("".join(pieces).rstrip())
        return out


def table_lines(node: Node, shown: bool, level: int) -> Step:
    """Cells in columns as wide as their widest line, two spaces apart; what is no cell comes before the rows."""
    grid, before = Grid(), Page()

    def gather(part: Node, visible: bool) -> Step:
        for child in part.children:
            if isinstance(child, str):
                if visible:
                    before.word(child)
                continue
            laid, own = shows(child, visible)
            if not laid:
                continue
            if child.tag in SECTIONS:
                grid.section()
                yield gather(child, own)
                grid.section()
            elif child.tag == "tr":
                cells: list[tuple[int, int, list[str]]] = []
                for cell in child.children:
                    if isinstance(cell, str):
                        if own:
                            before.word(cell)
                        continue
                    there, seen = shows(cell, own)
                    if there and cell.tag in CELLS:
                        inner = yield lines_of(cell, seen, level)
                        wide = min(max(number_of(cell.get("colspan"), 1), 1), 1000)
                        tall = number_of(cell.get("rowspan"), 1)
                        cells.append((wide, tall if tall >= 0 else 1, inner))
                    elif there:
                        before.part(1)
                        before.add((yield lines_of(cell, seen, level)))
                grid.row(cells)
            elif child.tag not in ("colgroup", "col"):
                before.part(1)
                before.add((yield lines_of(child, own, level)))

    yield gather(node, shown)
    return before.done() + grid.lines()


def visible_text(html: str | None) -> str:
    """All text that the page shows, laid out in lines."""
    return "\n".join(run(lines_of(build(html.replace("\x00", "")), True, 0))) if html else ""


def title_of(html: str | None) -> str:
    m = TITLE.search(html or "")
    start = html.find(">", m.start()) + 1 if m else 0
    if not start:
        return ""
    stop = TITLE_END.search(html, start)
    return SPACE.sub(" ", unescape(html[start : stop.start() if stop else len(html)])).strip()


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, title, text)``, a row for each row of ``pages``.

    Null and empty pages give empty texts, broken markup what can be read of it: numbers that are none count as absent, a
    tag that never ends is text, elements may be nested to any depth. The time for a page grows with its length. Rows are
    rendered one by one; other columns are not read.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        html = batch["html"].to_pylist()
        texts = [pa.array([f(h) for h in html], pa.string()) for f in (title_of, visible_text)]
        return pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], *texts], ["page_id", "url", "title", "text"])

    schema = pages.select("page_id", "url", F.lit("").alias("title"), F.lit("").alias("text")).schema
    return by_arrow(pages.select("page_id", "url", "html"), schema, work)
