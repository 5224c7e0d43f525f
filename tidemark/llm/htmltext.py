"""Visible text of HTML pages, laid out roughly as a reader sees it.

A page is read into a tree: tags that HTML lets authors leave out are implied
(a new ``li`` ends the last one, a ``td`` opens its ``tr``), end tags close what
is open inside them, and unmatched ones are ignored.  A walk over the tree then
emits all visible text: blocks on lines of their own, paragraphs and headings
apart, lists with markers and indents, ``pre`` as it stands, and tables with
their cells in aligned columns.  Scripts, styles, the head and whatever is
hidden by attribute or style are left out.

Both the tree and the walk use explicit stacks, so depth has no limit.

Defined results: null and empty pages give an empty text; broken markup gives
text as far as it can be read; repeated rows are rendered each; an empty table
gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import text_slices

# Element names of the HTML standard, by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe object svg math canvas audio video datalist".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table ul".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body html legend option optgroup summary".split())
SCOPE = frozenset("table td th caption html button".split())
#: Which open elements a start tag ends, and what the search for them stops at.
ENDED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"]) | SCOPE),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | SCOPE),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | SCOPE),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["table", "tr"])),
}
for _part in ("thead", "tbody", "tfoot"):
    ENDED_BY[_part] = (frozenset("thead tbody tfoot tr td th caption".split()), frozenset(["table"]))

#: Longest cell that others of its column are aligned with.
CELL_WIDTH = 40

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


class Node:
    """An element: its name, attributes that matter, and children (elements and strings)."""

    __slots__ = ("children", "name", "rest")

    def __init__(self, name: str, rest: str = ""):
        self.name, self.rest, self.children = name, rest, []

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(self.rest)}

    def hidden(self) -> bool:
        if self.name in HIDDEN:
            return True
        low = self.rest.lower() if self.rest else ""
        if self.name == "dialog":
            return "open" not in self.attributes()
        if "hidden" not in low and "style" not in low:
            return False
        found = self.attributes()
        return "hidden" in found or bool(_UNSEEN.search(found.get("style", "")))


    def shown(self) -> list:
        """The children that count: of a closed ``details`` its first summary only."""
        if self.name != "details" or "open" in self.attributes():
            return self.children
        return [c for c in self.children if isinstance(c, Node) and c.name == "summary"][:1]


class Builder:
    """Open elements from the root down, with a count of each name."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.names = Counter(["html"])

    def push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.names[node.name] += 1

    def pop(self) -> str:
        name = self.open.pop().name
        self.names[name] -= 1
        return name

    def close_within(self, names: frozenset, barrier: frozenset) -> None:
        """End the outermost open element of ``names`` above the nearest ``barrier``, and what is inside."""
        left = sum(self.names[n] for n in names)
        cut, i = None, len(self.open) - 1
        while left and i > 0:
            name = self.open[i].name
            if name in names:
                cut, left = i, left - 1
            elif name in barrier:
                break
            i -= 1
        while cut is not None and len(self.open) > cut:
            self.pop()

    def start(self, name: str, rest: str) -> None:
        if name in ("html", "body"):
            if rest and name == "body":
                self.root.rest = self.root.rest or rest
            return
        if name == "head" and len(self.open) > 1:
            return
        if name in ENDED_BY:
            self.close_within(*ENDED_BY[name])
        if name in ENDS_PARAGRAPH and self.names["p"]:
            self.close_within(frozenset(["p"]), SCOPE)
        if self.names["head"] and self.open[-1].name == "head" and name not in ("title", "meta", "link", "base", "script", "style", "noscript", "template"):
            self.pop()  # the head ends where the page begins
        if name in ("td", "th") and self.open[-1].name != "tr" and self.names["table"]:
            self.push(Node("tr"))
        if name in VOID:
            self.open[-1].children.append(Node(name, rest))
        else:
            self.push(Node(name, rest))

    def end(self, name: str) -> None:
        if name == "br":
            self.open[-1].children.append(Node("br"))
        if name in ("html", "body") or not self.names[name]:
            return
        stop = frozenset() if name in SCOPE or name in ("tr", "tbody", "thead", "tfoot") else frozenset(["table", "td", "th"])
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == name:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i].name in stop:
                return

    def text(self, text: str) -> None:
        if self.open[-1].name == "head" and text.strip():
            self.pop()
        self.open[-1].children.append(text)


def tree(page: str) -> Node:
    """The page as a tree."""
    build, at = Builder(), 0
    stop = page.rfind(">") + 1 if "<!--" not in page[page.rfind(">") + 1 :] else len(page)  # no markup ends beyond
    while True:
        m = _MARKUP.search(page, at, stop)
        if m is None:
            break
        if m.start() > at:
            build.text(unescape(page[at : m.start()]))
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            build.end(name)
            continue
        build.start(name, m["rest"])
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            raw = page[at : end.start() if end else len(page)]
            if name == "textarea":
                build.text(unescape(raw))
            build.end(name)
            at = end.end() if end else len(page)
    if at < len(page):
        build.text(unescape(page[at:]))
    return build.root


class Lines:
    """Text put together line by line: white space collapsed, breaks merged, indents and markers at line starts."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks = 0
        self.space = False
        self.begun = False  # something stands on the current line
        self.indents: list[str] = []
        self.marker = ""

    def _begin(self) -> None:
        if self.breaks and self.out:
            self.out.append("\n" * self.breaks)
        self.breaks = 0
        if not self.begun:
            indent = "".join(self.indents)
            if self.marker:
                indent = indent[: len(indent) - len(self.marker)] + self.marker
                self.marker = ""
            self.out.append(indent)
            self.begun = True
        elif self.space:
            self.out.append(" ")
        self.space = False

    def text(self, text: str) -> None:
        words = text.split()
        if not words:
            self.space = self.space or (self.begun and bool(text))
            return
        self.space = self.begun and (self.space or text[0].isspace())
        self._begin()
        self.out.append(" ".join(words))
        self.space = text[-1].isspace()

    def exact(self, line: str) -> None:
        self.space = False
        self._begin()
        self.out.append(line)

    def line_break(self, n: int = 1) -> None:
        if self.begun or self.breaks:
            self.breaks = max(self.breaks, n)
        self.begun = self.space = False

    def forced_break(self) -> None:
        """One more line break, as ``br`` makes."""
        self.breaks = min(self.breaks + 1, 2) if self.out else 0
        self.begun = self.space = False

    def result(self) -> str:
        return "".join(self.out).rstrip()


class Table:
    """Rows of cells (text, columns, rows down to the end of its group if 0), and the rows that begin a group."""

    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []
        self.groups: set[int] = set()

    def placed(self) -> list[list[tuple[int, str, int]]]:
        """Column, text and span of the cells of each row; a cell of an earlier row that reaches down keeps its columns.

        Columns taken so are kept as ranges in order.  The work of a row is that
        of its cells and of the ranges it passes over.
        """
        out: list[list[tuple[int, str, int]]] = []
        taken: list[tuple[int, int, float]] = []  # first column, column behind the last, row behind the last
        for r, row in enumerate(self.rows):
            taken = [] if r in self.groups else [t for t in taken if t[2] > r]
            cells, reaching, at, k = [], [], 0, 0
            for text, span, down in row:
                while k < len(taken) and taken[k][0] <= at:
                    at, k = max(at, taken[k][1]), k + 1
                cells.append((at, text, span))
                if down != 1:
                    until = r + down if down else float("inf")
                    if reaching and reaching[-1][1] == at and reaching[-1][2] == until:
                        reaching[-1] = (reaching[-1][0], at + span, until)
                    else:
                        reaching.append((at, at + span, until))
                at += span
            if reaching:
                taken = sorted(taken + reaching)
            out.append(cells)
        return out


def aligned(table: Table) -> list[str]:
    """Lines of a table; cells of a column begin below each other, unless an earlier one is too wide."""
    rows = table.placed()
    widths: dict[int, int] = {}
    for row in rows:
        for at, text, span in row:
            if span == 1:
                widest = max((len(x) for x in text.split("\n")), default=0)
                if widest <= CELL_WIDTH:
                    widths[at] = max(widths.get(at, 0), widest)

    def width(at: int, stop: int) -> int:
        """Of the columns and the marks between them; as wide as four cells at most, whatever a page asks for."""
        found = sum(widths.get(c, 0) for c in range(at, min(stop, at + 1000))) + 3 * (stop - at - 1)
        return min(found, 4 * CELL_WIDTH)

    lines = []
    for row in rows:
        cells = [(at, text.split("\n"), span) for at, text, span in row]
        for k in range(max((len(c) for _, c, _ in cells), default=0)):
            parts, behind = [], 0
            for at, cell, span in cells:
                if at > behind:  # columns of cells that reach down from above
                    parts.append(" " * width(behind, at))
                parts.append((cell[k] if k < len(cell) else "").ljust(width(at, at + span)))
                behind = at + span
            lines.append(" | ".join(parts).rstrip())
    return lines


def _number(text: str | None, most: int) -> int:
    """A whole number of ASCII digits, 1 for anything else, at most what a browser takes."""
    return min(int(text), most) if text and text.isascii() and text.isdigit() and len(text) < 10 else most if text and text.isascii() and text.isdigit() else 1


class Renderer:
    """A walk over the tree with a stack of outputs: the page, and a cell within a table within it."""

    def __init__(self):
        self.outputs = [Lines()]
        self.tables: list[Table] = []
        self.lists: list[int | None] = []
        self.preformatted = 0

    def render(self, root: Node) -> str:
        todo: list[tuple[bool, Node | str]] = [(True, root)]
        while todo:
            entering, item = todo.pop()
            if isinstance(item, str):
                self._text(item)
            elif not entering:
                self._leave(item)
            elif not item.hidden():
                self._enter(item)
                todo.append((False, item))
                todo.extend((True, c) for c in reversed(item.shown()))
        return self.outputs[0].result()

    def _text(self, text: str) -> None:
        out = self.outputs[-1]
        if not self.preformatted:
            out.text(text)
            return
        for i, line in enumerate(text.split("\n")):
            if i:
                out.forced_break()
            if line.strip():
                out.exact(line)

    def _enter(self, node: Node) -> None:
        name, out = node.name, self.outputs[-1]
        if name == "br":
            out.forced_break()
        elif name == "hr":
            out.line_break(2)
        elif name in BLOCKS:
            out.line_break(2 if name in APART and not self.lists else 1)
        if name == "table":
            self.tables.append(Table())
        elif name == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif name in ("tbody", "thead", "tfoot") and self.tables:
            self.tables[-1].groups.add(len(self.tables[-1].rows))
        elif name in ("td", "th") and self.tables:
            self.outputs.append(Lines())
        elif name in ("ul", "ol", "menu"):
            self.lists.append(int(n) if name == "ol" and (n := node.attributes().get("start", "1")).isdigit() else 1 if name == "ol" else None)
        elif name == "li":
            number = self.lists[-1] if self.lists else None
            marker = "- " if number is None else f"{number}. "
            if number is not None:
                self.lists[-1] = number + 1
            out.indents.append(" " * len(marker))
            out.marker = marker
        elif name in ("dd", "blockquote"):
            out.indents.append("  ")
        elif name == "pre":
            self.preformatted += 1

    def _leave(self, node: Node) -> None:
        name, out = node.name, self.outputs[-1]
        if name in ("td", "th") and self.tables and len(self.outputs) > 1:
            self.outputs.pop()
            found = node.attributes() if node.rest else {}
            rows = self.tables[-1].rows
            if not rows:
                rows.append([])
            rows[-1].append((out.result(), _number(found.get("colspan"), 1000) or 1, _number(found.get("rowspan"), 65534)))
            return
        if name == "table":
            out.line_break(2)
            for line in aligned(self.tables.pop()):
                if line.strip():
                    out.exact(line)
                    out.line_break()
        elif name in ("ul", "ol", "menu") and self.lists:
            self.lists.pop()
        elif name in ("li", "dd", "blockquote"):
            out.indents.pop()
            out.marker = ""
        elif name == "pre":
            self.preformatted -= 1
        elif name == "caption":
            out.line_break()
        if name in BLOCKS:
            out.line_break(2 if name in APART and not self.lists else 1)


def visible_text(page: str | None) -> str:
    """All visible text of a page."""
    return Renderer().render(tree(page)) if page else ""


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``id, text`` of every row."""

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = [visible_text(page) for page in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    source = pages.select(F.col(id_column).alias("id"), F.col(html_column).cast("string").alias("html"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, text string")
