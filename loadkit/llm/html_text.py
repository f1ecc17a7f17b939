"""Visible text of HTML pages, laid out: blocks apart, lists marked, table cells aligned."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, texts

# The element groups of the HTML standard's parsing and rendering sections.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("area audio base canvas datalist embed head iframe link math meta noembed noframes noscript object param rp script select source style svg template textarea title track video".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table ul xmp".split())
SPACED = set("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
CLOSES_P = BLOCK - {"body", "html", "optgroup", "option", "legend"}
#: A start tag ends these open elements, up to one of the second group.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
WALLS = {"td", "th", "table", "caption", "html", "template"}
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
#: Columns are padded to this width at most; longer cells push the rest of their line.
WIDEST = 40
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class TreeBuilder(HTMLParser):
    """A tree of elements: end tags that may be left out are implied by what follows, those that
    match nothing are passed over, and none reaches through the cell or table it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open, self.counts = [self.root], {}

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.counts[node.tag] = self.counts.get(node.tag, 0) + 1

    def _pop_to(self, at: int) -> None:
        for node in self.open[at:]:
            self.counts[node.tag] -= 1
        del self.open[at:]

    def _close(self, tags: set, walls: set) -> None:
        """End the outermost open element of `tags` inside the nearest of `walls`."""
        if not any(self.counts.get(t) for t in tags):
            return
        found = None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                found = at
            elif self.open[at].tag in walls:
                break
        if found is not None:
            self._pop_to(found)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close({"p"}, WALLS | {"button"})
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        elif self.counts.get("head") and (tag in BLOCK or tag in ("a", "span", "b", "i", "br", "img")):
            self._close({"head"}, {"html"})
        if tag in ("td", "th") and self.counts.get("table") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr"))
        node = Node(tag, {k: v or "" for k, v in attrs})
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.open[-1].children.append(Node("br"))
        if not self.counts.get(tag):
            return
        walls = WALLS - {tag} if tag not in ("table", "html", "tr", "tbody", "thead", "tfoot") else {"table", "html"} - {tag}
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._pop_to(at)
                return
            if self.open[at].tag in walls and tag != "body":
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


class Writer:
    """Lines of text. Space runs become one; margins between blocks don't add up."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.space, self.margin = [], False, 0
        self.indent, self.marker = [], None

    def text(self, data: str) -> None:
        parts = _SPACE.split(data)
        for k, part in enumerate(parts):
            if k:
                self.space = bool(self.line)
            if part:
                self._begin()
                if self.space:
                    self.line.append(" ")
                self.space = False
                self.line.append(part)

    def verbatim(self, data: str) -> None:
        for k, part in enumerate(data.expandtabs(8).replace("\r", "").split("\n")):
            if k:
                self._begin()
                self.end_line()
            if part:
                self._begin()
                self.line.append(part)

    def _begin(self) -> None:
        if not self.line:
            if self.lines:
                self.lines += [""] * self.margin
            self.margin = 0
            lead = "".join(self.indent)
            if self.marker is not None:
                lead = lead[: len(lead) - len(self.marker)] + self.marker
                self.marker = None
            self.line.append(lead)

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False

    def block(self, blank: int) -> None:
        self.end_line()
        self.margin = max(self.margin, blank)

    def whole(self, lines: list[str]) -> None:
        for line in lines:
            self._begin()
            self.line.append(line)
            self.end_line()

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs:
        return False
    style = node.attrs.get("style")
    return not (style and _GONE.search(style)) and not (node.tag == "dialog" and "open" not in node.attrs)


def _number(value: str, default: int, most: int) -> int:
    return min(max(int(value), 1), most) if re.fullmatch(r"[0-9]{1,6}", value or "") else default


class Table:
    """Cells by row and column, with spans; laid out in columns of equal width."""

    def __init__(self):
        self.rows: list[dict[int, list[str]]] = []
        self.held: dict[int, int] = {}
        self.column = 0

    def row(self) -> None:
        self.held = {c: n - 1 for c, n in self.held.items() if n > 1}
        self.rows.append({})
        self.column = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.held.get(self.column):
            self.column += 1
        self.rows[-1][self.column] = lines
        if down > 1:
            self.held.update(dict.fromkeys(range(self.column, self.column + across), down))
        self.column += across

    def lines(self) -> list[str]:
        used = sorted({c for row in self.rows for c in row})
        width = {c: min(WIDEST, max((len(x) for row in self.rows for x in row.get(c, [])), default=0)) for c in used}
        out = []
        for row in self.rows:
            for k in range(max(map(len, row.values()), default=0)):
                last = max(c for c, cell in row.items() if k < len(cell))
                cells = [(row[c][k] if c in row and k < len(row[c]) else "").ljust(width[c]) for c in used if c <= last]
                out.append("  ".join(cells).rstrip())
        return out


def render(root: Node) -> str:
    """All visible text below a node, without recursion."""
    writers, tables, lists, pre = [Writer()], [], [], 0
    stack: list = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        out = writers[-1]
        if isinstance(node, str):
            out.verbatim(node) if pre else out.text(node)
            continue
        tag = node.tag
        blank = 1 if tag in SPACED and not (tag in ("ul", "ol") and len(lists) > leaving) else 0
        if not leaving:
            if not visible(node):
                continue
            if tag == "br":
                out._begin()
                out.end_line()
                continue
            if tag == "img" or tag == "input":
                continue
            if tag == "hr":
                out.block(1)
                continue
            if tag in ("td", "th", "caption") and tables:
                writers.append(Writer())
            elif tag == "table":
                out.block(blank)
                tables.append(Table())
                writers.append(Writer())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in BLOCK:
                out.block(blank)
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag, _number(node.attrs.get("start", ""), 1, 10**6)])
                out.indent.append("  " if len(lists) > 1 else "")
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0] == "ol":
                    lists[-1][1] = _number(node.attrs.get("value", ""), lists[-1][1], 10**6)
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.indent.append(" " * len(marker))
                out.marker = marker
            elif tag in ("blockquote", "dd"):
                out.indent.append("  ")
            pre += tag in ("pre", "listing", "xmp", "plaintext")
            stack.append((node, True))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            stack += [(c, False) for c in reversed(children)]
            continue
        pre -= tag in ("pre", "listing", "xmp", "plaintext")
        if tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
            out.block(blank)
            out.indent.pop()
        elif tag == "li":
            out.block(0)
            out.indent.pop()
            out.marker = None
        elif tag in ("blockquote", "dd"):
            out.block(blank)
            out.indent.pop()
        elif tag in ("td", "th") and tables:
            lines = writers.pop().result()
            tables[-1].cell(lines, _number(node.attrs.get("colspan", ""), 1, 1000), _number(node.attrs.get("rowspan", ""), 1, 65_534))
        elif tag == "caption" and tables:
            lines = writers.pop().result()
            writers[-1].whole(lines)
        elif tag == "table":
            loose, table = writers.pop().result(), tables.pop()
            writers[-1].whole(loose + table.lines())
            writers[-1].block(blank)
        elif tag in BLOCK:
            out.block(blank)
    return "\n".join(writers[0].result())


def to_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def extract(pages: DataFrame, keys: list, html: str = "html") -> DataFrame:
    """`keys` and text. Null and empty pages give an empty text; a page is taken whole, whatever
    its length or nesting. Equal rows are returned each; other columns are not read."""
    kept = pages.select(*keys, F.col(html).alias("_html"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def fn(batch):
        return {n: batch.column(n) for n in names} | {"text": pa.array([to_text(h) for h in texts(batch.column("_html"))], pa.string())}

    return by_batch(kept, kept.columns, f"{schema}, text string", fn)
