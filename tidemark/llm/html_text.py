"""Visible text of HTML pages, laid out.

A tree builder with implied tags reads the markup; a renderer walks the tree,
skips what a browser would not show, and writes blocks, list items,
preformatted text and tables with aligned cells as plain text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import text_slices

# ---------------------------------------------------------------------------
# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes datalist "
                   "audio video canvas object applet rp".split())
BLOCK = frozenset("address article aside blockquote body center details dialog dd dir div dl dt "
                  "fieldset figcaption figure footer form header hgroup html legend li "
                  "main menu nav ol optgroup option search section summary table ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 pre ul ol dl table blockquote figure hr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset "
                     "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu "
                     "nav ol p pre search section table ul".split())
# Start tag -> open elements that it ends, and the elements that stop the search.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
TABLE_PARTS = frozenset("caption colgroup col tbody td tfoot th thead tr".split())
# Start tags that leave an open head open; any other, and text, ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# Elements that an end tag of something outside does not reach through.
SCOPE = frozenset("table td th caption button object template html".split())
# ---------------------------------------------------------------------------

#: Cells longer than this do not widen their column; their text stays whole.
WIDEST_CELL = 40

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_MAY_HIDE = re.compile(r"hidden|style", re.I)
_ATTRIBUTE = re.compile(r"([^\s/][^\s/=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"']\S*)?))?")
_ATTR_END = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+>")
_DECLARATION = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)", re.I)
_COMMENT = re.compile(r"/\*.*?\*/", re.S)
#: At-rules with rules inside (media queries and the like) do not apply everywhere, so none of them is used.
_AT_BLOCK = re.compile(r"@[^{};]*\{(?:[^{}]*\{[^{}]*\})*[^{}]*\}")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SIMPLE = re.compile(r"([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)", re.I)
_SPACES = " \t\n\f\r"
_SPACE_RUN = re.compile(f"[{_SPACES}]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(raw: str) -> dict[str, str]:
    """Attributes by lower-case name; of equal names the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def declared(style: str) -> dict[str, str]:
    """``display`` and ``visibility`` of a list of declarations; the last of each counts."""
    return {name.lower(): value.lower() for name, value in _DECLARATION.findall(style)}


class Sheet:
    """The rules of a page's style elements that show or hide: those with simple
    selectors (a tag, classes, an id, or several of these at once)."""

    def __init__(self, texts: list[str]):
        self.rules: list[tuple[int, int, str, frozenset, dict]] = []
        for selectors, body in _RULE.findall(_AT_BLOCK.sub("", _COMMENT.sub("", "\n".join(texts)))):
            says = declared(body)
            for selector in selectors.split(",") if says else ():
                m = _SIMPLE.fullmatch(selector.strip())
                if m and m.group():
                    marks = frozenset(re.findall(r"[.#][\w-]+", m.group(2)))
                    tag = (m.group(1) or "*").lower()
                    weight = sum(100 if x[0] == "#" else 10 for x in marks) + (tag != "*")
                    self.rules.append((weight, len(self.rules), tag, marks, says))
        self.rules.sort(key=lambda r: r[:2])

    def of(self, tag: str, named: dict[str, str]) -> dict[str, str]:
        """What applies to an element: more specific rules win, then later ones, then its own style."""
        if self.rules:
            marks = {"." + c for c in named.get("class", "").split()} | {"#" + named.get("id", "")}
            out: dict[str, str] = {}
            for _, _, of, wanted, says in self.rules:
                if of in ("*", tag) and wanted <= marks:
                    out |= says
            return out | declared(named.get("style", ""))
        return declared(named.get("style", ""))


def shows(node: Node, sheet: Sheet) -> bool | None:
    """False: the element and all in it are not shown; None: what is in it is
    invisible unless it says otherwise; True: visible, said so. Elements that
    say nothing are as visible as what they stand in ("")."""
    if not (sheet.rules or node.tag == "dialog" or (node.attrs and _MAY_HIDE.search(node.attrs))):
        return ""
    named = attributes(node.attrs)
    says = sheet.of(node.tag, named)
    if node.tag == "dialog" and "open" not in named:
        return False
    display = says.get("display")
    if display == "none" or ("hidden" in named and display is None):
        return False
    return {"hidden": None, "collapse": None, "visible": True}.get(says.get("visibility"), "")


def number_of(node: Node, name: str) -> int | None:
    """A whole number in an attribute, if there is one."""
    if name not in node.attrs.lower():
        return None
    m = re.match(r"\s*([+-]?\d{1,9})", attributes(node.attrs).get(name, ""))
    return int(m.group(1)) if m else None


def parse(page: str) -> Node:
    """Element tree of a page; children are nodes and text strings."""
    root = Node("#root", "")
    stack = [root]
    open_: Counter = Counter()  # open elements by tag

    def end_from(i: int) -> None:
        open_.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close(tags, stop) -> None:
        """End the nearest element of ``tags`` and those of them right above
        it (a table row ends a cell and the row around it)."""
        if not any(open_[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while i > 1 and stack[i - 1].tag in tags:
                    i -= 1
                return end_from(i)
            if stack[i].tag in stop:
                return

    at, end = 0, len(page)
    no_comment_end = False
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            text = html.unescape(page[at:lt])
            if stack[-1].tag == "head" and text.strip(" \t\n\f\r"):
                end_from(len(stack) - 1)
            stack[-1].children.append(text)
        if lt >= end:
            break
        nxt = page[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            stop = -1
            if page.startswith("<!--", lt) and not no_comment_end:
                stop = page.find("-->", lt + 4)
                no_comment_end = stop < 0
                at = stop + 3 if stop >= 0 else end
            else:
                stop = page.find(">", lt)
                at = stop + 1 if stop >= 0 else end
            continue
        if nxt == "/":
            m = _NAME.match(page, lt + 2)
            stop = page.find(">", lt)
            at = stop + 1 if stop >= 0 else end
            if m:
                tag = m.group().lower()
                if tag == "br":
                    if stack[-1].tag == "head":
                        end_from(len(stack) - 1)
                    stack[-1].children.append(Node("br", ""))
                elif tag == "p" and not open_["p"]:
                    stack[-1].children.append(Node("p", ""))
                elif open_[tag]:
                    stop_at = frozenset() if tag in SCOPE else SCOPE - {"html"}
                    if tag in ("tr", "tbody", "thead", "tfoot", "table"):
                        stop_at = frozenset({"table"}) - {tag}
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == tag:
                            end_from(i)
                            break
                        if stack[i].tag in stop_at:
                            break
            continue
        m = _NAME.match(page, lt + 1)
        if not m:
            if stack[-1].tag == "head":
                end_from(len(stack) - 1)
            stack[-1].children.append("<")
            at = lt + 1
            continue
        tag = m.group().lower()
        gt = page.find(">", m.end())
        if gt < 0:
            gt = end
        elif page.find('"', m.end(), gt) >= 0 or page.find("'", m.end(), gt) >= 0:
            full = _ATTR_END.match(page, m.end())
            if full:
                gt = full.end() - 1
        attrs = page[m.end():gt]
        at = gt + 1
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            if tag in ("html", "head"):
                continue
            end_from(len(stack) - 1)
        if tag in TABLE_PARTS and not open_["table"]:
            continue
        if tag in CLOSES_P and open_["p"]:
            close({"p"}, SCOPE)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            body = page[at:stop.start() if stop else end]
            if tag in ("textarea", "title"):
                body = html.unescape(body)
            node.children.append(body)
            at = stop.start() if stop else end
            if stop:
                gt = page.find(">", at)
                at = gt + 1 if gt >= 0 else end
            continue
        if not attrs.endswith("/") or tag not in ("svg", "path", "circle", "rect"):
            stack.append(node)
            open_[tag] += 1
    return root


class Flow:
    """Lines of one flow of blocks, with collapsed white space."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0  # blank lines due before the next text
        self.indent: list[str] = []
        self.marker = ""

    def text(self, s: str) -> None:
        words = _SPACE_RUN.sub(" ", s).strip(" ")  # a no-break space is no white space here
        if not words:
            self.space = self.space or bool(s and self.parts)
            return
        if self.parts and (self.space or s[0] in _SPACES):
            self.parts.append(" ")
        self.parts.append(words)
        self.space = s[-1] in _SPACES

    def raw(self, s: str) -> None:
        head, *rest = s.split("\n")
        self.parts.append(head)
        for line in rest:
            blank = self.gap if not "".join(self.parts).strip() and self.lines else 0
            self.end_line(keep=True)
            self.gap = max(self.gap, blank + 1) if blank else self.gap
            self.parts.append(line)

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.parts)
        line = line.rstrip(_SPACES) if keep else line.strip(_SPACES)
        if line.strip():
            self.put(line)
        elif keep and self.lines:
            self.gap = max(self.gap, 1)
        self.parts, self.space = [], False

    def put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        pad = "".join(self.indent)
        if self.marker:
            pad = pad[:len(pad) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append(pad + line)

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced:
            self.gap = max(self.gap, 1)

    def done(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


def _table_lines(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Rows of (text, columns, rows) cells as lines with aligned columns; a
    place that a cell from above reaches into stays empty."""
    widths: dict[int, int] = {}
    placed, below = [], {}  # below: rows that a column is still taken for
    for row in rows:
        cells, at, taken = [], 0, dict(below)
        for text, span, deep in row:
            while taken.get(at, 0):
                at += 1
            cells.append((at, text, span))
            if span == 1 and len(text) <= WIDEST_CELL:
                widths[at] = max(widths.get(at, 0), len(text))
            for c in range(at, at + span):
                below[c] = max(below.get(c, 0), deep)
            at += span
        below = {c: n - 1 for c, n in below.items() if n > 1}
        placed.append(cells)
    lines = []
    for cells in placed:
        out, at = [], 0
        for start, text, span in cells:
            out += [" " * widths.get(c, 0) for c in range(at, start)]
            out.append(text.ljust(sum(widths.get(c, 0) + 2 for c in range(start, start + span)) - 2))
            at = start + span
        lines.append("  ".join(out).rstrip())
    return [x for x in lines if x]


def _style_texts(root: Node) -> list[str]:
    texts, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag == "style":
            texts += [c for c in x.children if isinstance(c, str)]
        todo.extend(c for c in reversed(x.children) if not isinstance(c, str))
    return texts


def render(root: Node) -> str:
    """Visible text of a tree; walks with its own stack, at any depth."""
    flows = [Flow()]
    lists: list[list] = []  # [kind, next number]
    tables: list[list[list[tuple[str, int, int]]]] = []
    sheet = Sheet(_style_texts(root))
    visible = True
    pre = 0
    todo: list = [root]
    while todo:
        x = todo.pop()
        flow = flows[-1]
        if isinstance(x, str):
            if not visible:
                continue
            if pre and len(flows) == 1:
                flow.raw(x)
            else:
                flow.text(x)
            continue
        if isinstance(x, tuple):  # the end of an element
            tag, node = x
            if tag == "#visible":
                visible = node
            elif tag in ("td", "th"):
                text = _SPACE_RUN.sub(" ", flows.pop().done()).strip(" ")
                span, deep = (min(1000, max(1, number_of(node, n) or 1)) for n in ("colspan", "rowspan"))
                tables[-1][-1].append((text, span, deep))
            elif tag == "table":
                flow.end_line()  # text straight in the table stands before it
                for line in _table_lines(tables.pop()):
                    flow.put(line)
                flow.gap = 1
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.block(not lists)
            elif tag == "li":
                flow.end_line()
                flow.indent.pop()
                flow.marker = ""
            elif tag == "pre":
                pre -= 1
                flow.end_line(keep=True)
                flow.gap = 1
            elif tag == "dd" or tag == "blockquote":
                flow.block(tag == "blockquote")
                flow.indent.pop()
            elif tag != "tr":
                flow.block(tag in SPACED)
            continue
        tag = x.tag
        if tag in HIDDEN:
            continue
        shown = shows(x, sheet)
        if shown is False:
            continue
        if shown != "" and bool(shown) != visible:
            todo.append(("#visible", visible))
            visible = bool(shown)
        if tag == "br":
            flow.end_line(keep=True)
            continue
        if tag == "hr":
            flow.block(True)
            continue
        if tag in ("td", "th"):
            if not tables[-1]:
                tables[-1].append([])
            flows.append(Flow())
            todo.append((tag, x))
        elif tag == "tr":
            tables[-1].append([])
        elif tag == "table":
            flow.block(True)
            tables.append([])
            todo.append((tag, x))
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.block(not lists)
            first = number_of(x, "start") if tag == "ol" else None
            lists.append([tag, 1 if first is None else first])
            todo.append((tag, x))
        elif tag == "li":
            flow.end_line()
            marker = "- "
            if lists and lists[-1][0] == "ol":
                value = number_of(x, "value")
                lists[-1][1] = lists[-1][1] if value is None else value
                marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            flow.indent.append(" " * len(marker))
            flow.marker = marker
            todo.append((tag, x))
        elif tag == "pre":
            flow.block(True)
            pre += 1
            todo.append((tag, x))
        elif tag == "dd" or tag == "blockquote":
            flow.block(tag == "blockquote")
            flow.indent.append("  ")
            todo.append((tag, x))
        elif tag in BLOCK or tag in SPACED or tag == "caption":
            flow.block(tag in SPACED)
            todo.append((tag, x))
        children = x.children
        if tag == "details" and "open" not in attributes(x.attrs):  # closed: its summary shows
            children = [c for c in children if not isinstance(c, str) and c.tag == "summary"][:1]
        todo.extend(reversed(children))
    return flows[0].done().replace("\xa0", " ")


def visible_text(page: str) -> str:
    return render(parse(page))


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``page_id, text``: the visible text of every page, whole.

    Null pages give null, empty pages an empty text, repeated rows a row each,
    and an empty table no rows. Unclosed or stray tags never fail: the tree
    builder ends or ignores them. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                texts = [None if h is None else visible_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array(texts, pa.string())], ["page_id", "text"])

    src = pages.selectExpr("page_id", f"`{html_column}` as html")
    id_type = src.schema["page_id"].dataType.simpleString()
    return src.mapInArrow(run, f"page_id {id_type}, text string")
