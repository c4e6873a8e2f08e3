"""Operator 4: layout-aware text of web pages.

The markup is read into a tree, with the end tags that HTML lets one leave out. The tree is then walked
once, without recursion, and laid out like a page: blocks on lines of their own, paragraphs and headings
apart by an empty line, list items with their markers and indents, tables with aligned columns. Whatever a
reader of the page would see is emitted, labels of SVG and formulas of MathML too; scripts, styles, hidden elements and closed details are not.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.llm.common import packed, small_batches, text_or_empty, unpacked

# Elements by how HTML treats them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NEVER_SHOWN = set(
    "head title script style template noscript iframe object video audio canvas datalist rp param "
    "noembed noframes select".split()
)
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table ul".split()
)
APART = set("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
CLOSES_P = BLOCKS - {"body", "html", "legend", "optgroup", "option"}
BARRIERS = set("html table td th caption template".split())
# An open element of the right side ends when the tag at the left starts, up to an element of the last set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
    "body": ({"head"}, {"html"}),
}
# Foreign content: parts that are not drawn, elements that hold HTML or text, HTML start tags that end it.
NOT_DRAWN = {
    "svg": set("defs metadata title desc symbol clippath mask pattern marker style script filter".split()),
    "math": set("annotation annotation-xml mphantom".split()),
}
HOLDS_HTML = {"svg": {"foreignobject", "desc", "title"}, "math": {"mi", "mo", "mn", "ms", "mtext", "annotation-xml"}}
BREAKS_OUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FORMATTING = set("a b big code em font i nobr s small strike strong tt u".split())
HEAD_ONLY = set("base link meta noscript script style template title head html".split())
SPACES = re.compile(r"[ \t\n\r\f]+")
DECLARED = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)")


class Node:
    """``kind`` is svg or math for their elements, else empty; ``within`` is the kind of its children."""

    __slots__ = ("tag", "attrs", "children", "kind", "within")

    def __init__(self, tag: str, attrs: dict[str, str], kind: str = ""):
        self.tag, self.attrs, self.children, self.kind = tag, attrs, [], kind
        self.within = "" if kind and tag in HOLDS_HTML[kind] else kind


class TreeBuilder(HTMLParser):
    """``root`` holds nodes and strings; unclosed and crossing tags end where a browser would end them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        if self.open[-1].within and self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                self.handle_data(self.rawdata[i + 9:end])
                return end + 3
        end = self.rawdata.find(">", i)
        return -1 if end < 0 else end + 1

    def _close_to(self, tags: set[str], barriers: set[str]) -> None:
        """End the outermost open element of ``tags`` that no barrier hides, and all within it."""
        found = None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                found = at
            elif self.open[at].tag in barriers or self.open[at].kind and not self.open[at].within:
                break
        if found is not None:
            del self.open[found:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        named = {k: v or "" for k, v in reversed(attrs)}
        if self._foreign(tag, named, False):
            return
        if tag == "html" or (tag == "body" and any(n.tag == "body" for n in self.open)):
            target = self.root if tag == "html" else next(n for n in self.open if n.tag == "body")
            target.attrs = {**named, **target.attrs}
            return
        if tag not in HEAD_ONLY and self.open[-1].tag == "head":
            self._close_to({"head"}, {"html"})
        if tag in CLOSES_P:
            self._close_to({"p"}, BARRIERS)
        if tag in IMPLIED:
            ended, barriers = IMPLIED[tag]
            self._close_to(ended, barriers)
        if tag[0] == "h" and tag[1:] in ("1", "2", "3", "4", "5", "6") and self.open[-1].tag in APART and self.open[-1].tag[0] == "h":
            self.open.pop()
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        node = Node(tag, named)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if not self._foreign(tag, {k: v or "" for k, v in reversed(attrs)}, True):
            self.handle_starttag(tag, attrs)  # a slash means nothing in HTML

    def _break_out(self) -> None:
        while self.open[-1].within:
            self.open.pop()

    def _foreign(self, tag: str, attrs: dict[str, str], ended: bool) -> bool:
        """Add an element of svg or math, open unless ``ended``; False for one of HTML, which ends them if a block."""
        kind = self.open[-1].within
        if kind and (tag in BREAKS_OUT or (tag == "font" and attrs.keys() & {"color", "face", "size"})):
            self._break_out()
            return False
        if not kind and tag not in NOT_DRAWN:
            return False
        if not kind and self.open[-1].tag == "head":
            self._close_to({"head"}, {"html"})
        node = Node(tag, attrs, kind or tag)
        self.open[-1].children.append(node)
        if not ended:
            self.open.append(node)
        return True

    def _push(self, tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("br", "p"):
            self._break_out()
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
            return
        if tag in ("html", "body"):
            return
        crossed = False  # a block within the element, which an inline end tag does not end
        for at in range(len(self.open) - 1, 0, -1):
            inner, kind = self.open[at].tag, self.open[at].kind
            if inner == tag:
                if not crossed or kind or tag in BLOCKS | BARRIERS | NEVER_SHOWN:
                    del self.open[at:]
                elif tag in FORMATTING:
                    del self.open[at]
                return
            if kind:
                if not self.open[at].within and not any(n.kind and n.tag == tag for n in self.open[1:at]):
                    break  # HTML around foreign content is not ended from within its parts
                continue
            if inner in BARRIERS and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                break
            crossed = crossed or inner in BLOCKS - {"option", "optgroup"}
        if tag == "p":
            self.open[-1].children.append(Node("p", {}))

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self._close_to({"head"}, {"html"})
        self.open[-1].children.append(data)


def display_width(line: str) -> int:
    if line.isascii():
        return len(line)
    wide = sum(unicodedata.east_asian_width(c) in "WF" for c in line)
    return len(line) + wide - sum(unicodedata.combining(c) != 0 for c in line)


class Flow:
    """Lines of one box. ``apart(n)`` asks for n line ends before the next content; the most asked for counts."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.asked = 0
        self.spaced = True  # nothing or a space stands before the next character

    def apart(self, n: int) -> None:
        self.asked = max(self.asked, n)

    def _begin(self) -> None:
        if self.asked:
            if self.line:
                self.end_line()
            if self.lines:
                self.lines.extend([""] * (self.asked - 1))
            self.asked = 0

    def end_line(self) -> None:
        self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.spaced = [], True

    def text(self, data: str, kept: bool) -> None:
        if kept:
            if data:
                self._begin()
                first, *others = data.split("\n")
                self.line.append(first)
                for other in others:
                    self.end_line()
                    self.line.append(other)
                self.spaced = False
            return
        data = SPACES.sub(" ", data)
        if self.spaced or self.asked:
            data = data.lstrip(" ")
        if data:
            self._begin()
            self.line.append(data)
            self.spaced = data[-1] == " "

    def line_break(self) -> None:
        self._begin()
        self.end_line()

    def block(self, lines: list[str]) -> None:
        if lines:
            self.apart(1)
            self._begin()
            self.lines.extend(lines)
            self.apart(1)

    def finished(self) -> list[str]:
        if self.line:
            self.end_line()
        lines = self.lines
        first = next((i for i, x in enumerate(lines) if x), len(lines))
        last = next((i for i in range(len(lines) - 1, -1, -1) if lines[i]), -1)
        return lines[first:last + 1]


class Table:
    """Rows of cells; ``lines()`` pads every cell to the width of its column."""

    def __init__(self) -> None:
        self.caption: list[str] = []
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def lines(self) -> list[str]:
        grid: list[dict[int, tuple[list[str], int]]] = []
        held: dict[int, int] = {}  # column: rows that a cell above still covers
        for row in self.rows:
            placed, column = {}, 0
            covered = {c for c, n in held.items() if n > 0}
            held = {c: n - 1 for c, n in held.items() if n > 1}
            for lines, across, down in row:
                while column in covered:
                    column += 1
                placed[column] = (lines, across)
                if down > 1:
                    held.update({c: down - 1 for c in range(column, column + across)})
                column += across
            grid.append(placed)
        widths: dict[int, int] = {}
        for placed in grid:
            for column, (lines, across) in placed.items():
                if across == 1:
                    widths[column] = max(widths.get(column, 0), *map(display_width, lines or [""]), 0)
        out = list(self.caption)
        for placed in grid:
            height = max((len(lines) for lines, _ in placed.values()), default=0)
            for i in range(height):
                line, at, target = [], 0, 0
                column = 0
                for column_at, (lines, across) in sorted(placed.items()):
                    while column < column_at:
                        target += widths.get(column, 0) + 2
                        column += 1
                    cell = lines[i] if i < len(lines) else ""
                    if cell:
                        line.append(" " * max(target - at, 2 if at else 0))
                        at = max(target, at + 2 if at else 0) + display_width(cell)
                        line.append(cell)
                out.append("".join(line).rstrip(" "))
        return out


def _whole(value: str | None, least: int, most: int, default: int) -> int:
    found = re.match(r"\s*(-?\d{1,9})", value or "")
    return min(most, max(least, int(found[1]))) if found else default


def rendered(html: str) -> str:
    """The visible text of a page; an empty page gives an empty text. Markup of any depth is read."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    page = Flow()
    # What is still to do: (node or string, flow, state) on entry, or a function on exit.
    todo: list = [(builder.root, page, {"kept": False, "shown": True, "table": None, "list": None, "kind": ""})]
    while todo:
        step = todo.pop()
        if callable(step):
            step()
            continue
        node, flow, state = step
        if isinstance(node, str):
            if state["kind"] == "svg" or (state["kind"] == "math" and not node.strip()):
                continue  # only the text elements of svg are drawn
            if state["shown"] and (state["table"] is None or node.strip()):
                flow.text(node, state["kept"])  # text between the parts of a table stands before it
            continue
        tag, attrs = node.tag, node.attrs
        if tag in NEVER_SHOWN or "hidden" in attrs or (tag == "dialog" and "open" not in attrs):
            if tag == "select":
                _choice(node, flow, state)
            continue
        style = dict(DECLARED.findall(attrs["style"].lower())) if "style" in attrs else {}
        if style.get("display") == "none":
            continue
        if style.get("visibility"):
            state = {**state, "shown": style["visibility"] not in ("hidden", "collapse")}
        children = node.children
        if node.kind:
            if tag in NOT_DRAWN[node.kind] or (node.kind == "svg" and attrs.get("display") == "none"):
                continue
            if node.kind == "svg" and attrs.get("visibility") and not style.get("visibility"):
                state = {**state, "shown": attrs["visibility"] not in ("hidden", "collapse")}
            if tag in ("text", "foreignobject") or (tag == "math" and attrs.get("display") == "block"):
                flow.apart(1)
                todo.append(lambda flow=flow: flow.apart(1))
            if tag in ("svg", "math"):
                state = {**state, "table": None, "list": None, "kind": tag}
            elif tag == "text" or not node.within:
                state = {**state, "kind": ""}
            if tag in ("mfrac", "mtr", "mtable"):  # parts that stand apart
                children = [part for c in children if isinstance(c, Node) for part in (c, Node("mtext", {}, "math"))]
                for part in children[1:-1:2]:
                    part.children.append(" ")
            todo.extend((child, flow, state) for child in reversed(children))
            continue
        if tag == "br":
            if state["shown"]:
                flow.line_break()
            continue
        if tag in ("input", "textarea"):
            _field(node, flow, state)
            continue
        if tag == "table":
            table = Table()
            flow.apart(2)

            def end_table(flow=flow, table=table):
                flow.apart(2)
                flow.block(table.lines())
                flow.apart(2)

            todo.append(end_table)
            state = {**state, "table": table, "list": None, "kept": False}
        elif state["table"] is not None:
            table = state["table"]
            if tag == "tr":
                table.rows.append([])
            elif tag in ("td", "th", "caption"):
                inner = Flow()
                todo.append(_cell_end(table, tag, attrs, inner))
                flow, state = inner, {**state, "table": None}
            elif tag not in ("thead", "tbody", "tfoot", "colgroup", "col"):
                # Not a part of a table: shown before it, as a browser does.
                state = {**state, "table": None}
                flow.apart(1)
        elif tag in ("ul", "ol", "menu", "dir"):
            depth = 1 if state["list"] else 2
            flow.apart(depth)
            todo.append(lambda flow=flow, depth=depth: flow.apart(depth))
            counter = _whole(attrs.get("start"), -10**9, 10**9, 1)
            if "reversed" in attrs and "start" not in attrs:
                counter = sum(isinstance(c, Node) and c.tag == "li" for c in children)
            state = {**state, "list": [tag, counter, -1 if "reversed" in attrs else 1]}
        elif tag == "li":
            inner = Flow()
            todo.append(_item_end(state["list"], attrs, flow, inner))
            flow = inner
        elif tag in ("blockquote", "dd"):
            inner, n = Flow(), 2 if tag == "blockquote" else 1
            flow.apart(n)

            def end_indented(flow=flow, inner=inner, n=n):
                flow.block(["  " + x if x else x for x in inner.finished()])
                flow.apart(n)

            todo.append(end_indented)
            flow, state = inner, {**state, "list": None}
        elif tag in BLOCKS:
            n = 2 if tag in APART else 1
            flow.apart(n)
            todo.append(lambda flow=flow, n=n: flow.apart(n))
            if tag == "pre":
                state = {**state, "kept": True}
                if children and isinstance(children[0], str) and children[0].startswith("\n"):
                    children = [children[0][1:], *children[1:]]
            elif tag == "details" and "open" not in attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        todo.extend((child, flow, state) for child in reversed(children))
    return "\n".join(page.finished())


def _cell_end(table: Table, tag: str, attrs: dict[str, str], inner: Flow):
    def end() -> None:
        if tag == "caption":
            table.caption = inner.finished()
        else:
            if not table.rows:
                table.rows.append([])
            across, down = _whole(attrs.get("colspan"), 1, 1000, 1), _whole(attrs.get("rowspan"), 1, 65534, 1)
            table.rows[-1].append((inner.finished(), across, down))
    return end


def _item_end(counted: list | None, attrs: dict[str, str], flow: Flow, inner: Flow):
    mark = "- "
    if counted and counted[0] == "ol":
        number = _whole(attrs.get("value"), -10**9, 10**9, counted[1])
        counted[1] = number + counted[2]
        mark = f"{number}. "

    def end() -> None:
        lines = inner.finished() or [""]
        indent = " " * len(mark)
        flow.block([(mark + lines[0]).rstrip(" "), *[indent + x if x else x for x in lines[1:]]])
    return end


def _strings(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            todo.extend(reversed(part.children))
    return "".join(out)


def _choice(node: Node, flow: Flow, state: dict) -> None:
    """A select shows its chosen option, by default the first."""
    options, todo = [], [node]
    while todo:
        part = todo.pop()
        if isinstance(part, Node):
            if part.tag == "option":
                options.append(part)
            todo.extend(reversed(part.children))
    chosen = next((o for o in options if "selected" in o.attrs), options[0] if options else None)
    if chosen is not None and state["shown"] and "hidden" not in node.attrs:
        flow.text(_strings(chosen).strip(), False)


def _field(node: Node, flow: Flow, state: dict) -> None:
    """Fields show what they hold."""
    if state["shown"]:
        if node.tag == "textarea":
            flow.text(_strings(node), True)
        elif node.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "url", "tel", "email", "number"):
            flow.text(node.attrs.get("value", ""), False)


def with_layout_text(df: DataFrame, html: str, into: str = "text") -> DataFrame:
    """``df`` with the visible text of ``html`` in ``into``; a null page gives an empty text.

    Other columns, nulls and repeated rows pass through; an empty table gives no rows.
    """
    small_batches(df)

    @F.pandas_udf("string")
    def render(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for page in pages:
            yield page.map(rendered)

    out = packed(df, html=text_or_empty(html)).select("row", render("html").alias(into))
    return unpacked(out, [into], df.columns)
