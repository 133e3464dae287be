"""All visible text of HTML pages, laid out as it would be read.

A tree builder closes and opens tags that HTML implies; rendering follows
visibility rules, keeps blocks apart (a blank line where a browser has a
margin), marks list items, keeps preformatted text, and aligns table cells.

Formulas (MathML) are put out as their tokens in order, a space apart; of
drawings (SVG) the texts, a space apart, and the HTML in foreignObject. Text of a
drawing that shows only where <use> refers to it is left out.

Hidden are elements with display none, and text whose nearest element that sets a
visibility sets hidden or collapse. Both are read from the element's style and
from rules in <style> of the forms tag, .class, #id, tag.class and tag#id (more
telling selectors win, then later ones, then the element's own style; other
selectors, rules inside at-rules, !important and linked sheets are not read).

Cells stand in the columns that colspan and rowspan give them, each column as
far right as the longest cell before it asks for. Where that would make a table
more than PADDING times as long as its text, the longest lines do not count.
Buttons made by <input> show their value.

A quote opens an attribute's value only right after its "="; where it is never
closed it is an ordinary character, so that the rest of the page stays.
"""

from __future__ import annotations

import html
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from bancalyt.llm.common import blocks, workers_find_package

# fixed values: names of HTML elements by what they imply or how they are shown
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is text up to their end tag; the first two are never shown
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes datalist object audio video canvas".split())
IN_HEAD = frozenset("head base link meta noscript script style template title".split())
#: blocks with a margin, and those that only begin a new line
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table pre blockquote figure fieldset hr xmp".split())
BLOCK = SPACED | frozenset("html body div section article aside header footer nav main address form details summary dialog "
                           "figcaption legend li dt dd tr td th thead tbody tfoot caption center optgroup option search hgroup".split())
ENDS_P = (BLOCK - frozenset("li dt dd tr td th thead tbody tfoot caption option optgroup html body legend".split())) | frozenset(["li", "dt", "dd"])
#: tag -> (open tags that it ends, tags beyond which they are not looked for)
_ROWS = frozenset("tr td th".split())
_SECTIONS = frozenset("thead tbody tfoot caption colgroup".split())
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset("select datalist".split())), "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "tr": (_ROWS | frozenset(["caption", "colgroup"]), frozenset(["table"])), "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    **{t: (_ROWS | _SECTIONS, frozenset(["table"])) for t in ("thead", "tbody", "tfoot", "caption", "colgroup")},
}
#: parts of a drawing that are not drawn where they stand, and of a formula
UNDRAWN = frozenset("defs symbol clippath mask marker pattern lineargradient radialgradient filter desc metadata".split())
UNSET = frozenset("annotation annotation-xml mphantom".split())
FORMULA_TOKENS = frozenset("mi mo mn ms mtext".split())
#: elements of which only the first child shows
FIRST_ONLY = frozenset("switch semantics maction".split())
#: elements of formulas and drawings that hold HTML, and tags of HTML that end a formula or drawing elsewhere
HOLDS_HTML = FORMULA_TOKENS | frozenset("foreignobject desc annotation-xml".split())
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
                       "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: an end tag or an implied end does not reach beyond these
SCOPE = frozenset("table td th caption html button object template".split())
#: elements nested deeper become siblings, as browsers do
DEPTH = 200
#: length of an aligned table, as a multiple of its text, and what every table may have
PADDING, PADDING_LEAST = 16, 1 << 14
#: fixed limits of HTML tables
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
_VALUE = r"[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"{0}[^\"]*+{1}\"|'{0}[^']*+{1}'|{0}[^ \t\n\r\f>]++{1})?+"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^ \t\n\r\f/>]*)"
                    r"((?:[ \t\n\r\f/]++|" + _NAME + "(?:" + _VALUE.format("", "") + r")?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(f"({_NAME})(?:" + _VALUE.format("(", ")") + ")?+")
_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*([a-z-]+)", re.I)
_VISIBILITY = re.compile(r"(?:^|[;\s])visibility\s*:\s*([a-z-]+)", re.I)
_SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?(?:([.#])([\w-]+))?\Z")
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def visible(self, inherited: bool) -> bool:
        """Whether text right inside shows, as far as visibility goes."""
        found = _VISIBILITY.findall(self.attributes["style"]) if "style" in self.attributes else ()
        return found[-1].lower() not in ("hidden", "collapse") if found and found[-1].lower() != "inherit" else inherited

    def hidden(self, inherited: bool = True) -> bool:
        """Whether nothing of the element shows."""
        if self.tag in HIDDEN:
            return True
        a = self.attributes
        if a:
            if "hidden" in a or self.tag == "input" and a.get("type", "").lower() == "hidden":
                return True
            if "style" in a and (found := _DISPLAY.findall(a["style"])) and found[-1].lower() == "none":
                return True
        return not self.visible(inherited) and not self._shows_inside()

    def _shows_inside(self) -> bool:
        """Whether an element inside sets its visibility anew."""
        todo = [self]
        while todo:
            for child in todo.pop().children:
                if isinstance(child, Node) and child.tag not in HIDDEN:
                    if child.visible(False):
                        return True
                    todo.append(child)
        return False


def _rules(sheet: str) -> list[tuple]:
    """(telling, tag, kind, name, declarations) of the rules on display and visibility."""
    out, depth, begin, head = [], 0, 0, ""
    sheet = _CSS_COMMENT.sub(" ", sheet)
    for match in re.finditer(r"[{}]", sheet):
        text, begin = sheet[begin:match.start()], match.end()
        if match[0] == "{":
            if not depth:
                head = text.rpartition(";")[2].strip()
            depth += 1
            continue
        if depth == 1 and not head.startswith("@"):
            kept = ";".join(m[0].strip("; \t\r\n\f") for p in (_DISPLAY, _VISIBILITY) for m in p.finditer(text))
            for selector in head.split(",") if kept else ():
                one = _SELECTOR.match(selector.strip())
                if one and one[0]:
                    tag = (one[1] or "*").lower()
                    out.append((("", ".", "#").index(one[2] or ""), tag != "*", tag, one[2], one[3], kept))
        depth = max(depth - 1, 0)
    return sorted(out, key=lambda r: r[:2])


def _apply(root: Node, sheet: str) -> None:
    """Put the declarations of matching rules before each element's own style."""
    rules = _rules(sheet)
    if not rules:
        return
    by_name: dict[tuple, list[int]] = {}
    for i, (_, _, tag, kind, name, _) in enumerate(rules):
        by_name.setdefault((kind, name) if kind else tag, []).append(i)
    todo = [root]
    while todo:
        node = todo.pop()
        todo += [c for c in node.children if isinstance(c, Node)]
        a = node.attributes
        names = {node.tag, "*", ("#", a.get("id")), *((".", c) for c in a.get("class", "").split())}
        found = sorted({i for n in names for i in by_name.get(n, ()) if rules[i][2] in ("*", node.tag)})
        if found:
            node.attributes = {**a, "style": ";".join([*(rules[i][-1] for i in found), a.get("style", "")])}


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(text)))}


def _closes_itself(text: str) -> bool:
    """Whether a tag's attributes end with a slash that is not part of a value."""
    return text.endswith("/") and max((m.end() for m in _ATTRIBUTE.finditer(text)), default=0) < len(text)


def parse(page: str) -> Node:
    """The tree of a page."""
    root = Node("html", {})
    stack = [root]
    sheets: list[str] = []

    def end(tags, beyond) -> None:
        """Close the innermost open one of ``tags``, unless one of ``beyond`` is in between."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in beyond:
                return

    def add_text(text: str) -> None:
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                stack.pop()
            stack[-1].children.append(html.unescape(text) if "&" in text else text)

    def inside() -> int:
        """The place in the stack of the innermost formula or drawing whose own content is open, or 0."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ("svg", "math"):
                return i
            if stack[i].tag in HOLDS_HTML:
                return 0
        return 0

    place, foreign = 0, False  # no formula or drawing was met so far
    while match := _TOKEN.search(page, place):
        add_text(page[place:match.start()])
        place = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            if foreign and page.startswith("<![CDATA[", match.start()) and inside():
                close = page.find("]]>", match.start())
                close = len(page) if close < 0 else close
                stack[-1].children.append(page[match.start() + 9:close])
                place = min(close + 3, len(page))
            continue
        if match[1]:
            if tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p", {}))
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif tag not in ("html", "body"):
                end({tag}, SCOPE - {tag})
            continue
        if tag == "html":
            root.attributes = _attributes(match[3]) or root.attributes
            continue
        if foreign and tag in BREAKS_OUT:
            while at := inside():
                del stack[at:]
        own = foreign and inside() > 0
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in ENDS_P:
            end({"p"}, SCOPE)
        if tag in IMPLIED:
            closed, beyond = IMPLIED[tag]
            while any(n.tag in closed for n in stack[1:]):
                size = len(stack)
                end(closed, beyond)
                if len(stack) == size:
                    break
            if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                row = Node("tr", {})
                stack[-1].children.append(row)
                stack.append(row)
        node = Node(tag, _attributes(match[3].rstrip("/")))
        stack[-1].children.append(node)
        foreign = foreign or tag in ("svg", "math")
        if (own or tag in ("svg", "math")) and _closes_itself(match[3]):
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>|\\Z", re.I).search(page, place)
            if tag == "style" and not own:
                sheets.append(page[place:close.start()])
            if tag not in HIDDEN:
                node.children.append(page[place:close.start()])
            place = close.end()
        elif tag not in VOID and len(stack) < DEPTH:
            stack.append(node)
    add_text(page[place:])
    _apply(root, "\n".join(sheets))
    return root


class Page:
    """Lines put out so far, and the line being filled."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.margin: list[str] = []
        self.marker = ""
        self.gap = False
        self.at_space = True
        self.visible = True

    def text(self, text: str) -> None:
        if not self.visible:
            return
        text = _SPACES.sub(" ", text)
        if self.at_space:
            text = text.lstrip(" ")
        if text:
            self.parts.append(text)
            self.at_space = text[-1] == " "

    def apart(self) -> None:
        """What follows is a word of its own."""
        if self.parts and self.parts[-1][-1:] not in ("", " "):
            self.parts.append(" ")
        self.at_space = True

    def line(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        margin = "".join(self.margin)
        if self.marker:
            margin = margin[:len(margin) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((margin + text).rstrip())

    def end_line(self, forced: bool = False) -> None:
        text = "".join(self.parts).strip(" ")
        self.parts, self.at_space = [], True
        if text or forced:
            self.line(text)

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced


def _children(node: Node, page: Page, pre: bool) -> None:
    outer, page.visible = page.visible, node.visible(page.visible)
    for child in node.children:
        if isinstance(child, Node):
            _render(child, page, pre)
        elif pre and page.visible:
            first, *rest = child.split("\n")
            page.parts.append(first)
            for line in rest:
                page.line("".join(page.parts))
                page.parts = [line]
        else:
            page.text(child)
    page.visible = outer


def _render(node: Node, page: Page, pre: bool = False) -> None:
    tag = node.tag
    if node.hidden(page.visible):
        return
    if tag == "br":
        page.end_line(forced=page.visible)
    elif tag == "input":
        if node.attributes.get("type", "").lower() in ("submit", "reset", "button") and (value := node.attributes.get("value", "")).strip():
            page.apart()
            page.text(value)
            page.apart()
    elif tag == "svg":
        _drawing(node, page)
    elif tag == "math":
        block = node.attributes.get("display", "").lower() == "block"
        if block:
            page.block(False)
        elif pre:
            page.at_space = False
        _formula(node, page, False)
        if block:
            page.block(False)
    elif tag == "table":
        page.block(True)
        _table(node, page)
        page.block(True)
    elif tag in ("ul", "ol", "menu"):
        nested = bool(page.margin)
        page.block(not nested)
        outer, page.visible = page.visible, node.visible(page.visible)
        number = int(start) if tag == "ol" and (start := node.attributes.get("start", "1")).lstrip("-").isdigit() else 1
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li" and not child.hidden(page.visible):
                page.block(False)
                marker = f"{number}. " if tag == "ol" else "- "
                number += 1
                page.margin.append(" " * len(marker))
                page.marker = marker if child.visible(page.visible) else ""
                _children(child, page, pre)
                page.end_line(forced=bool(page.marker))
                page.margin.pop()
            elif isinstance(child, Node):
                _render(child, page, pre)
            elif not child.isspace():
                page.text(child)
        page.visible = outer
        page.block(not nested)
    elif tag in BLOCK:
        spaced = tag in SPACED and not (page.marker and not page.parts)
        page.block(spaced)
        indent = tag in ("blockquote", "dd")
        if indent:
            page.margin.append("  ")
        if tag == "hr":
            page.line("---")
        own = pre or tag in ("pre", "xmp", "textarea")
        _children(node, page, own)
        if own and not pre and "".join(page.parts).strip():
            page.line("".join(page.parts))
            page.parts, page.at_space = [], True
        page.block(tag in SPACED)
        if indent:
            page.margin.pop()
    else:
        _children(node, page, pre or tag == "textarea")


def _parts(node: Node) -> list:
    """The children of a part of a formula or drawing that may show."""
    if node.tag in FIRST_ONLY:
        return [c for c in node.children if isinstance(c, Node)][:1]
    return node.children


def _undrawn(node: Node, page: Page) -> bool:
    a = node.attributes
    return node.tag in UNDRAWN or node.hidden(page.visible) or a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse")


def _drawing(node: Node, page: Page) -> None:
    """The texts of a drawing, and HTML in it."""
    outer, page.visible = page.visible, node.visible(page.visible)
    for child in _parts(node):
        if not isinstance(child, Node) or _undrawn(child, page):
            continue
        if child.tag in ("text", "foreignobject"):
            page.apart()
            (_drawn_text if child.tag == "text" else _children)(child, page, False)
            page.apart()
        else:
            _drawing(child, page)
    page.visible = outer


def _drawn_text(node: Node, page: Page, pre: bool) -> None:
    outer, page.visible = page.visible, node.visible(page.visible)
    for child in node.children:
        if not isinstance(child, Node):
            page.text(child)
        elif not _undrawn(child, page):
            if "x" in child.attributes or "y" in child.attributes:  # at a place of its own
                page.apart()
            _drawn_text(child, page, pre)
    page.visible = outer


def _formula(node: Node, page: Page, begun: bool) -> bool:
    """The tokens of a formula; ``begun``, and returned, whether one was put out."""
    outer, page.visible = page.visible, node.visible(page.visible)
    for child in _parts(node):
        if isinstance(child, Node) and (child.tag in UNSET or child.hidden(page.visible)):
            continue
        if isinstance(child, Node) and child.tag not in FORMULA_TOKENS:
            begun = _formula(child, page, begun)
        elif isinstance(child, Node) or not child.isspace():
            if begun:
                page.apart()
            if isinstance(child, Node):
                _children(child, page, False)
            else:
                page.text(child)
            begun = True
    page.visible = outer
    return begun


def _wrapped(text: str, tag: str) -> Node:
    node = Node(tag, {})
    node.children.append(text)
    return node


def _rows(table: Node, visible: bool, first: bool = True):
    """(row of a table or whatever else it holds, whether visible, whether a group of rows begins)."""
    visible = table.visible(visible)
    for child in table.children:
        if not isinstance(child, Node):
            if child.isspace():
                continue
            child = _wrapped(child, "div")
        if child.hidden(visible):
            continue
        if child.tag in ("thead", "tbody", "tfoot"):
            yield from _rows(child, visible)
            first = True
        else:
            yield child, visible, first
            first = first and child.tag != "tr"


def _span(cell: Node, name: str, most: int) -> int:
    span = cell.attributes.get(name, "1")
    return min(int(span), most) if span.isascii() and span.isdigit() and len(span) < 9 else 1


def _cells(row: Node, visible: bool, above: list[tuple[int, int, int]]) -> tuple[list, list]:
    """(column, lines) of the cells of a row, and what reaches into the next row; ``above``
    reaches into this one: (first column, column after the last, rows), by first column."""
    cells, column, own_reach, taken = [], 0, [], 0
    visible = row.visible(visible)
    for cell in row.children:
        if not isinstance(cell, Node):
            if cell.isspace():
                continue
            cell = _wrapped(cell, "td")
        if cell.hidden(visible):
            continue
        while taken < len(above) and above[taken][0] <= column:
            column = max(column, above[taken][1])
            taken += 1
        own = Page()
        own.visible = visible
        (_children if cell.tag in ("td", "th") else _render)(cell, own, False)
        own.end_line()
        cells.append((column, own.lines))
        after = column + max(_span(cell, "colspan", MAX_COLSPAN), 1)
        rows = _span(cell, "rowspan", MAX_ROWSPAN) or MAX_ROWSPAN  # 0: to the end of the group
        if rows > 1:
            own_reach.append((column, after, rows - 1))
        column = after
    return cells, sorted([*((a, b, n - 1) for a, b, n in above if n > 1), *own_reach])


def _columns(rows: list[list], limit: int) -> dict[int, int]:
    """Where each column begins, if lines longer than ``limit`` count as ``limit``."""
    asked: dict[int, dict[int, int]] = {c: {} for row in rows for c, _ in row}
    for row in rows:
        for (c, lines), (after, _) in itertools.pairwise(row):
            longest = max(map(len, lines), default=0)
            asked[after][c] = max(asked[after].get(c, 0), min(longest, limit))
    at: dict[int, int] = {}
    last = -2
    for c in sorted(asked):
        at[c] = last = max([last + 2, *(at[x] + size + 2 for x, size in asked[c].items())])
    return at


def _table(table: Node, page: Page) -> None:
    """Rows as lines: every cell begins where its column does."""
    grid, above = [], []
    for row, visible, begins in _rows(table, page.visible):
        if row.tag != "tr":
            grid.append((row, visible))
            continue
        cells, above = _cells(row, visible, [] if begins else above)
        grid.append(cells)
    rows = [row for row in grid if isinstance(row, list) and row]
    length = sum(len(x) for row in rows for _, lines in row for x in lines)
    limit = max((len(x) for row in rows for _, lines in row for x in lines), default=0)
    while True:
        at = _columns(rows, limit)
        padded = sum(at[c] for row in rows for k in range(max(len(lines) for _, lines in row))
                     for c in [max((c for c, lines in row if k < len(lines)), default=0)])
        if padded <= PADDING * length + PADDING_LEAST or not limit:
            break
        limit //= 2
    for row in grid:
        if not isinstance(row, list):
            outer, page.visible = page.visible, row[1]
            _render(row[0], page)
            page.visible = outer
            page.end_line()
            continue
        for k in range(max((len(lines) for _, lines in row), default=0)):
            parts, reached = [], 0
            for c, lines in row:
                if k < len(lines) and lines[k]:
                    gap = at[c] - reached if reached <= at[c] else 2
                    parts += [" " * gap, lines[k]]
                    reached += gap + len(lines[k])
            page.line("".join(parts))


def visible_text(page: str) -> str:
    """The visible text of one page."""
    out = Page()
    _render(parse(page), out)
    out.end_line()
    return "\n".join(out.lines)


def extract(pages: DataFrame, carry: list[str] | None = None, column: str = "html") -> DataFrame:
    """The columns ``carry`` (default: page_id) with the visible ``text`` and its
    number of lines. One row per row; a null or empty page has an empty text."""
    workers_find_package(pages.sparkSession)
    carry = ["page_id"] if carry is None else carry
    held = pages.select(*[pages[c].alias(f"_c{i}") for i, c in enumerate(carry)], pages[column].alias("_html"))

    def run(batches):
        for batch in blocks(batches, "_html"):
            texts = [visible_text(x or "") for x in batch.column("_html").to_pylist()]
            lines = pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(carry))), lines, pa.array(texts, pa.string())],
                                             [*(f"_c{i}" for i in range(len(carry))), "n_lines", "text"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema if f.name != "_html")
    out = held.mapInArrow(run, f"{types}, n_lines long, text string")
    return out.select(*[out[f"_c{i}"].alias(c) for i, c in enumerate(carry)], "n_lines", "text")
