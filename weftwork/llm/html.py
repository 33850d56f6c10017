"""Visible text of web pages, laid out: blocks, lists and tables keep their shape."""

from __future__ import annotations

import html as entities
import re
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.tables import as_bytes, map_text

#: Elements nested deeper than this become siblings, as in browsers; their text stays.
DEPTH = 512
#: The widest and tallest cell that HTML knows.
COLUMNS, ROWS = 1000, 65534
#: Python frames that the layout of the deepest tree takes.
FRAMES = 20 * DEPTH

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript iframe title object audio video canvas datalist rp noembed noframes".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu xmp".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li "
    "main nav option optgroup search section select summary textarea caption".split()
)
HEAD = frozenset("base link meta script style template title noscript".split())
#: What an opening tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "table", "td", "th")),
    "dt": (("dt", "dd"), ("dl", "table", "td", "th")), "dd": (("dt", "dd"), ("dl", "table", "td", "th")),
    "option": (("option",), ("select", "datalist", "optgroup")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "rt": (("rt", "rp"), ("ruby",)), "rp": (("rt", "rp"), ("ruby",)),
}

# A comment without an end is matched as "<!--" alone.
_TAG = re.compile(
    r"""<!--(?:-?>|.*?--!?>)?|<[!?][^>]*>|</[^a-zA-Z>][^>]*>|</>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"[ \t\r\n\f]+")


class Element:
    __slots__ = ("_values", "attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children, self._values = tag, attributes, [], None

    def attribute(self, name: str) -> str | None:
        """The value, "" if it has none, None without the attribute; the first one counts."""
        if self._values is None:
            self._values = {}
            for found, value in _ATTRIBUTE.findall(self.attributes):
                self._values.setdefault(found.lower(), value)
        value = self._values.get(name)
        return value if value is None else entities.unescape(value.strip("\"'"))


# ---------------------------------------------------------------- tree

def build_tree(page: str) -> Element:
    """The element tree, with the end tags and table rows that HTML lets authors leave out."""
    root = Element("html")
    stack, place = [root], 0
    last = page.rfind(">") + 1  # no tag ends behind it

    places: dict[str, list[int]] = {}  # where on the stack the elements of a tag stand; may lag behind it

    def top(tags: tuple[str, ...]) -> int:
        """The highest place on the stack of an element with one of the tags, 0 without."""
        best = 0
        for tag in tags:
            held = places.get(tag, [])
            while held and (held[-1] >= len(stack) or stack[held[-1]].tag != tag):
                held.pop()
            best = max(best, held[-1] if held else 0)
        return best

    def close(tags: tuple[str, ...], barrier: tuple[str, ...]) -> None:
        found = top(tags)
        if found and found >= top(barrier):
            del stack[found:]

    def add(text: str) -> None:
        if text:
            stack[-1].children.append(entities.unescape(text) if "&" in text else text)

    def open_element(tag: str, attributes: str) -> Element:
        one = Element(tag, attributes)
        stack[-1].children.append(one)
        if tag not in VOID and len(stack) < DEPTH:
            places.setdefault(tag, []).append(len(stack))
            stack.append(one)
        return one

    while True:
        tag = _TAG.search(page, place, last)
        if tag is None:
            break
        add(page[place:tag.start()])
        place = tag.end()
        if tag[0] == "<!--":
            return root
        ends, name, attributes = tag[1], tag[2], tag[3]
        if name is None:
            ends, name, attributes = tag[4], tag[5], tag[6]
        if name is None:
            continue  # comment or declaration
        name = name.lower()
        if ends:
            inside = ("table",) if name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else ("td", "th", "caption")
            close((name,), () if name in ("table", "body", "html") else inside)
            continue
        if name in ("html", "body"):
            root.attributes = root.attributes + " " + attributes
            del stack[1:]
            continue
        if len(stack) > 1 and stack[-1].tag == "head" and name not in HEAD:
            stack.pop()
        if name in CLOSES:
            close(*CLOSES[name])
        if name in BLOCKS or name in ("table", "tr"):
            close(("p",), ("table", "td", "th", "button", "caption", "object"))
        if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            open_element("tr", "")
        one = open_element(name, attributes)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, place)
            text = page[place:end.start() if end else len(page)]
            one.children.append(entities.unescape(text) if name in ("textarea", "title") else text)
            place = end.end() if end else len(page)
            if stack[-1] is one:
                stack.pop()
    rest = page[place:]
    cut = _TAG_START.search(rest, max(0, last - place))  # a tag that the page breaks off in
    add(rest[:cut.start()] if cut else rest)
    return root


# ---------------------------------------------------------------- layout

def shown(one: Element, visible: bool) -> bool | None:
    """None if the element and all below take no room; else whether its own text is visible."""
    if one.tag in HIDDEN or (one.tag == "dialog" and one.attribute("open") is None):
        return None
    if not one.attributes:
        return visible
    if one.attribute("hidden") is not None:
        return None
    style = one.attribute("style")
    if style:
        for rule in style.lower().split(";"):
            name, _, value = (x.strip() for x in rule.partition(":"))
            value = value.removesuffix("!important").strip()
            if name == "display" and value == "none":
                return None
            if name == "visibility":
                visible = value not in ("hidden", "collapse")
    return visible


class Layout:
    """Lines as (indentation, text); gap is the number of empty lines wanted before the next one."""

    def __init__(self):
        self.lines: list[tuple[int, str]] = []
        self.line, self.gap = "", 0

    def text(self, text: str, keep_space: bool) -> None:
        if keep_space:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.line += first
            for line in rest:
                self.flush(always=True)
                self.line = line
            return
        text = _SPACE.sub(" ", text)
        if not self.line or self.line[-1] == " ":
            text = text.lstrip(" ")
        self.line += text

    def flush(self, always: bool = False) -> None:
        line, self.line = self.line.rstrip(), ""
        if line or always:
            self.put([(0, line)])

    def put(self, lines: list[tuple[int, str]]) -> None:
        if lines:
            if self.lines:
                self.lines += [(0, "")] * self.gap
            self.lines += lines
            self.gap = 0

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)


def lay_out(one: Element, page: Layout, visible: bool = True, keep_space: bool = False) -> None:
    closed = one.tag == "details" and one.attribute("open") is None
    for child in one.children:
        if closed and (isinstance(child, str) or child.tag != "summary"):
            continue
        if isinstance(child, str):
            if visible:
                page.text(child, keep_space)
            continue
        own = shown(child, visible)
        if own is None:
            continue
        tag = child.tag
        if tag == "br":
            page.flush(always=True)
            continue
        gap = int(tag in SPACED and not (one.tag == "li" and tag in ("ul", "ol", "menu")))
        if tag in BLOCKS:
            page.block(gap)
        if tag in ("ul", "ol", "menu", "dir"):
            _list(child, page, own)
        elif tag == "table":
            page.put([(0, line) for line in _table(child, own)])
        elif tag in ("blockquote", "dd"):
            page.put([(indent + 2, line) for indent, line in _inner(child, own)])
        else:
            lay_out(child, page, own, keep_space or tag in ("pre", "textarea", "xmp"))
        if tag in BLOCKS:
            page.block(gap)


def _inner(one: Element, visible: bool) -> list[tuple[int, str]]:
    page = Layout()
    lay_out(one, page, visible)
    page.flush()
    return page.lines


def _written(lines: list[tuple[int, str]]) -> list[str]:
    return [" " * indent + line if line else "" for indent, line in lines]


def _list(one: Element, page: Layout, visible: bool) -> None:
    """Items with "- " or their number; what follows in an item stands below its first word."""
    start = one.attribute("start") or ""
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    rest = Element(one.tag)
    for child in one.children:
        own = shown(child, visible) if isinstance(child, Element) else None
        if isinstance(child, Element) and child.tag == "li":
            if own is None:
                continue
            value = child.attribute("value") or ""
            number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
            mark = f"{number}. " if one.tag == "ol" else "- "
            number += 1
            lines = _inner(child, own)
            if lines:
                page.put([(0, mark + _written(lines[:1])[0]), *[(indent + len(mark), line) for indent, line in lines[1:]]])
        else:  # a list may hold other things than items
            rest.children = [child]
            page.put(_inner(rest, visible))


def _cells(one: Element, visible: bool) -> tuple[list[list[tuple]], list[str]]:
    """(rows of (lines, columns, rows spanned), lines outside the cells)."""
    rows, outside, loose = [], [], Element("div")
    for child in one.children:
        own = shown(child, visible) if isinstance(child, Element) else visible
        if own is None:
            continue
        if isinstance(child, str) or child.tag not in ("tr", "td", "th", "tbody", "thead", "tfoot"):
            loose.children = [child]
            outside += _written(_inner(loose, visible))
        elif child.tag == "tr":
            row = []
            for cell in child.children:
                seen = shown(cell, own) if isinstance(cell, Element) else None
                if isinstance(cell, Element) and cell.tag in ("td", "th") and seen is not None:
                    row.append((_written(_inner(cell, seen)), _span(cell, "colspan", COLUMNS), _span(cell, "rowspan", ROWS)))
                elif isinstance(cell, str) or seen is not None:
                    loose.children = [cell]
                    outside += _written(_inner(loose, own))
            rows.append(row)
        else:
            more, other = _cells(child, own)
            rows += more
            outside += other
    return rows, outside


def _span(cell: Element, name: str, most: int) -> int:
    found = re.match(r"[ \t\r\n\f]*\+?(\d+)", cell.attribute(name) or "")
    return min(most, max(1, int(found[1][:9]))) if found else 1


def _table(one: Element, visible: bool) -> list[str]:
    """Cells of a column start at the same place, two spaces after the widest cell before them."""
    rows, lines = _cells(one, visible)
    widths: dict[int, int] = {}
    taken: dict[int, int] = {}  # columns that cells from above still cover, and for how many rows
    placed: list[list[tuple[int, list[str]]]] = []
    for row in rows:
        column, held, fresh = 0, [], {}
        for text, columns, down in row:
            while taken.get(column, 0) > 0:
                column += 1
            held.append((column, text))
            if columns == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, text), default=0))
            for c in range(column, column + columns):
                widths.setdefault(c, 0)
                fresh[c] = down
            column += columns
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | {c: n - 1 for c, n in fresh.items() if n > 1}
        placed.append(held)
    starts, at = {}, 0
    for c in sorted(widths):
        starts[c] = at
        at += widths[c] + 2
    for held in placed:
        for i in range(max((len(text) for _, text in held), default=0)):
            line = ""
            for column, text in held:
                if i < len(text) and text[i]:
                    line = line.ljust(starts[column]) if len(line) <= starts[column] else line + "  "
                    line += text[i]
            lines.append(line.rstrip())
    return lines


def visible_text(page: str | bytes | None) -> str:
    """All text that a reader of the page sees; "" for NULL and empty pages.

    Hidden are the head, scripts and the like, elements with hidden, display: none or (until a child
    turns it on again) visibility: hidden in their own attributes, closed dialogs and details. Style
    sheets are not applied.
    """
    if sys.getrecursionlimit() < FRAMES:
        sys.setrecursionlimit(FRAMES)
    text = as_bytes(page).decode("utf-8", "replace").replace("\0", "")
    root = build_tree(text)
    visible = shown(root, True)
    return "" if visible is None else "\n".join(_written(_inner(root, visible))).strip("\n").replace("\u00a0", " ")


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, text) of every row, repeated rows and NULL keys included; further columns are not looked at."""
    kind = pages.select(key).schema[0].dataType.simpleString()

    def work(columns: list[list]) -> dict[str, list]:
        return {key: columns[0], "text": [visible_text(page) for page in columns[1]]}

    return map_text(pages, [F.col(key), F.col(html)], work, f"`{key}` {kind}, text string")
