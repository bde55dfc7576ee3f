"""HTML extraction by layout-aware rendering.

Pages are tokenised, built to a tree with the implied tags that HTML allows to leave out, and rendered
as text the way a page is laid out: invisible elements give nothing, white space collapses outside
preformatted text, blocks begin on lines of their own (paragraphs and the like after an empty line),
list items carry bullets or numbers and indent, and table cells stand in aligned columns.

Visibility comes from the element's kind, its attributes, its inline style and the page's own style
elements, of which rules with simple selectors (kind, id, classes, and lists of these) outside of media
queries are followed. ``display: none`` takes an element's whole content away, ``visibility: hidden`` its
text but not that of descendants which are visible again.

Cells stand in columns as long as the blanks and bars for it, over all tables of a page, are at most PADDING times the
page's characters; further tables have their cells side by side, each as wide as its text. So a page's text is bounded by
a multiple of the page.

Each page is rendered on its own inside Arrow batches of bounded size, without shuffle, in time linear in
its length. Cases: a null or blank page gives an empty text; very long pages are rendered whole; elements
nested deeper than DEPTH become siblings; stray tags, comments and quotes never fail; a quote without its
end ends with the tag; what follows the start of a tag that the page never ends is no text, as in a
browser; NUL characters are dropped; repeated rows give repeated results; an empty table gives an empty
result.
"""

from __future__ import annotations

import collections
import html
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from trajlake.llm.text import pieces

DEPTH = 256
#: Blanks and bars that align a page's tables may be so many times its characters (of at least 1000).
PADDING = 8
#: Those that the page at hand may still take.
_spare = [0]
_MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
#: What stands in a tag up to its end. Nothing is given back, so a tag without an end costs one pass.
_INSIDE = re.compile(r"(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=|[\"'])*+")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)")

# Element names of the HTML standard by their behaviour.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_HIDDEN = frozenset("head script style title meta link base template noscript noembed noframes iframe datalist audio video canvas object param source track area map rp annotation annotation-xml mphantom".split())
_LOOSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr xmp fieldset menu".split())
_BLOCK = _LOOSE | frozenset("html body div section article aside header footer nav main address li dt dd tr td th thead tbody tfoot caption figcaption form details summary center legend dialog hgroup search optgroup option textarea".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dt dd".split())
_UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split())
#: HTML elements that end an open svg or math, unless they stand in an element that may hold HTML.
_ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_HOLDS_HTML = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: A start tag of the key ends open elements of the first set, looking no further than the second.
_IMPLIES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "table", "td", "th"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "tr": (frozenset(("tr", "td", "th", "caption", "colgroup")), frozenset(("table",))),
    "td": (frozenset(("td", "th", "caption", "colgroup")), frozenset(("table", "tr"))),
    "th": (frozenset(("td", "th", "caption", "colgroup")), frozenset(("table", "tr"))),
    **{s: (frozenset(("tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot")), frozenset(("table",))) for s in ("thead", "tbody", "tfoot", "caption")},
    "body": (frozenset(("head",)), frozenset()),
}
_HEADS = frozenset("head title meta link base script style template noscript html".split())
_SCOPE = {"td": "table", "th": "table", "tr": "table", "thead": "table", "tbody": "table", "tfoot": "table", "li": None}


class Element:
    __slots__ = ("tag", "raw", "children", "_attributes")

    def __init__(self, tag: str, raw: str = ""):
        self.tag, self.raw, self.children, self._attributes = tag, raw, [], None

    def get(self, name: str) -> str | None:
        """An attribute's value; empty if it has none."""
        if not self.raw:
            return None
        if self._attributes is None:
            self._attributes = {}
            for m in _ATTRIBUTE.finditer(self.raw):
                self._attributes.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        return self._attributes.get(name)


def parse(page: str) -> Element:
    """Tree of a page. Tags that HTML implies are closed or opened as the standard tells."""
    root = Element("#root")
    stack = [root]
    at, end = 0, len(page)
    foreign = re.search(r"<(?:svg|math)[\s/>]", page, re.I) is not None

    def text(value: str) -> None:
        if value:
            if stack[-1].tag == "head" and not value.isspace():
                stack.pop()
            stack[-1].children.append(html.unescape(value) if "&" in value else value)

    def close(names: frozenset, barrier: frozenset) -> None:
        """Close the outermost open element of these names that no barrier hides."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in barrier:
                return
            if stack[k].tag in names:
                lowest = k
                while lowest > 1 and stack[lowest - 1].tag in names and stack[lowest - 1].tag not in barrier:
                    lowest -= 1
                del stack[lowest:]
                return

    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.start()
        if page.startswith("<!--", at):
            done = _COMMENT_END.search(page, at + 2)
            at = done.end() if done else end
            continue
        m = _NAME.match(page, at + 1)
        if m is None:
            if page[at + 1] == "/" and not page.startswith("</>", at) and at + 2 >= end:
                text("</")
            done = page.find(">", at)
            at = done + 1 if done >= 0 else end
            continue
        inside = _INSIDE.match(page, m.end())
        at = inside.end() + 1
        if at > end:
            break
        name = m[2]
        name = name.lower()
        if m[1]:
            if name == "br":
                stack[-1].children.append(Element("br"))
                continue
            stop = _SCOPE.get(name)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
                if stack[k].tag == stop or (stack[k].tag in ("td", "th", "table", "caption") and name not in ("table", "tr", "thead", "tbody", "tfoot", "body", "html")):
                    break
            continue
        if stack[-1].tag == "head" and name not in _HEADS:
            stack.pop()
        if foreign and name in _ENDS_FOREIGN:
            lowest = len(stack)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _HOLDS_HTML:
                    break
                if stack[k].tag in ("svg", "math"):
                    lowest = k
            del stack[lowest:]
        if name in _ENDS_P and len(stack) > 1:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in ("td", "th", "table", "caption", "button", "object"):
                    break
        if name in _IMPLIES:
            close(*_IMPLIES[name])
            if name in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                row = Element("tr")
                stack[-1].children.append(row)
                stack.append(row)
        raw = inside[0]
        node = Element(name, raw if raw and not raw.isspace() else "")
        stack[-1].children.append(node)
        if name in _VOID:
            continue
        if name in _RAW:
            done = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            content = page[at : done.start() if done else end]
            node.children.append(html.unescape(content) if name in ("textarea", "title") else content)
            at = done.end() if done else end
        elif len(stack) < DEPTH and (name in _BLOCK or not raw.endswith("/")):
            stack.append(node)
    return root


def _declared(style: str) -> dict[str, tuple[str, bool]]:
    """display and visibility of a list of declarations, and whether they are marked important."""
    out: dict[str, tuple[str, bool]] = {}
    for part in re.sub(r"/\*.*?(?:\*/|\Z)", "", style, flags=re.S).lower().split(";"):
        name, _, value = part.partition(":")
        if name.strip() in ("display", "visibility"):
            word, _, mark = value.partition("!")
            if word.strip() and not (name.strip() in out and out[name.strip()][1] and not mark):
                out[name.strip()] = word.strip(), mark.strip() == "important"
    return out


class _Sheet:
    """Rules of a page's style elements that tell display or visibility.

    Rules of one selector are merged to the strongest of each property. A selector stands under that part of it which
    the fewest selectors have, and what is said of a kind, id and classes is worked out once.
    """

    def __init__(self, root: Element):
        merged: dict[tuple[str, frozenset[str]], dict[str, tuple]] = {}
        serial = 0
        for css in self._texts(root):
            for selectors, body in self._blocks(re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)):
                told = _declared(body)
                for selector in selectors.split(",") if told else ():
                    m = _SELECTOR.fullmatch(selector.strip())
                    if m is None or not selector.strip():
                        continue
                    tag = "" if m[1] in (None, "*") else m[1].lower()
                    names = re.findall(r"[.#][\w-]+", m[2])
                    weight = (sum(n[0] == "#" for n in names), sum(n[0] == "." for n in names), tag != "")
                    own = merged.setdefault((tag, frozenset(names)), {})
                    for name, (value, important) in told.items():
                        own[name] = max(own.get(name, ((), "")), ((important, 0, weight, serial), value))
                    serial += 1
        often = collections.Counter(n for _, names in merged for n in names)
        self.rules: dict[str, list[tuple]] = {}
        for (tag, names), told in merged.items():
            self.rules.setdefault(min(names, key=lambda n: (often[n], n), default=tag), []).append((tag, names, told))
        self.known: dict[tuple[str, str, str], dict[str, tuple]] = {}

    @staticmethod
    def _texts(root: Element) -> Iterator[str]:
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag == "style" and (node.get("media") or "all").strip().lower() in ("", "all", "screen"):
                yield "".join(c for c in node.children if isinstance(c, str))
            stack += [c for c in reversed(node.children) if isinstance(c, Element)]

    @staticmethod
    def _blocks(css: str) -> Iterator[tuple[str, str]]:
        """Selectors and body of each rule outside of nested blocks."""
        depth, at, head = 0, 0, ""
        for m in re.finditer(r"[{};]", css):
            if m[0] == "{":
                if depth == 0:
                    head, at = css[at : m.start()], m.end()
                depth += 1
            elif m[0] == "}":
                depth = max(0, depth - 1)
                if depth == 0:
                    if not head.strip().startswith("@"):
                        yield head, css[at : m.start()]
                    at = m.end()
            elif depth == 0:
                at = m.end()

    def of(self, node: Element) -> dict[str, tuple]:
        """What the rules say of an element: name to (order of strength, value)."""
        own, classes = (node.get("id") or "", node.get("class") or "") if node.raw else ("", "")
        out = self.known.get((node.tag, own, classes))
        if out is None:
            names = {"." + c for c in classes.split()} | ({"#" + own} if own else set())
            out = {}
            for key in (*names, node.tag, ""):
                for tag, wanted, told in self.rules.get(key, ()):
                    if (not tag or tag == node.tag) and wanted <= names:
                        for name, said in told.items():
                            out[name] = max(out.get(name, ((), "")), said)
            self.known[node.tag, own, classes] = out
        return dict(out)


def _prune(node: Element, sheet: _Sheet | None, shown: bool) -> None:
    """Take what is not seen out of a tree."""
    closed = node.tag == "details" and node.get("open") is None
    summary = next((c for c in node.children if isinstance(c, Element) and c.tag == "summary"), None) if closed else None
    kept: list[Element | str] = []
    for child in node.children:
        if isinstance(child, str):
            if shown and not closed:
                kept.append(child)
            elif not closed and child.isspace():
                kept.append(child)
            continue
        if child.tag in _HIDDEN or closed and child is not summary:
            continue
        told = sheet.of(child) if sheet else {}
        if child.raw:
            if child.get("hidden") is not None or child.tag == "dialog" and child.get("open") is None:
                told.setdefault("display", ((), "none"))
            for name in ("display", "visibility"):
                if child.get(name):
                    told.setdefault(name, ((), child.get(name).strip().lower()))
            style = child.get("style")
            for name, (value, important) in _declared(style).items() if style else ():
                told[name] = max(told.get(name, ((), "")), ((important, 1), value))
        elif child.tag == "dialog":
            told.setdefault("display", ((), "none"))
        if "display" in told and told["display"][1] == "none":
            continue
        visible = told["visibility"][1] if "visibility" in told else ""
        seen = False if visible in ("hidden", "collapse") else True if visible in ("visible", "initial") else shown
        _prune(child, sheet, seen)
        kept.append(child)
    node.children = kept


class _Flow:
    """Lines of a block under construction: inline text collects on the last line, gaps come between blocks."""

    __slots__ = ("lines", "line", "gap", "broken")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.broken = False

    def inline(self, value: str) -> None:
        self.line.append(value)

    def verbatim(self, value: str) -> None:
        first, *rest = value.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line.append(first.replace(" ", "\x00").replace("\t", "\x00" * 4))
        for part in rest:
            self.end(True)
            self.line.append(part.replace(" ", "\x00").replace("\t", "\x00" * 4))

    def end(self, forced: bool = False) -> None:
        """End the line; a forced break keeps an empty line."""
        joined = _BLANKS.sub(" ", "".join(self.line)).strip(" ").replace("\x00", " ").rstrip()
        self.line.clear()
        if joined or forced and (self.lines or self.gap):
            self.emit([joined])

    def emit(self, lines: list[str]) -> None:
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.extend(lines)

    def block(self, lines: list[str], loose: bool) -> None:
        self.end()
        if loose:
            self.gap = max(self.gap, 1)
        while lines and not lines[0]:
            lines.pop(0)
        while lines and not lines[-1]:
            lines.pop()
        if lines:
            self.emit(lines)
            if loose:
                self.gap = 1


def _walk(node: Element, flow: _Flow, pre: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            flow.verbatim(child) if pre else flow.inline(child)
        elif child.tag == "br":
            flow.end(True)
        elif child.tag == "select":
            options = _options(child)
            flow.inline(" " + next((t for t, chosen in options if chosen), options[0][0] if options else "") + " ")
        elif child.tag in _BLOCK:
            flow.block(_block(child, pre), child.tag in _LOOSE and not (child.tag in ("ul", "ol", "menu") and node.tag == "li"))
        elif child.tag == "q":
            flow.inline('"')
            _walk(child, flow, pre)
            flow.inline('"')
        elif child.tag == "svg":
            _svg(child, flow, pre, False)
        elif child.tag == "mtd":
            flow.inline(" ")
            _walk(child, flow, pre)
            flow.inline(" ")
        else:
            _walk(child, flow, pre)


def _svg(node: Element, flow: _Flow, pre: bool, drawn: bool) -> None:
    """What a drawing shows as text: its text elements, each apart, and HTML in it."""
    for child in node.children:
        if isinstance(child, str):
            if drawn:
                flow.inline(child)
        elif child.tag in _UNDRAWN:
            continue
        elif child.tag == "foreignobject":
            flow.block(_lines(child, pre), False)
        elif child.tag == "text":
            flow.inline(" ")
            _svg(child, flow, pre, True)
            flow.inline(" ")
        else:
            _svg(child, flow, pre, drawn)


def _options(node: Element) -> list[tuple[str, bool]]:
    out = []
    for c in node.children:
        if isinstance(c, Element):
            out += [("".join(x for x in c.children if isinstance(x, str)), c.get("selected") is not None)] if c.tag == "option" else _options(c)
    return out


def _lines(node: Element, pre: bool) -> list[str]:
    flow = _Flow()
    _walk(node, flow, pre)
    flow.end()
    return flow.lines


def _block(node: Element, pre: bool) -> list[str]:
    if node.tag == "hr":
        return []
    if node.tag == "table":
        return _table(node, pre)
    if node.tag in ("ul", "ol", "menu"):
        return _list(node, pre)
    lines = _lines(node, pre or node.tag in ("pre", "xmp", "textarea"))
    if node.tag in ("blockquote", "dd"):
        return ["  " + x if x else x for x in lines]
    if node.tag == "li":
        return _item(lines, "- ")
    return lines


def _item(lines: list[str], mark: str) -> list[str]:
    while lines and not lines[0]:
        lines.pop(0)
    return [(mark if k == 0 else " " * len(mark)) + x if x or k == 0 else x for k, x in enumerate(lines)] if lines else []


def _list(node: Element, pre: bool) -> list[str]:
    out: list[str] = []
    number = int(node.get("start")) if node.tag == "ol" and re.fullmatch(r"-?\d{1,9}", node.get("start") or "") else 1
    loose = Element("li")  # what stands between items
    for child in node.children:
        if isinstance(child, Element) and child.tag == "li":
            out += _item(_lines(loose, pre), "  ")
            loose = Element("li")
            if re.fullmatch(r"-?\d{1,9}", child.get("value") or ""):
                number = int(child.get("value"))
            out += _item(_lines(child, pre), f"{number}. " if node.tag == "ol" else "- ")
            number += 1
        else:
            loose.children.append(child)
    return out + _item(_lines(loose, pre), "  ")


def _span(cell: Element, name: str, most: int) -> int:
    value = cell.get(name)
    return max(1, min(most, int(value))) if value and re.fullmatch(r"\d{1,6}", value.strip()) else 1


def _holds_cell(node: Element) -> bool:
    return any(c.tag in ("td", "th") or c.tag != "table" and _holds_cell(c) for c in node.children if isinstance(c, Element))


def _cells(parent: Element, aside: list[Element | str]) -> list[Element]:
    """Cells of a row, also those below elements that are no cells; all else goes aside."""
    out: list[Element] = []
    for child in parent.children:
        if isinstance(child, str):
            if not child.isspace():
                aside.append(child)
        elif child.tag in ("td", "th"):
            out.append(child)
        elif child.tag != "table" and _holds_cell(child):
            out += _cells(child, aside)
        else:
            aside.append(child)
    return out


def _table(node: Element, pre: bool) -> list[str]:
    rows: dict[str, list[list[Element]]] = {"thead": [], "tbody": [], "tfoot": []}
    out: list[str] = []
    aside = Element("div")  # what is in no cell stands before the table

    def take(parent: Element, section: str) -> None:
        for child in parent.children:
            if isinstance(child, str):
                if not child.isspace():
                    aside.children.append(child)
            elif child.tag in _SECTIONS:
                take(child, child.tag)
            elif child.tag == "tr":
                stray = Element("div")
                rows[section].append(_cells(child, stray.children))
                if stray.children:
                    aside.children.append(stray)
            elif child.tag not in ("colgroup", "col"):
                aside.children.append(child)

    take(node, "tbody")
    out += _lines(aside, pre)
    grid: list[dict[int, list[str]]] = []
    wide: set[tuple[int, int]] = set()  # cells over several columns do not set a column's width
    held: dict[int, int] = {}  # columns that a cell from above still fills, and for how many rows
    for row in (*rows["thead"], *rows["tbody"], *rows["tfoot"]):
        cells, column = {}, 0
        below: dict[int, int] = {}
        for cell in row:
            while held.get(column, 0) > 0:
                column += 1
            span = _span(cell, "colspan", 1000)
            cells[column] = _lines(cell, pre)
            if span > 1:
                wide.add((len(grid), column))
            for c in range(column, column + span):
                below[c] = _span(cell, "rowspan", 65534)
            column += span
        held = {c: n - 1 for c, n in {**held, **below}.items() if n > 1}
        grid.append(cells)
    width: dict[int, int] = {}
    for r, cells in enumerate(grid):
        for c, lines in cells.items():
            if (r, c) not in wide:
                width[c] = max(width.get(c, 0), max(map(len, lines), default=0))
    used = sorted({c for cells in grid for c in cells})
    tall = [max(map(len, cells.values()), default=0) for cells in grid]
    plain = sum(len(x) for cells in grid for lines in cells.values() for x in lines)
    padding = sum(tall) * sum(width.get(c, 0) + 3 for c in used) - plain
    if padding > _spare[0]:  # cells side by side, without columns
        for cells, most in zip(grid, tall, strict=True):
            for k in range(most):
                out.append(" | ".join(lines[k] for _, lines in sorted(cells.items()) if k < len(lines) and lines[k]))
        return out
    _spare[0] -= max(0, padding)
    for cells in grid:
        for k in range(max((len(x) for x in cells.values()), default=0)):
            parts = [cells[c][k] if c in cells and k < len(cells[c]) else "" for c in used]
            while len(parts) > 1 and not parts[-1]:
                parts.pop()
            out.append(" | ".join(p.ljust(width.get(c, 0)) for p, c in zip(parts, used, strict=False)).rstrip())
    return out


def render(page: str | None) -> str:
    """Visible text of a page."""
    if not page:
        return ""
    if sys.getrecursionlimit() < 8 * DEPTH:
        sys.setrecursionlimit(8 * DEPTH)
    root = parse(page.replace("\x00", ""))
    _spare[0] = PADDING * max(len(page), 1000)
    sheet = _Sheet(root) if re.search(r"display|visibility", page, re.I) and re.search("<style", page, re.I) else None
    _prune(root, sheet, True)
    lines = _lines(root, False)
    while lines and not lines[0]:
        lines.pop(0)
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines)


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text (all visible text of the page) and n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts = [render(p) for p in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "text", "n_chars"])

    return df.select(df[id_col].cast("long").alias("page_id"), df[html_col].cast("string").alias("text")).mapInArrow(run, "page_id long, text string, n_chars long")
