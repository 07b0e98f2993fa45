"""Visible text of HTML, laid out: a tree with implied tags, visibility rules, then rendering.

The tree builder closes what HTML closes by itself (paragraphs before blocks, list items, table
rows and cells, options) and ignores closing tags of nothing open. Left out are the head,
scripts, styles, templates, elements with ``hidden`` or display:none or visibility:hidden (in
their style, or by a tag, class or id rule of a style sheet in the page, but for print), hidden inputs and the
body of closed details. Everything else is emitted: blocks on lines of their own, paragraphs
and headings set apart by an empty line, list items marked and indented, table cells padded to
the width of their column.

Defined results: null or empty pages have the empty text; broken markup is text or is closed at
the end; any length and depth is rendered whole (tables nested deeper than ``DEEP`` as blocks);
repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head script style template noscript title datalist".split())
BLOCK = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tr ul".split())
APART = frozenset("blockquote dl h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
LISTS = frozenset(("ul", "ol", "menu"))
#: What an opening tag closes first, and the element beyond which it doesn't look.
CLOSES = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    **{t: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
}
DEEP = 20
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PRINT = re.compile(r"@media\s+print\b[^{}]*\{(?:[^{}]*\{[^{}]*\})*[^{}]*\}", re.I)
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []


class _Tree(HTMLParser):
    """Builds the tree; where the open elements of each tag stand is kept, so no tag looks through all that is open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}
        self.styles: list[str] = []

    def _innermost(self, tags) -> int:
        """Where the innermost open element with one of these tags stands; 0 without any."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _close_to(self, at: int) -> None:
        for node in self.open[at:]:
            self.places[node.tag].pop()
        del self.open[at:]

    def _close_first(self, tags: set[str], beyond) -> None:
        barrier = self._innermost(beyond)
        while (at := self._innermost(tags)) > barrier:
            self._close_to(at)
            if not tags & {"tr", "thead"}:
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("html", "body"):
            self.root.attrs.update(attrs if tag == "body" else ())
            if tag == "body" and len(self.open) > 1 and self.open[1].tag == "head":
                self._close_to(1)
            return
        if tag in CLOSES:
            self._close_first(*CLOSES[tag])
        elif tag in BLOCK:
            if self.open[-1].tag == "head":
                self._close_to(len(self.open) - 1)
            self._close_first({"p"}, {"td", "th", "li", "div", "table", "button", "dd", "blockquote"})
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag not in BLOCK:
            self._close_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        at = self._innermost((tag,))
        inside = 0 if tag in ("table", "tr", "tbody", "thead", "tfoot") else self._innermost(("table", "td", "th"))
        if at and at >= inside:
            self._close_to(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "style":
            self.styles.append(data)
        self.open[-1].children.append(data)


def _hidden_selectors(styles: list[str]) -> set[str]:
    found: set[str] = set()
    for selectors, body in _RULE.findall(_PRINT.sub(" ", " ".join(styles))):
        if _HIDING.search(body):
            found.update(s.strip().lower() for s in selectors.split(",") if re.fullmatch(r"\s*[.#]?[\w-]+\s*", s))
    return found


class _Page:
    """Lines under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.apart = False

    def text(self, data: str) -> None:
        data = _SPACE.sub(" ", data)
        if data == " " and (not self.now or self.now[-1].endswith(" ")):
            return
        if not self.now or self.now[-1].endswith(" "):
            data = data.removeprefix(" ")
        if data:
            self.now.append(data)

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.now).rstrip(" ")
        self.now = []
        if line or keep_empty:
            if self.apart and self.lines:
                self.lines.append("")
            self.apart = False
            self.lines.append(line)

    def blank(self) -> None:
        self.end_line()
        self.apart = True


class Renderer:
    def __init__(self, hidden: set[str]) -> None:
        self.hidden = hidden

    def seen(self, node: Node) -> bool:
        a = node.attrs
        if node.tag in UNSEEN or "hidden" in a or _HIDING.search(a.get("style") or ""):
            return False
        if node.tag == "input" and (a.get("type") or "").lower() == "hidden":
            return False
        return not (self.hidden and (node.tag in self.hidden or f"#{(a.get('id') or '').lower()}" in self.hidden or any(f".{c.lower()}" in self.hidden for c in (a.get("class") or "").split())))

    def lines(self, root: Node, depth: int = 0) -> list[str]:
        page = _Page()
        todo: list = [root]
        while todo:
            x = todo.pop()
            if callable(x):
                x()
            elif isinstance(x, str):
                page.text(x)
            elif x is root or self.seen(x):
                self._node(x, page, todo, depth, x is root)
        page.end_line()
        return page.lines

    def _nested(self, page: _Page, block: list[str], first: str, rest: str) -> None:
        page.end_line()
        for i, line in enumerate(block or [""]):
            page.now = [(first if i == 0 else rest) + line]
            page.end_line(keep_empty=True)

    def _node(self, x: Node, page: _Page, todo: list, depth: int, is_root: bool) -> None:
        tag = x.tag
        if tag == "br":
            return page.end_line(keep_empty=True)
        if tag == "hr":
            page.blank()
            page.now = ["---"]
            return page.blank()
        if tag == "input":
            return page.text(x.attrs.get("value") or "")
        if tag == "pre" and not is_root:
            page.blank()
            for line in _raw(x, self).strip("\n").split("\n"):
                page.now = [line]
                page.end_line(keep_empty=True)
            return page.blank()
        if depth < DEEP and not is_root:
            if tag == "table":
                page.blank()
                for line in self.table(x, depth + 1):
                    page.now = [line]
                    page.end_line(keep_empty=True)
                return page.blank()
            if tag in LISTS:
                page.blank() if not depth else page.end_line()
                n = _int(x.attrs.get("start"), 1)
                for child in x.children:
                    if isinstance(child, Node) and child.tag == "li" and self.seen(child):
                        mark = f"{n}. " if tag == "ol" else "- "
                        self._nested(page, self.lines(child, depth + 1), mark, " " * len(mark))
                        n += 1
                    elif isinstance(child, Node) and self.seen(child) or isinstance(child, str) and child.strip():
                        holder = Node("div", {})
                        holder.children = [child]
                        self._nested(page, self.lines(holder, depth + 1), "", "")
                return page.blank() if not depth else page.end_line()
        children = x.children
        if tag == "details" and "open" not in x.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        if tag in ("td", "th") and not is_root:
            page.text(" ")
        if tag in BLOCK:
            end = page.blank if tag in APART and not is_root else page.end_line
            end()
            todo.append(end)
        todo.extend(reversed(children))

    def table(self, table: Node, depth: int) -> list[str]:
        """Rows of cells padded to their columns; a cell's further lines follow below its first."""
        out, rows = [], []
        below: list[int] = []  # by column, how many rows a cell from above still takes
        todo = list(reversed(table.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                if x.strip():
                    out.append(_SPACE.sub(" ", x).strip())
            elif self.seen(x):
                if x.tag == "tr":
                    cells = []
                    for c in x.children:
                        if isinstance(c, Node) and not self.seen(c) or isinstance(c, str) and not c.strip():
                            continue
                        holder = c if isinstance(c, Node) and c.tag in ("td", "th") else Node("td", {})
                        if holder is not c:
                            holder.children = [c]
                        while len(cells) < len(below) and below[len(cells)]:
                            below[len(cells)] -= 1
                            cells.append([""])
                        first, wide = len(cells), min(_int(holder.attrs.get("colspan"), 1), 1000)
                        cells.append(self.lines(holder, depth) or [""])
                        cells.extend([[""]] * (wide - 1))
                        below.extend([0] * (len(cells) - len(below)))
                        below[first : len(cells)] = [(_int(holder.attrs.get("rowspan"), 1) or 65535) - 1] * (len(cells) - first)
                    for i in range(len(cells), len(below)):
                        below[i] = max(0, below[i] - 1)
                    rows.append(cells)
                elif x.tag in ("thead", "tbody", "tfoot"):
                    todo.extend(reversed(x.children))
                else:
                    out.extend(self.lines(x, depth))
        widths: list[int] = []
        for cells in rows:
            for i, cell in enumerate(cells):
                if i == len(widths):
                    widths.append(0)
                widths[i] = max(widths[i], *map(len, cell))
        for cells in rows:
            for k in range(max(map(len, cells), default=0)):
                out.append("  ".join((c[k] if k < len(c) else "").ljust(w) for c, w in zip(cells, widths)).rstrip())
        return out


def _int(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\d{1,6}", text) else default


def _raw(x: Node, renderer: Renderer) -> str:
    out, todo = [], list(reversed(x.children))
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag == "br":
            out.append("\n")
        elif renderer.seen(c):
            todo.extend(reversed(c.children))
    return "".join(out)


def visible_text(html: str | None) -> str:
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    lines = Renderer(_hidden_selectors(tree.styles)).lines(tree.root)
    return "\n".join(lines).strip("\n")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[visible_text(h) for h in batch["html"]])[["page_id", "url", "text"]]

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string")
