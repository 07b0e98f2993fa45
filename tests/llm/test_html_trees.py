"""Deep and broken pages in linear time; cells that span rows; rules for print."""

import random
import time

from millrace.llm import html_text


def test_a_hundred_thousand_open_elements():
    for page in (
        "<section>" * 100_000 + "end", "<section>" * 4000 + "</i>" * 100_000 + "end", "<div><p>x" * 30_000 + "end",
        "<ul><li>" * 15 + "<li>x" * 100_000 + "end", "<table><tr>" + "<td>x" * 50_000 + "</section>" * 50_000 + "end",
    ):
        start = time.perf_counter()
        assert html_text.visible_text(page).rstrip().endswith("end")
        assert time.perf_counter() - start < 8  # a busy machine; quadratic time takes minutes


def _slow_close_first(tree, tags, beyond):
    for i in range(len(tree.open) - 1, 0, -1):
        tag = tree.open[i].tag
        if tag in beyond:
            return
        if tag in tags:
            tree._close_to(i)
            if not tags & {"tr", "thead"}:
                return


def _slow_end(tree, tag):
    for i in range(len(tree.open) - 1, 0, -1):
        found = tree.open[i].tag
        if found == tag:
            return tree._close_to(i)
        if found in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
            return None


def test_the_same_tree_as_by_looking_through_all_that_is_open(monkeypatch):
    draw = random.Random(41)
    tags = "p div li ul ol table tr td th tbody thead dt dd dl option select b i section h1 button blockquote caption".split()
    pages = ["".join(draw.choice([f"<{t}>", f"<{t}>", f"</{t}>", f"<{t}/>", "word "]) for t in draw.choices(tags, k=80)) for _ in range(300)]
    got = [html_text.visible_text(p) for p in pages]
    monkeypatch.setattr(html_text._Tree, "_close_first", _slow_close_first)
    monkeypatch.setattr(html_text._Tree, "handle_endtag", _slow_end)
    assert got == [html_text.visible_text(p) for p in pages]


def test_cells_that_span_rows():
    page = "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td rowspan=0>g<td>h<tr><td>i<td>j<tr><td>k<td>l</table>"
    assert html_text.visible_text(page).split("\n") == ["a  b  c", "   d  e", "f  g  h", "i     j", "k     l"]


def test_rules_for_print_hide_nothing():
    page = "<style>@media print { .x { display:none } p {visibility:hidden} } .y {display:none}</style><p class=x>seen<p class=y>gone<p>end"
    assert html_text.visible_text(page) == "seen\n\nend"
