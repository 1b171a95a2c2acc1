"""The tolerant parser and the page struct, one case for each edge of the page semantics."""

import pytest

from leafline.functions import html as H
from leafline.operators.extract import _page
from leafline.plans.specs import GRID_ID


def row(*cells):
    return "<tr>" + "".join(f"<td><font>{c}</font></td>" if c is not None else "<td></td>" for c in cells) + "</tr>"


def grid(*rows):
    return f'<table id="{GRID_ID}"><tr><th>h</th></tr>{"".join(rows)}</table>'


def one(html, tbody=False):
    (found,) = _page(grid(html) if not tbody else html, tbody)["grid"]
    return found


def test_first_row_and_first_option_are_kept_apart():
    assert [r["row_ord"] for r in _page(grid(row("1"), row("2")), False)["grid"]] == [1, 2]
    lists = dict(_page('<select id="s"><option value="0">-<option value="1">one<option value="2">two</select>', False)["selects"])
    assert [(o["pos"], o["value"], o["name"]) for o in lists["s"]] == [(0, "0", "-"), (1, "1", "one"), (2, "2", "two")]


def test_option_without_text_or_value_is_null():
    lists = dict(_page('<select id="s"><option value="1"></option><option>x</option></select>', False)["selects"])
    assert [(o["value"], o["name"]) for o in lists["s"]] == [("1", None), (None, "x")]


@pytest.mark.parametrize(
    ("cell", "text"),
    [("a<br>b", "a"), ("<b>x</b>y", "y"), ("&nbsp;", " "), ("A &amp; B", "A & B"), (" pad ", " pad "), ("x<!-- c -->y", "x"), ("", None)],
)
def test_only_the_first_own_text_counts(cell, text):
    assert one(row(cell))["cells"][0] == text


def test_unclosed_cells_and_rows_end_where_the_next_begins():
    found = _page(f'<table id="{GRID_ID}"><tr><th>h<tr><td><font>1</font><td><font>2</font><tr><td><font>3</font></table>', False)["grid"]
    assert [r["cells"][:2] for r in found] == [["1", "2"], ["3", None]]


def test_nested_cells_count_by_their_own_parent():
    nested = "<tr><td><table><tr><td><font>a</font></td><td><font>b</font></td></tr></table></td><td><font>c</font></td></tr>"
    found = one(nested)
    assert found["cells"][:3] == ["a", "c", None]
    assert found["has_table"] and found["pager"] == "b"


def test_pager_text_is_that_of_the_last_cell():
    assert one("<tr><td><table><tr><td><span><font>1</font></span></td><td><a><font>7</font></a></td></tr></table></td></tr>")["pager"] == "7"


def test_rows_in_a_tbody_count_only_if_asked_for():
    html = f'<table id="{GRID_ID}"><tbody><tr><th>h</th></tr>{row("1")}</tbody></table>'
    assert _page(html, False)["grid"] == []
    assert one(html, True)["cells"][0] == "1"


def test_scripts_hold_no_markup():
    page = _page('<script>var t="</p><span id=x>n</span>";</script><span id="x">y</span>', False)
    assert page["spans"] == [("x", "y")]


@pytest.mark.parametrize("html", [None, "", "<", "<td", "</td></table>", "<table id=gvVoterListDetails>", "<a <b <c", "&#xD800;"])
def test_any_input_gives_a_page(html):
    assert set(_page(html, False)) == {"inputs", "selects", "spans", "grid", "title", "h1", "nav"}


def test_deep_nesting_needs_no_recursion():
    root = H.tree("<div>" * 20000 + "x")
    assert sum(1 for _ in root.walk()) == 20001
