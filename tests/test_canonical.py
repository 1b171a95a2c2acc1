"""Pages that the JVM reads give the structs that the tree gives; whatever is not canonical goes to the tree."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leafline.operators import extract, grid
from leafline.plans import catalog, render
from leafline.plans.specs import GRID_ID

DATA = Path(os.environ.get("LEAFLINE_TESTDATA", "/root/testdata/sf0.001"))


def as_tree(html):
    """What the tree says of a page, in the form of a collected struct."""
    p = extract._page(html, False)
    return p | {"inputs": dict(p["inputs"]), "spans": dict(p["spans"]), "selects": dict(p["selects"])}


def plain(row):
    return row.asDict(recursive=True)


class Pages:
    """Random pages: mostly canonical, each with a chance of something that isn't."""

    def __init__(self, seed, odd):
        self.rng, self.odd = random.Random(seed), odd

    def maybe(self, *strange, chance=0.03):
        return self.rng.choice(strange) if self.rng.random() < chance * self.odd else ""

    def text(self):
        return self.rng.choice(["", "a", " two words ", "é ü", "a &amp; b", "&lt;i&gt;", "&amp;lt;", "x > y", "line\nbreak", "&quot;q&quot;", "1/2"]) + self.maybe("&nbsp;", "&#65;", "<br>", "&amp", "\x01", "<b>x</b>", "<!-- c -->")

    def attributes(self):
        return self.rng.choice(["", "", ' align="left"', ' style="a:b;c" class="x y"']) + self.maybe(' id="x"', " nowrap", " a='b'", ' A="b"', ' t="a>b"', ' v="&amp;"')

    def gap(self):
        return self.rng.choice(["", "", "\n", " "])

    def cell(self):
        inner = "" if self.rng.random() < 0.2 else f"<font{self.attributes()}>{self.text()}</font>"
        return f"<td{self.attributes()}>{inner + self.maybe('text', '<font>2</font>', '<span>s</span>')}{self.maybe('<td>', chance=0.01) or '</td>'}"

    def row(self):
        return f"<tr{self.attributes()}>" + "".join(self.cell() + self.gap() for _ in range(self.rng.choice([0, 1, 3, 12, 12, 13]))) + (self.maybe("<tr>", chance=0.01) or "</tr>")

    def pager(self):
        link = lambda k: self.rng.choice([f"<td><a href=\"#\"><font>{k}</font></a></td>", f"<td><span><font>{k}</font></span></td>"]) + self.maybe(f"<td><font>{k}</font></td>", "<td>...</td>")
        return f'<tr{self.attributes()}><td colspan="12"><table border="0"><tr>' + "".join(link(k) for k in range(1, self.rng.randint(2, 5))) + link(self.rng.choice(["...", "12", ""])) + "</tr></table></td></tr>"

    def grid(self):
        rows = [self.row() for _ in range(self.rng.randrange(6))]
        if self.rng.random() < 0.4:
            rows.insert(self.rng.randrange(len(rows) + 1), self.pager())
        head = self.rng.choice(["<tr><th>header</th></tr>", "<tr><th>a</th>\n<th>b</th></tr>", ""])
        body = head + self.gap() + self.gap().join(rows)
        return f'<table{self.attributes()} id="{GRID_ID}">' + (self.maybe("<tbody>") or "") + body + self.maybe("<caption>c</caption>") + "</table>"

    def select(self):
        option = lambda: f'<option value="{self.rng.choice(["", "1", "a b", "&lt;"])}"{self.attributes()}>{self.text()}' + (self.maybe("<option>") or "</option>")
        return f'<select id="{self.rng.choice("abcd")}"{self.attributes()}>' + "".join(self.rng.choice([option(), f"<option>{self.text()}</option>"]) + self.gap() for _ in range(self.rng.randrange(4))) + "</select>"

    def part(self):
        return self.rng.choice(
            [
                lambda: f'<input type="hidden" name="n" id="{self.rng.choice("pqrs")}" value="{self.rng.choice(["", "v/+=", "a&amp;b"])}"{self.rng.choice(["", " /", "/"])}>',
                lambda: f'<span id="{self.rng.choice("uvwx")}">{self.text()}</span>',
                lambda: f"<span{self.attributes()}>{self.text()}</span>",
                self.select,
                self.text,
                lambda: self.maybe("<p>para", "<ul><li>x</ul>", "<script>a<b</script>", "<h1>head</h1>", "<title>t</title>", "<nav><ul><li><a href='#'>n</a></li></ul></nav>", self.row(), "</table>", "</td>", '<input id="q">', "<div>", "</div>", "<", chance=0.3),
            ]
        )()

    def page(self):
        parts = [self.part() for _ in range(self.rng.randrange(7))]
        for _ in range(self.rng.choice([0, 1, 1, 1]) + (self.rng.random() < 0.02 * self.odd)):
            parts.insert(self.rng.randrange(len(parts) + 1), self.grid())
        return f"<!DOCTYPE html>\n<html><body><form method=\"post\">{self.gap().join(parts)}</form></body></html>"


@pytest.mark.parametrize(("seed", "odd"), [(1, 0), (2, 1), (3, 4)])
def test_fuzzed_pages_are_read_as_the_tree_reads_them(spark, seed, odd):
    make = Pages(seed, odd)
    pages = [make.page() for _ in range(700)] + ["", None, "<", "<table>", f'<table id="{GRID_ID}"></table>']
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = df.select("i", extract.is_native("html").alias("native"), extract.parse("html").alias("page")).collect()
    for r in got:
        assert plain(r.page) == as_tree(pages[r.i]), pages[r.i]
    share = sum(r.native for r in got) / len(got)
    assert share > {0: 0.5, 1: 0.2, 4: 0.02}[odd] and share < 1


def test_long_rows_and_lists_break_no_pattern(spark):
    wide = f'<html><table id="{GRID_ID}"><tr><th>h</th></tr><tr>' + "<td><font>x</font></td>" * 60_000 + "</tr></table></html>"
    long = f'<html><table id="{GRID_ID}"><tr><th>h</th></tr>' + ("<tr>" + "<td><font>x</font></td>" * 12 + "</tr>") * 8_000 + "</table></html>"
    many = '<html><select id="a">' + "".join(f'<option value="{k}">name {k}</option>' for k in range(30_000)) + "</select></html>"
    pages = [wide, long, many]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", extract.is_native("html").alias("native"), extract.parse("html").alias("page")).collect()
    assert [r.native for r in sorted(got)] == [False, True, True]
    assert all(plain(r.page) == as_tree(pages[r.i]) for r in got)


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
def test_the_share_of_pages_that_need_a_tree(spark):
    """Rendered pages need none; raw pages with lists and headings all do."""
    site = render.site(spark, str(DATA), "mu")
    assert site.where(~extract.is_native("html")).count() == 0
    raw = spark.read.parquet(f"{DATA}/pages.parquet")
    assert raw.where(extract.is_native("html")).count() == 0
    assert catalog.QUERIES["parser_share"](spark, str(DATA)).count() == 2


def test_the_parser_is_given_no_canonical_page(spark):
    page = f'<html><table id="{GRID_ID}"><tr><th>h</th></tr><tr><td><font>x</font></td></tr></table></html>'
    plan = spark.createDataFrame([(page,)], "html string").select(extract.parse("html").alias("page"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    evaluated = [line for line in text.splitlines() if "ArrowEvalPython" in line]
    assert len(evaluated) == 1 and evaluated[0].count("pythonUDF") == 1 and "CASE WHEN NOT" in evaluated[0]  # once, of what isn't canonical
    assert plan.select(F.get("page.grid", F.lit(0))["cells"][0].alias("x")).first().x == "x"


def test_pagers_stay_short_and_the_site_is_written_once(spark, tmp_path):
    """A leaf of 1,500 rows: each pager names ten pages or so and ends with the last one, and every page is read as before."""
    made = spark.range(1, 1501).selectExpr("cast(id as int) as c_custkey", "concat('C', id) as c_name", "1 as c_nationkey", "'BUILDING' as c_mktsegment")
    made.write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("select 1 as n_nationkey, 'N' as n_name, 0 as n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("select 0 as r_regionkey, 'R' as r_name").write.parquet(f"{tmp_path}/region.parquet")
    for t in ("orders", "lineitem"):
        spark.sql("select 0 as o_orderkey").write.parquet(f"{tmp_path}/{t}.parquet")
    site = render.site(spark, str(tmp_path), "zp")
    grids = site.where("page_no > 0").selectExpr("page_no", "length(html) as n", "(length(html) - length(replace(html, '<a href', ''))) / 7 as links", "regexp_extract(html, '.*<font>([0-9]+)</font>', 1) as last").collect()
    assert sorted(r.page_no for r in grids) == list(range(1, 151)) and max(r.links for r in grids) <= 11 and {r["last"] for r in grids} == {"150"}
    assert site.where("page_no = 0").count() == 4  # a list for each of three levels, and the labels
    assert all(f.endswith(".parquet") for f in site.inputFiles())


def test_a_tag_that_is_cut_by_a_grid_is_left_to_the_tree(spark):
    """What stands on both sides of a construct is never put together to a tag."""
    page = f'<html><body><sp<table id="{GRID_ID}"></table>an id="a">x</span></body></html>'
    got = spark.createDataFrame([(page,)], "html string").select(extract.is_native("html").alias("native"), extract.parse("html").alias("page")).first()
    assert not got.native and plain(got.page) == as_tree(page)


def test_a_page_that_is_asked_for_its_grid_alone_gives_the_same_grid(spark):
    pages = [f'<div><span id="s">x</span><table id="{GRID_ID}"><tr><th>h</th></tr><tr><td><font>a &amp; b</font></td><td></td></tr></table></div>', f'<p><table id="{GRID_ID}"><tr><th>h</th></tr><tr><td><font>a</font></td></tr></table>']
    got = spark.createDataFrame([(p,) for p in pages], "html string").select("html", extract.parse("html", only_grid=True).alias("page")).collect()
    assert [plain(r.page)["grid"] for r in got] == [as_tree(r.html)["grid"] for r in got]
    assert [plain(r.page)["spans"] for r in got if "<p>" not in r.html] == [None]


@pytest.mark.parametrize(("seed", "odd"), [(4, 0), (5, 1), (6, 4)])
def test_fuzzed_grids_are_read_as_the_tree_reads_them(spark, seed, odd):
    make = Pages(seed, odd)
    pages = [make.page() for _ in range(700)] + [f'<table id="{GRID_ID}">{x}</table>' for x in ("", "<tr></tr>", make.pager(), make.row() + make.pager() * 2 + make.row())]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", extract.parse("html", only_grid=True).alias("page")).collect()
    for r in got:
        assert plain(r.page)["grid"] == as_tree(pages[r.i])["grid"], pages[r.i]


def test_ids_of_other_elements_send_no_grid_to_the_tree(spark):
    page = f'<form><input id="a" value="1"><input id="a" value="2"><table id="{GRID_ID}"><tr></tr><tr><td><font>x</font></td></tr></table></form>'
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(extract.is_native("html").alias("whole"), extract.is_native("html", only_grid=True).alias("grid")).first() == (False, True)
    assert plain(df.select(extract.parse("html", only_grid=True).alias("page")).first().page)["grid"] == as_tree(page)["grid"]


def test_rows_of_a_grid_are_read_once(spark, tmp_path):
    """No filter of the planner's reads a page to see whether it has rows."""
    made = spark.createDataFrame([(1, f'<table id="{GRID_ID}"><tr></tr><tr><td><font>x</font></td></tr></table>'), (2, "<p>"), (3, f'<table id="{GRID_ID}"></table>')], "page_no int, html string")
    made.write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    rows = grid.rows(pages.withColumn("page", extract.parse("html", only_grid=True)).drop("html"))
    assert [(r.page_no, r.kind, r.row["cells"][0]) for r in rows.collect()] == [(1, "data", "x")]
    assert rows._jdf.queryExecution().executedPlan().toString().count("split(html") == 1


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
def test_grids_alone_are_those_of_the_site(spark):
    """A query of grids renders no list of nodes."""
    site, grids = render.site(spark, str(DATA), "zp").where("page_no > 0"), render.grids(spark, str(DATA), "zp")
    assert grids.columns == site.columns and grids.where("page_no = 0").isEmpty()
    assert site.exceptAll(grids).isEmpty() and grids.exceptAll(site).isEmpty()
