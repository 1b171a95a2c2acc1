"""A page as one struct, parsed once, and the columns that are read from it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.functions import canonical
from leafline.functions import html as H
from leafline.functions.scalars import require
from leafline.plans.specs import GRID_ID, STATE_FIELDS, TAIL

OPTION = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("value", T.StringType()), T.StructField("name", T.StringType())])
ROW = T.StructType([T.StructField("row_ord", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType())), T.StructField("has_table", T.BooleanType()), T.StructField("pager", T.StringType())])
PAGE = T.StructType(
    [
        T.StructField("inputs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("selects", T.MapType(T.StringType(), T.ArrayType(OPTION))),
        T.StructField("spans", T.MapType(T.StringType(), T.StringType())),
        T.StructField("grid", T.ArrayType(ROW)),
        T.StructField("title", T.StringType()),
        T.StructField("h1", T.StringType()),
        T.StructField("nav", T.ArrayType(OPTION)),
    ]
)


#: Elements that a page is asked about.
ASKED = {"input", "select", "span", "table", "title", "h1", "nav"}


def _page(text: str | None, tbody: bool) -> dict:
    inputs: dict[str, str] = {}
    selects: dict[str, list[dict]] = {}
    spans: dict[str, str] = {}
    grid: list[dict] = []
    heads: dict[str, str | None] = {}
    nav: list[dict] = []
    for e in H.tree(text).walk():
        if e.tag not in ASKED:
            continue
        name = e.attributes.get("id")
        if e.tag == "input" and name and "value" in e.attributes:
            inputs.setdefault(name, e.attributes["value"])
        elif e.tag == "select" and name:
            selects.setdefault(name, []).extend(e.elements("option"))
        elif e.tag == "span" and name and name not in spans and (texts := e.texts()):
            spans[name] = texts[0]
        elif e.tag == "table" and name == GRID_ID:
            grid += H.grid_rows(e, len(TAIL), tbody)
        elif e.tag in ("title", "h1") and e.tag not in heads and (texts := e.texts()):
            heads[e.tag] = texts[0]
        elif e.tag == "nav":
            nav += [{"pos": 0, "value": a.attributes.get("href"), "name": H.first(a.all_texts())} for ul in e.elements("ul") for li in ul.elements("li") for a in li.elements("a")]
    for k, item in enumerate(nav):
        item["pos"] = k
    lists = {name: H.option_list(choices) for name, choices in selects.items()}
    return {"inputs": list(inputs.items()), "selects": list(lists.items()), "spans": list(spans.items()), "grid": grid, "title": heads.get("title"), "h1": heads.get("h1"), "nav": nav}


def _parser(tbody: bool):
    option = pa.struct([("pos", pa.int32()), ("value", pa.string()), ("name", pa.string())])
    row = pa.struct([("row_ord", pa.int32()), ("cells", pa.list_(pa.string())), ("has_table", pa.bool_()), ("pager", pa.string())])
    text = pa.map_(pa.string(), pa.string())
    kind = pa.struct([("inputs", text), ("selects", pa.map_(pa.string(), pa.list_(option))), ("spans", text), ("grid", pa.list_(row)), ("title", pa.string()), ("h1", pa.string()), ("nav", pa.list_(option))])

    @F.arrow_udf(PAGE)
    def parse(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else _page(p, tbody) for p in pages.to_pylist()], kind)

    # Not to be evaluated again by filters that are pushed below it.
    return parse.asNondeterministic()


def parse(html: Column | str, tbody: bool = False, only_grid: bool = False) -> Column:
    """The page struct. tbody: rows within a tbody count as rows of the grid. only_grid: nothing but the grid is asked for, and
    what else a page has may be missing.

    Canonical pages are read by the JVM; the tree parser in Python gets those alone that aren't, and nulls for the others.
    """
    html = F.col(html) if isinstance(html, str) else html
    tree = _parser(tbody)(F.when(~is_native(html, only_grid), F.coalesce(html, F.lit(""))))
    native, none = canonical.parts(html), F.lit(None).cast("string")
    maps = [(F.lit(None) if only_grid else F.map_from_entries(native[k])).alias(k) for k in ("inputs", "selects", "spans")]
    own = F.struct(*maps, native["grid"].alias("grid"), none.alias("title"), none.alias("h1"), F.array().cast(T.ArrayType(OPTION)).alias("nav"))
    # The tree stands in it once: an expression that isn't deterministic is evaluated wherever it stands.
    return F.coalesce(tree, own.cast(PAGE))


def heading(html: Column | str) -> Column:
    """A page's first h1 that has text of its own: its first text node, with character references as they stand in the page."""

    @F.arrow_udf(T.StringType())
    def read(pages: pa.Array) -> pa.Array:
        found = (H.first(texts[0] for e in H.tree(p, decode=str).walk() if e.tag == "h1" and (texts := e.texts())) for p in pages.to_pylist())
        return pa.array(list(found), pa.string())

    return read.asNondeterministic()(F.col(html) if isinstance(html, str) else html)


def is_native(html: Column | str, only_grid: bool = False) -> Column:
    """Whether a page is read without Python: its share among a table's pages tells what parsing costs."""
    return F.coalesce(canonical.is_canonical(F.col(html) if isinstance(html, str) else html, only_grid), F.lit(False))


def form_state(page: str = "page", strict: bool = True) -> Column:
    """The three hidden fields that every postback must send back."""
    value = lambda name: F.try_element_at(F.col(f"{page}.inputs"), F.lit(name))
    return F.struct(*[(require(value(name), name) if strict else value(name)).alias(field) for field, name in STATE_FIELDS.items()])


def options(select_id: str, page: str = "page") -> Column:
    """Choices of a dropdown without the first, which is a placeholder; empty where there is no such dropdown."""
    return without_first(F.coalesce(F.try_element_at(F.col(f"{page}.selects"), F.lit(select_id)), F.array().cast(T.ArrayType(OPTION))))


def without_first(choices: Column) -> Column:
    return F.slice(choices, 2, F.greatest(F.size(choices) - 1, F.lit(0)))


def has_select(select_id: str, page: str = "page") -> Column:
    return F.map_contains_key(F.col(f"{page}.selects"), select_id)


def label(span_id: str, page: str = "page", required: bool = False) -> Column:
    """First text of a span: '' where an optional one is missing, an error where a required one is."""
    text = F.try_element_at(F.col(f"{page}.spans"), F.lit(span_id))
    return require(text, span_id) if required else F.coalesce(text, F.lit(""))


def only_ok(pages: DataFrame) -> DataFrame:
    return pages.where("status = 200")


def failed(pages: DataFrame) -> DataFrame:
    """Pages that the status guard turns away; a missing status is a failure."""
    return pages.where("status is null or status <> 200")


def explode_options(df: DataFrame, choices: Column, strict: bool = True) -> DataFrame:
    """df with pos, value, name of each choice, pos counted from 0 after the placeholder.
    strict raises for a choice without value or text."""
    out = df.select("*", F.posexplode(choices).alias("pos", "_choice"))
    read = lambda f: require(F.col(f"_choice.{f}"), f"option {f}") if strict else F.col(f"_choice.{f}")
    return out.withColumns({"value": read("value"), "name": read("name")}).drop("_choice")
