"""Grid rows: which are data, what their cells hold, how many pages there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions.scalars import page_count, require
from leafline.plans.specs import OPTIONAL_CELL, TAIL


def rows(pages: DataFrame) -> DataFrame:
    """One row for each grid row of pages(..., page_no, page), in order of row_ord, with its kind.

    A row whose first cell has text is data. Else, on the first page, one with a table in it is the pager
    (only the first such row, and no row behind it counts); any other is ignored.
    """
    pager = F.array_min(F.transform(F.filter("page.grid", lambda r: F.get(r["cells"], F.lit(0)).isNull() & r["has_table"]), lambda r: r["row_ord"]))
    # Outer: of a plain explode the planner makes a filter on the array's size, which parses each page once more to be asked.
    out = pages.withColumn("_pager", F.when(F.col("page_no") == 1, pager)).select("*", F.explode_outer("page.grid").alias("row")).where("row is not null and (_pager is null or row.row_ord <= _pager)")
    kind = F.when(F.get("row.cells", F.lit(0)).isNotNull(), "data").when(F.col("row.row_ord") == F.col("_pager"), "pager").otherwise("ignored")
    return out.withColumn("kind", kind).drop("_pager", "page")


def data_rows(page: str = "page", page_no: str = "page_no") -> Column:
    """The data rows of a page as an array, by the rules of rows()."""
    pager = F.when(F.col(page_no) == 1, pager_row(page)["row_ord"])
    return F.filter(F.col(f"{page}.grid"), lambda r: F.get(r["cells"], F.lit(0)).isNotNull() & (pager.isNull() | (r["row_ord"] <= pager)))


def pager_row(page: str = "page") -> Column:
    """The first row of a page's grid that isn't data and has a table in it, null where there is none."""
    return F.get(F.filter(F.col(f"{page}.grid"), lambda r: F.get(r["cells"], F.lit(0)).isNull() & r["has_table"]), F.lit(0))


def pages_of(first_page: str = "page", strict: bool = True) -> Column:
    """Number of pages that the pager of a leaf's first page shows, one without a pager. A pager whose last
    cell isn't a number raises or, if not strict, gives null."""
    pager = pager_row(first_page)
    return F.when(pager.isNotNull(), page_count(pager["pager"], strict)).otherwise(F.lit(1))


def pager_number(page: str = "page") -> Column:
    """The number that a page's pager ends with, null where there is no pager or no number."""
    return page_count(pager_row(page)["pager"], strict=False)


def cells(strict: bool = True) -> dict[str, Column]:
    """The twelve cells of a data row by name. e-mail may be missing; any other that is raises or, if not
    strict, is null."""
    out = {}
    for k, name in enumerate(TAIL):
        cell = F.get("row.cells", F.lit(k))
        out[name] = F.coalesce(cell, F.lit("")) if k == OPTIONAL_CELL else require(cell, name) if strict else cell
    return out


def rejects(grid_rows: DataFrame) -> DataFrame:
    """Data rows that lack a required cell, for a run that isn't strict."""
    lacks = F.lit(False)
    for k in range(len(TAIL)):
        if k != OPTIONAL_CELL:
            lacks = lacks | F.get("row.cells", F.lit(k)).isNull()
    return grid_rows.where((F.col("kind") == "data") & lacks)
