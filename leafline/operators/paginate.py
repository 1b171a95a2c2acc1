"""Pages of a leaf: the first says how many there are, or the last of those that it leads to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafline.operators.extract import parse
from leafline.operators.grid import pager_number, pager_row, pages_of
from leafline.sources.storage import materialize

#: Pages repeat each other and are a tenth or a hundredth of their size when written, which is what the planner goes by: it would
#: send gigabytes of them through the driver to all tasks.
SHUFFLED = "merge"
#: For the side without pages: it is held by its keys, and pages pass by it one by one, where a merge would sort a task's whole share of them.
HELD = "shuffle_hash"


def _parsed(pages: DataFrame, tbody: bool) -> DataFrame:
    """pages with page, null where the fetch failed, in the place of html."""
    return pages.withColumn("page", F.when(F.col("status") == 200, parse("html", tbody, only_grid=True))).drop("html")


def page_by_page(leaves: DataFrame, pages: DataFrame, tbody: bool = False) -> tuple[DataFrame, DataFrame]:
    """Of leaves(values) whose first pager shows no number: values and _found, the number of pages; and
    values, page_no, status, page of those that were landed, as far as one follows another.

    The first pager with a number ends the search. Where none has one, the last landed page ends the leaf if it has no pager,
    else a page is missing behind it, and counted. Pages are parsed once and written: the search reads
    two small columns of theirs.
    """
    landed = pages.where("page_no > 1").join(leaves.select("values").distinct().hint(HELD), "values", "left_semi")
    order = Window.partitionBy("values").orderBy("page_no")
    # Numbered by the slim keys, so that no page is sorted.
    run = landed.select("values", "page_no").withColumn("_k", F.row_number().over(order)).where("_k = page_no - 1").drop("_k")
    read = _parsed(landed.join(run.hint(HELD), ["values", "page_no"], "left_semi").select("values", "page_no", "status", "html"), tbody)
    seen = materialize(read.withColumns({"_number": pager_number("page"), "_has_pager": pager_row("page").isNotNull()}), "dotted-pages")
    first = F.min_by(F.greatest("page_no", "_number"), F.when(F.col("_number").isNotNull(), F.col("page_no")))
    ends = seen.groupBy("values").agg(first.alias("_first"), F.max("page_no").alias("_last"), F.max_by("_has_pager", "page_no").alias("_more"))
    found = leaves.select("values").distinct().join(ends, "values", "left")
    last, more = F.coalesce("_last", F.lit(1)), F.coalesce("_more", F.lit(True))
    return found.select("values", F.coalesce("_first", last + more.cast("int")).alias("_found")), seen.drop("_number", "_has_pager")


def _later(counted: DataFrame, pages: DataFrame) -> DataFrame:
    """counted(_pages, ...) with page_no from 2 and what pages(values, page_no, status, ...) have, up to the first that fails."""
    more = counted.where("_pages > 1").withColumn("page_no", F.explode(F.sequence(F.lit(2), "_pages"))).drop("_pages")
    # Where a leaf ends is found by the slim columns, so that pages move once.
    asked = more.join(pages.select("values", "page_no", "status").hint(SHUFFLED), ["values", "page_no"], "left")
    bad = asked.where("status is null or status <> 200").groupBy("values").agg(F.min("page_no").alias("_bad"))
    read = more.join(bad, "values", "left").where("_bad is null or page_no <= _bad").drop("_bad")
    return read.join(pages.hint(SHUFFLED), ["values", "page_no"], "left")


def follow(leaves: DataFrame, pages: DataFrame, strict: bool = True, tbody: bool = False) -> DataFrame:
    """leaves(values, ...) with page_no, status, page of the pages that a run reads, from landed pages.

    Each leaf's first page is read, then pages 2 to what its pager shows; the first page that fails ends
    the leaf, those before it stay. A leaf whose first page fails has that page only. A pager without a
    number (links for a part of the pages and dots) raises if strict, else the leaf is followed page by page.
    Every page is parsed once.
    """
    got = pages.where("page_no = 1").select("values", "status", "html").join(leaves.hint(HELD), "values", "right").withColumn("page_no", F.lit(1))
    # Written, since it is read twice and its pages are to be parsed once.
    wanted = materialize(_parsed(got, tbody).withColumn("_pages", F.when(F.col("status") == 200, pages_of("page", strict)).otherwise(1)), "first-pages")
    counted, columns = wanted.drop("page_no", "status", "page"), wanted.drop("_pages").columns
    out = wanted.select(columns).unionByName(_parsed(_later(counted, pages.where("page_no > 1").select("values", "page_no", "status", "html")), tbody).select(columns))
    if strict:
        return out
    dotted = counted.where("_pages is null")
    found, seen = page_by_page(dotted, pages, tbody)
    return out.unionByName(_later(dotted.drop("_pages").join(found.withColumnRenamed("_found", "_pages"), "values"), seen).select(columns))


def leaf_status(pages: DataFrame) -> DataFrame:
    """values, pages_read, complete of each leaf: whether every page that was asked for came. Leaves of equal
    values are told apart by path where pages have it."""
    ok = F.coalesce(F.col("status") == 200, F.lit(False))
    keys = [c for c in ("path", "values") if c in pages.columns]
    return pages.groupBy(*keys).agg(F.sum(ok.cast("long")).alias("pages_read"), F.min(ok).alias("complete"))
