"""Landed grid pages as a stream: an extension for sites that are crawled continually."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.operators import grid
from leafline.operators.extract import parse

SCHEMA = "values array<string>, page_no int, status int, html string, landed timestamp"


def rows(pages: DataFrame) -> DataFrame:
    """Data rows of pages(SCHEMA), streaming or not: values, page_no, landed, row_ord and the twelve cells.
    Row-wise, so the stream keeps no state."""
    paged = pages.where("status = 200 and page_no > 0").select("values", "page_no", "landed", parse("html").alias("page"))
    return grid.rows(paged).where("kind = 'data'").withColumns(grid.cells(strict=False)).select("values", "page_no", "landed", F.col("row.row_ord").alias("row_ord"), *grid.TAIL)


def once_each(found: DataFrame, late: str = "1 day") -> DataFrame:
    """Rows without those of pages that landed again within late: keys older than that leave the state."""
    return found.withWatermark("landed", late).dropDuplicatesWithinWatermark(["values", "page_no", "row_ord"])


def start(spark: SparkSession, path: str, out: str, checkpoint: str, late: str = "1 day"):
    """Processes all that has landed at path and stops; the next start goes on from there."""
    pages = spark.readStream.schema(SCHEMA).parquet(path)
    return once_each(rows(pages), late).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
