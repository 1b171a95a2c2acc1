"""The order of a depth-first walk over pages as one binary key, and row numbers in that order without one task that sorts all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.sources.storage import materialize

#: In front of each position of a path, and behind the last: a path stands before those that go on from it.
STEP, END = "01", "00"


def _hex(number: Column) -> Column:
    return F.lpad(F.hex(number), 8, "0")


def _steps(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda p: F.concat(F.lit(STEP), _hex(p))), "")


def order_key(path: str = "path", page_no: str = "page_no", row_ord: str = "row_ord") -> Column:
    """Binary, compared byte by byte as (path, page_no, row_ord) are compared: for range partitions, and for the least and
    greatest key that Parquet keeps of each row group. Positions are whole numbers from 0."""
    return F.unhex(F.concat(_steps(F.col(path)), F.lit(END), _hex(F.col(page_no)), _hex(F.col(row_ord))))


def below(node: list[int], key: str = "order_key") -> Column:
    """Rows of a node's subtree, as two comparisons with constants, which the scan of a sorted table is pruned by."""
    first = "".join(f"{STEP}{p:08X}" for p in node)
    # Whatever goes on from the node begins with END or STEP.
    return (F.col(key) >= F.lit(bytes.fromhex(first))) & (F.col(key) < F.lit(bytes.fromhex(first + "02")))


def in_ranges(records: DataFrame, what: str = "ordered") -> DataFrame:
    """records with order_key, written in ranges of it, each sorted and numbered by _part."""
    keyed = records.withColumn("order_key", order_key()).repartitionByRange("order_key").sortWithinPartitions("order_key")
    # Written, since ranges are found by a sample: read again, they are the same ones.
    return materialize(keyed.withColumn("_part", F.spark_partition_id()), what)


def with_row_number(records: DataFrame, name: str = "row_no") -> DataFrame:
    """records with order_key and their place in the order of the pages, from 1. Ranges are counted, and each row's number is its
    place in its range behind those before: what meets in one task is a range, or the counts of the ranges."""
    parts = in_ranges(records)
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).drop("_n")
    own = F.row_number().over(Window.partitionBy("_part").orderBy("order_key"))
    return parts.withColumn("_own", own).join(before, "_part").withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_own")).drop("_part", "_own", "_before")
