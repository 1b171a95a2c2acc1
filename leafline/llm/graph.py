"""Connected components by alternating large-star and small-star steps, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import materialize


def _digest(edges: DataFrame) -> tuple[int, int]:
    """Count and order-free hash of the edges: two numbers for the driver."""
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of edges(u, v): the least node that can be reached.

    The minimum over a node's neighbours is aggregated map-side before the shuffle; the join that
    follows is one that adaptive execution can split where one node holds a large share of the edges.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    seen = _digest(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = materialize(small.where("u <> v").distinct(), "components")
        if (after := _digest(now)) == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
