"""Where a run resumes: a latch for each level that opens at a name and stays open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def threshold(nodes: DataFrame, name: str, above: Column | None = None) -> DataFrame:
    """One row with p, the least place of a node so named, not before the level above opened. No such
    node: null, and nothing is at or behind it. Places are arrays of positions, compared in order, a prefix
    before what extends it."""
    found = nodes.where(F.col("name") == name)
    if above is not None:
        found = found.where(F.col("path") >= above)
    return found.agg(F.min("path").alias("p"))


def latch(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes of one level at or behind the place where its latch opens; all of them if name is empty.

    nodes are those below kept parents only, so they lie behind the places of the levels above. The place
    is an uncorrelated scalar subquery: a least value is summed in each task, and one array goes to all.
    """
    return nodes if not name else nodes.where(F.col("path") >= threshold(nodes, name).scalar())


def keep_first(nodes: DataFrame) -> DataFrame:
    """The first of the kept nodes: a run does one post only."""
    return nodes.where(F.col("path") == nodes.agg(F.min("path")).scalar())
