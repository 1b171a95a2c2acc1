"""One level of the descent: the choices on each parent's page become nodes that inherit what it has.

A page's form state is tens of kB, and every child of a page sends the same one back. Nodes carry its digest, of
STATE_BYTES; the states themselves stand once each in a table by digest, which is joined just before a fetch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.operators.extract import explode_options, form_state, options, parse

#: Of a node: what was chosen down to it, the names and positions of that, and the digest of the state to send back.
NODE = ("values", "names", "path", "state_id")
STATE_BYTES = 16


def with_state(pages: DataFrame, strict: bool = True) -> DataFrame:
    """pages(page, ...) with state and state_id, the first bytes of the SHA-256 of its three fields."""
    fields = F.to_json(F.col("state"), {"ignoreNullFields": "false"})
    return pages.withColumn("state", form_state(strict=strict)).withColumn("state_id", F.substring(F.unhex(F.sha2(fields, 256)), 1, STATE_BYTES))


def states(parents: DataFrame) -> DataFrame:
    """state_id and state of each different form state, once."""
    return parents.select("state_id", "state").dropDuplicates(["state_id"])


def slim(parents: DataFrame) -> DataFrame:
    """parents with as much of their pages as the descent still asks for."""
    return parents.withColumn("page", F.struct("page.selects", "page.spans"))


def root(landing: DataFrame, strict: bool = True, tbody: bool = False) -> DataFrame:
    """The node above all posts, with its page. landing: status, html."""
    strings = F.array().cast("array<string>")
    paged = landing.where("status = 200").select(strings.alias("values"), strings.alias("names"), F.array().cast("array<int>").alias("path"), parse("html", tbody).alias("page"))
    return with_state(paged, strict)


def children(parents: DataFrame, select_id: str, strict: bool = True) -> DataFrame:
    """NODE and name of each choice on parents(NODE, page), in page order by path."""
    listed = explode_options(parents.select(*NODE, "page"), options(select_id), strict).withColumnRenamed("value", "_value")
    grown = {"values": "_value", "names": "name", "path": "pos"}
    return listed.select(*[F.concat(F.col(k), F.array(F.col(v))).alias(k) for k, v in grown.items()], "state_id", "name")


def opened(fetched: DataFrame, strict: bool = True, tbody: bool = False) -> DataFrame:
    """NODE, page and state of those whose fetch succeeded, the state being that of the page that they got."""
    return with_state(fetched.where("status = 200").select("values", "names", "path", parse("html", tbody).alias("page")), strict)


def named(df: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Ancestors' names as columns."""
    return df.withColumns({level: F.get("names", F.lit(k)) for k, level in enumerate(levels) if level != "pradesik"})
