"""Pages that were landed before, looked up by what had been chosen when they were fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.operators.paginate import HELD, follow
from leafline.sources.storage import materialize

#: page_no 0: the answer to choosing the last of values; 1 and on: grid pages of that leaf.
SCHEMA = "values array<string>, page_no int, status int, html string"


def latest(pages: DataFrame) -> DataFrame:
    """Of each request's pages the one that was landed last: by the column landed if there is one, else, and
    where that is equal, one that succeeded before one that failed, and then by its text."""
    order = F.struct(*[c for c in pages.columns if c == "landed"], (F.col("status") == 200).alias("ok"), "html")
    return pages.groupBy("values", "page_no").agg(F.max_by(F.struct("status", "html"), order).alias("_last")).select("values", "page_no", "_last.*")


class Replay:
    """Answers each request by an equi-join with a table of landed pages (see SCHEMA; a column landed may
    follow). A request that was never landed has no status, one that was landed several times the last answer.
    Both are shuffled by the key; the frontier is held by it, and pages pass by."""

    #: Whether requests send form states.
    stateful = False

    def __init__(self, pages: DataFrame):
        # Looked for in the keys alone, so that pages without repeats, the usual case, aren't shuffled for it.
        repeated = not pages.groupBy("values", "page_no").count().where("count > 1").isEmpty()
        self.pages = materialize(latest(pages), "latest-pages") if repeated else pages.select("values", "page_no", "status", "html")

    def landing(self, spec) -> DataFrame:
        """One row, without a status where no landing page is there."""
        return self.pages.where("size(values) = 0 and page_no = 0").agg(F.first("status").alias("status"), F.first("html").alias("html"))

    def choose(self, frontier: DataFrame, spec, depth: int, states: DataFrame | None = None) -> DataFrame:
        """frontier with status and html of the page that choosing each node gives."""
        found = self.pages.where(f"page_no = 0 and size(values) = {depth + 1}").drop("page_no")
        return frontier.hint(HELD).join(found, "values", "left")

    def grid(self, leaves: DataFrame, spec, strict: bool = True, tbody: bool = False, states: DataFrame | None = None) -> DataFrame:
        """leaves with page_no, status and page of their pages up to the first that failed."""
        return follow(leaves, self.pages.where("page_no > 0"), strict, tbody)
