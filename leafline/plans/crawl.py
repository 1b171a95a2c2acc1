"""The whole extraction of one office as one composition of DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leafline.functions.scalars import constituency_suffix
from leafline.operators import expand, grid
from leafline.operators.extract import failed, label
from leafline.operators.order import order_key
from leafline.operators.paginate import leaf_status
from leafline.operators.resume import keep_first, latch
from leafline.plans.specs import NUMBER_LABEL, REQUIRED_LABEL, SELECT_IDS, STATUS_LABEL, OfficeSpec, ResumeSpec
from leafline.sources.forms import FetchFailed
from leafline.sources.storage import materialize


@dataclass
class Crawl:
    """records: the office's columns, with path, page_no and row_ord for the order of the pages.
    errors: level, values, status of fetches that failed, whose subtrees are left out: landing for the page that
    all starts from, and nothing below it is then read; a null status was never landed. leaves: outcome by leaf.
    rejects: data rows that lack a required cell (only where the run isn't strict). seen: of a run that is watched, the
    counts that the first action on records (or on a table that reads the grids) leaves: grid (asked, failed) and records (rows)."""

    records: DataFrame
    errors: DataFrame
    leaves: DataFrame
    rejects: DataFrame
    seen: dict[str, Observation] = field(default_factory=dict)


@dataclass(frozen=True)
class Progress:
    """Told of each level as soon as its pages are there: its name, and how many were asked for and failed. Counted by
    the job that fetches them, at the cost of no other."""

    tell: Callable[[str, dict[str, int]], None]


def counted(pages: DataFrame) -> tuple[DataFrame, Observation]:
    """pages, counted as an action reads them."""
    seen, ok = Observation(), F.coalesce(F.col("status") == 200, F.lit(False))
    return pages.observe(seen, F.count(F.lit(1)).alias("asked"), F.count_if(~ok).alias("failed")), seen


def _land(pages: DataFrame, level: str, progress: Progress | None, abort: bool) -> DataFrame:
    """Written, since a live page is to be fetched once."""
    if progress:
        pages, seen = counted(pages)
    landed = materialize(pages, f"pages-{level}")
    if progress:
        progress.tell(level, seen.get)
    if abort and (bad := failed(landed).select(*[c for c in ("values", "status") if c in landed.columns]).first()):
        raise FetchFailed(f"the page of {'/'.join(bad['values']) if 'values' in bad else level} has status {bad['status']}")
    return landed


def leaves_of(spec: OfficeSpec, transport, resume: ResumeSpec, strict: bool = True, tbody: bool = False, abort: bool = False, progress: Progress | None = None) -> tuple[DataFrame, list[DataFrame], DataFrame | None]:
    """Leaf nodes with number and reservation_status, the failed fetches above them, and the states that leaves send back.

    A node is dropped before anything below it is fetched. Levels are written where the plan reads them
    twice, to find where a latch opens and to filter by it; others flow through. Where the transport sends form
    states, parsed pages are written, so that each is parsed once for its choices and its state.
    abort: the first failed fetch raises FetchFailed.
    """
    landing = _land(transport.landing(spec), "landing", progress, abort)
    errors = [failed(landing).select(F.lit("landing").alias("level"), F.array().cast("array<string>").alias("values"), "status")]
    kept = lambda parents, what: materialize(expand.slim(parents), f"parsed-{what}") if transport.stateful else parents
    parents = kept(expand.root(landing, strict, tbody), "landing")
    for depth, level in enumerate(spec.levels):
        nodes = expand.children(parents, SELECT_IDS[level], strict)
        if depth == 0 or resume.at(level):
            nodes = materialize(nodes, f"nodes-{level}")
        nodes = latch(nodes, resume.at(level))
        if depth == 0:
            nodes = keep_first(nodes)
        fetched = _land(transport.choose(nodes.drop("name"), spec, depth, expand.states(parents)), level, progress, abort)
        errors.append(failed(fetched).select(F.lit(level).alias("level"), "values", "status"))
        parents = kept(expand.opened(fetched, strict, tbody), level)
    if spec.labels == "optional":
        leaves = parents.withColumns({"number": label(NUMBER_LABEL), "reservation_status": label(STATUS_LABEL)})
    else:
        leaves = parents.withColumns({"number": F.element_at("names", -1), "reservation_status": label(REQUIRED_LABEL, required=strict)})
    leaves = leaves.drop("page", "state").withColumn("number_suffix", constituency_suffix("number"))
    if resume.number and spec.labels == "optional":
        leaves = materialize(leaves.withColumn("name", F.col("number")), "leaves")
        leaves = latch(leaves, resume.number).drop("name")
    return leaves, errors, expand.states(parents) if transport.stateful else None


def crawl(spec: OfficeSpec, transport, resume: ResumeSpec | None = None, strict: bool = True, tbody: bool = False, abort: bool = False, progress: Progress | None = None) -> Crawl:
    """abort: a failed fetch above the grids ends the run with FetchFailed, instead of an error row and a subtree left out.
    A grid page that fails ends its leaf in either case."""
    leaves, errors, states = leaves_of(spec, transport, resume or ResumeSpec(), strict, tbody, abort, progress)
    pages = transport.grid(leaves, spec, strict, tbody, states)
    seen = {}
    if progress:
        pages, seen["grid"] = counted(pages)
    rows = grid.rows(pages.where("status = 200").drop("html"))
    kept = rows.where("kind = 'data'")
    if not strict:
        bad = grid.rejects(rows)
    else:
        bad = rows.where("false")
    records = expand.named(kept, spec.levels).withColumns(grid.cells(strict)).select(*spec.columns, "path", "page_no", F.col("row.row_ord").alias("row_ord"))
    if progress:
        seen["records"] = Observation()
        records = records.observe(seen["records"], F.count(F.lit(1)).alias("rows"))
    every = errors[0]
    for more in errors[1:]:
        every = every.unionByName(more)
    every = every.unionByName(failed(pages).select(F.lit("grid").alias("level"), "values", "status"))
    return Crawl(records, every, leaf_status(pages.select("path", "values", "status")), bad, seen)


def in_page_order(records: DataFrame) -> DataFrame:
    """Rows in the order of a depth-first walk over pages; only a sink that needs it pays for the sort."""
    return records.orderBy(order_key())


def combined(records: dict[str, DataFrame]) -> DataFrame:
    """An extension: records of several offices in one table with office and all nineteen columns."""
    out = None
    for office, df in records.items():
        df = df.drop("path", "page_no", "row_ord").withColumn("office", F.lit(office))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
