"""spark.read.format("form_pages"): the grid pages of an office, whose filters stop fetches.

    pages.register(spark)
    found = spark.read.format("form_pages").option("office", "zp").option("pages", landed).load()
    pages.records(found.where("district = 'D1' and page_no <= 3"), OFFICES["zp"])

Columns: the office's levels by name, number, reservation_status, path, page_no, status, html. Planning goes down to the
level that split names, on the driver, and every node that is left there is a partition; a task goes on below its node with a
session of its own. A filter on a column is applied as soon as the column is known: on a level's names before anything below
is asked for, on number and reservation_status before the grid, on page_no (an upper bound) before the next page.
Of such filters Spark evaluates none again but those on page_no. A fetch above the grids that fails gives a row with
page_no 0, its status and the names that were known, unless abort is set, which raises.

Pages come from a folder of landed pages (option pages, see land) by default, or live (option url, with those of form_page). A
landed table that is read whole is better joined: plans.crawl does that. This source is for a part of a site.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith

from leafline.operators import extract, grid
from leafline.plans.specs import GRID_ID, NUMBER_LABEL, OFFICES, REQUIRED_LABEL, SELECT_IDS, STATUS_LABEL, OfficeSpec
from leafline.sources import forms
from leafline.sources.forms import FetchFailed

FORMAT = "form_pages"
#: What each filter asks of a value that isn't null.
ASKS = {
    EqualTo: lambda a, b: a == b,
    EqualNullSafe: lambda a, b: a == b,
    In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    StringStartsWith: lambda a, b: a.startswith(b),
    StringEndsWith: lambda a, b: a.endswith(b),
    StringContains: lambda a, b: b in a,
}


def passes(asked: Filter, value) -> bool:
    if isinstance(asked, Not):
        return not passes(asked.child, value)
    return isinstance(asked, IsNotNull) or ASKS[type(asked)](value, asked.value)


def asks_of(asked: Filter) -> str | None:
    """The column that a filter asks about, None for a kind that isn't known here."""
    inner = asked.child if isinstance(asked, Not) else asked
    known = type(inner) in ASKS and inner.value is not None or isinstance(inner, IsNotNull) and inner is asked
    return inner.attribute[0] if known and len(inner.attribute) == 1 else None


def request(values: list[str], page_no: int) -> str:
    """A landed page's key: requests below a node share its beginning."""
    return "".join(f"{v}\x01" for v in values) + f"\x02{page_no:09d}"


def land(pages: DataFrame, path: str) -> None:
    """Writes pages(values, page_no, status, html) for the source: in ranges of their requests, sorted, so that statistics lead
    a lookup to the pages around it."""
    key = F.concat(F.array_join(F.transform("values", lambda v: F.concat(v, F.lit("\x01"))), ""), F.lit("\x02"), F.lpad(F.col("page_no").cast("string"), 9, "0"))
    keyed = pages.select(key.alias("request"), "status", "html")
    keyed.repartitionByRange("request").sortWithinPartitions("request").write.option("parquet.block.size", str(1 << 20)).parquet(path)


class Landed:
    """Answers requests from landed pages; 0 for one that never landed. It counts no state: a landed page is the answer whatever is
    sent back."""

    def __init__(self, spec: OfficeSpec, path: str):
        self.levels, self.pages = [SELECT_IDS[x] for x in spec.levels], ds.dataset(path.removeprefix("file://").removeprefix("file:"), format="parquet")

    def __call__(self, sent: dict[str, str] | None) -> tuple[int, str]:
        values = [sent[x] for x in self.levels if x in sent] if sent else []
        page = 0 if not sent else 1 if "btnSubmit" in sent else int(sent["__EVENTARGUMENT"][5:]) if sent["__EVENTTARGET"] == GRID_ID else 0
        found = self.pages.to_table(columns=["status", "html"], filter=ds.field("request") == request(values, page)).to_pylist()
        return (found[0]["status"], found[0]["html"]) if found else (0, "")


@dataclass
class Node:
    """What was chosen down to here, and the state to send back."""

    values: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    path: list[int] = field(default_factory=list)
    state: dict[str, str] | None = None
    failed: int | None = None


class FormPagesReader(DataSourceReader):
    def __init__(self, spec: OfficeSpec, options, session=None):
        self.spec, self.session, self.filters = spec, session, {}
        self.split = options.get("split", spec.levels[1])
        self.start = options.get("start_post", "")
        self.strict, self.tbody, self.abort = (options.get(k, default).lower() == "true" for k, default in (("strict", "true"), ("tbody", "false"), ("abort", "false")))
        self.pages, self.http = options.get("pages"), None
        if self.split not in spec.levels:
            raise ValueError(f"option split is {self.split!r}, not one of {', '.join(spec.levels)}")
        if session is None and not self.pages:
            self.http = forms.HttpOptions(options["url"], **{k: kind(options[k]) for k, kind in (("retries", int), ("timeout", float), ("backoff", float), ("encoding", str), ("proxy", str)) if k in options}) if "url" in options else None
            if self.http is None:
                raise ValueError("option pages (landed pages) or url (a live site) is missing")

    def opened(self) -> forms.Sender:
        return self.session() if self.session else Landed(self.spec, self.pages) if self.pages else self.http.session()

    def column_of(self, level: str) -> str:
        return "number" if level == "pradesik" else level

    def pushFilters(self, filters):
        for f in filters:
            column = asks_of(f)
            if column in {*map(self.column_of, self.spec.levels), "number", "reservation_status"}:
                self.filters.setdefault(column, []).append(f)
            else:
                if column == "page_no" and isinstance(f, (EqualTo, In, LessThan, LessThanOrEqual)):
                    self.filters.setdefault(column, []).append(f)
                yield f

    def wanted(self, column: str, value) -> bool:
        return all(passes(f, value) for f in self.filters.get(column, ()))

    def last_page(self) -> int | None:
        """Beyond which no page is asked for, None without a bound."""
        bound = {EqualTo: lambda v: v, In: max, LessThanOrEqual: lambda v: v, LessThan: lambda v: v - 1}
        return min((bound[type(f)](f.value) for f in self.filters.get("page_no", ())), default=None)

    def choices(self, page: dict, level: str, above: Node) -> Iterator[Node]:
        """The nodes of a level on a page that the filters leave."""
        for c in dict(page["selects"]).get(SELECT_IDS[level], [])[1:]:
            if self.strict and (c["value"] is None or c["name"] is None):
                raise ValueError(f"a choice of {level} has no value or no text")
            if self.wanted(self.column_of(level), c["name"]):
                yield Node([*above.values, c["value"]], [*above.names, c["name"]], [*above.path, c["pos"] - 1])

    def read_page(self, send: forms.Sender, node: Node, sent: dict[str, str] | None) -> dict | None:
        """The parsed page of a node, which gets its state; None for one that failed."""
        status, html = send(sent)
        if status != 200:
            if self.abort:
                raise FetchFailed(f"the page of {'/'.join(node.values) or 'landing'} has status {status}")
            node.failed = status
            return None
        page = extract._page(html, self.tbody)
        node.state = forms.page_state(html)
        if node.state is None and self.strict:
            raise ValueError(f"the page of {'/'.join(node.values) or 'landing'} has no form state")
        return page

    def below(self, send: forms.Sender, node: Node, sent: dict[str, str] | None, until: int) -> Iterator[tuple[Node, dict | None]]:
        """Nodes of that depth below node, failed ones of any depth, and the pages that led to them."""
        page, depth = self.read_page(send, node, sent), len(node.values)
        if page is None or depth == len(self.spec.levels):
            yield node, page
            return
        level = self.spec.levels[depth]
        children = list(self.choices(page, level, node)) if depth else self.first_post(page, node)
        for child in children:
            child.state = node.state
            if depth + 1 == until:
                yield child, None
            else:
                yield from self.below(send, child, self.sent(child), until)

    def sent(self, node: Node) -> dict[str, str]:
        return forms.postback(self.spec, node.state, node.values, self.spec.targets[len(node.values) - 1])

    def first_post(self, page: dict, root: Node) -> list[Node]:
        """A run does the post that it starts with and no other; the filters come after that."""
        held, self.filters = self.filters, {}
        posts = [n for n in self.choices(page, self.spec.levels[0], root) if not self.start or n.names[0] == self.start][:1]
        self.filters = held
        return [n for n in posts if self.wanted(self.spec.levels[0], n.names[0])]

    def partitions(self):
        until = self.spec.levels.index(self.split) + 1
        return [InputPartition(node) for node, _ in self.below(self.opened(), Node(), None, until)]

    def row(self, node: Node, number: str | None, status_label: str | None, page_no: int, status: int, html: str) -> tuple:
        names = [*node.names, *[None] * (len(self.spec.levels) - len(node.names))]
        return (*[n for n, level in zip(names, self.spec.levels) if level != "pradesik"], number, status_label, node.path, page_no, status, html)

    def labels(self, node: Node, page: dict) -> tuple[str, str]:
        spans = dict(page["spans"])
        if self.spec.labels == "optional":
            return spans.get(NUMBER_LABEL) or "", spans.get(STATUS_LABEL) or ""
        if spans.get(REQUIRED_LABEL) is None and self.strict:
            raise ValueError(f"missing {REQUIRED_LABEL}")
        return node.names[-1], spans.get(REQUIRED_LABEL) or ""

    def failure(self, node: Node) -> Iterator[tuple]:
        """The row of a fetch that failed, if no filter asks for a column that isn't known of it."""
        whole = self.spec.labels == "required" and len(node.names) == len(self.spec.levels)
        known = {self.column_of(level) for level, _ in zip(self.spec.levels, node.names, strict=False)} | {"page_no"}
        if self.filters.keys() <= known:
            yield self.row(node, node.names[-1] if whole else None, None, 0, node.failed, "")

    def read(self, partition):
        node: Node = partition.value
        if node.failed is not None:
            yield from self.failure(node)
            return
        send = self.opened()
        for leaf, page in self.below(send, node, self.sent(node), len(self.spec.levels) + 1):
            if leaf.failed is not None:
                yield from self.failure(leaf)
                continue
            number, status_label = self.labels(leaf, page)
            if self.wanted("number", number) and self.wanted("reservation_status", status_label):
                for page_no, status, html in forms.grid_pages(self.spec, send, leaf.state, leaf.values, self.strict, self.tbody, self.last_page()):
                    yield self.row(leaf, number, status_label, page_no, status, html)


class FormPages(DataSource):
    """Options: office (required); pages or url; split (a level, by default the second), start_post, strict, tbody, abort; retries,
    timeout, backoff, encoding, proxy of a live site."""

    @classmethod
    def name(cls):
        return FORMAT

    @property
    def spec(self) -> OfficeSpec:
        if self.options.get("office") not in OFFICES:
            raise ValueError(f"option office is {self.options.get('office')!r}, not one of {', '.join(OFFICES)}")
        return OFFICES[self.options["office"]]

    def schema(self):
        text = [*self.spec.ancestors, "number", "reservation_status"]
        return T.StructType([*[T.StructField(c, T.StringType()) for c in text], T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("page_no", T.IntegerType()), T.StructField("status", T.IntegerType()), T.StructField("html", T.StringType())])

    def reader(self, schema):
        return FormPagesReader(self.spec, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FormPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(found: DataFrame, spec: OfficeSpec, strict: bool = True, tbody: bool = False) -> DataFrame:
    """The office's columns, path, page_no, row_ord of the data rows on the source's pages. Filter the pages, not the records, to
    stop fetches: the parser stands between."""
    parsed = found.where("status = 200 and page_no > 0").withColumn("page", extract.parse("html", tbody)).drop("html")
    return grid.rows(parsed).where("kind = 'data'").withColumns(grid.cells(strict)).select(*spec.columns, "path", "page_no", F.col("row.row_ord").alias("row_ord"))
