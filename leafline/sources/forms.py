"""Live pages by form postback: requests, a session for each task with retries and timeout, chained grid pages."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from http.cookiejar import CookieJar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from leafline.functions import html as H
from leafline.plans.specs import GRID_ID, SELECT_IDS, STATE_FIELDS, TAIL, OfficeSpec
from leafline.sources.pace import Breaker, Pace


class FetchFailed(RuntimeError):
    """A fetch above the grids that failed, in a run that is to end then."""


Sender = Callable[[dict[str, str] | None], tuple[int, str]]


@dataclass(frozen=True)
class HttpOptions:
    """url has no default: a live run names its site. retries apply to any scheme; a request that stalls
    ends after timeout seconds. proxy: for both schemes. pace: when each request may be sent, retries included. failures: after so
    many requests in a row without an answer or with a server's error, a session sends none for cool seconds at
    a time and gives status 0 instead, as for a page that can't be had; 0: never."""

    url: str
    retries: int = 4
    timeout: float = 30.0
    backoff: float = 0.5
    encoding: str = "utf-8"
    proxy: str = ""
    headers: dict[str, str] = field(default_factory=dict)
    pace: Pace | None = None
    failures: int = 0
    cool: float = 30.0

    def session(self) -> Sender:
        """A function of the parameters (none: a GET) that keeps cookies between its calls."""
        handlers = [urllib.request.HTTPCookieProcessor(CookieJar())]
        if self.proxy:
            handlers.append(urllib.request.ProxyHandler({"http": self.proxy, "https": self.proxy}))
        opener = urllib.request.build_opener(*handlers)
        wait = self.pace.gate() if self.pace else None
        breaker = Breaker(self.failures, self.cool)

        def send(parameters: dict[str, str] | None) -> tuple[int, str]:
            data = None if parameters is None else urllib.parse.urlencode(parameters).encode()
            for attempt in range(self.retries + 1):
                if not breaker.closed():
                    return 0, ""
                if wait:
                    wait()
                try:
                    with opener.open(urllib.request.Request(self.url, data, self.headers), timeout=self.timeout) as answer:
                        got = answer.status, answer.read().decode(answer.headers.get_content_charset() or self.encoding, "replace")
                    breaker.tell(True)
                    return got
                except urllib.error.HTTPError as e:
                    breaker.tell(e.code < 500)
                    if e.code < 500 or attempt == self.retries:
                        return e.code, ""
                except OSError:
                    breaker.tell(False)
                    if attempt == self.retries:
                        return 0, ""
                time.sleep(self.backoff * 2**attempt)
            return 0, ""

        return send


def chosen(spec: OfficeSpec, values: list[str]) -> dict[str, str]:
    return {SELECT_IDS[level]: value for level, value in zip(spec.levels, values)}


def postback(spec: OfficeSpec, state: dict[str, str], values: list[str], target: str, argument: str = "") -> dict[str, str]:
    """Parameters of a postback: event, state and all that was chosen so far."""
    sent = {"__EVENTARGUMENT": argument, "__EVENTTARGET": target, "__LASTFOCUS": ""}
    return sent | {name: state[f] for f, name in STATE_FIELDS.items()} | chosen(spec, values)


def submit(spec: OfficeSpec, state: dict[str, str], values: list[str]) -> dict[str, str]:
    """Parameters that ask for the first grid page of a leaf."""
    return postback(spec, state, values, "") | {"btnSubmit": "View"}


def page_state(html: str) -> dict[str, str] | None:
    found = {e.attributes["id"]: e.attributes.get("value", "") for e in reversed(list(H.tree(html).walk())) if e.tag == "input" and "id" in e.attributes}
    return {f: found[name] for f, name in STATE_FIELDS.items()} if all(n in found for n in STATE_FIELDS.values()) else None


def shown(html: str, tbody: bool = False) -> tuple[list[list[str | None]], bool, str]:
    """(cells of the data rows, whether there is a pager, what it ends with) of a grid page."""
    found = [r for e in H.tree(html).walk() if e.tag == "table" and e.attributes.get("id") == GRID_ID for r in H.grid_rows(e, len(TAIL), tbody)]
    pagers = [r["pager"] or "" for r in found if r["cells"][0] is None and r["has_table"]]
    return [r["cells"] for r in found if r["cells"][0] is not None], bool(pagers), pagers[0].strip() if pagers else ""


def grid_pages(spec: OfficeSpec, send: Sender, state: dict[str, str], values: list[str], strict: bool = True, tbody: bool = False, last: int | None = None):
    """(page_no, status, html) of a leaf's pages, none behind the page last. Each page is asked for with the state of the one before,
    so they come one after another; the first that fails is the last.

    The first pager says how many there are. Where it has no number, a strict run raises; any other goes on
    page by page until a pager ends with a number, a page has no pager, or a page shows the rows of the one
    before it (a site that answers beyond its end), which isn't counted. A page without form state raises, or
    the state of the one before is sent again if not strict.
    """
    count, number, before = 0, 1, None
    while (not count or number <= count) and (last is None or number <= last):
        sent = submit(spec, state, values) if number == 1 else postback(spec, state, values, GRID_ID, f"Page${number}")
        status, html = send(sent)
        if status != 200:
            yield number, status, html
            return
        rows, has_pager, shows = shown(html, tbody)
        if not count and number > 1 and rows == before:
            return
        yield number, status, html
        if not count:
            if not has_pager or shows.isdecimal():
                count = max(number, int(shows)) if has_pager else number
            elif strict:
                raise ValueError(f"the pager of {'/'.join(values)} ends with {shows!r}, which is no number")
        own = page_state(html)
        if own is None and strict:
            raise ValueError(f"page {number} of {'/'.join(values)} has no form state")
        state, number, before = own or state, number + 1, rows


class Live:
    """Fetches by an open session in each task. parallel bounds how many sessions there are at once; pages
    that a task has fetched are written before they are used, so a later failure doesn't fetch them again. States are
    joined to what is about to be fetched, by their digests, and go no further. Sessions of HttpOptions with a pace need
    one for as many tasks as parallel, or more."""

    stateful = True

    def __init__(self, spark: SparkSession, session: Callable[[], Sender], parallel: int = 4):
        pace = getattr(getattr(session, "__self__", None), "pace", None)
        if pace and pace.tasks < parallel:
            raise ValueError(f"the pace is for {pace.tasks} tasks, and {parallel} fetch")
        self.spark, self.session, self.parallel = spark, session, parallel

    def landing(self, spec: OfficeSpec) -> DataFrame:
        session = self.session

        def run(batches):
            for batch in batches:
                got = [session()(None) for _ in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in got], pa.int32()), pa.array([h for _, h in got], pa.string())], names=["status", "html"])

        return self.spark.range(0, 1, 1, 1).mapInArrow(run, "status int, html string")

    def _sent(self, nodes: DataFrame, states: DataFrame) -> DataFrame:
        """nodes dealt to as many tasks as there may be sessions, each with the state that it sends as _state."""
        return nodes.join(states.withColumnRenamed("state", "_state"), "state_id").select(*nodes.columns, "_state").repartition(self.parallel)

    def choose(self, frontier: DataFrame, spec: OfficeSpec, depth: int, states: DataFrame) -> DataFrame:
        session = self.session

        def run(batches):
            send = session()
            for batch in batches:
                got = [send(postback(spec, state, values, spec.targets[depth])) for state, values in zip(batch.column("_state").to_pylist(), batch.column("values").to_pylist(), strict=True)]
                yield batch.drop_columns(["_state"]).append_column("status", pa.array([s for s, _ in got], pa.int32())).append_column("html", pa.array([h for _, h in got], pa.string()))

        return self._sent(frontier, states).mapInArrow(run, T.StructType([*frontier.schema, T.StructField("status", T.IntegerType()), T.StructField("html", T.StringType())]))

    def grid(self, leaves: DataFrame, spec: OfficeSpec, strict: bool, tbody: bool, states: DataFrame) -> DataFrame:
        from leafline.operators.extract import parse
        from leafline.sources.storage import materialize

        session = self.session

        def run(batches):
            send = session()
            for batch in batches:
                nodes = batch.drop_columns(["_state"])
                for k, (state, values) in enumerate(zip(batch.column("_state").to_pylist(), batch.column("values").to_pylist(), strict=True)):
                    got = list(grid_pages(spec, send, state, values, strict, tbody))
                    own = nodes.take(pa.array([k] * len(got)))
                    for name, kind, at in (("page_no", pa.int32(), 0), ("status", pa.int32(), 1), ("html", pa.string(), 2)):
                        own = own.append_column(name, pa.array([g[at] for g in got], kind))
                    yield own

        more = [T.StructField("page_no", T.IntegerType()), T.StructField("status", T.IntegerType()), T.StructField("html", T.StringType())]
        return materialize(self._sent(leaves, states).mapInArrow(run, T.StructType([*leaves.schema, *more])), "grid-pages").withColumn("page", parse("html", tbody))
