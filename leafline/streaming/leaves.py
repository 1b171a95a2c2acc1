"""Leaves whose pages land on a stream: in any order, with gaps, more than once, or never.

Of each leaf state is kept: the page that is next, how many pages there are once the first has told, and pages that
landed ahead of their turn, with their data rows. A page's rows are released when all before it have been,
so a page that fails keeps back those behind it, as in a run that asks page by page. The last landing of a page that is still
waited for counts. A leaf ends complete with its last page, or incomplete when nothing of it has landed for the time
give_up; pages that land after that go on where it stopped, and its later outcome replaces the earlier one. State of a leaf
that ended goes after the time forget; until then its pages may land again without being released twice.

Leaves are put together in buckets, which are the keys: to call a key's function costs milliseconds, and so do its questions to the
state, each of which is a message to the JVM. A bucket's leaves but their waiting pages are one value, which is read and written
once in a batch. It has one timer, for the first of its leaves, in steps of a 24th of the lesser time: a leaf is given up or
forgotten by so much later at most.

Time is that of the column landed (event time): a replay of the same landings ends alike.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from leafline.operators import extract, grid
from leafline.streaming.landed import SCHEMA

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keys of the state. A batch's landings of a bucket are in a worker's memory at once. Another number needs a new checkpoint.
BUCKETS = 2048
#: leaf: the JSON of its values. A released page has rows, an outcome pages_read and complete.
RELEASED = "leaf string, page_no int, rows string, pages_read long, complete boolean, at timestamp"
ROWS = "array<struct<row_ord:int,cells:array<string>>>"


class Leaves(StatefulProcessor):
    """give_up and forget in milliseconds, as are all times in the state."""

    def __init__(self, give_up: int, forget: int):
        self.give_up, self.forget = give_up, forget
        self.step = max(1, min(give_up, forget) // 24)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # alarm: when the bucket's timer goes off. places, JSON: of each leaf the page that is next, how many there are, from when on the leaf
        # is forgotten or, unless it ended, given up, whether it ended, and how many of its pages are in ahead.
        self.bucket = handle.getValueState("bucket", "alarm long, places string")
        self.ahead = handle.getMapState("ahead", "leaf string, page_no int", "status int, landed long, pages int, rows string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        landed: dict[str, list[tuple]] = {}
        for frame in rows:
            pages = [None if pd.isna(n) else int(n) for n in frame["pages"]]
            for leaf, page_no, *page in zip(frame["leaf"], frame["page_no"].tolist(), frame["status"].tolist(), frame["moment"].tolist(), pages, frame["rows"], strict=True):
                landed.setdefault(leaf, []).append((page_no, tuple(page)))
        known = self.bucket.get()
        alarm, places = (known[0], json.loads(known[1])) if known else (None, {})
        due, out, changed = alarm, [], False
        for leaf, pages in landed.items():
            if (place := self._land(leaf, places.get(leaf), pages, out)) is not None:
                places[leaf], changed = place, True
                due = place[2] if due is None else min(due, place[2])
        if changed:
            due = self._stepped(due)
            if due != alarm:
                if alarm is not None:
                    self.handle.deleteTimer(alarm)
                self.handle.registerTimer(due)
            self.bucket.update((due, json.dumps(places)))
        if out:
            yield self._frame(out)

    def _land(self, leaf: str, place: list | None, landed: list[tuple], out: list[tuple]) -> tuple | None:
        """The leaf's place after pages landed, None where it stays; what is released is put to out."""
        next_, pages, wake, ended, held = place or (1, None, None, False, 0)
        latest, came, was_complete = max(page[1] for _, page in landed), {}, pages is not None and next_ > pages
        for page_no, page in landed:
            if page_no >= next_ and (page_no not in came or self._before(came[page_no], page)):
                came[page_no] = page
        arrived, stored = bool(came), set()
        if held:
            for page_no, page in came.items():
                if (before := self.ahead.getValue((leaf, page_no))) is not None:
                    stored.add(page_no)
                    if not self._before(tuple(before), page):
                        came[page_no] = tuple(before)
        while pages is None or next_ <= pages:
            page = came.get(next_)
            if page is None and held and (before := self.ahead.getValue((leaf, next_))) is not None:
                stored.add(next_)
                page = tuple(before)
            if page is None or page[0] != 200:
                break
            pages = page[2] if next_ == 1 else pages
            out.append((leaf, next_, page[3], None, None, latest))
            came.pop(next_, None)
            if next_ in stored:
                self.ahead.removeKey((leaf, next_))
                held -= 1
            next_ += 1
        # Only what lands ahead of its turn is kept.
        for page_no, page in came.items():
            self.ahead.updateValue((leaf, page_no), page)
            held += page_no not in stored
        complete = pages is not None and next_ > pages
        if complete and not was_complete:
            out.append((leaf, None, None, pages, True, latest))
        # Pages that change nothing, of a leaf that has ended, don't put off that it is forgotten.
        if arrived or not ended:
            return next_, pages, latest + (self.forget if complete else self.give_up), complete, held
        return None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out, kept, lost = timerValues.getCurrentWatermarkInMs(), [], {}, set()
        for leaf, (next_, pages, wake, ended, held) in json.loads(self.bucket.get()[1]).items():
            if wake <= now and not ended:
                out.append((leaf, None, None, next_ - 1, False, wake))
                wake, ended = wake + self.forget, True
            if wake > now:
                kept[leaf] = next_, pages, wake, ended, held
            elif held:
                lost.add(leaf)
        if lost and not kept:
            self.ahead.clear()
        elif lost:
            for page in [k for k in self.ahead.keys() if k[0] in lost]:
                self.ahead.removeKey(page)
        if kept:
            due = self._stepped(min(place[2] for place in kept.values()))
            self.handle.registerTimer(due)
            self.bucket.update((due, json.dumps(kept)))
        else:
            self.bucket.clear()
        if out:
            yield self._frame(out)

    def _stepped(self, due: int) -> int:
        return -(-due // self.step) * self.step

    def close(self) -> None:
        pass

    @staticmethod
    def _before(held: tuple, new: tuple) -> bool:
        """Whether new is the later landing; of two at once one that succeeded is."""
        return (held[1], held[0] == 200) < (new[1], new[0] == 200)

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        leaf, page_no, rows, pages_read, complete, at = zip(*out, strict=True)
        typed = {"page_no": pd.array(page_no, "Int32"), "pages_read": pd.array(pages_read, "Int64"), "complete": pd.array(complete, "boolean")}
        return pd.DataFrame({"leaf": leaf, "page_no": typed["page_no"], "rows": rows, "pages_read": typed["pages_read"], "complete": typed["complete"], "at": np.array(at, "int64")})


def pages_of(landed: DataFrame, tbody: bool = False) -> DataFrame:
    """leaf, page_no, status, landed, pages (of a first page, what its pager shows), rows (JSON) of grid pages(SCHEMA)."""
    paged = landed.where("page_no > 0").select(F.to_json("values").alias("leaf"), "page_no", "status", "landed", F.when(F.col("status") == 200, extract.parse("html", tbody, only_grid=True)).alias("page"))
    rows = F.transform(grid.data_rows(), lambda r: F.struct(r["row_ord"].alias("row_ord"), r["cells"].alias("cells")))
    return paged.select("leaf", "page_no", "status", "landed", F.when(F.col("page_no") == 1, grid.pages_of("page", strict=False)).alias("pages"), F.to_json(rows, {"ignoreNullFields": "false"}).alias("rows"))


def released(landed: DataFrame, late: str = "1 hour", give_up: str = "1 day", forget: str = "7 days", tbody: bool = False) -> DataFrame:
    """RELEASED of a stream of grid pages(SCHEMA): pages in the order of their leaf, and outcomes. Pages that land more than late
    behind the newest are left out. A first page whose pager shows no number leaves its leaf without an end: it is given up in time."""
    millis = lambda text: int(pd.Timedelta(text) / pd.Timedelta(milliseconds=1))
    keyed = pages_of(landed, tbody).withWatermark("landed", late).withColumns({"bucket": F.pmod(F.xxhash64("leaf"), F.lit(BUCKETS)), "moment": F.unix_millis("landed")})
    found = keyed.groupBy("bucket").transformWithStateInPandas(Leaves(millis(give_up), millis(forget)), RELEASED.replace("at timestamp", "at long"), "append", "EventTime")
    return found.withColumn("at", F.timestamp_millis("at"))


def records_of(found: DataFrame, strict: bool = True) -> DataFrame:
    """values, page_no, row_ord and the twelve cells of released pages."""
    rows = found.where("page_no is not null").select(_values(), "page_no", F.explode(F.from_json("rows", ROWS)).alias("row"))
    return rows.withColumns(grid.cells(strict)).select("values", "page_no", F.col("row.row_ord").alias("row_ord"), *grid.TAIL)


def outcomes_of(found: DataFrame) -> DataFrame:
    """values, pages_read, complete of each leaf that has ended, its last outcome."""
    ended = found.where("pages_read is not null")
    last = F.max_by(F.struct("pages_read", "complete"), F.struct("at", "pages_read", "complete")).alias("_last")
    return ended.groupBy("leaf").agg(last).select(_values(), "_last.*")


def _values() -> Column:
    return F.from_json("leaf", "array<string>").alias("values")


def start(spark: SparkSession, path: str, out: str, checkpoint: str, files: int = 1000, **times: str):
    """Processes all that has landed at path (Parquet of SCHEMA) and stops; the next start goes on from there. Needs a state store
    with timers, which it sets for the session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    pages = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(path)
    return released(pages, **times).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
