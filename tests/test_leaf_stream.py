"""Pages that land in any order give the rows and outcomes of a run that asks for them in turn."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_crawl import PAGER, person, table

from leafline.operators import grid
from leafline.operators.paginate import follow, leaf_status
from leafline.streaming import leaves
from leafline.streaming.landed import SCHEMA

START = 1_700_000_000


def site():
    """{leaf: pages as (status, html)}; None never lands."""
    ok = lambda k, n, pages: (200, table(person(f"{k}.{n}"), *[PAGER.format(pages)] * (n == 1 and pages > 1), person(f"{k}.{n}.behind")))
    out = {f"whole{k}": [ok(k, n, k) for n in range(1, k + 1)] for k in (1, 2, 5)}
    out["gap"] = [ok("g", n, 4) if n != 3 else None for n in range(1, 5)]
    out["failed"] = [ok("f", n, 4) if n != 2 else (500, "") for n in range(1, 5)]
    out["first"] = [(404, ""), ok("x", 2, 2)]
    return out


def landings(rng):
    """(leaf, page_no, status, html, second), every page in its own time and some again."""
    rows = [(leaf, n, *page, rng.randrange(2000)) for leaf, own in site().items() for n, page in enumerate(own, 1) if page]
    rows += [(*r[:4], r[4] + rng.randrange(900)) for r in rows if rng.random() < 0.4]
    rows += [(r[0], r[1], 503, "", r[4] - 1 - rng.randrange(50)) for r in rows if r[2] == 200 and rng.random() < 0.3]  # a failure before a success
    rng.shuffle(rows)
    return rows


def land(spark, at, rows):
    made = spark.createDataFrame([([leaf], n, status, html, START + second) for leaf, n, status, html, second in rows], "values array<string>, page_no int, status int, html string, second long")
    made.withColumn("landed", F.col("second").cast("timestamp")).select("values", "page_no", "status", "html", "landed").coalesce(1).write.mode("append").parquet(at)


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_landings_give_what_a_run_reads(spark, tmp_path, seed):
    at, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    rng = random.Random(seed)
    rows = landings(rng)
    for k in range(3):  # three files, a batch each; the last behind a restart
        land(spark, at, rows[k::3])
    leaves.start(spark, at, out, mark, files=1).awaitTermination()
    land(spark, at, [("later", 2, 200, "", 900_000)])
    leaves.start(spark, at, out, mark, files=1).awaitTermination()
    found = spark.read.schema(leaves.RELEASED).parquet(out)

    pages = spark.createDataFrame([([leaf], n, *page) for leaf, own in site().items() for n, page in enumerate(own, 1) if page], "values array<string>, page_no int, status int, html string")
    read = follow(pages.where("page_no = 1").select("values"), pages).cache()
    rows_of = lambda df: sorted((tuple(r["values"]), r.page_no, r.row_ord, r.sr_no) for r in df.select("values", "page_no", "row_ord", "sr_no").collect())
    want = grid.rows(read.where("status = 200")).where("kind = 'data'").withColumns(grid.cells()).withColumn("row_ord", F.col("row.row_ord"))
    assert rows_of(leaves.records_of(found)) == rows_of(want)  # each once, though pages landed twice
    outcomes = lambda df: sorted((tuple(r["values"]), r.pages_read, r.complete) for r in df.collect())
    assert outcomes(leaves.outcomes_of(found)) == outcomes(leaf_status(read.select("values", "status")))


def test_a_leaf_that_was_given_up_goes_on_and_is_forgotten_in_time(spark, tmp_path):
    at, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    day = 86_400
    times = {"late": "1 hour", "give_up": "1 day", "forget": "3 days"}
    steps = [
        [("a", 1, 200, table(person(1), PAGER.format(2)), 0)],
        [("clock", 2, 200, "", 2 * day)],  # a is given up
        [("a", 2, 200, table(person(2)), 2 * day + 60)],  # and goes on
        [("a", 1, 200, table(person(1), PAGER.format(2)), 2 * day + 120), ("clock", 3, 200, "", 2 * day + 180)],  # known, so not released again
        [("clock", 4, 200, "", 9 * day)],  # a is forgotten
        [("a", 2, 200, table(person(2)), 9 * day + 60), ("clock", 5, 200, "", 12 * day)],  # a leaf of its own now
    ]
    for rows in steps:
        land(spark, at, rows)
        leaves.start(spark, at, out, mark, **times).awaitTermination()
    found = spark.read.schema(leaves.RELEASED).parquet(out).where("leaf = '[\"a\"]'")
    told = [(r.page_no, r.pages_read, r.complete) for r in found.orderBy("at", "pages_read", "page_no").collect()]
    assert told == [(1, None, None), (None, 1, False), (2, None, None), (None, 2, True), (None, 0, False)]


class Held:
    """State of one key in the place of Spark's, which counts what it is asked."""

    def __init__(self):
        self.asked, self.timers, self.values, self.maps = 0, set(), {}, {}

    def getValueState(self, name, schema):
        return Value(self, name)

    def getMapState(self, name, key, schema):
        return Entries(self, name)

    def registerTimer(self, at):
        self.asked += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.asked += 1
        self.timers.remove(at)


class Value:
    def __init__(self, of, name):
        self.of, self.name = of, name

    def get(self):
        self.of.asked += 1
        return self.of.values.get(self.name)

    def update(self, value):
        self.of.asked += 1
        self.of.values[self.name] = value

    def clear(self):
        self.of.asked += 1
        self.of.values.pop(self.name, None)


class Entries:
    def __init__(self, of, name):
        self.of, self.held = of, of.maps.setdefault(name, {})

    def getValue(self, key):
        self.of.asked += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.of.asked += 1
        self.held[key] = value

    def removeKey(self, key):
        self.of.asked += 1
        del self.held[key]

    def keys(self):
        self.of.asked += 1
        return iter(list(self.held))

    def clear(self):
        self.of.asked += 1
        self.held.clear()


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def told(frames):
    return sorted((r.leaf, r.pages_read, r.complete, r.at) for f in frames for r in f.itertuples() if not pd.isna(r.pages_read))


def frame(*rows):
    return pd.DataFrame(rows, columns=["leaf", "page_no", "status", "moment", "pages", "rows"])


def test_a_bucket_of_leaves_asks_the_state_a_few_times():
    """What came of 300 leaves takes as many messages as what came of one, but for pages that wait."""
    held, stream = Held(), leaves.Leaves(24_000, 48_000)
    stream.init(held)
    out = list(stream.handleInputRows((0,), iter([frame(*[(f"l{k}", n, 200, 1000 + k, 2 if n == 1 else None, "[]") for k in range(300) for n in (2, 1)])]), Clock(0)))
    assert told(out) == sorted((f"l{k}", 2, True, 1000 + k) for k in range(300)) and sum(f.page_no.notna().sum() for f in out) == 600
    assert held.asked <= 3 and len(held.timers) == 1
    out = list(stream.handleInputRows((0,), iter([frame(("l7", 1, 200, 1500, 2, "[]"), ("new", 2, 200, 1500, None, "[]"))]), Clock(0)))
    assert out == [] and held.asked <= 8 and list(held.maps["ahead"]) == [("new", 2)]


def test_leaves_of_a_bucket_go_in_their_own_time():
    held, stream = Held(), leaves.Leaves(24_000, 48_000)
    stream.init(held)
    rows = [("whole", 1, 200, 0, 1, "[]"), ("gap", 1, 200, 500, 3, "[]"), ("gap", 3, 200, 500, None, "[]"), ("late", 2, 200, 30_000, None, "[]")]
    assert told(stream.handleInputRows((0,), iter([frame(*rows)]), Clock(0))) == [("whole", 1, True, 0)]
    go = lambda now: (held.timers.remove(at := min(held.timers)), told(stream.handleExpiredTimer((0,), Clock(now), None)), at)[1:]
    assert go(25_000) == ([("gap", 1, False, 24_500)], 25_000)  # given up; the others stay
    assert go(50_000) == ([], 48_000)  # whole is forgotten
    assert go(60_000) == ([("late", 0, False, 54_000)], 54_000)
    assert list(held.maps["ahead"]) == [("gap", 3), ("late", 2)]
    assert go(80_000) == ([], 73_000)
    assert list(held.maps["ahead"]) == [("late", 2)]  # gap is forgotten, with what waited
    assert go(200_000) == ([], 102_000) and held.values == {} and held.maps["ahead"] == {} and held.timers == set()


def test_leaves_that_share_a_bucket_give_what_a_run_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(leaves, "BUCKETS", 1)
    test_shuffled_landings_give_what_a_run_reads(spark, tmp_path, 3)


def test_times_are_those_of_the_column_in_any_time_zone(spark, tmp_path):
    at, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        land(spark, at, [("a", 2, 200, table(person(1)), 0), ("clock", 2, 200, "", 4 * 3600)])
        leaves.start(spark, at, out, mark, late="1 hour", give_up="2 hours").awaitTermination()
        found = leaves.outcomes_of(spark.read.schema(leaves.RELEASED).parquet(out)).collect()
        times = [r.t for r in spark.read.schema(leaves.RELEASED).parquet(out).where("leaf = '[\"a\"]'").selectExpr("unix_seconds(at) as t").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(r["values"], r.pages_read, r.complete) for r in found] == [(["a"], 0, False)] and times == [START + 7200]
