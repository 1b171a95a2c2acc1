"""What a task holds: shares of rows that don't grow with the tables, and no pages or records to sort."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.operators import paginate
from leafline.plans import render
from leafline.plans.specs import OFFICES
from leafline.sources import runs
from leafline.sources.replay import SCHEMA, Replay

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_that_render_a_site_are_as_many_as_its_rows_ask_for(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before, whole = spark.conf.get(key), render.site(spark, SF, "mu")
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    monkeypatch.setattr(render, "TASK_ROWS", n // 20)
    dealt = render.site(spark, SF, "mu")
    assert spark.conf.get(key) == before
    files = dealt.where("page_no > 0").select(F.input_file_name()).distinct().count()
    assert files > 15
    assert whole.exceptAll(dealt).isEmpty() and dealt.exceptAll(whole).isEmpty()


def test_more_rows_make_more_tasks(spark):
    tasks = [int(render.rendering(spark, n)["spark.sql.shuffle.partitions"]) for n in (0, 1, 1 << 16, 1 << 27, 6 << 27)]
    assert tasks[:2] == [1, 1] and tasks[2] == 4 and tasks[3] == 1024 and tasks[4] == 6 * 1024


def test_pages_are_not_sorted_to_be_found(spark, monkeypatch):
    pages = spark.createDataFrame([(["a"], 0, 200, "<p>"), (["a"], 1, 200, ""), (["b"], 1, 404, "")], SCHEMA)
    frontier = spark.createDataFrame([(["a"], ["A"], [0]), (["c"], ["C"], [1])], "values array<string>, names array<string>, path array<int>")
    chosen = Replay(pages).choose(frontier, OFFICES["zp"], 0)
    assert "ShuffledHashJoin" in plan(chosen) and "Sort" not in plan(chosen) and "Broadcast" not in plan(chosen)
    assert sorted((r["values"][0], r.status) for r in chosen.collect()) == [("a", 200), ("c", None)]
    written, keep = [], paginate.materialize
    monkeypatch.setattr(paginate, "materialize", lambda df, what: written.append(plan(df)) or keep(df, what))
    leaves = frontier.unionByName(spark.createDataFrame([(["b"], ["B"], [2])], frontier.schema))
    found = paginate.follow(leaves, pages.where("page_no > 0"))
    assert "ShuffledHashJoin" in written[0] and "Sort" not in written[0] and "Broadcast" not in written[0]
    assert sorted((r["values"][0], r.page_no, r.status) for r in found.collect()) == [("a", 1, 200), ("b", 1, 404), ("c", 1, None)]


def test_the_first_page_that_fails_ends_a_leaf(spark):
    pages = spark.createDataFrame([([v], k, 500 if (v, k) == ("a", 3) else 200, f"{v}{k}") for v in "abc" for k in range(2, 6) if (v, k) != ("b", 2)], SCHEMA)
    later = paginate._later(spark.createDataFrame([([v], n, 4) for n, v in enumerate("aabc")], "values array<string>, leaf int, _pages int"), pages)
    assert sorted((r.leaf, r.page_no, r.html) for r in later.collect()) == [(0, 2, "a2"), (0, 3, "a3"), (1, 2, "a2"), (1, 3, "a3"), (2, 2, None), (3, 2, "c2"), (3, 3, "c3"), (3, 4, "c4")]

def test_records_are_not_sorted_to_find_their_last_reading(spark, tmp_path):
    spec, at = OFFICES["zp"], str(tmp_path)
    schema = ", ".join(f"{c} string" for c in spec.columns) + ", path array<int>, page_no int, row_ord int"
    made = lambda name, paths: spark.createDataFrame([(*[name] * len(spec.columns), [0, p], k, 0) for p in paths for k in (1, 2)], schema)
    runs.write(made("old", (0, 1, 2)), spec, at, "r1")
    runs.write(made("new", (1, 2, 3)), spec, at, "r2", runs.ResumeSpec({"district": "D2"}))
    current = runs.current(spark, spec, at)
    assert "Window" not in plan(current) and "Sort " not in plan(current)
    assert sorted((r.path[1], r.page_no, r.post) for r in current.collect()) == sorted((p, k, "old" if p == 0 else "new") for p in range(4) for k in (1, 2))
