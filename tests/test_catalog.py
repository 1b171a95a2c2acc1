"""Every query with SQL gives the SQL's rows, here on the smallest tables where they are at hand."""

import os
from pathlib import Path

import duckdb
import pytest

from leafline.plans import catalog

DATA = Path(os.environ.get("LEAFLINE_TESTDATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def sql():
    if not DATA.exists():
        pytest.skip("no tables")
    con = duckdb.connect()
    for p in DATA.iterdir():
        con.sql(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n in catalog.ORACLES])
def test_query(spark, sql, name):
    got, want = catalog.QUERIES[name](spark, str(DATA)), sql.sql(catalog.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda r: tuple(map(str, r))
    rows = sorted(key(r) for r in got.select(*columns).collect())
    assert rows == sorted(key(r) for r in want.project(", ".join(columns)).fetchall())
    assert rows or name == "resume_cross_parent"


def test_headings_keep_references_that_the_sql_keeps(spark, tmp_path):
    heads = ["a &quot;b&quot; &#x27;c&#x27;", "cut &amp;&amp", "cut &am", "&amp;lt; &lt;b&gt;", "plain", "&eacute; &ltx"]
    pages = spark.createDataFrame([(k, f"<html><head></head><body><h1>{h}</h1><p>x</p></body></html>") for k, h in enumerate(heads)], "page_id long, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(f"SELECT page_id, heading FROM ({catalog.ORACLES['label_required']}) ORDER BY 1").fetchall()
    assert [tuple(r) for r in catalog.QUERIES["label_required"](spark, str(tmp_path)).orderBy("page_id").collect()] == want


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
