"""The source of grid pages: filters stop fetches, rows are those of the whole crawl."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith
from test_crawl import PAGER, SITE, Site, choices, one_leaf, person, state, table

from leafline.plans.crawl import crawl
from leafline.plans.specs import NUMBER_LABEL, OFFICES, STATUS_LABEL
from leafline.sources import pages
from leafline.sources.replay import SCHEMA, Replay

ZP = OFFICES["zp"]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("landed") / "pages")
    rows = [(list(v), p, s, state("/".join(v)) + h) for (v, p), (s, h) in SITE.items()]
    pages.land(spark.createDataFrame(rows, SCHEMA).repartition(3), at)
    pages.register(spark)
    return at


def load(spark, landed, **options):
    return spark.read.format(pages.FORMAT).options(office="zp", pages=landed, **options).load()


@pytest.mark.parametrize("split", ["post", "district", "pradesik"])
def test_rows_are_those_of_the_crawl(spark, landed, split):
    rows = [(list(v), p, s, state("/".join(v)) + h) for (v, p), (s, h) in SITE.items()]
    want = crawl(ZP, Replay(spark.createDataFrame(rows, SCHEMA)))
    got = load(spark, landed, split=split)
    assert sorted(pages.records(got, ZP).collect()) == sorted(want.records.collect())
    assert [(r.district, r.number, r.path, r.status) for r in got.where("page_no = 0").collect()] == [("D1", "C2", [0, 0, 1], 500)]
    with pytest.raises(PySparkException, match="status 500"):
        load(spark, landed, split=split, abort="true").collect()


class Counted:
    """A session that notes what it is asked for."""

    def __init__(self, site=SITE):
        self.site, self.asked = Site(site), []

    def __call__(self):
        def send(sent):
            self.asked.append(sent)
            return self.site.send(sent)

        return send


def fetched(filters, site=SITE, office="zp", **options):
    """(rows, number of requests, filters that are left to Spark) of a scan in this process."""
    session = Counted(site)
    reader = pages.FormPagesReader(OFFICES[office], options, session)
    left = list(reader.pushFilters(filters))
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    return rows, len(session.asked), left


def test_filters_stop_fetches():
    everything, requests, _ = fetched([])
    assert requests == 10 == len(SITE) and len(everything) == 4  # landing, post, two districts, three constituencies, three grid pages
    of_district, requests, left = fetched([IsNotNull(("district",)), EqualTo(("district",), "D2")])
    assert requests == 5 and left == [] and {r[1] for r in of_district} == {"D2"}
    assert fetched([EqualTo(("post",), "Other")])[:2] == ([], 1)  # a run does its first post only
    assert fetched([In(("district",), ("D1", "D3"))])[1] == 7
    by_number, requests, _ = fetched([EqualTo(("number",), "C2")])
    assert requests == 5 and [(r[2], r[-2]) for r in by_number] == [("C2", 500)]  # its page fails, its number is known
    assert fetched([EqualTo(("reservation_status",), "Woman")])[1] == 8  # known once a constituency's page is there
    up_to, requests, left = fetched([bound := LessThan(("page_no",), 2)])
    assert requests == 9 and left == [bound] and max(r[-3] for r in up_to) == 1
    nothing, requests, left = fetched([LessThanOrEqual(("page_no",), 0)])
    assert requests == 7 and [r[-3] for r in nothing] == [0]
    assert fetched([unknown := IsNull(("district",))])[1:] == (10, [unknown])


def test_a_filter_that_spark_pushes_stops_fetches(spark, landed, tmp_path):
    """Requests counted from the tasks, by the files that a session leaves."""
    at = tmp_path / "asked"
    at.mkdir()

    def load_counted(where):
        class Source(pages.FormPages):
            def reader(self, schema):
                folder, path = str(at), self.options["pages"]

                def session():
                    import uuid

                    answer = pages.Landed(ZP, path)
                    return lambda sent: (Path(folder, uuid.uuid4().hex).write_text(json.dumps(sent)), answer(sent))[1]

                return pages.FormPagesReader(self.spec, self.options, session)

        spark.dataSource.register(Source)
        got = spark.read.format(pages.FORMAT).options(office="zp", pages=landed).load().where(where).collect()
        asked = len(list(at.iterdir()))
        for p in at.iterdir():
            p.unlink()
        return got, asked

    try:
        everything, all_ = load_counted("true")
        some, fewer = load_counted("district = 'D2' and page_no < 2")
        one, fewest = load_counted("district like 'D%' and district <> 'D1' and number = 'C9'")
    finally:
        pages.register(spark)
    assert len(everything) == 4 and [(r.district, r.page_no) for r in some] == [("D2", 1)] and one == []
    assert all_ > fewer > fewest


def test_kinds_of_filters():
    ask = pages.passes
    for f, yes, no in [(GreaterThan(("d",), "b"), "c", "b"), (StringStartsWith(("d",), "a"), "ab", "b"), (StringEndsWith(("d",), "a"), "ba", "b"), (StringContains(("d",), "a"), "bab", "b"), (Not(In(("d",), ("a",))), "b", "a")]:
        assert ask(f, yes) and not ask(f, no) and pages.asks_of(f) == "d"
    for f in (IsNull(("d",)), Not(IsNotNull(("d",))), EqualTo(("a", "b"), 1), EqualTo(("d",), None)):
        assert pages.asks_of(f) is None


def test_labels_that_are_read_from_the_page_are_filtered_before_the_grid():
    labels = lambda n: f'<span id="{NUMBER_LABEL}">{n}</span><span id="{STATUS_LABEL}"></span>'
    found = {((), 0): choices("post", "M"), (("m",), 0): choices("district", "D"), (("m", "d"), 0): choices("block", "B"), (("m", "d", "b"), 0): choices("panchayat", "P1", "P2")}
    found |= {(("m", "d", "b", f"p{k}"), 0): labels(f"x/{k}") for k in (1, 2)} | {(("m", "d", "b", f"p{k}"), 1): table(person(k)) for k in (1, 2)}
    from leafline.plans.specs import SELECT_IDS

    asked = []

    def session():
        def send(sent):
            values = tuple(sent[SELECT_IDS[x]] for x in OFFICES["mu"].levels if SELECT_IDS[x] in sent) if sent else ()
            asked.append((values, int(bool(sent) and "btnSubmit" in sent)))
            return 200, state(0) + found[asked[-1]]

        return send

    reader = pages.FormPagesReader(OFFICES["mu"], {}, session)
    assert list(reader.pushFilters([EqualTo(("number",), "x/2")])) == []
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert [(r[3], r[4], r[5]) for r in rows] == [("P2", "x/2", "")] and (("m", "d", "b", "p1"), 0) in asked and (("m", "d", "b", "p1"), 1) not in asked


def test_pages_behind_a_bound_are_not_asked_for():
    site = one_leaf(*[table(person(k), PAGER.format(5)) for k in range(1, 6)])
    rows, requests, _ = fetched([EqualTo(("page_no",), 3)], site)
    assert [r[-3] for r in rows] == [1, 2, 3] and requests == 4 + 3  # pages are chained: those before it come too
    assert Counter(r[-2] for r in rows) == {200: 3}


def test_options():
    with pytest.raises(ValueError, match="split"):
        pages.FormPagesReader(ZP, {"split": "ward", "pages": "x"})
    with pytest.raises(ValueError, match="pages"):
        pages.FormPagesReader(ZP, {})
    with pytest.raises(ValueError, match="office"):
        pages.FormPages({}).schema()
    assert pages.FormPagesReader(ZP, {"url": "http://example.invalid/", "retries": "1"}).http.retries == 1


def test_requests_below_a_node_share_its_beginning(spark):
    values = [["a"], ["a", "b"], ["ab"], []]
    got = spark.createDataFrame([(v, p) for v in values for p in (0, 12)], "values array<string>, page_no int")
    key = F.concat(F.array_join(F.transform("values", lambda v: F.concat(v, F.lit("\x01"))), ""), F.lit("\x02"), F.lpad(F.col("page_no").cast("string"), 9, "0"))
    assert all(r.k == pages.request(r["values"], r.page_no) for r in got.withColumn("k", key).collect())
    assert pages.request(["a", "b"], 3).startswith("a\x01") and not pages.request(["ab"], 3).startswith("a\x01")
