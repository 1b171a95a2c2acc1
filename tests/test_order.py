"""The binary key orders as the tuples do, prunes, and numbers rows over many ranges."""

import random

from leafline.operators import order
from leafline.sources.storage import materialize


def places(n=400):
    rng = random.Random(8)
    return sorted({(tuple(rng.choice([0, 1, 9, 255, 256, 70_000, 2**31 - 1]) for _ in range(rng.randrange(4))), rng.randrange(1, 300), rng.randrange(1, 12)) for _ in range(n)})


def frame(spark, rows):
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    return spark.createDataFrame([(list(p), page, row) for p, page, row in shuffled], "path array<int>, page_no int, row_ord int")


def test_keys_are_ordered_as_places_are(spark):
    rows = places()
    got = frame(spark, rows).orderBy(order.order_key()).collect()
    assert [(tuple(r.path), r.page_no, r.row_ord) for r in got] == rows


def test_row_numbers_over_many_ranges(spark):
    rows = places(900)
    numbered = order.with_row_number(frame(spark, rows).repartition(7))
    assert sorted((r.row_no, tuple(r.path), r.page_no, r.row_ord) for r in numbered.collect()) == [(k, *r) for k, r in enumerate(rows, 1)]
    assert order.with_row_number(frame(spark, rows).limit(0)).count() == 0


def test_a_subtree_is_a_range_that_the_scan_gets(spark):
    rows = [((a, b), page, 1) for a in range(6) for b in (0, 1, 2) for page in (1, 2)] + [((3,), 1, 1), ((30,), 1, 1), ((3, 1, 4), 1, 1)]
    parts = order.in_ranges(frame(spark, rows))
    for node in ([], [3], [3, 1], [2, 2], [7]):
        found = parts.where(order.below(node))
        assert sorted(tuple(r.path) for r in found.collect()) == sorted(p for p, *_ in rows if list(p[: len(node)]) == node), node
    scan = parts.where(order.below([3]))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_key" in scan and "LessThan(order_key" in scan
    kept = materialize(parts.where(order.below([3])))
    assert kept.count() == 8
