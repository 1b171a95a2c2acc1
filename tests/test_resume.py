"""The set-based latch against a loop over the tree, on random trees and starts."""

import random

import pytest
from pyspark.sql import functions as F

from leafline.operators.resume import keep_first, latch
from leafline.sources.storage import materialize


def tree(rng, depth):
    return [(rng.choice("abc"), tree(rng, depth - 1) if depth > 1 else []) for _ in range(rng.randint(0 if depth < 3 else 1, 3))]


def walked(nodes, starts):
    """Paths of leaves that the loop with one flag a level reaches."""
    flags, out = [s == "" for s in starts], []

    def go(children, path):
        for i, (name, below) in enumerate(children):
            k = len(path)
            if starts[k] == name:
                flags[k] = True
            if not flags[k]:
                continue
            if k + 1 == len(starts):
                out.append((*path, i))
            else:
                go(below, (*path, i))

    go(nodes, ())
    return out


def level(nodes, depth, path=()):
    for i, (name, below) in enumerate(nodes):
        if depth == 0:
            yield [*path, i], name
        else:
            yield from level(below, depth - 1, (*path, i))


@pytest.mark.parametrize("seed", range(6))
def test_latch_agrees_with_the_loop(spark, seed):
    rng = random.Random(seed)
    nodes, starts = tree(rng, 3), [rng.choice(["", "a", "b"]) for _ in range(3)]
    kept = None
    for depth, start in enumerate(starts):
        rows = spark.createDataFrame(list(level(nodes, depth)) or [], "path array<int>, name string")
        if kept is not None:
            above = kept.selectExpr("path AS up")
            rows = rows.join(above, above.up == F.slice("path", 1, F.size("path") - 1), "left_semi")
        kept = materialize(latch(materialize(rows), start))
    assert sorted(tuple(r.path) for r in kept.collect()) == sorted(walked(nodes, starts))


def test_no_match_keeps_nothing_and_no_start_keeps_all(spark):
    nodes = spark.createDataFrame([([0], "a"), ([1], "b")], "path array<int>, name string")
    assert latch(nodes, "z").count() == 0
    assert latch(nodes, "").count() == 2
    assert [r.name for r in keep_first(latch(nodes, "b")).collect()] == ["b"]
