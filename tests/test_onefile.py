"""One CSV file from many tasks: the bytes that one task would write."""

import random

import pytest

from leafline.plans.specs import OFFICES, ResumeSpec
from leafline.sources import csv, onefile

SPEC = OFFICES["zp"]
SCHEMA = ", ".join(f"{c} string" for c in SPEC.columns) + ", path array<int>, page_no int, row_ord int"
AWKWARD = ["", None, "plain", 'a "quoted" one', "two\nlines", "comma, and \\", " spaces ", "é – हिन्दी", "x" * 3000]


def records(spark, n, seed=0, first=0):
    rng = random.Random(seed)
    rows = [(*[rng.choice(AWKWARD) for _ in SPEC.columns], [0, first + k // 40, k // 8 % 5], k // 4 % 2 + 1, k % 4) for k in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(df, folder):
    """What the standard writer gives in one task, without a header."""
    df.orderBy("path", "page_no", "row_ord").select(*SPEC.columns).coalesce(1).write.options(**csv.OPTIONS).csv(str(folder))
    return b"".join(f.read_bytes() for f in sorted(folder.glob("part-*")))


def test_bytes_are_those_of_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(onefile, "SLICE", 1000)
    monkeypatch.setattr(onefile, "HELD", 300)
    one = records(spark, 200)
    header = (",".join(SPEC.columns) + "\n").encode()
    path = tmp_path / "all.csv"
    for _ in range(2):  # a fresh run replaces what is there
        assert onefile.write(one, SPEC, str(path)) == path.stat().st_size
        assert path.read_bytes() == header + plain(one, tmp_path / f"plain-{_}")
    before = path.read_bytes()
    more = records(spark, 60, 1, first=9)
    onefile.write(more, SPEC, str(path), ResumeSpec({"district": "D2"}))
    assert path.read_bytes() == before + plain(more, tmp_path / "more")
    onefile.write(more.limit(0), SPEC, str(path), ResumeSpec({"district": "D2"}))
    assert path.read_bytes() == before + plain(more, tmp_path / "again")
    assert sorted(f.name for f in tmp_path.iterdir() if f.name.startswith("all")) == ["all.csv"]  # nothing is left beside it


def test_no_records_give_the_header(spark, tmp_path):
    path = tmp_path / "none.csv"
    onefile.write(records(spark, 1).limit(0), SPEC, str(path))
    assert path.read_text() == ",".join(SPEC.columns) + "\n"
    onefile.write(records(spark, 1).limit(0), SPEC, str(tmp_path / "new.csv"), ResumeSpec({"district": "D2"}))
    assert (tmp_path / "new.csv").read_bytes() == b""


def test_slices_cover_all_once():
    rng = random.Random(5)
    for _ in range(200):
        files = [(f"f{k}", rng.randrange(30)) for k in range(rng.randrange(6))]
        got = onefile.slices(files, rng.randrange(1, 12))
        assert sorted(p for _, _, n, at in got for p in range(at, at + n)) == list(range(sum(n for _, n in files)))
        assert all(n > 0 and start + n <= dict(files)[name] for name, start, n, _ in got)


def test_a_part_that_is_short_leaves_the_old_file(spark, tmp_path):
    path, part = tmp_path / "kept.csv", tmp_path / "part-0"
    path.write_bytes(b"old")
    part.write_bytes(b"abc")
    with pytest.raises(Exception, match="2 bytes early"):
        onefile.assemble(spark, [(str(part), 5)], str(path))
    assert path.read_bytes() == b"old" and sorted(f.name for f in tmp_path.iterdir()) == ["kept.csv", "part-0"]


def test_many_tasks_copy(spark, tmp_path):
    files = []
    for k in range(7):
        at = tmp_path / f"part-{k}"
        at.write_bytes(random.Random(k).randbytes(10_000 * k))
        files.append((str(at), at.stat().st_size))
    whole = tmp_path / "whole"
    onefile.assemble(spark, files, str(whole), size=4096)
    assert whole.read_bytes() == b"".join((tmp_path / f"part-{k}").read_bytes() for k in range(7))
