"""Records of runs, each run counted once however often it was killed and started again.

    runs.write(found.records, spec, path, run="2024-05-02", resume=resume)
    runs.raw(spark, spec, path)      # every committed run's rows, a leaf that two runs read twice
    runs.current(spark, spec, path)  # the last reading of every page

A task writes files under names of its own and tells the driver of them; nothing else makes a file count. Once all tasks
are done the driver writes the run's manifest, which takes effect by one rename: a run that dies before it has left
files that no manifest names, and what a task wrote before it was repeated is named by none either. A manifest of a
run that is there already takes its place, so that a run may be repeated by whoever doesn't know whether it got
through. A fresh run's manifest ends all before it in the same moment that its own rows appear.

path is a folder that the driver and all tasks open by pyarrow: a shared mount, or an address of an object store or HDFS.
Records are read back by Spark's own reader, from the files that the manifests name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from leafline.plans.specs import OfficeSpec, ResumeSpec

FORMAT = "leafline_run"
#: Where a row stands in the order of the pages.
PLACE = T.StructType([T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("page_no", T.IntegerType()), T.StructField("row_ord", T.IntegerType())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the folder there; a plain path is local."""
    system, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, folder.rstrip("/")


def _address(path: str, file: str) -> str:
    return f"{path.rstrip('/')}/{file}"


@dataclass
class Written(WriterCommitMessage):
    """Of one task: its file below the folder, how many rows are in it, and their first and last path; no file of a task without rows."""

    file: str | None = None
    rows: int = 0
    first: list[int] | None = None
    last: list[int] | None = None


class RunWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str, fresh: bool):
        self.path, self.run, self.fresh, self.attempt = path, run, fresh, uuid.uuid4().hex

    @property
    def folder(self) -> str:
        return f"data/{self.attempt}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _opened(self.path)
        file, writer, rows, first, last = f"{self.folder}/{uuid.uuid4().hex}.parquet", None, 0, None, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(f"{root}/{self.folder}", recursive=True)
                writer = pq.ParquetWriter(f"{root}/{file}", batch.schema, filesystem=system)
            paths = batch.column("path").to_pylist()
            own = min(paths), max(paths)
            first, last = (own[0] if first is None else min(first, own[0])), (own[1] if last is None else max(last, own[1]))
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return Written()
        writer.close()
        return Written(file, rows, first, last)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _opened(self.path)
        wrote = [m for m in messages if m and m.file]
        manifest = {
            "run": self.run,
            "order": 1 + max((m["order"] for m in _all_manifests(self.path)), default=0),
            "fresh": self.fresh,
            "rows": sum(m.rows for m in wrote),
            "first": min((m.first for m in wrote), default=None),
            "last": max((m.last for m in wrote), default=None),
            "files": sorted(m.file for m in wrote),
        }
        system.create_dir(f"{root}/runs", recursive=True)
        # Written aside and renamed, so that nobody reads half of one.
        aside = f"{root}/runs/.{self.attempt}"
        with system.open_output_stream(aside) as out:
            out.write(json.dumps(manifest).encode())
        system.move(aside, f"{root}/runs/{manifest['order']:012d}-{self.attempt}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """A failed run's files go; those of a run whose driver died stay until vacuum."""
        system, root = _opened(self.path)
        if system.get_file_info(f"{root}/{self.folder}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.folder}")


class RunSink(DataSource):
    """Options: path, run (both required). Mode overwrite is a fresh run."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        path, run = self.options.get("path"), self.options.get("run")
        if not path or not run:
            raise ValueError("options path and run are required")
        return RunWriter(path, run, overwrite)


def write(records: DataFrame, spec: OfficeSpec, path: str, run: str, resume: ResumeSpec | None = None) -> None:
    """Appends the office's records under the name of their run, in the place of what a run of that name wrote before. A
    run that nothing but a post was given for starts afresh."""
    spark = records.sparkSession
    spark.dataSource.register(RunSink)
    out = records.select(*[F.col(c).cast("string").alias(c) for c in spec.columns], *[F.col(f.name).cast(f.dataType) for f in PLACE], F.lit(run).alias("run"))
    out.write.format(FORMAT).option("path", path).option("run", run).mode("overwrite" if (resume or ResumeSpec()).fresh else "append").save()


def _all_manifests(path: str) -> list[dict]:
    system, root = _opened(path)
    out = []
    for info in system.get_file_info(fs.FileSelector(f"{root}/runs", allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with system.open_input_stream(info.path) as f:
                out.append(json.loads(f.read()) | {"name": info.base_name})
    return sorted(out, key=lambda m: m["name"])


def manifests(path: str) -> list[dict]:
    """Those that count, in the order of their commits: of each run the last, none before the last fresh one."""
    found = _all_manifests(path)
    start = max((k for k, m in enumerate(found) if m["fresh"]), default=0)
    last = {m["run"]: m for m in found[start:]}
    return sorted(last.values(), key=lambda m: m["name"])


def _schema(spec: OfficeSpec) -> T.StructType:
    return T.StructType([*spec.schema, *PLACE, T.StructField("run", T.StringType())])


def _read(spark: SparkSession, spec: OfficeSpec, path: str, counted: list[dict]) -> DataFrame:
    files = [_address(path, f) for m in counted for f in m["files"]]
    return spark.read.schema(_schema(spec)).parquet(*files) if files else spark.createDataFrame([], _schema(spec))


def raw(spark: SparkSession, spec: OfficeSpec, path: str) -> DataFrame:
    """The office's columns, path, page_no, row_ord and run of all that was committed. A resumed run reads the leaf that it starts
    at again, so rows of several runs may repeat."""
    return _read(spark, spec, path, manifests(path))


def shared_ranges(counted: list[dict]) -> list[tuple[list[int], list[int]]]:
    """Ranges of paths that more than one run may have read, first and last path included, by the runs' own ranges."""
    edges = sorted(e for m in counted if m["rows"] for e in ((m["first"], 0), (m["last"], 1)))
    out, open_, start = [], 0, None
    for at, closes in edges:
        open_ += -1 if closes else 1
        if not closes and open_ == 2:
            start = at
        elif closes and open_ == 1:
            if out and out[-1][1] >= start:
                out[-1] = (out[-1][0], at)
            else:
                out.append((start, at))
    return out


def _within(ranges: list[tuple[list[int], list[int]]]) -> Column:
    place = lambda path: F.array(*[F.lit(p) for p in path]).cast("array<int>")
    inside = F.lit(False)
    for first, last in ranges:
        inside = inside | F.col("path").between(place(first), place(last))
    return inside


def current(spark: SparkSession, spec: OfficeSpec, path: str) -> DataFrame:
    """Rows as raw() has them, of each page only those of the run that read it last.

    Runs that follow each other share a leaf or so: only rows of paths that the ranges of two runs hold are shuffled, to find
    which run was the last; all others are read as they are.
    """
    counted = manifests(path)
    rows, ranges = _read(spark, spec, path, counted), shared_ranges(counted)
    if not ranges:
        return rows
    inside = _within(ranges)
    orders = spark.createDataFrame([(m["run"], m["order"]) for m in counted], "run string, _order long")
    contested = rows.where(inside).join(F.broadcast(orders), "run")
    # Found by the slim columns and held by page, so that no record is sorted.
    last = contested.groupBy(F.col("path").alias("_path"), F.col("page_no").alias("_page_no")).agg(F.max("_order").alias("_last"))
    same = F.col("path").eqNullSafe(F.col("_path")) & F.col("page_no").eqNullSafe(F.col("_page_no")) & (F.col("_order") == F.col("_last"))
    return rows.where(~inside).unionByName(contested.join(last.hint("shuffle_hash"), same, "left_semi").drop("_order"))


def resume_after(spark: SparkSession, spec: OfficeSpec, path: str) -> ResumeSpec:
    """Where the next run goes on: at the last leaf that is there, which it reads again. Nothing there: from the start."""
    known = [*spec.ancestors, "number"]
    row = raw(spark, spec, path).agg(F.max_by(F.struct(*known), "path").alias("last")).first()
    if row["last"] is None:
        return ResumeSpec()
    last = row["last"].asDict()
    if spec.labels == "required":
        return ResumeSpec({x: last["number" if x == "pradesik" else x] for x in spec.levels})
    return ResumeSpec({x: last[x] for x in spec.levels}, last["number"])


def vacuum(path: str) -> list[str]:
    """Removes files that no manifest that counts names, and manifests that don't count; gives their names. Not to be run beside a
    run that is still writing."""
    system, root = _opened(path)
    counted = manifests(path)
    named, kept = {f for m in counted for f in m["files"]}, {m["name"] for m in counted}
    gone = []
    for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        file = info.path.removeprefix(f"{root}/")
        if info.type == fs.FileType.File and file not in named and info.base_name not in kept:
            system.delete_file(info.path)
            gone.append(file)
    return sorted(gone)
