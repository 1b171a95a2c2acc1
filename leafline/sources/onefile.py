"""One CSV file that many tasks write: parts by the standard writer, their sizes added up, each copied to its place.

Page order is that of a range sort, so the parts in the order of their names are the file. The driver sees names and sizes
of parts only. A copy writes the same bytes to the same place however often it is tried, into a file beside the one that
is wanted, which takes that one's name when all is there: who reads the path sees the old file or the new one.

The path must be on a file system that tasks and driver open by that path and that can be written at a position (a
disk or a shared mount, no object store). Nothing to write gives the header line alone, or an unchanged file for a run that resumes.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.plans.specs import OfficeSpec, ResumeSpec
from leafline.sources import csv

#: Bytes that a task copies at most for one row of the plan, and that it holds at once.
SLICE, HELD = 64 << 20, 4 << 20


def slices(files: list[tuple[str, int]], size: int | None = None) -> list[tuple[str, int, int, int]]:
    """(file, start in it, length, place in the whole) of files(name, bytes) laid end to end."""
    size, out, place = size or SLICE, [], 0
    for name, length in files:
        out += [(name, at, min(size, length - at), place + at) for at in range(0, length, size)]
        place += length
    return out


def assemble(spark: SparkSession, files: list[tuple[str, int]], path: str, size: int | None = None) -> int:
    """Makes path of the files, one after another, and returns its length. size: bytes of a slice."""
    plan = slices(files, size)
    total = sum(length for _, length in files)
    new = f"{path}.{uuid.uuid4().hex}.part"
    with open(new, "wb") as f:
        f.truncate(total)

    def copy(batches):
        for batch in batches:
            with open(new, "r+b") as out:
                for name, start, length, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    done = 0
                    out.seek(place)
                    with open(name, "rb") as f:
                        f.seek(start)
                        while done < length:
                            block = f.read(min(HELD, length - done))
                            if not block:
                                raise OSError(f"{name} ends {length - done} bytes early")
                            out.write(block)
                            done += len(block)
                out.flush()
                os.fsync(out.fileno())
            yield pa.RecordBatch.from_arrays([batch.column(2)], names=["length"])

    try:
        if plan:
            tasks = min(len(plan), spark.sparkContext.defaultParallelism * 4)
            laid = spark.createDataFrame(plan, "name string, start long, length long, place long").repartition(tasks)
            done = laid.mapInArrow(copy, "length long").agg(F.sum("length").alias("bytes")).first()["bytes"]
            if done != total:
                raise OSError(f"{done} of {total} bytes were copied to {path}")
        os.replace(new, path)
    finally:
        if os.path.exists(new):
            os.remove(new)
    return total


def parts(folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of a written folder's files in the order of their names, empty ones left out."""
    return [(str(f), n) for f in sorted(Path(folder).glob("part-*")) if (n := f.stat().st_size)]


def write(records: DataFrame, spec: OfficeSpec, path: str, resume: ResumeSpec | None = None, redact: bool = False) -> int:
    """The office's records in page order as the one CSV file path; returns its length. A fresh run replaces the file and
    begins with the header, one that resumes goes on behind what is there. The parts stand beside it meanwhile."""
    folder = f"{path}.{uuid.uuid4().hex}.parts"
    fresh = (resume or ResumeSpec()).fresh
    try:
        csv.write(records, spec, folder, resume, ordered=True, redact=redact)
        before = [(path, os.path.getsize(path))] if not fresh and os.path.exists(path) else []
        return assemble(records.sparkSession, before + parts(folder), path)
    finally:
        at = records.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(records.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
