"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths that were handed out within scratch(), innermost scope.
_OPEN: ContextVar[list[str] | None] = ContextVar("leafline_scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where none is set, a local folder is chosen if all runs in one
    process (tests); on a cluster each executor would write to a disk of its own, so that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        context = spark.sparkContext
        set_dir = context._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            at = set_dir.get()
        elif not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        else:
            at = tempfile.mkdtemp(prefix="leafline-")
            context.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/leafline/{what}-{uuid.uuid4().hex}"
    if (open_ := _OPEN.get()) is not None:
        open_.append(path)
    return path


def materialize(df: DataFrame, what: str = "table") -> DataFrame:
    """Writes df as Parquet and reads it back: later reads survive lost executors, and lineage is cut."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that are written within. Results are lazy and may read them, so write a result, to
    a path of your own, before the scope ends."""
    token = _OPEN.set([])
    try:
        yield
    finally:
        paths = _OPEN.get()
        _OPEN.reset(token)
        jvm = spark._jvm
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
