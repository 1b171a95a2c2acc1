"""Helpers that the training-data operators share: tables, shared storage, Arrow text access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.sources.storage import materialize, new_path, shared_dir  # noqa: F401

#: Word separators of the contracts: space and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(df: DataFrame, column: str = "text") -> DataFrame:
    """doc_id and text only, so that further columns of any name can't clash; null texts are empty."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text"))


def rows(batch: pa.RecordBatch, step: int = 512):
    """(doc_id, UTF-8 bytes) of each row, a slice at a time so that few texts are held twice."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        texts = part.column("text").cast(pa.large_binary()) if pa.types.is_large_string(part.column("text").type) else part.column("text").cast(pa.binary())
        yield from zip(part.column("doc_id").to_pylist(), texts.to_pylist(), strict=True)


def arrow_batch(columns: dict[str, tuple[list | np.ndarray | pa.Array, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in columns.values()], names=list(columns))


def sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """chosen(_id, ...) with text, the text of docs(doc_id, text) of that doc_id: no more rows than chosen has, which must be
    bounded, since its ids go to all tasks.

    Of rows that share a doc_id one text counts, that of the least hash, so a doc_id of very many rows brings one; each task
    keeps one text of a doc_id before any moves.
    """
    ids = chosen.select("_id").distinct()
    found = text_or_empty(docs).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    one = found.groupBy("_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return chosen.join(one, "_id")
