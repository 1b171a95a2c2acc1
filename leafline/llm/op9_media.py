"""Media columns: texts as lossless baseline JPEG, read back into payloads, dimensions and thumbnail hashes.

A text's payload is its UTF-8 with zero bytes up to a positive multiple of 64 (null counts as empty, 64
zeros). Equal texts have equal media and features. All that a row gives depends on that row alone, so
there is no shuffle, and repeated rows or nulls in other columns change nothing.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from leafline.llm import jpeg
from leafline.llm.common import arrow_batch, materialize, read, rows, text_or_empty

STORED = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "media": pa.binary()}
FEATURES = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "width": pa.int32(), "height": pa.int32(), "thumbnail_hash": pa.string()}
STORED_DDL = "doc_id long, n_bytes long, media binary"
FEATURES_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int, thumbnail_hash string"
#: Media bytes that a batch holds, or a single row where that has more.
BATCH_BYTES = 1 << 22


def payload(text: bytes) -> bytes:
    return text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")


def _batch(kinds: dict, out: list[tuple]) -> pa.RecordBatch:
    return arrow_batch({n: (list(v), t) for (n, t), v in zip(kinds.items(), zip(*out, strict=True), strict=True)})


def store_batches(batches):
    for batch in batches:
        out, held = [], 0
        for doc_id, text in rows(batch):
            media = jpeg.encode(payload(text))
            out.append((doc_id, len(text), media))
            held += len(media)
            if held >= BATCH_BYTES:
                yield _batch(STORED, out)
                out, held = [], 0
        if out:
            yield _batch(STORED, out)


def feature_batches(batches):
    for batch in batches:
        out = []
        for doc_id, n_bytes, media in zip(*(batch.column(c).to_pylist() for c in STORED), strict=True):
            image = jpeg.decode(media)
            data = image.payload()
            hashed = jpeg.average_hash(image.thumbnail())
            out.append((doc_id, n_bytes, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(media), hashlib.sha256(media).hexdigest(), f"{image.width}x{image.height}:{hashed}", image.width, image.height, hashed))
        if out:
            yield _batch(FEATURES, out)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the media column, to be written to a table."""
    return text_or_empty(docs).mapInArrow(store_batches, STORED_DDL)


def features(media: DataFrame) -> DataFrame:
    """What the stored bytes say when read back."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(feature_batches, FEATURES_DDL)


def store_and_read(docs: DataFrame) -> DataFrame:
    """The media column written as a table, and what it says when read back."""
    return features(materialize(store(docs), "media"))


def thumbnails(media: DataFrame) -> DataFrame:
    """doc_id, width, height, thumbnail_hash of any column media of baseline files; nulls where one can't be read."""

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                try:
                    image = jpeg.decode(data or b"")
                    out.append((doc_id, image.width, image.height, jpeg.average_hash(image.thumbnail())))
                except (ValueError, IndexError, KeyError, OverflowError):
                    out.append((doc_id, None, None, None))
            if out:
                yield _batch({"doc_id": pa.int64(), "width": pa.int32(), "height": pa.int32(), "thumbnail_hash": pa.string()}, out)

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, width int, height int, thumbnail_hash string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_and_read(read(spark, sf_dir, "documents"))
