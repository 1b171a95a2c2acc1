"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of F_2^3, and each of the seven non-zero vectors v names a
table whose mask keeps the positions with an odd inner product with v. Any two positions span at most
a plane, which some v is orthogonal to, so two fingerprints that differ in two bits or fewer agree on
the whole mask of at least one table. The family covers; it misses no pair.

Texts without words have fingerprint zero and link like any other. Null texts count as empty. Rows
repeated under one doc_id are ordinary members of a group; a null doc_id never becomes a component's
name unless all its members lack one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import near_copies
from leafline.llm.common import arrow_batch, materialize, read, rows, text_or_empty
from leafline.llm.graph import components

RADIUS = 2
SEED = 42


def masks() -> list[int]:
    """Seven masks of 36 or 37 of the 64 bits, as signed 64-bit numbers."""
    out = []
    for v in range(1, 8):
        mask = sum(1 << i for i in range(64) if (v & (1 + i % 7)).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def simhash(text: bytes, width: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: 1 - width], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        s, e = starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist()
        h = np.array([digest(line[a:b], SEED) for a, b in zip(s, e, strict=True)], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def run(batches):
        for batch in batches:
            ids, fps = [], []
            for doc_id, text in rows(batch):
                ids.append(doc_id)
                fps.append(simhash(text))
            yield arrow_batch({"doc_id": (ids, pa.int64()), "fp": (np.array(fps, np.uint64).view(np.int64), pa.int64())})

    return text_or_empty(docs).mapInArrow(run, "doc_id long, fp long")


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints whose closure is that of all pairs within the radius.

    A bucket of two is checked directly. The members of larger buckets never meet pairwise: two
    fingerprints are within two bits exactly if some value is within one bit of both, so each member
    names the 65 values around it and members are tied to the least one at the same value, at most 65.
    """
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks())])).alias("k")).select("fp", "k.t", "k.key")
    buckets = materialize(keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1"), "simhash-buckets")
    pairs = buckets.where(f"n = 2 and bit_count(u ^ v) <= {RADIUS}").select("u", "v")
    crowded = keyed.join(buckets.where("n > 2").select("t", "key"), ["t", "key"], "left_semi").select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(b - (1 << 64) if b >> 63 else b)) for b in (1 << i for i in range(64))]
    around = crowded.select("fp", F.explode(F.array(*flips)).alias("value"))
    tied = around.groupBy("value").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    stars = tied.select(F.array_min("near").alias("u"), F.explode("near").alias("v")).where("u <> v")
    return pairs.union(stars).distinct()


def grouped(distinct: DataFrame) -> DataFrame:
    """distinct(fp, ...), each fingerprint once, with label: equal for those that links within the radius lead to."""
    label = components(links(distinct))
    return distinct.join(label, distinct.fp == label.node, "left").select(*distinct.columns, F.coalesce("label", "fp").alias("label"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group of near copies the row of the smallest doc_id. Components of fingerprints are checked by the texts' shingle
    sets, and min-wise bands bring together what differs in more bits than the radius."""
    return near_copies.keep_one(docs, simhash, grouped)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of every row. Equal fingerprints are grouped before anything is compared."""
    prints = materialize(fingerprints(docs), "simhash-prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    named = materialize(grouped(distinct), "simhash-labels")
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(ids, "label").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
