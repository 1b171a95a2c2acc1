"""Sharding by extendible hashing.

Rows are hashed to 60 bits. A shard is a prefix of these bits; one that holds more bytes than the limit
splits on its next bit, and only such shards do, until each fits. The directory lists every prefix of
the depth that a round looks at with the shard it belongs to, so that rows find theirs by an equi-join.

A round sums bytes by a prefix deep enough for the expected number of shards, and sums of all shorter
prefixes follow from those; what still exceeds the limit at that depth goes on to the next round alone.
The first 40 bits are the key's, the last 20 the row's: rows of one hot key part where they must and stay
together where they can. A row larger than the limit has a shard of its own, or shares it with rows of all
60 bits, and is marked oversized. Null keys hash like any other value; null texts have no bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import materialize, read

KEY_BITS, ROW_BITS = 40, 20
BITS = KEY_BITS + ROW_BITS
#: Bytes of text that a shard holds at most: what a loader takes at a time.
LIMIT = 1 << 20
#: Bits beyond those that equal shards would need, before the next round.
SLACK = 5


def hashed(docs: DataFrame, key: str = "doc_id", whole: bool = False) -> DataFrame:
    """doc_id, n_bytes and h of every row, and with whole the row itself as a struct, where no column of docs can
    clash with another; written once so that all rounds see the same row bits."""
    bits = lambda hex_, n: F.conv(F.substring(hex_, 1, n // 4), 16, 10).cast("bigint")
    named = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")))
    row = F.md5(F.monotonically_increasing_id().cast("string"))
    slim = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), (F.shiftleft(bits(named, KEY_BITS), ROW_BITS) + bits(row, ROW_BITS)).alias("h")]
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    return materialize(docs.select(*slim, *carried), "shard-hashes")


def prefix(depth: int):
    return F.shiftright("h", BITS - depth)


def assign(slim: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard (its bits), local_depth and oversized, and row where it is there, for the rows of hashed()."""
    done, left, base = [], slim, 0
    kept = ["doc_id", "n_bytes", *(c for c in slim.columns if c == "row")]
    while True:
        # Two numbers for the driver: they set how deep this round looks.
        total, largest = left.agg(F.sum("n_bytes"), F.count("*")).first()
        depth = min(BITS, base + max(1, math.ceil(math.log2(max(1, (total or 0) / limit)))) + SLACK) if base < BITS else BITS
        if not largest:
            break
        slots = left.groupBy(prefix(depth).alias("slot")).agg(F.sum("n_bytes").alias("n"))
        levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth")).withColumn("p", F.expr(f"shiftright(slot, {depth} - depth)"))
        sums = levels.groupBy("depth", "p").agg(F.sum("n").alias("n"))
        # The shallowest prefix that fits; at the last bit there is nothing left to split on.
        fits = levels.drop("n").join(sums.where((F.col("n") <= limit) | (F.col("depth") == BITS)), ["depth", "p"])
        directory = materialize(fits.groupBy("slot").agg(F.min(F.struct("depth", "p", "n")).alias("s")), "shard-directory")
        with_slot = left.withColumn("slot", prefix(depth))
        found = with_slot.join(directory, "slot")
        shard = F.lpad(F.bin(F.col("s.p")), F.col("s.depth"), F.lit("0"))
        done.append(found.select(*kept, F.when(F.col("s.depth") == 0, "").otherwise(shard).alias("shard"), F.col("s.depth").cast("int").alias("local_depth"), (F.col("s.n") > limit).alias("oversized")))
        if depth == BITS:
            break
        left, base = materialize(with_slot.join(directory, "slot", "left_anti").drop("slot"), "shard-rest"), depth
    out = done[0] if done else slim.select(*kept, F.lit("").alias("shard"), F.lit(0).alias("local_depth"), F.lit(False).alias("oversized"))
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def shard(docs: DataFrame, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    return assign(hashed(docs, key), limit)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", folder: str = "shard") -> None:
    """Writes the rows of docs, a folder and a file to a shard: s and the shard's bits. Rows carry their shard
    with them, so repeated or null keys write each row once. Where docs has a column of the folder's name,
    the folder's gets a leading underscore."""
    while folder.lower() in (c.lower() for c in docs.columns):
        folder = f"_{folder}"
    placed = assign(hashed(docs, key, whole=True), limit).select(F.concat(F.lit("s"), "shard").alias("to"), "row")
    placed = placed.repartition("to").select(F.col("to").alias(folder), "row.*")
    placed.write.partitionBy(folder).parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))


#: The splits one bit at a time. The row's bits never matter where keys are unique and texts below the limit.
ORACLE = f"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 10))::BIGINT AS h
  FROM documents
), r AS (
  SELECT doc_id, n_bytes, h, 0 AS depth, 0::BIGINT AS p, sum(n_bytes) OVER ()::BIGINT AS n FROM t
  UNION ALL
  SELECT doc_id, n_bytes, h, depth + 1, h >> (40 - depth - 1),
         sum(n_bytes) OVER (PARTITION BY h >> (40 - depth - 1))::BIGINT
  FROM r WHERE n > {LIMIT} AND depth < 40
)
SELECT doc_id, n_bytes,
       coalesce(array_to_string([((p >> (depth - i)) & 1)::VARCHAR FOR i IN range(1, depth + 1)], ''), '') AS shard,
       depth AS local_depth, false AS oversized
FROM r WHERE n <= {LIMIT}
"""
