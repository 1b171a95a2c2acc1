"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer_digest, content_digest, n_tokens), appended to and never
rewritten. A text's content digest is SHA-256 of its normalised content (null becomes the empty
string; nothing else is changed, since any other normalisation could change the count). The tokenizer
digest covers the model file and the encoding options, so that another version never meets old counts.

Digests go first: those of all rows are written as a slim table, those that the cache lacks are found by an
anti join of digests alone, and no text moves before that. Where the misses are few enough to go to every
task (BROADCAST), only their texts are shuffled; else texts are deduplicated in each task and shuffled
once. Each distinct miss is encoded once and appended. A count is looked up for every row by a join on the
digest; rows repeated or null in any other column get their own result row.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import materialize, new_path, read, text_or_empty

CACHE = "tokenizer_digest string, content_digest binary, n_tokens long"
#: Misses, of 32 bytes each, up to which they are sent to every task.
BROADCAST = 1 << 20
#: What the counts depend on besides the model file.
OPTIONS = "no begin, end or added tokens; no truncation"


@lru_cache(maxsize=2)
def _encoder(path: str):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text, num_threads=1))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + OPTIONS.encode()).hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at path, empty where there is none yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def encode_misses(texts: DataFrame, path: str, version: str) -> DataFrame:
    def run(batches):
        count = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n = [count(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([version] * len(n)), part.column("content_digest"), pa.array(n, pa.int64())], names=["tokenizer_digest", "content_digest", "n_tokens"])

    return texts.mapInArrow(run, CACHE)


def missing(keys: DataFrame, known: DataFrame) -> DataFrame:
    """content_digest of each distinct text that has no count yet."""
    return keys.select("content_digest").distinct().join(known.select("content_digest"), "content_digest", "left_anti")


def texts_of(digested: DataFrame, misses: DataFrame, count: int) -> DataFrame:
    """content_digest and text of each of count misses, once."""
    once = lambda df: df.groupBy("content_digest").agg(F.first("text").alias("text"))
    if count <= BROADCAST:
        return once(digested.select("content_digest", "text").join(F.broadcast(misses), "content_digest", "left_semi"))
    return once(digested).join(misses, "content_digest", "left_semi")


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs(doc_id, text).

    tokenizer: path of the vocabulary file, the same on all machines. cache: path of the cache table,
    which gets the counts of the texts that it lacks.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    digested = text_or_empty(docs).withColumn("content_digest", F.unhex(F.sha2("text", 256)))
    keys = materialize(digested.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content_digest"), "token-keys")
    known = lambda: read_cache(spark, cache).where(F.col("tokenizer_digest") == version)
    misses = materialize(missing(keys, known()), "token-misses")
    if count := misses.count():
        encode_misses(texts_of(digested, misses, count), tokenizer, version).write.mode("append").parquet(cache)
    counts = known().groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    # Written, so that the join reads both sides plainly and a digest of very many rows can be split.
    counts = materialize(counts.join(keys.select("content_digest").distinct(), "content_digest", "left_semi"), "token-counts")
    return keys.join(counts, "content_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), new_path(spark, "token-cache"))
