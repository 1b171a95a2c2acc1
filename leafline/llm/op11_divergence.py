"""Audit of how sources diverge, by language: each from every other and from the language as a whole.

Terms are counted in tasks and added up by (language, source, term). Terms in enough documents of a language
are kept and numbered within slices of it, in the order of their bytes. A cell is a block of sources and a
slice: it holds a compressed count vector for each source, so that neither a source nor a vocabulary meets in
one task whole.

Cells stay where they are, partitioned once and kept. The blocks of a language play a round-robin tournament:
in each round every block meets one other, whose vectors are sent to it, and the next round sends the vectors
on. A meeting gives both directions of every pair of sources, summed over the slice; each pair meets once. Some
rounds make a job, so that what is on its way stays a fixed multiple of the vectors however many blocks
there are. Before the rounds each block meets itself, and the language's own vector: a heap of each source
keeps its best terms of the slice, and the best of all slices are ranked.

All arithmetic is on whole numbers. Null texts, languages and sources are ''. A source without terms is a source
of zero counts; a language without kept terms gives pairs of value 0 and no terms. Repeated rows count as often as they
come. An empty table gives no rows. Only text, lang and source are read, so further columns of any name can't
clash. A text is read whole, in one task; its terms may be of any length.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafline.llm.common import arrow_batch, materialize, new_path, read

LEAST_DOCUMENTS, TOP = 10, 10
#: Sources of a block; terms of a slice, and slices at least; rounds of a job.
BLOCK, SLICE, SLICES, ROUNDS = 4, 8192, 24, 4
#: Different (language, source, term) that a task counts before it hands them on.
HELD = 1 << 18
UNIT = 1_000_000_000
#: Bytes of terms: A-Z lower-cased, a-z and all of the signs beyond ASCII as they are; all else parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of every term, and a row of null term for each source."""

    def hand_on(counts, found):
        out = [(*group, term, n, found[group][term]) for group, own in counts.items() for term, n in own.items()]
        out += [(*group, None, 0, 0) for group in counts]
        lang, source, term, n, found_in = zip(*out, strict=True)
        return arrow_batch({"lang": (lang, pa.string()), "source": (source, pa.string()), "term": (pa.array(term, pa.binary()).cast(pa.string()), None), "n": (n, pa.int64()), "docs": (found_in, pa.int64())})

    def run(batches):
        counts, found, held = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs, sources = part.column("lang").to_pylist(), part.column("source").to_pylist()
                for lang, source, text in zip(langs, sources, part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    own = Counter(text.translate(LETTERS).split(b" "))
                    del own[b""]
                    group = counts[lang, source]
                    held -= len(group)
                    group.update(own)
                    held += len(group)
                    found[lang, source].update(own.keys())
                    if held >= HELD:
                        yield hand_on(counts, found)
                        counts, found, held = defaultdict(Counter), defaultdict(Counter), 0
        if counts:
            yield hand_on(counts, found)

    read_as = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = read_as.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, n of terms in at least so many documents of their language."""
    return counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")


def numbered(kept: DataFrame) -> DataFrame:
    """kept with slice and id: terms of a slice are numbered from 0 in the order of their bytes."""
    slices = max(SLICES, math.ceil(kept.count() / SLICE))
    sliced = kept.withColumn("slice", F.pmod(F.xxhash64("lang", "term"), F.lit(slices)).cast("int"))
    return sliced.withColumn("id", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")) - 1)


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A sparse vector: steps from id to id, then the counts, deflated."""
    return zlib.compress(np.concatenate((np.diff(ids, prepend=0), counts)).astype("<i8").tobytes(), 1)


def unpacked(vector: bytes | None, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    if vector:
        steps, counts = np.frombuffer(zlib.decompress(vector), "<i8").reshape(2, -1)
        out[steps.cumsum()] = counts
    return out


def vectors(counts: DataFrame, terms: DataFrame, by: list[str]) -> DataFrame:
    """by, slice, vector of counts(lang, term, n and by)."""

    def pack(key, table):
        ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
        order = ids.argsort()
        *group, slice_ = ([k.as_py()] for k in key)
        return pa.table([*(pa.array(g, pa.string()) for g in group), pa.array(slice_, pa.int32()), pa.array([packed(ids[order], n[order])], pa.binary())], names=[*by, "slice", "vector"])

    found = counts.join(terms.select("lang", "term", "slice", "id"), ["lang", "term"]).select(*by, "slice", "id", "n")
    return found.groupBy(*by, "slice").applyInArrow(pack, ", ".join(f"{c} string" for c in by) + ", slice int, vector binary")


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + UNIT * (count + 2) / total, rounded down, digits of a thousand at a time so that nothing overflows."""
    out, rest = np.zeros_like(counts), counts + 2
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shares(members: list[dict], size: int) -> np.ndarray:
    """A row for each member(total, vector)."""
    return np.array([shares(unpacked(m["vector"], size), m["total"]) for m in members], np.int64).reshape(len(members), size)


def cells(groups: DataFrame, terms: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, slice, block, size and members: array of (k, total, vector). groups: lang, source, k. Every block has a cell in every slice of
    its language, in one empty slice if the language keeps no term."""
    sizes = terms.groupBy("lang", "slice").agg(F.count("*").cast("int").alias("size"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"))
    own = counts.where("term is not null").join(terms.select("lang", "term"), ["lang", "term"], "left_semi")
    occurrences = own.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"))
    totals = groups.join(occurrences, ["lang", "source"], "left").join(kept, "lang", "left")
    totals = totals.select("lang", "source", "k", (F.coalesce("occurrences", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total"))
    every = totals.join(sizes, "lang", "left").select("lang", "source", "k", "total", F.coalesce("slice", F.lit(0)).alias("slice"), F.coalesce("size", F.lit(0)).alias("size"))
    filled = every.join(vectors(counts.select("lang", "source", "term", "n"), terms, ["lang", "source"]), ["lang", "source", "slice"], "left")
    block = F.floor(F.col("k") / BLOCK).cast("int").alias("block")
    return filled.groupBy("lang", "slice", block).agg(F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("k", "total", "vector"))).alias("members"))


PAIR = "lang string, a int, b int, value long"
MEMBERS = "array<struct<k:int,total:bigint,vector:binary>>"


def _pairs_of(lang: str, one: list[dict], other: list[dict] | None, size: int) -> list[tuple]:
    """Both directions of every pair of a meeting; other None: of a block with itself."""
    p = _shares(one, size)
    q = p if other is None else _shares(other, size)
    out = []
    for i, a in enumerate(one):
        values = divergence(p[i], q).sum(axis=1).tolist()
        for j, b in enumerate(other or one):
            if other is not None:
                out += [(lang, a["k"], b["k"], values[j]), (lang, b["k"], a["k"], values[j])]
            elif i != j:
                out.append((lang, a["k"], b["k"], values[j]))
    return out


def _pair_batch(out: list[tuple]) -> pa.RecordBatch:
    lang, a, b, value = zip(*out, strict=True)
    return arrow_batch({"lang": (lang, pa.string()), "a": (a, pa.int32()), "b": (b, pa.int32()), "value": (value, pa.int64())})


def meetings(met: DataFrame) -> DataFrame:
    """PAIR of met(lang, size, members, guests); guests null: a block meets itself."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                for r in batch.slice(at, 1).to_pylist():
                    if out := _pairs_of(r["lang"], r["members"], r["guests"], r["size"]):
                        yield _pair_batch(out)

    return met.select("lang", "size", "members", "guests").mapInArrow(run, PAIR).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def best_terms(met: DataFrame, top: int) -> DataFrame:
    """lang, k, slice, id, value: of each source the best terms of each slice, by its heap. met: cells with the language's
    own vector and total."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                q = shares(unpacked(r["all"], r["size"]), r["all_total"])
                out = []
                for m in r["members"]:
                    n = unpacked(m["vector"], r["size"])
                    p = shares(n, m["total"])
                    ids = np.flatnonzero((n > 0) & (p > q))
                    out += [(r["lang"], m["k"], r["slice"], i, -v) for v, i in heapq.nsmallest(top, zip((-divergence(p[ids], q[ids])).tolist(), ids.tolist(), strict=True))]
                if out:
                    lang, k, slice_, i, v = zip(*out, strict=True)
                    yield arrow_batch({"lang": (lang, pa.string()), "k": (k, pa.int32()), "slice": (slice_, pa.int32()), "id": (i, pa.int32()), "value": (v, pa.int64())})

    return met.select("lang", "slice", "size", "members", "all", "all_total").mapInArrow(run, "lang string, k int, slice int, id int, value long")


def partner(block, round_, seats):
    """Whom a block meets in a round of the tournament of an even number of seats: places in a circle but the last, which each
    round pairs with the one that would meet itself. Columns of whole numbers."""
    ring = seats - 1
    other = F.pmod(round_ - block, ring)
    alone = F.pmod(round_.cast("long") * F.floor(seats / 2), ring)
    return F.when(block == ring, alone).when(other == block, ring).otherwise(other)


def rotate(held: DataFrame, rounds: int) -> DataFrame:
    """PAIR sums of all blocks' meetings with others; held: cells with blocks, the number of blocks of their language."""
    spark, path = held.sparkSession, new_path(held.sparkSession, "divergence-meetings")
    keys = ["lang", "slice", "block"]
    resident = held.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for first in range(0, rounds, ROUNDS):
            seats = F.col("blocks") + F.pmod("blocks", F.lit(2))
            on = held.withColumn("round", F.explode(F.sequence(F.lit(first), F.lit(min(rounds, first + ROUNDS) - 1)))).where(F.col("round") < seats - 1)
            on = on.withColumn("at", partner(F.col("block"), F.col("round"), seats))
            # Each pair meets at the place of one of the two, which differs from round to round; a free seat sends and receives nothing.
            sent = on.where((F.col("at") < F.col("blocks")) & F.when(F.col("block") < F.col("at"), (F.col("block") + F.col("at")) % 2 == 0).otherwise((F.col("block") + F.col("at")) % 2 == 1))
            sent = sent.select("lang", "slice", F.col("at").cast("int").alias("block"), F.col("members").alias("guests"))
            meetings(resident.join(sent, keys)).write.mode("append").parquet(path)
    finally:
        resident.unpersist()
    return spark.read.schema(PAIR).parquet(path) if rounds else spark.createDataFrame([], PAIR)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. Part pair: every other source of the language and the divergence from it; part term: the top
    terms that the source has more of than its language."""
    counts = materialize(term_counts(docs), "divergence-counts")
    terms = materialize(numbered(materialize(kept_terms(counts, least), "divergence-kept")), "divergence-terms")
    sources = counts.where("term is null").select("lang", "source")
    groups = materialize(sources.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "divergence-sources")
    blocks = groups.groupBy("lang").agg((F.floor(F.max("k") / BLOCK) + 1).cast("int").alias("blocks"))
    held = materialize(cells(groups, terms, counts).join(blocks, "lang"), "divergence-cells")
    within = materialize(meetings(held.withColumn("guests", F.lit(None).cast(MEMBERS))), "divergence-within")
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    rounds = most + most % 2 - 1 if most > 1 else 0
    sums = within.unionByName(rotate(held, rounds)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    whole = vectors(terms.select("lang", "term", "n"), terms, ["lang"]).withColumnRenamed("vector", "all")
    whole = whole.join(terms.groupBy("lang").agg((F.sum("n") + 2 * F.count("*")).alias("all_total")), "lang")
    heaps = materialize(best_terms(held.join(whole, ["lang", "slice"]), top), "divergence-heaps")
    named = groups.select("lang", "source", "k")
    pairs = sums.join(named.withColumnRenamed("k", "a"), ["lang", "a"]).join(named.select("lang", F.col("k").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    best = heaps.join(terms.select("lang", "slice", "id", F.col("term").alias("item")), ["lang", "slice", "id"]).join(named, ["lang", "k"])
    best = best.select("lang", "source", F.lit("term").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(best.withColumn("rank", rank).where(F.col("rank") <= top))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


#: The same by joins over every term of every pair of groups; r: the result's rows before they are ranked.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT i, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT i) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
q AS (SELECT lang, term, CAST(1 + 1000000000 * CAST(n + 2 AS HUGEINT) // (total + 2 * v) AS HUGEINT) AS q FROM kept JOIN v USING (lang)),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, CAST(1 + 1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // (coalesce(t.total, 0) + 2 * v) AS HUGEINT) AS p
    FROM g JOIN kept AS k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN t USING (lang, source)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 10
"""
