"""One row of each group of near copies: five-word shingles with a Jaccard similarity of 0.8 or more.

Texts of equal shingle sets are one node. The caller's fingerprints propose pairs of nodes: texts that its links put into one
component meet in a bucket. Pairs of similarity 0.8 can be up to 12 of a SimHash's 64 bits apart, where a covering family has 8191
tables; so min-wise hashes in bands of a few rows propose those that fingerprints leave apart. Two sets of similarity s share no
band with probability (1 - s ** ROWS) ** BANDS, 3e-5 at 0.8. Whoever proposes a pair, only one whose shingle sets have the
similarity is linked.

A bucket of at most CROWD nodes proposes all its pairs. In a larger one every node first meets the bucket's centre,
the node whose bands are the most frequent ones: copies of one text have that text or a close copy as the centre of all
their buckets, so a node meets few, and most are linked there. The buckets of a centre are a family. Where links leave
a family in several components, those outside the centre's meet all of the family in cells, a
block of nodes by a block: a task compares two blocks' shingle sets as matrices, exactly, and gives only such links as
join components. So the closure is that of all pairs; no pair is a row of a table but the links, and the sets of
a node are sent once for each block of its family, not for each bucket.

Null texts are empty; texts without words are copies of each other. Rows are told apart by a written
number, so that repeated or null doc_ids name no row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import arrow_batch, materialize, rows
from leafline.llm.graph import components

WIDTH, SEED = 5, 42
BANDS, ROWS = 20, 4
CROWD = 16
#: Nodes and shingles of a block, about; columns of a matrix.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1 << 19, 1 << 14
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 64, (3, BANDS * ROWS), np.uint64)
FLIP, FACTOR, MIX = _DRAWN[0], _DRAWN[1] | np.uint64(1), (_DRAWN[2] | np.uint64(1)).reshape(BANDS, ROWS)


def shingles(text: bytes) -> np.ndarray:
    """XXH64 of the different runs of five words, in order; a shorter text is one run, one without words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - WIDTH + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)], np.uint64))


def bands(own: np.ndarray) -> np.ndarray:
    """BANDS keys, each of ROWS min-wise hashes."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(own), 2048):
        np.minimum(least, ((own[at : at + 2048, None] ^ FLIP) * FACTOR).min(axis=0), out=least)
    return (least.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)


def _text(df: DataFrame) -> DataFrame:
    """The row number in the place of doc_id, and the text."""
    return df.select(F.col("_row").alias("doc_id"), F.coalesce("doc.text", F.lit("")).alias("text"))


def _prints(df: DataFrame, fingerprint: Callable[[bytes], int]) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, sets, keys, fps = [], [], [], []
            for row, text in rows(batch):
                own = shingles(text)
                ids.append(row)
                sets.append(xxhash.xxh3_128_digest(own.tobytes()))
                keys.append(bands(own).view(np.int64) if len(own) else np.zeros(0, np.int64))
                fps.append(fingerprint(text))
            yield arrow_batch({"row": (ids, pa.int64()), "same": (sets, pa.binary()), "bands": (keys, pa.list_(pa.int64())), "fp": (np.array(fps, np.uint64).view(np.int64), pa.int64())})

    return _text(df).mapInArrow(run, "row long, same binary, bands array<long>, fp long")


def _sets(df: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, sets = [], []
            for row, text in rows(batch):
                ids.append(row)
                sets.append(shingles(text).view(np.int64))
            yield arrow_batch({"node": (ids, pa.int64()), "own": (sets, pa.list_(pa.int64()))})

    return _text(df).mapInArrow(run, "node long, own array<long>")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (u, v), those of similarity 0.8 or more: common / (all - common) >= 4 / 5."""
    one, other = sets.select(F.col("node").alias("u"), F.col("own").alias("a")), sets.select(F.col("node").alias("v"), F.col("own").alias("b"))
    near = (5 * F.least(F.size("a"), F.size("b")) >= 4 * F.greatest(F.size("a"), F.size("b"))) & (9 * F.size(F.array_intersect("a", "b")) >= 4 * (F.size("a") + F.size("b")))
    return pairs.join(one, "u").join(other, "v").where(near).select("u", "v")


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def cell_links(own: list[np.ndarray], other: list[np.ndarray], label: np.ndarray, other_label: np.ndarray) -> list[tuple[int, int]]:
    """Places (in own, in other) of pairs of similarity 0.8 or more that join components, as many as do and no more. Sets are sorted."""
    sizes, other_sizes = np.array(list(map(len, own))), np.array(list(map(len, other)))
    shared = np.intersect1d(np.concatenate(own), np.concatenate(other))
    common = np.zeros((len(own), len(other)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        part = shared[at : at + COLUMNS]
        a, b = (_incidence(sets, part) for sets in (own, other))
        common += a @ b.T
    near = 9 * common >= 4 * (sizes[:, None] + other_sizes)
    near &= label[:, None] != other_label
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        if (u := root(int(label[i]))) != (v := root(int(other_label[j]))):
            parent[max(u, v)] = min(u, v)
            out.append((i, j))
    return out


def _incidence(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(columns)), np.float32)
    for i, own in enumerate(sets):
        own = own[np.searchsorted(own, columns[0]) : np.searchsorted(own, columns[-1], "right")]
        at = np.searchsorted(columns, own)
        out[i, at[columns[at] == own]] = 1
    return out


def across(crowded: DataFrame, label: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) between components of each family of crowded(node, centre); label(node, label) as it is so far."""
    members = materialize(crowded.join(label, "node", "left").select("centre", "node", F.coalesce("label", "node").alias("label")), "copies-families")
    mains = members.where("node = centre").select("centre", F.col("label").alias("main"))
    marked = members.join(mains, "centre").withColumn("outside", F.col("label") != F.col("main"))
    marked = materialize(marked.join(sets.select("node", F.size("own").alias("size")), "node"), "copies-marked")
    block = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SHINGLES)).cast("int")
    counts = marked.groupBy("centre").agg(block(F.count("*"), F.sum("size")).alias("all_blocks"), F.count_if("outside").alias("n"), F.sum(F.when(F.col("outside"), F.col("size")).otherwise(0)).alias("_size"))
    counts = counts.where("n > 0").select("centre", "all_blocks", block(F.col("n"), F.col("_size")).alias("out_blocks"))
    placed = marked.join(counts, "centre").join(sets, "node").drop("size", "main")
    at = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    sent = lambda df, side, own, other: df.select("centre", at(own).alias(f"_{side}"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("_other"), "node", "label", "own", F.lit(side).alias("side"))
    rows = sent(placed.where("outside"), "row", "out_blocks", "all_blocks").select("centre", F.col("_row").alias("r"), F.col("_other").alias("c"), "node", "label", "own", "side")
    columns = sent(placed, "column", "all_blocks", "out_blocks").select("centre", F.col("_other").alias("r"), F.col("_column").alias("c"), "node", "label", "own", "side")

    def meet(key, table):
        side, node, label = table["side"].to_numpy(), table["node"].to_numpy(), table["label"].to_numpy()
        held = [np.sort(x.values.to_numpy(zero_copy_only=False)) for x in table["own"].combine_chunks()] if table.num_rows else []
        one, other = np.flatnonzero(side == "row"), np.flatnonzero(side == "column")
        found = cell_links([held[i] for i in one], [held[i] for i in other], label[one], label[other]) if len(one) and len(other) else []
        u, v = (np.array([node[side[x[k]]] for x in found], np.int64) for k, side in ((0, one), (1, other)))
        return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    return rows.unionByName(columns).groupBy("centre", "r", "c").applyInArrow(meet, "u long, v long")


def _fingerprinted(prints: DataFrame, nodes: DataFrame, grouped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, t, key: of each node with words, the components of its texts' fingerprints, as one more table of buckets."""
    own = prints.where("size(bands) > 0").select("same", "fp").distinct()
    label = grouped(own.select("fp").distinct()).select("fp", "label")
    return own.join(label, "fp").join(nodes.select("same", "node"), "same").select("node", F.lit(BANDS).alias("t"), F.col("label").alias("key")).distinct()


def links(keyed: DataFrame, numbered: DataFrame) -> DataFrame:
    """Pairs of nodes of keyed(node, t, key) whose closure is that of all pairs that share a bucket (t, key) and have the similarity."""
    buckets = materialize(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "copies-buckets")
    met = materialize(keyed.join(buckets, ["t", "key"]), "copies-met")
    few = met.where(f"n <= {CROWD}").groupBy("t", "key").agg(F.collect_list("node").alias("all"))
    few = few.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b"))
    busy = met.where(f"n > {CROWD}")
    # The more often a node's bands are met, the more it is like the others.
    liked = busy.groupBy("node").agg(F.sum("n").alias("liked"))
    centres = busy.join(liked, "node").groupBy("t", "key").agg(F.min(F.struct((-F.col("liked")).alias("l"), F.col("node").alias("centre")))["centre"].alias("centre"))
    crowded = materialize(busy.join(centres, ["t", "key"]).select("node", "centre").distinct(), "copies-crowded")
    pairs = materialize(_ordered(few.where("a < b").union(crowded), "a", "b"), "copies-pairs")
    # Written, so that the planner knows its size before any text moves.
    wanted = materialize(met.select(F.col("node").alias("_row")).distinct(), "copies-wanted")
    sets = materialize(_sets(numbered.select("_row", F.struct("doc.text").alias("doc")).join(wanted, "_row", "left_semi")), "copies-sets")
    found = materialize(_alike(pairs, sets), "copies-links")
    if crowded.isEmpty():
        return found
    return found.union(materialize(across(crowded, components(found), sets), "copies-across"))


def keep_one(docs: DataFrame, fingerprint: Callable[[bytes], int], grouped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of each group of near copies the row of the smallest doc_id, all columns kept; null doc_ids come last.
    fingerprint: 64 bits of a text. grouped: fp and label of each of distinct fingerprints (fp), equal for those that it links."""
    # The row in one struct, so that its columns clash with no others.
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "copies-rows")
    prints = materialize(_prints(numbered, fingerprint), "copies-prints")
    nodes = materialize(prints.groupBy("same").agg(F.min("row").alias("node"), F.first("bands").alias("bands")), "copies-nodes")
    marked = materialize(_fingerprinted(prints, nodes, grouped), "copies-fingerprints")
    label = components(links(nodes.select("node", F.posexplode("bands").alias("t", "key")).union(marked), numbered))
    named = materialize(nodes.select("same", "node").join(label, "node", "left").select("same", F.coalesce("label", "node").alias("label")), "copies-labels")
    ids = numbered.select(F.col("_row").alias("row"), F.col("doc.doc_id").cast("long").alias("id"))
    chosen = prints.select("row", "same").join(named, "same").join(ids, "row").groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).getField("row").alias("_row"))
    # The rows that go are the fewer ones. Written, so that the planner knows their size: while it lets them be broadcast no text moves.
    removed = materialize(prints.select(F.col("row").alias("_row")).join(chosen.select("_row"), "_row", "left_anti"), "copies-removed")
    return numbered.join(removed, "_row", "left_anti").select("doc.*")
