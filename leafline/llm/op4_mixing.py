"""Mixing to target weights by soft membership.

A softmax classifier, fitted on a bounded sample of labelled documents, gives every document a posterior
over the domains (here its languages), so that mixed and unlabelled documents count in parts. Then each
document gets a rate r >= 0 such that expected token totals, the sum of r x tokens x posterior, match
targets: weighted least squares by projected gradient. A step takes from each rate the inner product of
its posterior with one vector per step; so all that is kept of the search is those few vectors, a rate is
their fold over the posterior, and a step is one pass that sums a number for each domain.

The residual is measured in the metric of the inverse Gram matrix of the posteriors, in which the gradient
has Lipschitz constant one: with no rate at zero a single step arrives, and each further one mends what
the projection has cut. If targets can't be met exactly the least-squares fit is given.

Tokens are those of a byte-level tokenizer, the one that packing uses, without an end id.

Null texts are empty, have no tokens and the classifier's prior as posterior. Repeated rows count as often
as they come. Without labelled documents, or with one domain only, all rates are one. A text of any length is
counted and classified whole; texts are encoded in bounded groups. Other columns, of any name, pass through mix().
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import features
from leafline.llm.common import arrow_batch, materialize, read, sampled_texts, text_or_empty
from leafline.llm.optimise import minimise
from leafline.llm.words import encoder

#: Shares of tokens that the mixture should have.
TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 4000
RIDGE, SCALE = 1e-5, 30.0
#: Bytes of texts that are encoded together, and that a mixed batch holds, or one row.
TEXT_BYTES, BATCH_BYTES = 1 << 20, 1 << 24
#: Passes at most, and the relative residual at which the search ends.
PASSES, CLOSE = 40, 1e-6


@dataclass(frozen=True)
class Mixture:
    """What the rates follow from: domains, the classifier's weights and biases, first rate and steps."""

    domains: tuple[str, ...]
    weights: np.ndarray
    biases: np.ndarray
    start: float
    steps: tuple[tuple[float, ...], ...]

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        r = np.full(len(posteriors), self.start)
        for step in self.steps:
            r = np.maximum(0.0, r - posteriors @ np.array(step))
        return r


def posteriors(texts: pa.Array, weights: np.ndarray, biases: np.ndarray) -> np.ndarray:
    """Posterior by domain of each text."""
    tokens = np.zeros(len(texts), np.int64)
    total = np.zeros((len(texts), weights.shape[1]))
    for text, hashed in features.hashed_tokens(texts):
        tokens += np.bincount(text, minlength=len(texts))
        for c in range(weights.shape[1]):
            total[:, c] += np.bincount(text, weights[hashed, c], len(texts))
    logits = total / (tokens + features.DAMP)[:, None] + biases
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, domain: the language of each document that has a label row."""
    marked = labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct()
    known = docs.where("lang is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("domain"))
    return known.join(marked, known["doc_id"] == marked["_id"], "left_semi")


def classify(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], sample: int = SAMPLE) -> tuple[tuple[str, ...], np.ndarray, np.ndarray]:
    """(domains, weights, biases). At most sample vectors meet in one task: a doc_id has one for each domain that it is labelled
    with, however often it is repeated. Labelled rows of domains without a target aren't used."""
    once = labelled.where(F.col("domain").isin(*targets)).select(F.col("doc_id").alias("_id"), "domain").distinct()
    # Written, so that it is chosen once.
    chosen = materialize(once.orderBy(F.xxhash64("_id"), "_id", "domain").limit(sample), "mixing-labels")
    docs = sampled_texts(docs, chosen).select("domain", "text")

    def vectors(batches):
        for batch in batches:
            pairs = [(n[n < features.HASHED], s[n < features.HASHED]) for n, s in features.vectors(batch.column("text"))]
            yield arrow_batch({"domain": (batch.column("domain"), pa.string()), "numbers": ([n.astype(np.int32) for n, _ in pairs], pa.list_(pa.int32())), "shares": ([s.astype(np.float32) for _, s in pairs], pa.list_(pa.float32()))})

    def fit(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        names = table["domain"].to_pylist()
        domains = sorted(set(names))
        lists = table["numbers"].combine_chunks()
        rows, numbers = np.repeat(np.arange(len(names)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
        x = table["shares"].combine_chunks().flatten().to_numpy().astype(np.float64)
        weights, biases = softmax_fit(np.array([domains.index(d) for d in names]), len(domains), rows, numbers, x)
        yield arrow_batch({"domains": ([domains], pa.list_(pa.string())), "weights": ([weights.astype("<f4").tobytes()], pa.binary()), "biases": ([biases.tolist()], pa.list_(pa.float64()))})

    table = materialize(docs.mapInArrow(vectors, "domain string, numbers array<int>, shares array<float>"), "mixing-sample")
    model = table.coalesce(1).mapInArrow(fit, "domains array<string>, weights binary, biases array<double>").first()
    if model is None:
        return (), np.zeros((features.HASHED, 1)), np.zeros(1)
    return tuple(model["domains"]), np.frombuffer(model["weights"], "<f4").reshape(features.HASHED, -1), np.array(model["biases"])


def softmax_fit(domain: np.ndarray, count: int, rows: np.ndarray, numbers: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(domain)
    often = np.flatnonzero(np.bincount(numbers, minlength=features.HASHED) >= 5)
    column = np.full(features.HASHED, -1)
    column[often] = np.arange(len(often))
    own = column[numbers] >= 0
    rows, numbers, x = rows[own], column[numbers[own]], shares[own] * SCALE
    truth = np.eye(count)[domain]

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        w = v.reshape(len(often) + 1, count)
        logits = np.stack([np.bincount(rows, w[numbers, c] * x, n) for c in range(count)], axis=1) + w[-1]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        off = (p - truth) / n
        g = np.stack([np.bincount(numbers, off[rows, c] * x, minlength=len(often)) for c in range(count)], axis=1) + 2 * RIDGE * w[:-1]
        return float(-np.log(np.maximum((p * truth).sum(axis=1), 1e-300)).mean() + RIDGE * (w[:-1] ** 2).sum()), np.concatenate((g, off.sum(axis=0)[None])).ravel()

    w = minimise(loss, np.zeros((len(often) + 1) * count), steps=60, tolerance=1e-5).reshape(-1, count)
    out = np.zeros((features.HASHED, count))
    out[often] = w[:-1] * SCALE
    return out, w[-1]


def memberships(docs: DataFrame, weights: np.ndarray, biases: np.ndarray, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, p0, p1, ... of every row."""
    names = [f"p{k}" for k in range(len(biases))]

    def run(batches):
        for batch in batches:
            p, n = posteriors(batch.column("text"), weights, biases), []
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(ends // TEXT_BYTES, prepend=-1))
            for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
                n += encoder(tokenizer).counts(batch.column("text").slice(at, end - at).to_pylist())
            yield arrow_batch({"doc_id": (batch.column("doc_id"), pa.int64()), "n_tokens": (n, pa.int64())} | {c: (p[:, k], pa.float64()) for k, c in enumerate(names)})

    return text_or_empty(docs).mapInArrow(run, f"doc_id long, n_tokens long, {', '.join(f'{c} double' for c in names)}")


def rated(member: DataFrame, mixture: Mixture) -> DataFrame:
    """member with the rate of each row, folded in the task, so that many steps make no deep expression."""

    def run(batches):
        for batch in batches:
            p = np.stack([batch.column(f"p{k}").to_numpy(zero_copy_only=False) for k in range(len(mixture.biases))], axis=1)
            yield batch.append_column("rate", pa.array(mixture.rates(p), pa.float64()))

    return member.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in member.dtypes) + ", rate double")


def solve(member: DataFrame, shares: np.ndarray, total: float | None = None) -> tuple[float, tuple[tuple[float, ...], ...]]:
    """(first rate, steps). total: tokens of the mixture; by default the least at which no domain loses tokens.

    A pass brings a number for each domain to the driver, the first one for each pair of domains.
    """
    k = len(shares)

    def summed(start: float, steps: tuple, squares: bool = False) -> np.ndarray:
        mixture, width = Mixture(("",) * k, np.zeros((1, k)), np.zeros(k), start, steps), k + k * k * squares

        def run(batches):
            total = np.zeros(width)
            for batch in batches:
                n = batch.column("n_tokens").to_numpy(zero_copy_only=False)
                p = np.stack([batch.column(f"p{i}").to_numpy(zero_copy_only=False) for i in range(k)], axis=1)
                weighed = p * (n * mixture.rates(p))[:, None]
                total += np.concatenate([weighed.sum(axis=0), (weighed.T @ p).ravel()])[:width]
            yield arrow_batch({f"s{i}": ([x], pa.float64()) for i, x in enumerate(total.tolist())})

        names = [f"s{i}" for i in range(width)]
        row = member.mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c).alias(c) for c in names]).first()
        return np.array([float(x or 0) for x in row])

    first = summed(1.0, (), squares=True)
    natural, gram = first[:k], first[k:].reshape(k, k)
    if natural.sum() <= 0:
        return 1.0, ()
    total = total or float((natural / shares).max())
    goal = total * shares
    inverse = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    start, steps = 1.0, ()
    now = natural
    for _ in range(PASSES):
        off = now - goal
        if np.abs(off).max() <= CLOSE * total:
            break
        steps = (*steps, tuple((inverse @ off).tolist()))
        before, now = off, summed(start, steps)
        if np.abs(now - goal - before).max() <= 1e-9 * total:
            break
    return start, steps


def fit(docs: DataFrame, labelled: DataFrame, tokenizer: str, targets: dict[str, float] | None = None, total: float | None = None, sample: int = SAMPLE) -> tuple[Mixture, DataFrame]:
    """The mixture and the written memberships that it was fitted on. Targets of domains without labelled
    documents are left out and the others scaled to one."""
    targets = targets or TARGETS
    domains, weights, biases = classify(docs, labelled, targets, sample)
    member = materialize(memberships(docs, weights, biases, tokenizer), "mixing-memberships")
    if len(domains) < 2:
        return Mixture(domains or ("",), weights, biases, 1.0, ()), member
    shares = np.array([targets[d] for d in domains], float)
    start, steps = solve(member, shares / shares.sum(), total)
    return Mixture(domains, weights, biases, start, steps), member


def taken(copies: np.ndarray, size: np.ndarray, limit: int = BATCH_BYTES):
    """Row numbers, each as often as copies says, in runs of limit bytes, or one row where that has more."""
    held: list[np.ndarray] = []
    room = limit
    for row in np.flatnonzero(copies).tolist():
        left, each = int(copies[row]), int(size[row]) + 64
        while left:
            n = min(left, max(room // each, 0 if held else 1))
            if n:
                held.append(np.full(n, row))
                left, room = left - n, room - n * each
            if left or room <= 0:
                yield np.concatenate(held)
                held, room = [], limit
    if held:
        yield np.concatenate(held)


def mix(docs: DataFrame, mixture: Mixture, seed: int = 7, least: int = 0) -> DataFrame:
    """docs with each row as often as its rate says, and least times at least: the whole part, and once more
    with the rest as probability, drawn from the hash of doc_id, so that a lost task draws the same again.
    No shuffle, and no batch holds more than BATCH_BYTES of copies, however high a rate is."""
    # The last column, whatever the others are called.
    drawn = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    drawn = drawn.withColumn("draw", F.pmod(F.xxhash64(F.lit(seed), F.col(f"c{docs.columns.index('doc_id')}")), F.lit(1 << 30)) / float(1 << 30))
    text = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(text).fill_null("")
            r = mixture.rates(posteriors(texts, mixture.weights, mixture.biases))
            copies = np.floor(r + batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)).astype(np.int64).clip(least)
            own = batch.select(range(batch.num_columns - 1)).rename_columns(docs_columns)
            for rows in taken(copies, pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                yield own.take(pa.array(rows))

    docs_columns = docs.columns
    return drawn.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    mixture, member = fit(docs, labelled_domains(docs, read(spark, sf_dir, "labels")), public_tokenizers.path("byte_bpe_50k.json"))
    out = [F.round(f"p{k}", 6).alias(f"share_{d}") for k, d in enumerate(mixture.domains)]
    return rated(member, mixture).select("doc_id", "n_tokens", *out, "rate")
