"""Quality by ordinal cumulative-link regression on graded ratings.

Grades come from the labels: 0 for low quality, 1 for good but toxic, 2 for good. A single linear score of
hashed text features is shared by all grades, and ordered thresholds cut it: P(grade > k) is the logistic
function of score - threshold k. That gives an expected grade and the tail probability of the best grade,
by which documents are selected.

The model is fitted in one task on a bounded sample of label rows, those of the lowest hashes of doc_id, and the text
of each one's doc_id: sample vectors at most, however often an id is repeated in either table. Their whole texts count;
of rows that share a doc_id one. Scoring runs over every row where it lies, without a shuffle. Labels without quality are
left out, a missing toxic mark counts as none, and of a doc_id's labels all count. Where there are no labelled
documents, or all have one grade, nothing is rejected. Null texts are empty. A text of any length is scored whole, a
slice of its words at a time. Only doc_id and text are read of documents, so other columns, of any name, pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import features
from leafline.llm.common import arrow_batch, materialize, read, sampled_texts, text_or_empty
from leafline.llm.optimise import minimise

GRADES = 3
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 8000
#: A document stays if it has the best grade with this probability.
TAIL = 0.3
RIDGE = 1e-4
STEPS = 300
#: A feature is used if its presence is associated with a text being above some grade: by so many standard
#: errors, and with such a phi coefficient, below which thousands of texts make chance look certain.
SCREEN, PHI = 5.0, 0.11


def graded(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) != 0, 1).otherwise(2)
    return labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), grade.alias("grade"))


def sample_vectors(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """grade, numbers, shares of the document of each sampled label: sample rows at most."""
    chosen = graded(labels).orderBy(F.xxhash64("_id"), "_id", "grade").limit(sample)

    def run(batches):
        for batch in batches:
            pairs = features.vectors(batch.column("text"))
            yield arrow_batch({"grade": (batch.column("grade").to_pylist(), pa.int32()), "numbers": ([n.astype(np.int32) for n, _ in pairs], pa.list_(pa.int32())), "shares": ([s.astype(np.float32) for _, s in pairs], pa.list_(pa.float32()))})

    # Written, so that it is chosen once.
    joined = sampled_texts(docs, materialize(chosen, "quality-labels")).select("grade", "text")
    return joined.mapInArrow(run, "grade int, numbers array<int>, shares array<float>")


def screened(grade: np.ndarray, rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Features whose presence tells grades apart: those of a few texts only would be learned by heart."""
    used = np.zeros(features.SIZE, bool)
    for low in range(GRADES - 1):
        for texts in (grade >= 0, grade >= low):
            up, down = texts & (grade > low), texts & (grade <= low)
            if not up.any() or not down.any():
                continue
            a, b = (np.bincount(numbers[which[rows]], minlength=features.SIZE) for which in (up, down))
            share = (a + b) / texts.sum()
            error = np.sqrt(share * (1 - share) * (1 / up.sum() + 1 / down.sum()))
            z = np.where(a + b >= 5, np.abs(a / up.sum() - b / down.sum()) / np.maximum(error, 1e-9), 0)
            used |= z >= max(SCREEN, PHI * texts.sum() ** 0.5)
    return np.flatnonzero(used)


def fit_arrays(grade: np.ndarray, rows: np.ndarray, numbers: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) from sparse rows. Thresholds are kept in order by fitting the log of their steps."""
    n, cuts = len(grade), GRADES - 1
    used = screened(grade, rows, numbers)
    column = np.full(features.SIZE, -1)
    column[used] = np.arange(len(used))
    own = column[numbers] >= 0
    rows, numbers, x = rows[own], column[numbers[own]], shares[own]
    # Columns of about one length let the search turn few corners.
    size = np.sqrt(np.bincount(numbers, x * x, len(used)) / n) + 1e-12
    x = x / size[numbers]
    balance = n / (GRADES * np.maximum(1, np.bincount(grade, minlength=GRADES)))
    # Between equal and balanced weight for the grades, so that the rare ones shape the score and clean texts stay.
    each = np.sqrt(balance)[grade]
    each /= each.sum()

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        w, raw = v[:-cuts], v[-cuts:]
        steps = np.exp(raw[1:])
        limits = np.concatenate(([-np.inf], np.cumsum(np.concatenate((raw[:1], steps))), [np.inf]))
        s = np.bincount(rows, w[numbers] * x, n)
        high, low = (1 / (1 + np.exp(-np.clip(limits[grade + k] - s, -40, 40))) for k in (1, 0))
        high, low = np.where(grade == cuts, 1.0, high), np.where(grade == 0, 0.0, low)
        p = np.maximum(high - low, 1e-12)
        by_score = -each * (high + low - 1)
        by_limit = np.zeros(GRADES + 1)
        np.add.at(by_limit, grade + 1, -each * high * (1 - high) / p)
        np.add.at(by_limit, grade, each * low * (1 - low) / p)
        tail = np.cumsum(by_limit[1:-1][::-1])[::-1]
        g = np.concatenate((np.bincount(numbers, by_score[rows] * x, minlength=len(w)) + 2 * RIDGE * w, tail[:1], tail[1:] * steps))
        return float(-(each * np.log(p)).sum() + RIDGE * w @ w), g

    v = minimise(loss, np.concatenate((np.zeros(len(used)), [-1.0], np.zeros(cuts - 1))), steps=STEPS, tolerance=1e-8)
    weights = np.zeros(features.SIZE)
    weights[used] = v[:-cuts] / size
    return weights, np.cumsum(np.concatenate((v[-cuts:][:1], np.exp(v[-cuts:][1:]))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds). The sample's vectors, bounded by sample, meet in one task."""
    vectors = materialize(sample_vectors(docs, labels, sample), "quality-sample")

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        weights, limits = np.zeros(features.SIZE), np.full(GRADES - 1, -50.0)
        if parts:
            table = pa.Table.from_batches(parts).combine_chunks()
            grade = table["grade"].to_numpy().astype(np.int64)
            if len(set(grade.tolist())) > 1:
                lists = table["numbers"].combine_chunks()
                rows = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))
                weights, limits = fit_arrays(grade, rows, lists.flatten().to_numpy(), table["shares"].combine_chunks().flatten().to_numpy().astype(np.float64))
        yield arrow_batch({"weights": ([weights.astype("<f4").tobytes()], pa.binary()), "limits": ([limits.astype("<f8").tobytes()], pa.binary())})

    model = vectors.coalesce(1).mapInArrow(run, "weights binary, limits binary").first()
    if model is None:  # no partition at all
        return np.zeros(features.SIZE), np.full(GRADES - 1, -50.0)
    return np.frombuffer(model["weights"], "<f4").astype(float), np.frombuffer(model["limits"], "<f8")


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], tail: float = TAIL) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept of every row."""
    weights, limits = model[0].reshape(-1, 1).astype(np.float32), model[1]

    def run(batches):
        for batch in batches:
            s = features.scores(batch.column("text"), weights)[:, 0]
            above = 1 / (1 + np.exp(-np.clip(s[:, None] - limits, -40, 40)))
            yield arrow_batch({"doc_id": (batch.column("doc_id"), pa.int64()), "expected_grade": (above.sum(axis=1), pa.float64()), "tail_probability": (above[:, -1], pa.float64()), "kept": (above[:, -1] >= tail, pa.bool_())})

    return text_or_empty(docs).mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], tail: float = TAIL) -> DataFrame:
    """The rows of docs that the model keeps, all columns as they are and no shuffle."""
    weights, limits = model[0].reshape(-1, 1).astype(np.float32), model[1]

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            s = features.scores(texts.fill_null(""), weights)[:, 0]
            above = 1 / (1 + np.exp(-np.clip(s - limits[-1], -40, 40)))
            yield batch.filter(pa.array(above >= tail))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
