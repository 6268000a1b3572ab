"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

#: Labelled documents that the model is fitted on, at most; least hash first.
MAX_TRAIN = 20_000
#: Features of the model, at most.
MAX_FEATURES = 4096
MIN_DOCS = 5
#: How much likelier a feature is in toxic documents, and its least chi-square.
MIN_LIFT = 6.0
MIN_CHI2 = 15.0
#: Lift of the features whose number in a toxic document sets its grade.
GRADE_LIFT = 20.0
PREFIXES = (3, 4, 5, 6)
STEPS = 400
RATE = 0.1
L2 = 1e-5
#: Probability of the first grade or more at which a document is rejected.
REJECT = 0.5
#: Letters and digits, A-Z lower-cased; every other ASCII byte is a space.
FOLDED = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def features_of(text: str | None) -> set[bytes]:
    """The distinct words of a whole text, and the beginnings of the longer ones."""
    words = set((text or "").encode().translate(FOLDED).split())
    begun = {b"^" + w[:size] for size in PREFIXES for w in words if len(w) > size}
    return words | begun


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Model:
    """``P(grade >= k) = sigmoid(score - thresholds[k - 1])``, one score for all k."""

    weights: dict[bytes, float]
    thresholds: list[float]

    def exceeding(self, text: str | None) -> list[float]:
        """Probabilities of grade 1 or more, 2 or more, and so on."""
        known = sorted(self.weights.keys() & features_of(text)) if self.weights else []
        score = fsum(self.weights[f] for f in known)
        return [1 / (1 + exp(min(500.0, t - score))) for t in self.thresholds]


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_thresholds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of the penalised maximum likelihood.

    ``rows`` lists the features of each document. Thresholds are the first one
    and logarithms of the distances between the next, so they stay in order.
    Adam over all rows, a fixed number of steps: the same rows, the same model.
    """
    lengths = np.array([len(r) for r in rows], np.int64)
    columns = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    row_of = np.repeat(np.arange(len(rows)), lengths)
    n = max(1, len(rows))
    weights = np.zeros(n_features)
    shape = np.zeros(n_thresholds)
    rare = np.array([(grades >= k + 1).mean() if len(rows) else 0.0 for k in range(n_thresholds)])
    rare = np.clip(rare, 1e-6, 1 - 1e-6)
    cuts = np.log((1 - rare) / rare)
    shape[0] = cuts[0]
    shape[1:] = np.log(np.maximum(np.diff(cuts), 1e-2))
    means = [np.zeros_like(weights), np.zeros_like(shape)]
    squares = [np.zeros_like(weights), np.zeros_like(shape)]
    for step in range(1, STEPS + 1):
        cuts = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
        score = np.bincount(row_of, weights[columns], len(rows))
        over = _sigmoid(score[:, None] - cuts[None, :])
        bounds = np.hstack([np.ones((len(rows), 1)), over, np.zeros((len(rows), 1))])
        slopes = bounds * (1 - bounds)
        here = np.arange(len(rows))
        mass = np.maximum(bounds[here, grades] - bounds[here, grades + 1], 1e-12)
        by_score = (slopes[here, grades] - slopes[here, grades + 1]) / mass / n
        g_weights = np.bincount(columns, by_score[row_of], n_features) - L2 * weights
        g_cuts = np.zeros(n_thresholds)
        for k in range(n_thresholds):
            at_k, below = grades == k + 1, grades == k
            g_cuts[k] = (slopes[below, k + 1] / mass[below]).sum() / n
            g_cuts[k] -= (slopes[at_k, k + 1] / mass[at_k]).sum() / n
        g_shape = np.concatenate(
            [[g_cuts.sum()], np.cumsum(g_cuts[:0:-1])[::-1] * np.exp(shape[1:])]
        )
        for value, gradient, mean, square in zip(
            (weights, shape), (g_weights, g_shape), means, squares
        ):
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            value += RATE * (mean / (1 - 0.9**step)) / (
                np.sqrt(square / (1 - 0.999**step)) + 1e-8
            )
    cuts = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
    return weights, cuts


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """A model of grades 0 (clean), 1 and 2 (toxic, the half with more toxic words).

    At most ``max_train`` labelled documents are used, those of the least hash of
    the id; a document is toxic if any of its labels says so. Features are words
    and beginnings of words that toxic documents hold far more often. The counts
    that choose them are grouped on the executors; what comes to the driver is
    bounded by ``max_train`` rows and ``MAX_FEATURES`` features. Without toxic
    labels the model rejects nothing.
    """
    sample = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    # at most max_train rows of two numbers
    train = written(
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                found = pa.array(list(features_of(text.as_py())), pa.binary())
                flags = pa.array(np.full(len(found), int(toxic.as_py())), pa.int32())
                yield pa.RecordBatch.from_arrays([found, flags], ["feature", "toxic"])

    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, n_toxic = sizes.n, int(sizes.toxic or 0)
    n_clean = n - n_toxic
    if not n_toxic or not n_clean:
        return Model({}, [20.0, 21.0])
    a, b = F.col("a"), F.col("b")
    counts = (
        train.select("text", F.col("toxic").cast("int"))
        .mapInArrow(emit, "feature binary, toxic int")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    )
    lift = ((a + 0.5) / (n_toxic + 1.0)) / ((b + 0.5) / (n_clean + 1.0))
    odd = a * (n_clean - b) - b * (n_toxic - a)
    spread = (a + b).cast("double") * (n - a - b) * n_toxic * n_clean
    chi2 = F.when(spread > 0, odd.cast("double") * odd * n / spread).otherwise(0.0)
    chosen = (
        counts.filter(a >= MIN_DOCS)
        .select("feature", lift.alias("lift"), chi2.alias("chi2"))
        .filter((F.col("lift") >= MIN_LIFT) & (F.col("chi2") >= MIN_CHI2))
        .orderBy(F.desc("chi2"), "feature")
        .limit(MAX_FEATURES)
        .collect()
    )
    index = {bytes(row.feature): i for i, row in enumerate(chosen)}
    strong = np.array([row.lift >= GRADE_LIFT for row in chosen], bool)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features_of(t.as_py()) for t in batch.column(1)]
            hits = [sorted(index[f] for f in index.keys() & fs) for fs in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(hits, pa.list_(pa.int32())),
                ],
                ["doc_id", "toxic", "hits"],
            )

    ids = train.schema["doc_id"].dataType.simpleString()
    known = sorted(
        train.select("doc_id", "text", F.col("toxic").cast("int"))
        .mapInArrow(rows_of, f"doc_id {ids}, toxic int, hits array<int>")
        .collect()
    )
    rows = [np.array(row.hits, np.int64) for row in known]
    toxic = np.array([row.toxic for row in known], np.int64)
    strength = np.array([strong[hits].sum() for hits in rows])
    grades = toxic + ((toxic == 1) & (strength >= np.median(strength[toxic == 1])))
    weights, cuts = fit_ordinal(rows, grades, len(index), 2)
    return Model({f: float(weights[i]) for f, i in index.items()}, [float(c) for c in cuts])


def graded(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """``doc_id, severity, grade, rejected`` of every row, from its whole text.

    ``severity`` is the expected grade, ``grade`` counts the thresholds that are
    passed with at least even odds, and a row is rejected if its probability of
    grade 1 or more reaches ``reject``. A null or empty text has no features.
    Rows are judged alone, so repeated ones get equal results; other columns are
    not read.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            over = [model.exceeding(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array((fsum(p) for p in over), pa.float64()),
                    pa.array((sum(x >= 0.5 for x in p) for p in over), pa.int32()),
                    pa.array((p[0] >= reject for p in over), pa.bool_()),
                ],
                ["doc_id", "severity", "grade", "rejected"],
            )

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {ids}, severity double, grade int, rejected boolean"
    )


def without_rejected(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, in one pass."""

    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.exceeding(t.as_py())[0] < reject for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
