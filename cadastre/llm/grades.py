"""Quality classifier: cumulative-link (ordinal logistic) regression on graded ratings.

One set of hashed-text weights w gives a text its score s; ordered thresholds t_1 < t_2 < ... give
P(grade <= k) = sigmoid(t_(k+1) - s).  The expected grade and the probability of the upper grades
follow, and a document is selected by the latter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm.common import in_parts, maybe_broadcast, ship

BUCKETS = 1 << 16
MAX_LABELLED = 8_000  # labelled rows the fit takes, those with the smallest hash
EPOCHS, RATE, RIDGE = 250, 0.05, 1e-4
CUT, MIN_TAIL = 2, 0.5  # kept if P(grade >= CUT) is at least MIN_TAIL
CACHE = 400_000
SHAPES = 4  # buckets before the words: figures of the whole text
SCALE = 4.0
DOCUMENT = "keys array<int>, weights array<float>"

_buckets: dict[bytes, int] = {}


def _bucket(word: bytes, buckets: int) -> int:
    if word not in _buckets:
        if len(_buckets) > CACHE:
            _buckets.clear()
        _buckets[word] = xxhash.xxh64_intdigest(word)
    return SHAPES + _buckets[word] % (buckets - SHAPES)


def features(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a whole text.

    A word weighs 1 + log of its count, over the root of the number of different words, so that a
    few telling words show in a long text; its letters are lowered and the signs at its ends dropped.
    Before the words: shares of symbols, of repeated words, of short words, and a one.
    """
    words = text.encode().lower().split() if text else []
    bare = [w.strip(b".,;:!?\"'()") or w for w in words]
    kinds, counts = np.unique([_bucket(w, buckets) for w in bare], return_counts=True) if bare else (np.zeros(0, "i8"),) * 2
    n = max(1, len(words))
    symbols = sum(text.count(c) for c in "#*$%&|<>{}") / len(text) if text else 0.0
    shape = [10 * symbols, 1 - len(kinds) / n, float(n < 50), 1.0]
    weights = SCALE * (1 + np.log(np.maximum(counts, 1))) / np.sqrt(max(1, len(kinds)))
    return np.concatenate([np.arange(SHAPES), kinds]).astype("i4"), np.concatenate([shape, weights]).astype("f4")


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))

    def score(self, keys: np.ndarray, weights: np.ndarray) -> float:
        return float(self.weights[keys] @ weights)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, buckets: int = BUCKETS) -> OrdinalModel:
    """Maximum likelihood with a ridge on the weights, by full-batch Adam steps.

    Thresholds are the first and the logs of the gaps, so they stay in order.
    """
    row = np.repeat(np.arange(len(rows)), [len(k) for k, _ in rows])
    key = np.concatenate([k for k, _ in rows]) if rows else np.zeros(0, "i4")
    val = np.concatenate([v for _, v in rows]).astype("f8") if rows else np.zeros(0)
    shares = np.cumsum(np.bincount(grades, minlength=n_grades) + 1.0)[:-1] / (len(grades) + n_grades)
    at = np.log(shares / (1 - shares))
    gaps = np.log(np.maximum(np.diff(at), 1e-2))
    p = np.concatenate([np.zeros(buckets), at[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    place = np.arange(len(grades))
    for step in range(1, EPOCHS + 1):
        w = p[:buckets]
        steps = np.exp(p[buckets + 1 :])
        t = p[buckets] + np.concatenate([[0.0], np.cumsum(steps)])
        s = np.bincount(row, val * w[key], minlength=len(rows))
        edge = np.concatenate([np.zeros((len(rows), 1)), sigmoid(t[None, :] - s[:, None]), np.ones((len(rows), 1))], axis=1)
        slope = edge * (1 - edge)
        like = np.maximum(edge[place, grades + 1] - edge[place, grades], 1e-12)
        up, down = slope[place, grades + 1] / like, slope[place, grades] / like
        g_t = np.zeros(len(t))
        np.add.at(g_t, np.minimum(grades, len(t) - 1), np.where(grades < len(t), -up, 0.0))
        np.add.at(g_t, np.maximum(grades - 1, 0), np.where(grades > 0, down, 0.0))
        later = np.cumsum(g_t[::-1])[::-1]
        g_w = np.bincount(key, val * (up - down)[row], minlength=buckets) / max(1, len(rows)) + RIDGE * w
        g = np.concatenate([g_w, later[:1] / max(1, len(rows)), later[1:] * steps / max(1, len(rows))])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    t = p[buckets] + np.concatenate([[0.0], np.cumsum(np.exp(p[buckets + 1 :]))])
    return OrdinalModel(p[:buckets].astype("f4"), t)


def featurised(docs: DataFrame, text: str = "text", *keep: str, buckets: int = BUCKETS) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def run(batches):
        for pdf in in_parts(batches):
            found = [features(t, buckets) for t in pdf["_text"]]
            out = pdf.drop(columns="_text")
            out["keys"], out["weights"] = [k for k, _ in found], [w for _, w in found]
            yield out

    return rows.mapInPandas(run, f"{schema}, {DOCUMENT}")


def train(
    docs: DataFrame,
    ratings: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    grade: str = "grade",
    n_grades: int = 3,
    max_labelled: int = MAX_LABELLED,
    buckets: int = BUCKETS,
) -> OrdinalModel:
    """Fit on ``ratings(id, grade)``, grades 0 to ``n_grades - 1``; nulls are left out.

    Takes the ``max_labelled`` rated documents with the smallest hash of their id; of a document
    rated more than once, the lowest grade.  Their sparse features are what the driver receives.
    """
    rated = ratings.filter(F.col(grade).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("_id"))
    rated = rated.agg(F.min(grade).cast("int").alias("_grade")).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    rated = maybe_broadcast(rated)
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_body")).join(rated, "_id")
    rows = featurised(rows.dropDuplicates(["_id"]), "_body", "_grade", "_id", buckets=buckets)
    got = rows.orderBy("_id").toPandas()
    pairs = list(zip(got["keys"].map(np.asarray), got["weights"].map(np.asarray), strict=True))
    return fit(pairs, got["_grade"].to_numpy("i8"), n_grades, buckets)


def graded(
    docs: DataFrame,
    model: OrdinalModel,
    id: str = "doc_id",
    text: str = "text",
    cut: int = CUT,
    min_tail: float = MIN_TAIL,
) -> DataFrame:
    """(id, expected_grade, tail_probability, kept) per document; tail: P(grade >= cut).

    A null or empty text has the score of its shape alone.  Repeated rows are graded alike.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # of fixed size
    size = len(model.weights)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def run(batches):
        model = sent.value
        for pdf in in_parts(batches):
            scores = np.array([model.score(*features(t, size)) for t in pdf["text"]], "f8")
            tails = model.tails(scores)
            yield pd.DataFrame(
                {"id": pdf["id"], "expected_grade": tails.sum(axis=1), "tail_probability": tails[:, cut - 1]}
            )

    schema = f"id {docs.schema[id].dataType.simpleString()}, expected_grade double, tail_probability double"
    out = rows.mapInPandas(run, schema).withColumn("kept", F.col("tail_probability") >= min_tail)
    return out.withColumnRenamed("id", id)


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings from two marks: 0 for toxic, 1 for neither toxic nor good, 2 for good."""
    known = F.col("toxic").isNotNull() & F.col("quality").isNotNull()
    grade = F.when(F.col("toxic") == 1, 0).otherwise(1 + F.col("quality"))
    return labels.filter(known).select("doc_id", grade.cast("int").alias("grade"))
