"""Quality classifier: regularised quadratic discriminant over transformed statistics of whole texts.

Class means and covariances come from one Spark aggregation over all rows that teach. Covariances are shrunk towards
the diagonal of the pooled one; their Cholesky factors are computed once and shipped with the scoring function, which
turns the difference of two Mahalanobis log-densities into a probability.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import materialize
from buzzmill.llm.textstats import labelled, with_stats

#: Repeated lines are left out: clean documents have them too.
FEATURES = ["mean_word", "symbols", "bangs", "capitals", "distinct_words", "n_words"]
#: Words that pull the ratios of a text towards the corpus mean, so that a few words decide little.
PULL = 20


def transformed() -> list[Column]:
    """Square roots tame the ratios, a logarithm the length."""
    return [*[F.sqrt(F.col(r)) for r in FEATURES[:-1]], F.log1p(F.col("n_words").cast("double"))]


def pulled(stats: DataFrame) -> DataFrame:
    """x with its ratios pulled towards their mean over all rows, the more the fewer words a text has."""
    d = len(FEATURES) - 1
    means = stats.agg(*[F.avg(F.get("x", F.lit(i))) for i in range(d)]).first()
    words = F.expm1(F.get("x", F.lit(d)))
    ratios = [m + (F.get("x", F.lit(i)) - m) * words / (words + PULL) for i, m in enumerate(means)] if means[0] is not None else []
    return stats.withColumn("x", F.array(*ratios, F.get("x", F.lit(d)))) if ratios else stats


@dataclass
class Discriminant:
    """Means, inverse-free Cholesky factors and log priors of classes 0 and 1 in standardised coordinates."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    priors: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        x = (x - self.centre) / self.scale
        logs = []
        for mean, factor, prior in zip(self.means, self.factors, self.priors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(prior - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def fit(rows: DataFrame, shrinkage: float = 0.2, ridge: float = 0.02) -> Discriminant | None:
    """From rows with label and x (array of double); None unless both classes have rows."""
    d = len(FEATURES)
    x = [F.get("x", F.lit(i)) for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)] + [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {r["label"]: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), *sums).collect()}
    if set(found) != {0, 1}:
        return None
    n = {c: found[c]["n"] for c in (0, 1)}
    mean, covariance = {}, {}
    for c, r in found.items():
        mean[c] = np.array([r[f"s{i}"] for i in range(d)]) / n[c]
        second = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"] / n[c]
        covariance[c] = second - np.outer(mean[c], mean[c])
    total = n[0] + n[1]
    centre = (n[0] * mean[0] + n[1] * mean[1]) / total
    # classes weigh alike: the rarer one holds most of the spread
    scale = np.sqrt(np.maximum((np.diag(covariance[0]) + np.diag(covariance[1])) / 2 + ((mean[0] - mean[1]) / 2) ** 2, 1e-12))
    means, factors, priors = [], [], []
    for c in (0, 1):
        own = covariance[c] / np.outer(scale, scale)
        own = (1 - shrinkage) * own + shrinkage * np.diag(np.diag(own)) + ridge * np.eye(d)
        means.append((mean[c] - centre) / scale)
        factors.append(np.linalg.cholesky(own))
        priors.append(float(np.log(n[c] / total)))
    return Discriminant(centre, scale, means, factors, priors)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def accepted(docs: DataFrame, labels: DataFrame, kind: str = "quality") -> DataFrame:
    """docs without the rows that classify predicts as 0, with all columns; rows are told apart by id and text's hash."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    id_, hash_ = (f"_{c}_{uuid.uuid4().hex}" for c in ("id", "hash"))  # docs may have columns of any name
    rejected = _classified(texts, labels, kind).where("predicted = 0").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    return docs.join(rejected.hint("shuffle_hash"), same, "left_anti")


def classify(docs: DataFrame, labels: DataFrame, kind: str = "quality") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on).

    Held-out rows never teach, nor do rows without an id or label, or whose labels disagree. Null and empty texts get
    the score of an empty text. Without rows of both classes every score is 0.5. Repeated ids are scored row by row;
    extra columns are ignored. Statistics are ratios of whole texts, so a very long text is scored like others.
    """
    return _classified(docs.select("doc_id", "text", F.lit(0).cast("long").alias("text_hash")), labels, kind).drop("text_hash")


def _classified(docs: DataFrame, labels: DataFrame, kind: str) -> DataFrame:
    stats = with_stats(docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), "text_hash").alias("doc_id"), "text"))
    stats = stats.select(F.col("doc_id.doc_id").alias("doc_id"), F.col("doc_id.text_hash").alias("text_hash"), F.array(*transformed()).alias("x"))
    stats = pulled(materialize(stats.withColumn("held_out", held_out(F.col("doc_id"))), "quality-stats"))
    model = fit(stats.where(~F.col("held_out")).join(labelled(labels, kind), "doc_id").select("label", "x"))

    def score(batches):
        for batch in batches:
            x = np.asarray(batch.column(3).flatten(), np.float64).reshape(-1, len(FEATURES))
            scores = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "text_hash", "held_out", "score", "predicted"])

    return stats.select("doc_id", "text_hash", "held_out", "x").mapInArrow(score, "doc_id long, text_hash long, held_out boolean, score double, predicted int")
