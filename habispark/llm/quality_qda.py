"""Quality classifier: a regularised quadratic discriminant over statistics of whole documents.

The statistics are logarithms and shifted log-odds (`statistics.Measured.document_features`), put on one scale.
Each class has a mean and a covariance that is shrunk towards the pooled one and then towards its own
mean variance; the Cholesky factors are computed once and kept in the model. A score comes from the difference
of the two log-densities, that is of Mahalanobis distances and log-determinants.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.statistics import Measured
from habispark.llm.tables import remainder, stored
from habispark.llm.words import read_texts, slices

POOLED = 0.1
SPHERICAL = 0.05
# The statistics depend on each other, so their joint evidence is tempered.
TEMPERATURE = 4.0
THRESHOLD = 0.3


@dataclass(frozen=True)
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    # Inverses of the Cholesky factors, and half the log-determinants.
    factors: np.ndarray
    halves: np.ndarray
    log_prior: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for every row."""
        if not len(self.means):
            return np.full(len(x), 0.5)
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        density = [
            -0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1) - half
            for mean, factor, half in zip(self.means, self.factors, self.halves, strict=True)
        ]
        evidence = (density[1] - density[0]) / TEMPERATURE + self.log_prior[1] - self.log_prior[0]
        return 1 / (1 + np.exp(-np.clip(evidence, -500, 500)))


def discriminant(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """From the count, the sum and the sum of outer products of both classes; without rows of both, a
    model that scores 0.5."""
    if counts.min() < 1:
        none = np.zeros(0)
        return Discriminant(none, none, none, none, none, none)
    n = counts.sum()
    centre = sums.sum(axis=0) / n
    scale = np.sqrt(np.maximum(np.diag(products.sum(axis=0)) / n - centre**2, 1e-12))
    means = (sums / counts[:, None] - centre) / scale
    raw = products / counts[:, None, None] - np.einsum("ki,kj->kij", sums, sums) / counts[:, None, None] ** 2
    own = raw / scale[:, None] / scale[None]
    pooled = np.einsum("k,kij->ij", counts / n, own)
    size = len(centre)
    factors, halves = [], []
    for covariance in own:
        c = (1 - POOLED) * covariance + POOLED * pooled
        c = (1 - SPHERICAL) * c + SPHERICAL * max(np.trace(c) / size, 1e-6) * np.eye(size)
        lower = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(lower))
        halves.append(np.log(np.diag(lower)).sum())
    return Discriminant(centre, scale, means, np.array(factors), np.array(halves), np.log(counts / n))


def document_statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = Measured(read_texts(part.column("text"))).document_features()
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())
                )
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "x"])

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(measure, "doc_id long, x array<double>")


def train(statistics: DataFrame, labels: DataFrame) -> Discriminant:
    """Fits on every labelled row; only class sums reach the driver.

    `labels` has doc_id and quality; rows with another quality than 0 and 1 are ignored.
    """
    labelled = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            y = batch.column("quality").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy().reshape(len(y), -1)
            for label in (0, 1):
                own = x[y == label]
                if len(own):
                    part = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                    total[label] = total.get(label, 0) + part
        for label, values in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(values), label, np.int32)),
                    pa.array(np.arange(len(values), dtype=np.int32)),
                    pa.array(values),
                ],
                ["quality", "place", "value"],
            )

    rows = (
        statistics.join(labelled, "doc_id")
        .select(F.col("quality").cast("int").alias("quality"), "x")
        .mapInArrow(moments, "quality int, place int, value double")
        .groupBy("quality", "place")
        .agg(F.sum("value").alias("value"))
        .toArrow()  # two classes of 1 + d + d * d numbers
    )
    width = Measured(read_texts(pa.array([], pa.string()))).document_features().shape[1]
    table = np.zeros((2, 1 + width + width * width))
    table[rows["quality"].to_numpy(), rows["place"].to_numpy()] = rows["value"].to_numpy()
    return discriminant(table[:, 0], table[:, 1 : 1 + width], table[:, 1 + width :].reshape(2, width, width))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    Labels are learned from rows whose id's crc32 modulo `folds` is not `held`. NULL and empty texts have the
    statistics of a text without words and are scored by them. Repeated identifiers are scored each; a NULL
    identifier has remainder 0 and is never learned from. Without labels of both classes every score is 0.5. An empty
    table gives an empty result; other columns of `docs` may have any name.
    """
    statistics = stored(document_statistics(docs, doc_id, text), "statistics")
    model = train(statistics, labels.filter(remainder(F.col("doc_id"), folds) != held))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return statistics.select("doc_id", (remainder(F.col("doc_id"), folds) == held).alias("held_out"), "x").mapInArrow(
        apply, "doc_id long, held_out boolean, score double, predicted int"
    )
