"""Bounded samples of labelled rows for the small models that are trained on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bound of every labelled sample, in documents. It doesn't grow with the input.
SAMPLE_ROWS = 4000


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % F.lit(folds)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most `rows` labelled documents (doc_id, text, label), chosen by a hash of the id.

    `allowed` is a condition on doc_id. Null labels are left out; if an id has several labels, the
    largest holds; of an id that stands in several rows the least text holds, so the bound is one of rows.
    The ids are at most `rows`, so sending them to every task is bounded.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.max(label).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    met = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_label").alias("label"))


def adam(params: list[np.ndarray], gradients, steps: int, rate: float) -> list[np.ndarray]:
    """Full-batch Adam; gradients(params) gives one array for each."""
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        for p, m, s, g in zip(params, mean, square, gradients(params), strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return params


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
