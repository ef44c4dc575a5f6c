"""Labelled samples and a sparse optimiser shared by the text classifiers.

The classifiers are fitted on a bounded sample of labelled rows (``per_class``
rows of each label, those with the smallest hash of their doc_id).  Features are
computed on the executors; the driver gets at most ``2 * per_class`` sparse
rows of bounded width (each classifier's ``FEATURES``) and fits a linear model on them.  Everything else (the
scoring) covers all rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                    only: Column | None = None) -> DataFrame:
    """(doc_id, y, weight, text) of up to ``per_class`` labelled documents of each class.

    ``only`` is a condition on doc_id.  ``weight`` is class rows / sampled rows, so that the
    weighted sample has the class shares of all labelled rows.  A doc_id with contradicting
    labels counts as the larger one; repeated rows of an id give their smallest text.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    rows = rows if only is None else rows.where(only)
    rows = rows.where(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = rows.where("y = 0").orderBy(*by_hash).limit(per_class).unionByName(
        rows.where("y = 1").orderBy(*by_hash).limit(per_class))
    total = rows.groupBy("y").agg(F.count("*").alias("n"))
    picked = picked.join(F.broadcast(total), "y").withColumn("weight", F.greatest(F.col("n") / per_class, F.lit(1.0)))
    # At most 2 * per_class small rows: a bounded broadcast against one scan of the documents.
    texts = id_text(documents).where(F.col("text").isNotNull()).join(F.broadcast(picked), "doc_id")
    return texts.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("weight").alias("weight"), F.min("text").alias("text"))


def adam(loss_grad: Callable[[np.ndarray], np.ndarray], size: int, steps: int, rate: float) -> np.ndarray:
    """Minimise from zero with Adam; ``loss_grad`` gives the gradient at a point."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = loss_grad(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments (some may be empty) that begin at ``starts`` and reach to the next start."""
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[np.append(starts[1:], len(values))] - total[starts]
