"""Labelled ids, bounded samples of labelled documents, and logistic regression on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, shared_table

#: Labelled rows that a model is fitted on at most (by hash order of the ids).
MAX_TRAIN = 8000


def labelled_ids(labels: DataFrame, label_col: str, modulus: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    """(__id, label) of all labelled ids that are not held out, each once."""
    return (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
            .filter(F.col("__id").isNotNull() & F.col("label").isin(0, 1) & (crc_mod("__id", modulus) != held_out))
            .groupBy("__id").agg(F.max("label").alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, held_out: int,
                    id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """(text, label) of at most ``max_train`` labelled ids that are not held out.

    Only the ids and labels of the sample are broadcast: ``max_train`` rows."""
    ids = labelled_ids(labels, label_col, modulus, held_out, id_col).orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    ids = shared_table(ids, "train-ids")
    d = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return shared_table(d.join(F.broadcast(ids), "__id").dropDuplicates(["__id"]).select("text", "label"), "train")


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, intercept: bool = True, steps: int = 50) -> np.ndarray:
    """Newton's method; the last weight is the intercept (not penalised) if there is one."""
    if intercept:
        x = np.hstack([x, np.ones((len(x), 1))])
    pen = np.full(x.shape[1], l2)
    if intercept:
        pen[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) + pen * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pen)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
