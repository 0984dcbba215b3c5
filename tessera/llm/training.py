"""Labelled rows and a small logistic fit for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_sample, id_class

#: Labelled documents that a classifier is fitted on, at most (about).
TRAIN_ROWS = 20_000


def chosen_labels(labels: DataFrame, label: str, modulus: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    """``lid, y``: one row of every labelled id outside the held-out class."""
    return (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (id_class(id_col, modulus) != held_out))
            .groupBy(F.col(id_col).alias("lid")).agg(F.max(F.col(label).cast("int")).alias("y")))


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
             id_col: str = "doc_id", text_col: str = "text", bound: int = TRAIN_ROWS) -> DataFrame:
    """``id, text, y`` of about ``bound`` documents with a label, none of the
    held-out class ``crc32(id) mod modulus = held_out``.

    Null labels and ids are no labels; of several labels of one id the largest
    holds; repeated documents come once each.  The sample of labels is bounded,
    so it is broadcast and texts are not shuffled.
    """
    chosen = F.broadcast(bounded_sample(chosen_labels(labels, label, modulus, held_out, id_col), "lid", bound))
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(chosen, F.col("id") == F.col("lid")).select("id", "text", "y"))


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: np.ndarray | float = 1.0,
             rounds: int = 60) -> np.ndarray:
    """Weights of a logistic model by Newton's method, drawn to ``prior``."""
    w = prior.astype(np.float64).copy()
    pull = np.broadcast_to(np.asarray(strength, float), w.shape)

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, z).sum() - (z * y).sum() + 0.5 * (pull * (v - prior) ** 2).sum())

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + pull * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull) + 1e-9 * np.eye(len(w)), grad)
        scale = 1.0
        while scale > 1e-4 and (after := loss(w - scale * step)) > now:
            scale /= 2
        if scale <= 1e-4:
            break
        w -= scale * step
        if now - after < 1e-8 * max(1.0, now):
            break
        now = after
    return w
