"""Training helpers of the text classifiers: bounded labelled samples and probability calibration."""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, give_back_memory


def worker_state(name: str) -> types.ModuleType:
    """A place in the Python worker's process that outlives a task, for caches of pure functions."""
    return sys.modules.setdefault(f"corpus_worker_{name}", types.ModuleType(f"corpus_worker_{name}"))


def drop_worker_states() -> None:
    """Frees what earlier tasks of other operators have left in this Python worker; they build it anew if they come back."""
    held = [name for name in sys.modules if name.startswith("corpus_worker_")]
    for name in held:
        del sys.modules[name]
    if held:
        give_back_memory()


def logistic(x: np.ndarray, y: np.ndarray, share: float = 0.5) -> np.ndarray:
    """w of P(1 | x) = 1 / (1 + exp(-(w[:-1] x + w[-1]))), with Platt's smoothed targets.

    Label 1 weighs ``share`` in all; Newton steps with a small ridge.
    """
    pos, neg = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y > 0, share / pos, (1 - share) / neg) * len(y)
    ones = np.concatenate([x.reshape(len(y), -1), np.ones((len(y), 1))], axis=1)
    ridge = np.full(ones.shape[1], 1e-3)
    w = np.zeros(ones.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(ones @ w, -35, 35)))
        grad = ones.T @ (weight * (p - target)) + ridge * w
        hess = (ones * (weight * p * (1 - p) + 1e-9)[:, None]).T @ ones + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 10 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, most: dict[int, int],
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of at most ``most[label]`` documents per label, chosen by a hash of the id.

    ``learn`` is a condition on the id column. Ids are chosen among the
    narrow rows; only the chosen texts are read to the driver, one per id (of
    rows that share an id, that of the smallest hash of the text).
    """
    ids = docs.select(col(id_col).alias(id_col)).where(learn).distinct()
    known = labels.select(col(id_col).alias(id_col), col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = known.groupBy(id_col).agg(F.max("label").alias("label")).join(ids, id_col, "left_semi")
    chosen = []
    for label, n in most.items():
        rows = known.where(F.col("label") == label).orderBy(F.xxhash64(id_col), id_col).limit(n).collect()
        chosen += [(r[id_col], label) for r in rows]
    if not chosen:
        return []
    picked = docs.sparkSession.createDataFrame(chosen, f"{id_col} bigint, label int")
    rows = docs.select(col(id_col).cast("bigint").alias(id_col), col(text_col).cast("string").alias("text"))
    found = rows.join(F.broadcast(picked), id_col)
    one = found.groupBy(id_col, "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = one.select(id_col, "text", "label").collect()                     # as many as chosen
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: (r[id_col], r["text"] or ""))]
