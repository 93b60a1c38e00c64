"""Join helpers: lookups by USING, anti joins, row-preserving guard, row-number join.

No broadcast hints: the planner broadcasts a side when its file size (or,
with adaptive execution, its size at run time) is under the session's
threshold, and joins by sort-merge otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def left_join_using(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Left outer join on same-named key columns (``USING``)."""
    return left.join(right, keys, "left")


def orphans(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent``.

    A plain equi anti join: a null key never matches, so it is an orphan.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return child.join(parent.select(*keys), keys, "left_anti")


class RowPreservingJoin:
    """Prove that a chain of lookups neither fans out nor loses rows.

    ``after(df)`` attaches an observation to the frame that is written: it
    runs in the writing (result) stage, where each partition's metric is
    applied once even when tasks are retried or executors are lost. The
    input side is counted from the stored input table (Parquet footers), not
    observed inside a shuffle map stage, which a lost executor can re-run
    and count twice. ``check(stored_input)`` runs after the write.
    """

    def __init__(self, name: str = "rows"):
        self.name = name
        self._out = Observation(f"{name}_out")

    def after(self, df: DataFrame) -> DataFrame:
        return df.observe(self._out, F.count(F.lit(1)).alias("n"))

    def check(self, stored_input: DataFrame) -> tuple[int, int]:
        n_in, n_out = stored_input.count(), self._out.get["n"]
        if n_in != n_out:
            raise AssertionError(f"{self.name}: fan-out or row loss ({n_in} in, {n_out} out)")
        return n_in, n_out


def row_number_join(left: DataFrame, right: DataFrame, left_order, right_order,
                    how: str = "left", name: str = "rn") -> DataFrame:
    """Pair the n-th row of ``left`` with the n-th row of ``right``.

    Both sides are numbered with the distributed dense key (no single-
    partition window), then equi-joined on the number.
    """
    from medallion_ops.operators.keys import dense_surrogate_key

    a = dense_surrogate_key(left, left_order, name=name)
    b = dense_surrogate_key(right, right_order, name=name)
    return a.join(b, name, how)
