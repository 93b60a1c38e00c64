"""Partition totals, minima and ratios.

A window ``PARTITION BY k`` puts every row of a key in one task. Where the
result is only a per-key aggregate attached to each row, the skew-safe
form is an aggregation (partial in every task, so a hot key is combined
before the shuffle) joined back on the key; AQE splits a skewed detail
side of that join. ``per_key_agg`` / ``per_key_total`` are that form; the ``*_over`` helpers
are the plain window form for small partitions (e.g. after a DISTINCT).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_key_agg(df: DataFrame, keys, aggs: dict) -> DataFrame:
    """Attach per-key aggregates to every row: ``{name: aggregate Column}``.

    Same result as ``agg over (partition by keys)``, including null keys (one
    group, joined back null-safely); output columns are the key columns
    first, then the rest of ``df``, then the aggregates.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tot = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    tot = tot.select(*[F.col(k).alias(f"__pk{i}") for i, k in enumerate(keys)], *aggs)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__pk{i}")) for i, k in enumerate(keys)])
    rest = [c for c in df.columns if c not in keys]
    return df.join(tot, cond, "left").select(*keys, *rest, *aggs)


def per_key_total(df: DataFrame, keys, value: str, name: str, scale: int | None = 2) -> DataFrame:
    """Attach ``name`` = sum of ``value`` over the row's key.

    With ``scale`` the values are rounded to that many decimals before an
    exact decimal sum, so the result does not depend on the order of rows.
    """
    return per_key_agg(df, keys, {name: money_sum(value, scale) if scale is not None else F.sum(value)})


def money_sum(value: str, scale: int = 2) -> Column:
    """Sum of ``value`` rounded to ``scale`` decimals, as an exact decimal."""
    return F.sum(F.col(value).cast(f"decimal(18,{scale})")).cast(f"decimal(38,{scale})")


def sum_over(col: str, keys) -> Column:
    return F.sum(col).over(Window.partitionBy(*([keys] if isinstance(keys, str) else keys)))


def min_over(col: str, keys) -> Column:
    return F.min(col).over(Window.partitionBy(*([keys] if isinstance(keys, str) else keys)))


def max_over(col: str, keys) -> Column:
    return F.max(col).over(Window.partitionBy(*([keys] if isinstance(keys, str) else keys)))


def ratio_to_max(col: str, keys) -> Column:
    """``col / max(col) over (partition by keys)`` as a double."""
    return F.col(col).cast("double") / max_over(col, keys).cast("double")
