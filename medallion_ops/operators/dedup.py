"""Keyed de-duplication: latest wins, or a repeatable arbitrary row.

``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
below the shuffle, so each map task forwards at most one row per key: a key
holding a third of the rows costs one row per task in the exchange, not a
third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__rn"


def _sort_spec(item) -> Column:
    """``"c"`` / ``("c", "desc")`` / Column  ->  a sort Column (nulls last)."""
    if isinstance(item, Column):
        return item
    if isinstance(item, str):
        return F.col(item).asc_nulls_last()
    name, direction = item
    col = F.col(name) if isinstance(name, str) else name
    return col.desc_nulls_last() if direction.lower() == "desc" else col.asc_nulls_last()


def top_per_key(df: DataFrame, keys, order_by, n: int = 1) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[_sort_spec(o) for o in order_by])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) <= n).drop(_RN)


def dedup_latest(df: DataFrame, keys, order_by, tie_break=None) -> DataFrame:
    """One row per key: the first under ``order_by`` then ``tie_break``.

    ``order_by`` items are column names (ascending), ``(name, "desc"|"asc")``
    pairs or Columns; nulls sort last either way, so a null time never wins.
    """
    return top_per_key(df, keys, list(order_by) + list(tie_break or []), 1)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def dedup_any(df: DataFrame, keys) -> DataFrame:
    """One row per key, chosen repeatably: the smallest row by all columns.

    The reference orders by a constant (any row may win); a total order
    over every orderable column makes the result the same on every run.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    return dedup_latest(df, keys, [F.col(c).asc_nulls_last() for c in rest])


def latest_per_entity(df: DataFrame, entity, recency, tie_break=None) -> DataFrame:
    """One row per entity from its most recent record (null times last)."""
    rec = [recency] if isinstance(recency, str) else list(recency)
    return dedup_latest(df, entity, [(c, "desc") for c in rec], tie_break)
