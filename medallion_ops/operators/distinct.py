"""Exact distinct counts that add up: bitmaps kept per group and united.

``count(DISTINCT id)`` of two months is not the sum of their counts, so a
growing table is counted anew. A bitmap per group and bucket of ids can be
stored and united with the next load's (an id set twice is one bit), for any
coarser group as well, and counts exactly. A bucket is 32,768 ids in 4 KB, so
ids should be dense, as surrogate keys are; others get dense numbers from a key
registry first (``dense_ids``).

State: the group columns, ``bucket`` and ``bits``. Null ids are not counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.registry import KeyRegistry


def _list(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def distinct_state(df: DataFrame, id_col: str, by=()) -> DataFrame:
    """Bitmaps of the integer ids in each group; combined in every task before the shuffle."""
    ids = df.filter(F.col(id_col).isNotNull())
    number = F.col(id_col).cast("bigint")
    return ids.select(*_list(by), F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("__bit")) \
        .groupBy(*_list(by), "bucket").agg(F.bitmap_construct_agg("__bit").alias("bits"))


def unite(states, by=()) -> DataFrame:
    """One state of several (loads, or one state alone brought to coarser groups ``by``)."""
    rows = reduce(DataFrame.unionByName, [s.select(*_list(by), "bucket", "bits") for s in states])
    return rows.groupBy(*_list(by), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, by=(), name: str = "n_distinct") -> DataFrame:
    """Exact number of distinct ids per group of a state (groups coarser than the state's are united first)."""
    finest = [c for c in state.columns if c not in ("bucket", "bits")]
    state = state if sorted(finest) == sorted(_list(by)) else unite([state], by)
    return state.groupBy(*_list(by)).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def dense_ids(df: DataFrame, registry: KeyRegistry) -> DataFrame:
    """``df`` with the registry's number of its key columns first, new keys registered; so any key can be counted."""
    registry.register(df)
    return registry.attach(df)
