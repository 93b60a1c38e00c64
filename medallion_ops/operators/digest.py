"""Change detection by order-insensitive digests.

A table's rows are hashed and the hashes summed per key, so a key's digest does
not depend on the order of its rows, adds up over tables and loads, and is a
few numbers wide whatever the rows are. Two states of a table differ in a key
exactly if the multisets of its rows differ (but for a collision of 128 bits),
and finding such keys shuffles keys and digests only, once per state instead of
whole rows in both directions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.keys import match

DIGEST = ["n_rows", "low", "high", "mix"]
NEW, CHANGED, GONE = "new", "changed", "gone"


def row_hash(columns: list[str], seed: str) -> Column:
    """64 bits of a row; nulls count by their place (a plain hash skips them)."""
    nulls = F.concat_ws("", *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(c) for c in columns])


def digests(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """``key``, n_rows, low, high and mix over the rows of all ``tables``, each under its own name.

    One grouped aggregation, combined in every task before the shuffle. The
    columns of a table count in alphabetical order. ``low`` and ``high`` are
    the sums of a hash's halves, which cannot overflow below 2^31 rows a key;
    ``mix`` is the exclusive or of a second hash.
    """
    parts = []
    for name, df in tables.items():
        columns = sorted(df.columns)
        parts.append(df.select(F.col(key), row_hash(columns, f"{name}:1").alias("__h"), row_hash(columns, f"{name}:2").alias("__g")))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("__h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned("__h", 32)).alias("high"),
        F.bit_xor("__g").alias("mix"))


def changed_keys(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """``key`` and ``change`` (new, changed or gone) of the keys whose digests differ; null keys are one key."""
    old = before.select(key, F.struct(*DIGEST).alias("__before"))
    current = now.select(key, F.struct(*DIGEST).alias("__now"))
    here = match(current, old, [key], "left")
    here = here.filter(~F.col("__now").eqNullSafe(F.col("__before")))
    change = F.when(F.col("__before").isNull(), NEW).otherwise(CHANGED)
    gone = match(old, current.select(key), [key], "left_anti")
    return here.select(key, change.alias("change")).unionByName(gone.select(key, F.lit(GONE).alias("change")))
