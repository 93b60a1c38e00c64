"""A quality gate that scans changed partitions only.

What the checks of ``quality.table_checks`` need is kept per partition of the
table: its rows, its nulls per column and the hashes of its keys with their
numbers (128 bits each). These add up over partitions, so after a load only the
partitions it wrote are scanned, their part of the state is replaced, and the
report over all is made from the state: equal to a full scan's, also where a
key is repeated in two partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.digest import row_hash
from medallion_ops.operators.keys import match
from medallion_ops.operators.quality import REPORT_COLS


@dataclass
class QualityState:
    metrics: DataFrame          # part, n_rows, null_<column>...
    keys: DataFrame             # part, h1, h2, n


def quality_state(df: DataFrame, part: Column, unique, not_null=()) -> QualityState:
    """State of the partitions that ``df`` holds; ``part`` is the value rows are partitioned by."""
    unique = [unique] if isinstance(unique, str) else list(unique)
    rows = df.withColumn("__part", part)
    metrics = rows.groupBy(F.col("__part").alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null])
    keys = rows.select(F.col("__part").alias("part"), row_hash(unique, "key:1").alias("h1"), row_hash(unique, "key:2").alias("h2"))
    return QualityState(metrics, keys.groupBy("part", "h1", "h2").agg(F.count(F.lit(1)).alias("n")))


def replace_partitions(state: QualityState, load: QualityState, emptied: DataFrame | None = None) -> QualityState:
    """The state after a load wrote some partitions; ``emptied`` (part) are those it left without rows."""
    gone = load.metrics.select("part")
    gone = gone if emptied is None else gone.unionByName(emptied.select("part"))
    keep = lambda rows: match(rows, gone.distinct(), ["part"], "left_anti")
    return QualityState(keep(state.metrics).unionByName(load.metrics), keep(state.keys).unionByName(load.keys))


def state_report(name: str, state: QualityState, unique, not_null=(), not_empty: bool = True) -> DataFrame:
    """The rows that ``quality.table_checks`` gives for the whole table, from the state alone."""
    unique = [unique] if isinstance(unique, str) else list(unique)
    total = state.metrics.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"),
                              *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in not_null])
    distinct = state.keys.select("h1", "h2").distinct().agg(F.count(F.lit(1)).alias("keys"))
    one = total.withColumn("__one", F.lit(1)).join(distinct.withColumn("__one", F.lit(1)), "__one")      # a row each
    checks = [("not_empty", F.when(F.col("rows") == 0, 1).otherwise(0))] if not_empty else []
    checks += [(f"unique({','.join(unique)})", F.col("rows") - F.col("keys"))]
    checks += [(f"not_null({c})", F.col(f"null_{c}")) for c in not_null]
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), e.cast("long").alias("failures")) for n, e in checks]))
    return one.select(stacked.alias("c")).select(
        F.lit(name).alias("table_name"), "c.check_name", "c.failures", (F.col("c.failures") == 0).alias("passed")).select(*REPORT_COLS)
