"""As-of lookup by one sorted merge of facts and versions.

A join on the key with a date condition pairs every fact of a key with every
version of it before the condition is tested: a person with a third of the
facts and many versions multiplies. Here facts and versions are range-sorted
together by key and time, a version before the facts of its day, and every fact
takes the last version before it. The range partitions cut through a key where
it is long, so no key is a task; a partition's last version is carried over its
border (a row per partition).

Every fact comes out exactly once. Of versions that overlap, the one that began
last counts; versions that are empty (end not after begin) or lack a key or a
begin are left out. Facts without key or time get nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.session import materialize


def asof_join(facts: DataFrame, versions: DataFrame, key: str, at: str | Column, begin: str, columns,
              end: str | None = None, fact_key: str | None = None, partitions: int | None = None) -> DataFrame:
    """``facts`` with ``columns`` of the last version of their key that began at ``at`` or before.

    ``begin`` and ``end`` (exclusive; a version that ended by ``at`` does not
    count) are columns of ``versions``, of the type of ``at``. Ties among
    versions of one begin go to the later end, then to the larger columns.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    fk, at = fact_key or key, F.col(at) if isinstance(at, str) else at
    ends = F.col(end) if end else F.lit(None)
    good = F.col(key).isNotNull() & F.col(begin).isNotNull()
    good = good & (F.col(end).isNull() | (F.col(end) > F.col(begin))) if end else good
    payload = F.struct(F.col(key).alias("key"), F.col(begin).alias("begin"), ends.alias("end"),
                       F.struct(*columns).alias("columns"))
    right = versions.filter(good).select(
        F.col(key).alias("__key"), F.col(begin).alias("__at"), F.lit(0).alias("__side"), payload.alias("__version"),
        F.lit(None).cast(facts.select(F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("f")).schema["f"].dataType)
        .alias("__fact"))
    left = facts.select(F.col(fk).alias("__key"), at.alias("__at"), F.lit(1).alias("__side"),
                        F.lit(None).cast(right.schema["__version"].dataType).alias("__version"),
                        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("__fact"))
    rows = right.unionByName(left).withColumn("__row", F.monotonically_increasing_id())      # splits equal key and time
    order = [F.col("__key").asc_nulls_first(), F.col("__at").asc_nulls_first(), F.col("__side"),
             F.col("__version").asc_nulls_first(), F.col("__row")]
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    stored = materialize(dealt.withColumn("__part", F.spark_partition_id()), "asof_sorted")

    # a row per partition: its last version, and the last one of all partitions before it
    last = stored.filter(F.col("__side") == 0).groupBy("__part").agg(
        F.max(F.struct("__key", "__at", "__version")).alias("__last"))
    last = stored.select("__part").distinct().join(last, "__part", "left")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(last.select("__part", F.last("__last.__version", ignorenulls=True).over(before).alias("__carried")),
                          "asof_carried")

    so_far = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = stored.withColumn("__found", F.last("__version", ignorenulls=True).over(so_far)).filter(F.col("__side") == 1)
    filled = filled.join(carried, "__part", "left").withColumn("__found", F.coalesce("__found", "__carried"))
    holds = (F.col("__found.key") == F.col("__key")) & (F.col("__found.begin") <= F.col("__at"))
    holds = holds & (F.col("__found.end").isNull() | (F.col("__at") < F.col("__found.end"))) if end else holds
    return filled.select(*[F.col(f"__fact.`{c}`").alias(c) for c in facts.columns],
                         *[F.when(holds, F.col(f"__found.columns.`{c}`")).alias(c) for c in columns])
