"""Helpers shared by the corpus operators: table reads, range-ordered running totals, batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion_ops.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Spark alone opens the path, so any store it can read will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A top-level column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def range_stage(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and stored, with ``__pid`` = its partition.

    Stored once, so that every later job sees the same partition numbers.
    All rows of partition p sort before those of p + 1.
    """
    dealt = df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id())
    return materialize(dealt, name)


def partition_offsets(stage: DataFrame, value: str) -> DataFrame:
    """One row per stored partition: ``__pid``, ``__before`` (sum of all earlier partitions), ``__own``."""
    totals = stage.groupBy("__pid").agg(F.coalesce(F.sum(value), F.lit(0)).alias("__own"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)   # as many rows as partitions
    return totals.withColumn("__before", F.coalesce(F.sum("__own").over(w), F.lit(0)))


def running_total(df: DataFrame, order: list[Column], values: dict[str, str], name: str) -> DataFrame:
    """Inclusive running totals in ``order`` without passing the table through one task.

    ``values`` maps new column -> summed column. The frame is range-
    partitioned and stored, totalled per partition, and the small table of
    partition offsets is joined back to a per-partition window. ``order``
    must be total up to rows that are interchangeable.
    """
    stage = range_stage(df, order, name)
    within = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = None
    for i, src in enumerate(values.values()):
        o = partition_offsets(stage, src).select("__pid", F.col("__before").alias(f"__before{i}"))
        offsets = o if offsets is None else offsets.join(o, "__pid")
    # the window comes first: it spreads the rows by __pid, and the join then finds them there
    out = stage.withColumns({new: F.sum(src).over(within) for new, src in values.items()})
    out = out.join(offsets, "__pid", "left")
    out = out.withColumns({new: F.col(new) + F.col(f"__before{i}") for i, new in enumerate(values)})
    return out.drop("__pid", *[f"__before{i}" for i in range(len(values))])


def text_chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that a slice holds about ``limit`` bytes of ``text`` at most (one row at least)."""
    import numpy as np

    for batch in batches:
        n, at = batch.num_rows, 0
        if not n:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        while at < n:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def give_back_memory() -> None:
    """Returns freed memory to the system: a Python worker lives on and serves the tasks of other stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library keeps or returns memory in its own way
        pass


def import_arrow_compute() -> None:
    """``pyarrow.compute`` must be imported before ``pa.compute`` is used in a worker."""
    import pyarrow.compute  # noqa: F401


import_arrow_compute()
