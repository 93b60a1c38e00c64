"""Dense surrogate keys without a single-partition sort.

``row_number() over (order by k)`` plans ``Exchange SinglePartition``: the
whole table passes through one task. Here the same numbers come from

1. the input, computed and stored once;
2. one range shuffle of the stored rows on the key, the tie-break and the
   place a row was stored at, sorted within partitions and stored with the
   running number that a task gives its rows: all rows of partition p sort
   before those of p + 1;
3. the rows per partition, prefix-summed on the driver (a row per partition:
   bounded by the shuffle parallelism, as is its broadcast) and added.

A table of up to ``ONE_TASK`` rows, counted while it is stored, is sorted in one
task instead: sampling and dealing it would only add jobs. Rows with equal keys are told apart by
``tie_break`` columns and then by where they were stored, so a hot key spreads
over as many partitions as its rows need.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion_ops.session import materialize, materialize_counted

ONE_TASK = 1 << 16               # rows that are numbered without a shuffle; larger tables are range-dealt


def _cols(items) -> list[Column]:
    items = [items] if isinstance(items, (str, Column)) else list(items)
    return [F.col(c) if isinstance(c, str) else c for c in items]


def dense_surrogate_key(df: DataFrame, order_cols, name: str = "sk", start: int = 1,
                        tie_break=None, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based rank of each row under ``order_cols`` (asc, nulls first).

    Equals ``row_number() over (order by order_cols, tie_break)`` plus
    ``start - 1``; the new column comes first. ``df`` is computed once;
    ``partitions`` sets the number of range partitions, whatever the size.
    """
    by = _cols(order_cols) + _cols(tie_break or [])
    names = [f"__k{i}" for i in range(len(by))]
    stored, n_rows = materialize_counted(df.withColumns(dict(zip(names, by))), "sk_rows")
    order = [F.col(n).asc_nulls_first() for n in names] + [F.col("__stored")]
    if n_rows <= ONE_TASK and partitions is None:
        sorted_ = stored.withColumn("__stored", F.monotonically_increasing_id()).coalesce(1).sortWithinPartitions(*order)
        return sorted_.select((F.monotonically_increasing_id() + start).cast("bigint").alias(name), *[_exact(c) for c in df.columns])
    placed = stored.withColumn("__stored", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    numbered = dealt.sortWithinPartitions(*order).select(
        *[_exact(c) for c in df.columns], F.monotonically_increasing_id().alias("__at"))
    numbered = materialize(numbered, "sk_input").withColumns({
        "__part": F.shiftright("__at", 33), "__row": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))})   # a task's 2^33 ids

    sizes = sorted(numbered.groupBy("__part").agg((F.max("__row") + 1).alias("n")).collect())     # a row per partition
    before = [(part, sum_before) for (part, _), sum_before in zip(sizes, accumulate((n for _, n in sizes), initial=0))]
    before = df.sparkSession.createDataFrame(before, "__part bigint, __before bigint")
    out = numbered.join(F.broadcast(before), "__part")
    return out.select((F.col("__before") + F.col("__row") + start).cast("bigint").alias(name), *[_exact(c) for c in df.columns])


def _exact(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe join on ``keys``, which come from the left side only; ``right`` holds them and its own columns."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = one if same is None else same & one
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def extend_surrogate_keys(existing: DataFrame, incoming: DataFrame, key, name: str = "sk",
                          issued_to: int | None = None) -> DataFrame:
    """Surrogate keys for an incremental load: known keys keep theirs, new ones follow the highest number.

    ``existing`` holds the key columns ``key`` and ``name``; every row of
    ``incoming`` comes back with ``name`` first. Keys are matched null-safely.
    New ones are numbered densely in key order after ``issued_to``, the
    highest number ever issued (default: the highest in ``existing``, which is
    right only if nothing ever leaves it; ``operators/registry.py`` keeps
    both over loads).
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = existing.select(*keys, name)
    if issued_to is None:
        issued_to = existing.agg(F.max(name).alias("m")).collect()[0]["m"] or 0
    kept = match(incoming, known, keys, "inner").select(name, *incoming.columns)
    new = match(incoming, known.select(*keys), keys, "left_anti")
    return kept.unionByName(dense_surrogate_key(new, keys, name=name, start=issued_to + 1))
