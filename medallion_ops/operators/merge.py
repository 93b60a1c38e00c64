"""Idempotent merges: upsert (MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *), and with NOT MATCHED BY SOURCE.

Plain Parquet has no MERGE, so the merged table is expressed as a relation:
``source  UNION ALL  (target LEFT ANTI JOIN source ON keys)``. Both sides
shuffle once on the keys (or the source is broadcast when its size is under
the planner's threshold); nothing is rewritten in place, so a failed run leaves the
old table intact and a rerun gives the same result.

``merge_changes`` is the merge that also follows the source when rows vanish:
one full outer join on the keys tells updates, inserts and, within a declared
scope, deletes apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def assert_same_columns(a: DataFrame, b: DataFrame) -> None:
    """The source/target column check done before a merge (same set of names)."""
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"column lists differ: {sorted(a.columns)} vs {sorted(b.columns)}")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once (``GROUP BY keys HAVING count(*) > 1``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys, what: str = "source") -> None:
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{what} has duplicate keys, e.g. {dup[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys, check_unique: bool = True) -> DataFrame:
    """Rows of ``source`` replace same-key rows of ``target``; the rest is inserted.

    Stricter than MERGE: any duplicate source key raises (MERGE rejects only
    duplicates that match). Null keys never match, so they are inserted and
    target rows with null keys are kept. The planner decides from sizes
    whether the source's keys are broadcast or both sides are sorted.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    assert_same_columns(target, source)
    if check_unique:
        assert_unique(source, keys)
    cols = target.columns
    kept = target.join(source.select(*keys), keys, "left_anti")
    return source.select(*cols).unionByName(kept.select(*cols))


INSERT, UPDATE, SAME, DELETE, KEEP = "insert", "update", "same", "delete", "keep"


def merge_changes(target: DataFrame, source: DataFrame, keys, scope: DataFrame | None = None,
                  check_unique: bool = True) -> DataFrame:
    """Every key of either side once, with ``__action`` and its row after the merge (before it, where it is deleted).

    ``insert``: only in ``source``; ``update``, ``same``: in both, with other or
    equal values (null-safe); ``delete``: only in ``target`` and within
    ``scope``; ``keep``: only in ``target`` and outside of it. ``scope`` holds
    values of some columns of the target (say, the orders that a load is
    complete for); None is all of it. Keys are matched null-safely, so a rerun
    deletes and inserts nothing. A duplicate key on the source side raises.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    assert_same_columns(target, source)
    if check_unique:
        assert_unique(source, keys)
    cols = target.columns
    old = target
    if scope is not None:
        inside = scope.distinct().withColumn("__in", F.lit(True))
        old = _match(target, inside, [c for c in scope.columns], "left")
    else:
        old = old.withColumn("__in", F.lit(True))
    old = old.select(*[F.col(c).alias(f"__t_{c}") for c in cols], F.coalesce("__in", F.lit(False)).alias("__in"),
                     F.lit(True).alias("__old"))
    new = source.select(*cols).withColumn("__new", F.lit(True))
    same_key = [F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in keys]
    both = new.join(old, reduce(lambda a, b: a & b, same_key), "full_outer")
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in cols])
    there, was = F.coalesce("__new", F.lit(False)), F.coalesce("__old", F.lit(False))
    action = (F.when(there & ~was, INSERT).when(there & equal, SAME).when(there, UPDATE)
              .when(F.col("__in"), DELETE).otherwise(KEEP))
    return both.select(action.alias("__action"),
                       *[F.when(there, F.col(c)).otherwise(F.col(f"__t_{c}")).alias(c) for c in cols])


def merge(target: DataFrame, source: DataFrame, keys, scope: DataFrame | None = None, check_unique: bool = True) -> DataFrame:
    """The target after ``merge_changes``: updates and inserts applied, what the source lost within ``scope`` gone."""
    changes = merge_changes(target, source, keys, scope, check_unique)
    return changes.filter(F.col("__action") != DELETE).drop("__action")


def _match(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    from medallion_ops.operators.keys import match

    return match(left, right, keys, how)


def _drop_partition(spark, path: str, parts: list[str], values) -> None:
    """Deletes one partition's folder of a Parquet table."""
    jvm = spark.sparkContext._jvm
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    folder = jvm.org.apache.hadoop.fs.Path("/".join(
        [path.rstrip("/"), *[name(p, None if v is None else str(v)) for p, v in zip(parts, values)]]))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def upsert_partitioned(target_path: str, source: DataFrame, keys, partition_cols, check_unique: bool = True,
                       delete_missing: bool = False, scope: DataFrame | None = None) -> str:
    """Upsert into a partitioned Parquet table, rewriting only the partitions it touches.

    With ``delete_missing`` it is ``merge``: rows within ``scope`` (None: all)
    whose keys ``source`` no longer holds are removed, and partitions they were
    in are touched as well.

    Touched are the partitions ``source`` falls into and those that hold the
    present rows of its keys: a row whose partition changes (or that leaves
    the null partition) is found where it lies now by a semi join on the
    target's key and partition columns. Their values become a partition
    filter on the target scan (the driver lists that many folders anyway to
    plan it), so other partitions are neither read in full nor rewritten.
    The merged partitions are staged in the shared folder (Spark cannot
    overwrite files it is reading) and then swapped in with a dynamic
    partition overwrite; partitions that lost all their rows are deleted
    last. A run that fails in between is mended by running it again.
    """
    from medallion_ops.session import materialize

    spark = source.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    target = spark.read.parquet(target_path)
    source = source.select(*target.columns)
    if check_unique:
        assert_unique(source, keys)
    if delete_missing:      # what changes, by the full classification of the narrow columns
        narrow = [*dict.fromkeys([*keys, *parts, *(scope.columns if scope is not None else [])])]
        before = target.select(*narrow)
        present = _match(before, source.select(*keys).distinct(), keys, "left_semi").select(*parts)
        lost = _match(before, source.select(*keys).distinct(), keys, "left_anti")
        lost = lost if scope is None else _match(lost, scope.distinct(), list(scope.columns), "left_semi")
        present = present.unionByName(lost.select(*parts))
    else:
        present = target.select(*keys, *parts).join(source.select(*keys), keys, "left_semi").select(*parts)
    touched = {tuple(r) for r in present.unionByName(source.select(*parts)).distinct().collect()}
    cond = F.lit(False)
    for row in sorted(touched, key=str):
        one = F.lit(True)
        for p, v in zip(parts, row):
            one = one & (F.col(p).isNull() if v is None else F.col(p) == F.lit(v))
        cond = cond | one
    if len(parts) == 1:      # one IN set instead of a chain
        values = [r[0] for r in touched if r[0] is not None]
        cond = F.col(parts[0]).isin(values) if values else F.lit(False)
        cond = cond | F.col(parts[0]).isNull() if (None,) in touched else cond
    merged = (merge(target.filter(cond), source, keys, scope, check_unique=False) if delete_missing
              else upsert(target.filter(cond), source, keys, check_unique=False))
    staged = materialize(merged, "upsert_partitions")
    left = {tuple(r) for r in staged.select(*parts).distinct().collect()}
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(target_path))
    for row in touched - left:
        _drop_partition(spark, target_path, parts, row)
    return target_path
