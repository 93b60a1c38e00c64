"""Sinks: overwrite writes and schema conformance.

Plain Parquet has no transaction log, so a table that is also an input of
the job is never overwritten in place: results go to a fresh path that
is returned (and read back) instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.session import scratch_path


def write_overwrite(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet",
                    mode: str = "overwrite") -> str:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        w = w.option("header", True).option("quote", '"').option("escape", '"')
    w.save(path)
    return path


def overwrite_roundtrip(df: DataFrame, name: str = "table", fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to a fresh path in the shared folder and scan it back."""
    spark: SparkSession = df.sparkSession
    path = write_overwrite(df, scratch_path(spark, name), fmt=fmt)
    r = spark.read.format(fmt).schema(df.schema)        # known schema: no inference pass
    if fmt == "csv":
        r = r.option("header", True).option("quote", '"').option("escape", '"')
    return r.load(path)


def schema_conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly ``schema``'s columns, cast to its types (missing -> typed null).

    ANSI casts raise on values that do not fit, so a bad load fails loudly.
    """
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def ensure_namespace(spark: SparkSession, database: str, location: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (placed under ``location`` when given)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    return database


def register_table(spark: SparkSession, database: str, name: str, path: str,
                   db_location: str | None = None) -> str:
    """Expose the Parquet files at ``path`` as ``database.name`` (an external table).

    Re-registering points the name at the new path; the old files are left
    alone, so readers of the previous version are not disturbed.
    """
    ensure_namespace(spark, database, db_location)
    full = f"`{database}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")      # register the partition folders
    return f"{database}.{name}"
