"""Multi-line CSV read by as many tasks as the file has splits.

A quoted field may hold line breaks, so a reader that starts in the middle of
a file does not know whether it stands inside quotes; Spark's ``multiLine`` scan
therefore gives each file to one task. Here the file is scanned as lines, split
like any text, and the quotes decide:

1. each line's number of quotes is taken modulo two (a doubled quote inside a
   field does not change it) and the lines are stored with their split;
2. a split's quotes tell whether the next one begins inside a field: parities
   are summed over the splits of a file (a row per split) and over the lines of
   a split;
3. a line that begins and ends outside of quotes is a record. The others are
   glued, in order, to the record that the last line outside of quotes began,
   which may lie splits before; only those are shuffled by record;
4. ``from_csv`` parses the records with the options of the ``multiLine`` scan.

Needs: line breaks are ``\n`` or ``\r\n``; a quote stands only around a field or
doubled inside one, as every writer of quoted CSV makes it (a lone quote inside
an unquoted field would shift the rest of its file). A quote that never closes
would make the rest of the file one record: records over ``max_record_bytes``
raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.session import materialize

MB = 1 << 20


def csv_records(spark: SparkSession, path: str, max_record_bytes: int = 64 * MB) -> DataFrame:
    """The records of CSV files, header lines included: ``file``, ``head`` (first of its file) and ``record`` (raw text)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),           # ascends within a split
        "value", (quotes % 2).alias("odd"))
    lines = materialize(lines, "csv_lines")

    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)    # a row per split
    splits = lines.groupBy("file", "split").agg(F.sum("odd").alias("odd"))
    splits = splits.select("file", "split", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("__open"))
    before = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("__before", F.coalesce(F.sum("odd").over(before), F.lit(0)))
    placed = placed.join(splits, ["file", "split"]).select(
        "file", "split", "line", "value", "odd", (((F.col("__before") + F.col("__open")) % 2) == 0).alias("begins"))
    placed = materialize(placed, "csv_placed")

    # the last line that began a record, in this split or in one before it (a row per split)
    starts = placed.groupBy("file", "split").agg(
        F.max(F.when(F.col("begins"), F.struct("split", "line"))).alias("last"),
        F.min("line").alias("at"))
    carried = starts.select("file", "split", F.last("last", ignorenulls=True).over(earlier).alias("__carried"))
    first = starts.groupBy("file").agg(F.min(F.struct("split", "at")).alias("__first"))

    single = placed.filter(F.col("begins") & (F.col("odd") == 0)).select("file", "split", "line", "value")
    parts = placed.filter(~F.col("begins") | (F.col("odd") == 1))
    running = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("__home", F.last(F.when(F.col("begins"), F.struct("split", "line")), ignorenulls=True).over(running))
    parts = parts.join(carried, ["file", "split"]).withColumn("__home", F.coalesce("__home", "__carried"))
    parts = materialize(parts.select("file", "__home", "split", "line", "value"), "csv_parts")
    sizes = parts.groupBy("file", "__home").agg(F.sum(F.octet_length("value") + 1).alias("size"))
    large = sizes.filter(F.col("size") > max_record_bytes).limit(1).collect()
    if large:
        raise ValueError(f"{large[0]['file']}: a quote opened at {large[0]['__home']} does not close within {max_record_bytes} bytes")
    glued = parts.groupBy("file", "__home").agg(F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("__lines"))
    glued = glued.select("file", "__home.split", "__home.line",
                         F.array_join(F.transform("__lines", lambda x: x["value"]), "\n").alias("value"))
    records = single.unionByName(glued).join(first, "file")
    head = (F.col("split") == F.col("__first.split")) & (F.col("line") == F.col("__first.at"))
    return records.select("file", head.alias("head"), F.regexp_replace("value", "\r$", "").alias("record"))


def split_csv_scan(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str = "_corrupt_record",
                   max_record_bytes: int = 64 * MB) -> DataFrame:
    """The rows that the permissive ``multiLine`` scan gives, from files of any size in many tasks.

    Rows that do not fit ``schema`` keep what parsed and carry the raw record
    in ``corrupt_col``. Empty lines between records are no rows; the first
    record of each file is its header.
    """
    if corrupt_col not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col, "multiLine": "true"}
    rows = csv_records(spark, path, max_record_bytes).filter(~F.col("head") & (F.col("record") != ""))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")
