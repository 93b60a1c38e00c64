"""File sources: CSV scans, corrupt-record quarantine, lineage, config-driven ingest.

Explicit schemas everywhere (inference costs an extra pass and turns codes
such as zip ``01310`` into the number 1310); ``infer=True`` is kept for
parity with exploratory use.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.session import materialize

CORRUPT = "_corrupt_record"


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """Header CSV scan; splittable, so many tasks per large file."""
    r = spark.read.option("header", header)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", infer)
    return r.csv(path)


def csv_permissive_scan(spark: SparkSession, path: str, schema: T.StructType,
                        corrupt_col: str = CORRUPT) -> DataFrame:
    """CSV whose quoted fields span lines and use ``""`` for a literal quote.

    Rows that do not fit ``schema`` keep what parsed and carry the raw text
    in ``corrupt_col``. ``multiLine`` files cannot be split: one task per
    file, so land many files rather than one huge one.
    """
    if corrupt_col not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .csv(path))


def quarantine_split(parsed: DataFrame, rules: list[Column] | None = None,
                     corrupt_col: str = CORRUPT, stage: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split into ``(clean, rejects)``.

    ``clean``: no corrupt text and every rule true (helper column dropped).
    ``rejects``: the rest, with the raw text kept for inspection. The parsed
    frame is first stored (``stage=True``): Spark refuses plans that read
    only the corrupt column of a raw CSV scan (so ``clean.count()`` would
    fail), and the costly multi-line parse then runs once for both outputs.
    """
    if stage:
        parsed = materialize(parsed, "parsed")
    ok = F.col(corrupt_col).isNull()
    for r in rules or []:
        ok = ok & F.coalesce(r, F.lit(False))
    tagged = parsed.withColumn("__ok", ok)
    clean = tagged.filter(F.col("__ok")).drop("__ok", corrupt_col)
    rejects = tagged.filter(~F.col("__ok")).drop("__ok")
    return clean, rejects


def lineage_columns(df: DataFrame, load_ts: str | None = None) -> DataFrame:
    """Add ``_load_timestamp`` (now, or the given instant) and ``_source_file``.

    Must be applied directly on a file scan, where ``_metadata`` exists.
    """
    ts = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    return df.withColumns({"_load_timestamp": ts, "_source_file": F.col("_metadata.file_path")})


def bronze_ingest(spark: SparkSession, sources: dict, write, load_ts: str | None = None) -> tuple[DataFrame, dict]:
    """Land every ``{table: (path, schema)}`` file set with lineage columns.

    ``write(table, df) -> path`` persists one table (overwrite). Returns the
    report ``(table_name, n_rows)`` read from the landed tables (a footer-level
    count per table) and the counts observed by the writing jobs themselves;
    the two agree unless a landed table was changed in between.
    """
    def land(name, path, schema):
        obs = Observation(f"ingest_{name}")
        df = lineage_columns(csv_scan(spark, path, schema), load_ts)
        landed = write(name, df.observe(obs, F.count(F.lit(1)).alias("n")))
        report = (spark.read.schema(df.schema).parquet(landed).agg(F.count(F.lit(1)).alias("n_rows"))
                  .select(F.lit(name).alias("table_name"), "n_rows"))
        return report, int(obs.get["n"])

    with ThreadPoolExecutor(max(1, len(sources))) as pool:          # tables are landed at once
        landing = {name: pool.submit(land, name, path, schema) for name, (path, schema) in sources.items()}
        done = {name: f.result() for name, f in landing.items()}
    return reduce(DataFrame.unionByName, [r for r, _ in done.values()]), {name: n for name, (_, n) in done.items()}
