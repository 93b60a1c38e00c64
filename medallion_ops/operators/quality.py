"""One-pass quality reports that fail loudly.

All checks over one table are evaluated in a single scan: the rows are
grouped by the uniqueness key (partial aggregation in every task, so a hot
key is combined before the shuffle) with the null counts as extra
aggregates, then reduced to one row. Orphan checks add one anti join each.
The report is a DataFrame ``(table_name, check_name, failures, passed)``;
``enforce`` raises on any failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.joins import orphans

REPORT_COLS = ["table_name", "check_name", "failures", "passed"]


class QualityError(AssertionError):
    pass


def table_checks(name: str, df: DataFrame, unique=None, not_null=(), not_empty: bool = True) -> DataFrame:
    """Row count, duplicate keys and null counts of one table, in one pass.

    ``failures`` of ``unique`` = rows - distinct keys (null-containing keys
    count as values, as ``select(k).distinct()`` does).
    """
    unique = [unique] if isinstance(unique, str) else list(unique or [])
    not_null = list(not_null)
    nulls = {c: F.sum(F.col(c).isNull().cast("long")) for c in not_null}
    if unique:
        g = df.groupBy(*unique).agg(F.count(F.lit(1)).alias("__n"),
                                    *[v.alias(f"__null_{c}") for c, v in nulls.items()])
        one = g.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                    F.count(F.lit(1)).alias("keys"),
                    *[F.coalesce(F.sum(f"__null_{c}"), F.lit(0)).alias(f"null_{c}") for c in not_null])
    else:
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("keys"),
                     *[F.coalesce(v, F.lit(0)).alias(f"null_{c}") for c, v in nulls.items()])
    checks = []
    if not_empty:
        checks.append(("not_empty", F.when(F.col("rows") == 0, 1).otherwise(0)))
    if unique:
        checks.append((f"unique({','.join(unique)})", F.col("rows") - F.col("keys")))
    for c in not_null:
        checks.append((f"not_null({c})", F.col(f"null_{c}")))
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), e.cast("long").alias("failures")) for n, e in checks]))
    return one.select(stacked.alias("c")).select(
        F.lit(name).alias("table_name"), "c.check_name", "c.failures",
        (F.col("c.failures") == 0).alias("passed"))


def orphan_check(name: str, child: DataFrame, parent: DataFrame, keys, parent_name: str = "parent") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = orphans(child.select(*keys), parent, keys).agg(F.count(F.lit(1)).alias("failures"))
    return n.select(F.lit(name).alias("table_name"),
                    F.lit(f"orphans({','.join(keys)}->{parent_name})").alias("check_name"),
                    F.col("failures").cast("long").alias("failures"),
                    (F.col("failures") == 0).alias("passed"))


def quality_report(parts) -> DataFrame:
    """Union of check frames from ``table_checks`` / ``orphan_check``."""
    return reduce(DataFrame.unionByName, parts).select(*REPORT_COLS)


def enforce(report: DataFrame) -> list:
    """Collect the (small) report and raise on the first failing check."""
    rows = report.collect()
    bad = [r for r in rows if not r["passed"]]
    if bad:
        lines = "; ".join(f"{r['table_name']}.{r['check_name']}: {r['failures']}" for r in bad)
        raise QualityError(f"quality checks failed: {lines}")
    return rows


def unique_flag(df: DataFrame, keys) -> DataFrame:
    """``count(*) == count(distinct keys)`` as one boolean row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg((F.coalesce(F.sum("__n"), F.lit(0)) == F.count(F.lit(1))).alias("is_unique"))


def null_counts(df: DataFrame, cols) -> DataFrame:
    """One row: ``null_<c>`` = number of nulls in each column."""
    return df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"null_{c}")
                    for c in cols])
