"""Date dimension: bounds over many timestamp columns, year-padded spine, attributes.

The bounds are one aggregation per source table (every column's min and max
in the same pass, partial per task, one tiny final reduce), combined in the
plan, not on the driver. The spine is bounded by the calendar: at most 366
rows per year between the bounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.functions.dates import date_attributes, year_end, year_start


def date_bounds(sources) -> DataFrame:
    """``sources``: [(df, [timestamp/date columns])] -> one row (min_date, max_date)."""
    parts = []
    for df, cols in sources:
        cols = [cols] if isinstance(cols, str) else list(cols)
        aggs = []
        for c in cols:
            aggs += [F.min(F.to_date(F.col(c))).alias(f"mn_{c}"), F.max(F.to_date(F.col(c))).alias(f"mx_{c}")]
        one = df.agg(*aggs)
        mins = [F.col(f"mn_{c}") for c in cols]
        maxs = [F.col(f"mx_{c}") for c in cols]
        parts.append(one.select(
            (F.least(*mins) if len(mins) > 1 else mins[0]).alias("min_date"),
            (F.greatest(*maxs) if len(maxs) > 1 else maxs[0]).alias("max_date")))
    both = reduce(DataFrame.unionByName, parts)
    return both.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from Jan 1 of the first year to Dec 31 of the last year."""
    return bounds.select(F.explode(F.sequence(
        year_start("min_date"), year_end("max_date"), F.expr("interval 1 day"))).alias("date"))


def date_dimension(spine: DataFrame) -> DataFrame:
    """One row per day: date_key first, then the date and its attributes."""
    attrs = date_attributes("date")
    return spine.select(attrs["date_key"].alias("date_key"), "date",
                        *[v.alias(k) for k, v in attrs.items() if k != "date_key"])
