"""Retention cohorts as a state that loads add to.

The state holds every (person, month) of activity, each person's first month
and the size of each (cohort, offset). A load adds its own pairs; a person whose
first month moves to an earlier one has their pairs taken out of the old cohort
and put into the new. Nothing else is counted again, whatever the order in
which months arrive, and loading a month twice changes nothing.

Months are numbers ``12 year + month``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion_ops.operators.windows import max_over
from medallion_ops.session import materialize


@dataclass
class CohortState:
    activity: DataFrame         # person, month
    first: DataFrame            # person, first
    sizes: DataFrame            # cohort, month_offset, active_customers


def no_cohorts(spark: SparkSession, person_type: str = "bigint") -> CohortState:
    return CohortState(spark.createDataFrame([], f"person {person_type}, month int"),
                       spark.createDataFrame([], f"person {person_type}, first int"),
                       spark.createDataFrame([], "cohort int, month_offset int, active_customers bigint"))


def _placed(pairs: DataFrame, first: DataFrame, sign: int) -> DataFrame:
    """How (person, month) pairs count under the persons' first months."""
    return pairs.join(first, "person").select(
        F.col("first").alias("cohort"), (F.col("month") - F.col("first")).cast("int").alias("month_offset"),
        F.lit(sign).cast("bigint").alias("n"))


def add_activity(state: CohortState, load: DataFrame) -> CohortState:
    """The state after a load of (person, month) rows; rows with a null are left out, repeated ones count once.

    Reads the state's pairs for the anti join and for people who moved; both
    joins are on the person, whose pairs are one per month.
    """
    pairs = load.select("person", F.col("month").cast("int").alias("month")).dropna().distinct()
    new = materialize(pairs.join(state.activity, ["person", "month"], "left_anti"), "cohort_new")
    seen = new.groupBy("person").agg(F.min("month").alias("__seen"))
    first = materialize(state.first.join(seen, "person", "full_outer").select(
        "person", F.col("first").alias("__was"), F.least("first", "__seen").alias("first")), "cohort_first")
    moved = first.filter(F.col("__was") > F.col("first"))
    old = state.activity.join(moved.select("person"), "person", "left_semi")
    now = first.select("person", "first")
    change = (_placed(old, moved.select("person", F.col("__was").alias("first")), -1)
              .unionByName(_placed(old, now, 1)).unionByName(_placed(new, now, 1)))
    sizes = state.sizes.select("cohort", "month_offset", F.col("active_customers").alias("n")).unionByName(change)
    sizes = sizes.groupBy("cohort", "month_offset").agg(F.sum("n").alias("active_customers"))
    sizes = materialize(sizes.filter(F.col("active_customers") != 0), "cohort_sizes")
    return CohortState(materialize(state.activity.unionByName(new), "cohort_activity"), now, sizes)


def retention(state: CohortState) -> DataFrame:
    """cohort_month (yyyy-MM), month_offset, active_customers and retention_rate, as ``cohort_retention`` gives them."""
    year, month = F.floor((F.col("cohort") - 1) / 12), (F.col("cohort") - 1) % 12 + 1
    named = state.sizes.select(F.format_string("%04d-%02d", year.cast("int"), month.cast("int")).alias("cohort_month"),
                               "month_offset", "active_customers")
    rate = F.round(F.lit(100.0) * (F.col("active_customers") / max_over("active_customers", "cohort_month")), 5)
    return named.withColumn("retention_rate", rate).orderBy("cohort_month", "month_offset")
