"""Physical-plan properties the scale design relies on."""

import contextlib
import io

from __spark_entry__ import queries
from medallion_ops.operators.quality import table_checks
from medallion_ops.sources.tables import table

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_projection_reach_the_scan(spark):
    text = _formatted(queries()["filter_eq"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," \
           "o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "o_orderpriority" not in text.split("ReadSchema")[1].split("\n")[0]


def test_quality_checks_scan_the_table_once(spark):
    li = table(spark, SF_SMALL, "lineitem")
    plan = _plan(table_checks("li", li, unique=["l_orderkey", "l_linenumber"], not_null=["l_partkey", "l_tax"]))
    assert plan.count("FileScan parquet") == 1


def test_star_queries_avoid_single_partition_and_cartesian_plans(spark):
    q = queries()
    for key in ["fact_sales", "dim_customer", "dim_product", "scd2_point_in_time", "monthly_revenue"]:
        plan = _formatted(q[key](spark, SF_SMALL))
        # the sort of a few result months may pass one task; a join or window of facts may not
        assert "SinglePartition" not in plan or key == "monthly_revenue", key
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_dense_key_stage_itself_is_dealt_by_range_without_code_trees(spark):
    """The stored stage's own plan: a range shuffle into many partitions, never one, at any size."""
    from pyspark.sql import functions as F

    from medallion_ops.operators.keys import dense_surrogate_key

    df = spark.range(200_000).select("id", F.pmod(F.col("id") * 7919, F.lit(200_000)).alias("k"))
    out = dense_surrogate_key(df, ["k"], partitions=300)
    plan = _plan(out)
    assert "SinglePartition" not in plan and "CASE WHEN" not in plan
    stored = out.inputFiles()
    assert sum("sk_input" in f for f in stored) > 200           # one file per range partition
    wrong = out.where(F.col("sk") != F.col("k") + 1).count()
    assert wrong == 0


def test_monthly_revenue_pre_aggregates(spark):
    plan = _formatted(queries()["monthly_revenue"](spark, SF_SMALL))
    assert "HashAggregate" in plan and "partial_sum" in plan


def test_top_products_is_take_ordered(spark):
    plan = _formatted(queries()["top_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
