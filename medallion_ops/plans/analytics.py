"""Analytics over the star: monthly revenue trend, top products, retention cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.windows import max_over, min_over

REVENUE = "decimal(38,2)"


def _dates(dim_date: DataFrame, *cols) -> DataFrame:
    return dim_date.select("date_key", *cols)


def monthly_revenue(fact: DataFrame, dim_date: DataFrame, status: str | None) -> DataFrame:
    """Revenue (sum of price, freight excluded) per calendar month, chronological.

    ``status`` keeps only facts with that order status (None: all).
    """
    f = fact if status is None else fact.filter(F.col("order_status") == status)
    j = f.select("date_key", "price").join(_dates(dim_date, "year_month"), "date_key")
    return (j.groupBy(F.col("year_month").alias("month"))
             .agg(F.sum("price").cast(REVENUE).alias("product_revenue"))
             .orderBy(F.col("month").asc_nulls_first()))


def top_products(fact: DataFrame, dim_product: DataFrame, status: str, k: int = 10) -> DataFrame:
    """The ``k`` products with the highest revenue (ties by product_sk).

    Aggregated to product grain and cut to the top k before the join: the
    order (revenue, product_sk) needs no dimension column, and facts without
    a product are out as the inner join has them. Each task keeps its own
    top k; the dimension is joined to k rows.
    """
    order = [F.col("product_revenue").desc(), F.col("product_sk").asc()]
    sales = (fact.filter((F.col("order_status") == status) & F.col("product_sk").isNotNull())
                 .groupBy("product_sk")
                 .agg(F.count(F.lit(1)).alias("units_sold"),
                      F.sum("price").cast(REVENUE).alias("product_revenue"))
                 .orderBy(*order).limit(k))
    dp = dim_product.select("product_sk", "product_id", "product_category_name")
    return (sales.join(dp, "product_sk")
                 .select("product_sk", "product_id", "product_category_name", "units_sold", "product_revenue")
                 .orderBy(*order).limit(k))


def monthly_activity(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, status: str) -> DataFrame:
    """Distinct (person, active month) pairs of the given order status."""
    f = fact.filter(F.col("order_status") == status).select("customer_sk", "date_key")
    dc = dim_customer.select("customer_sk", "customer_unique_id")
    j = (f.join(dc, "customer_sk")
          .join(_dates(dim_date, "year_month", "year", "month"), "date_key"))
    return j.select("customer_unique_id", F.col("year_month").alias("activity_month"),
                    (F.col("year") * 12 + F.col("month")).alias("activity_index")).distinct()


def cohort_retention(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, status: str) -> DataFrame:
    """Share of each first-purchase-month cohort active N months later.

    The windows run per person after the DISTINCT, so a partition holds at
    most one row per active month of one person.
    """
    act = monthly_activity(fact, dim_customer, dim_date, status)
    off = act.select(
        "customer_unique_id",
        min_over("activity_month", "customer_unique_id").alias("cohort_month"),
        (F.col("activity_index") - min_over("activity_index", "customer_unique_id")).alias("month_offset"))
    # After the DISTINCT a person has one row per active month, hence at most one
    # per (cohort, offset): count(*) equals count(DISTINCT person) without the
    # extra distinct-aggregation stage.
    ret = off.groupBy("cohort_month", "month_offset").agg(
        F.count(F.lit(1)).alias("active_customers"))
    rate = F.round(F.lit(100.0) * (F.col("active_customers") / max_over("active_customers", "cohort_month")), 5)
    return (ret.select("cohort_month", F.col("month_offset").cast("int").alias("month_offset"),
                       "active_customers", rate.alias("retention_rate"))
               .orderBy("cohort_month", "month_offset"))
