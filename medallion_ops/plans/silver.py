"""Silver models: dedup, cast, null-key filter (in that order, as the source does).

Each takes a bronze-shaped DataFrame and returns the silver DataFrame with
an explicit column list (lineage columns are dropped here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.dedup import dedup_any, dedup_latest
from medallion_ops.operators.windows import money_sum, per_key_total

ORDERS_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_total"]
ORDER_ITEMS_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                    "price", "freight_value"]
CUSTOMERS_COLS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"]
PRODUCTS_COLS = ["product_id", "product_category_name", "product_name", "product_brand",
                 "product_size", "product_list_price"]
REVIEWS_COLS = ["review_id", "order_id", "review_score", "review_comment_message",
                "review_creation_date", "review_answer_timestamp"]
PAYMENTS_COLS = ["order_id", "payment_sequential", "payment_type", "payment_value"]

MONEY = "decimal(10,2)"


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Latest record per order (purchase time, then load time), then drop null keys.

    The null filter stays after the dedup: a null customer on the newest
    record removes the order rather than falling back to an older one.
    """
    d = dedup_latest(bronze, ["order_id"],
                     [("order_purchase_timestamp", "desc"), ("_load_timestamp", "desc")],
                     tie_break=[("customer_id", "asc"), ("order_status", "asc"), ("order_total", "asc")])
    return d.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()).select(*ORDERS_COLS)


def silver_order_items(bronze: DataFrame, tie_break) -> DataFrame:
    """Latest record per (order, item) by shipping date then load time; money to decimal(10,2)."""
    d = dedup_latest(bronze, ["order_id", "order_item_id"],
                     [("shipping_limit_date", "desc"), ("_load_timestamp", "desc")],
                     tie_break=[(c, "desc") for c in tie_break])
    d = d.withColumns({"price": F.col("price").cast(MONEY),
                       "freight_value": F.col("freight_value").cast(MONEY)})
    return d.filter(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()) \
            .select(*ORDER_ITEMS_COLS)


def silver_customers(bronze: DataFrame) -> DataFrame:
    """One row per customer_id (repeatable choice), zip as string, null ids dropped."""
    d = dedup_any(bronze.drop("_load_timestamp", "_source_file"), "customer_id")
    d = d.withColumn("customer_zip_code_prefix", F.col("customer_zip_code_prefix").cast("string"))
    return d.filter(F.col("customer_id").isNotNull()).select(*CUSTOMERS_COLS)


def silver_products(bronze: DataFrame) -> DataFrame:
    """Latest load per product (remaining columns break ties), null ids dropped."""
    rest = [c for c in PRODUCTS_COLS if c != "product_id"]
    d = dedup_latest(bronze, ["product_id"], [("_load_timestamp", "desc")],
                     tie_break=[(c, "asc") for c in rest])
    return d.filter(F.col("product_id").isNotNull()).select(*PRODUCTS_COLS)


def silver_reviews(bronze: DataFrame) -> DataFrame:
    """Latest review activity per review_id (answer, then creation time, then event id)."""
    d = dedup_latest(bronze, ["review_id"],
                     [("review_answer_timestamp", "desc"), ("review_creation_date", "desc")],
                     tie_break=[("event_id", "desc")])
    return d.filter(F.col("review_id").isNotNull()).select(*REVIEWS_COLS)


def payments_collapsed(bronze: DataFrame) -> DataFrame:
    """One row per order; payment_value replaced by the order's total (exact decimal).

    The surviving row is the latest load, lowest payment_sequential. Written
    as one grouped aggregation (``max_by`` over the ordering), so partial
    aggregation combines a hot order inside every task before the shuffle.
    """
    b = bronze.filter(F.col("order_id").isNotNull())
    keep = F.struct(*[F.col(c) for c in PAYMENTS_COLS if c not in ("order_id", "payment_value")])
    rank = F.struct(F.col("_load_timestamp"), -F.col("payment_sequential"))
    g = b.groupBy("order_id").agg(
        F.max_by(keep, rank).alias("__row"),
        money_sum("payment_value").alias("payment_value"))
    return g.select("order_id", "__row.payment_sequential", "__row.payment_type", "payment_value")


def payments_with_total(bronze: DataFrame) -> DataFrame:
    """Every payment row plus ``order_total_payment`` (the order's exact total)."""
    b = bronze.filter(F.col("order_id").isNotNull()).select(*PAYMENTS_COLS)
    return per_key_total(b, "order_id", "payment_value", "order_total_payment") \
        .select(*PAYMENTS_COLS, "order_total_payment")
