"""Table scans and the fixture adapters.

The driver ships TPC-H-like Parquet tables. The adapters below give them
the shape of the e-commerce bronze tables the operators are written for
(mapping in FIXTURES.md). They are plain projections and joins over the
whole tables, so every downstream query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the fixture mapping.
DELIVERED = "F"                       # o_orderstatus playing the role of 'delivered'
LOAD_TS = "2024-06-01 00:00:00"       # the bronze load time stamped on every adapted row
REVIEW_ID_LENGTH = 32                 # the shape rule of review ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; Catalyst prunes columns and pushes filters.

    The schema is read from the files each time: a path may be rewritten
    with other columns.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_load_timestamp": F.lit(LOAD_TS).cast("timestamp_ntz"),
        "_source_file": F.col("_metadata.file_path"),
    })


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: one row per order; customer_id is order-level as in the source domain."""
    o = table(spark, sf_dir, "orders")
    return _lineage(o).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_totalprice").alias("order_total"),
        "_load_timestamp", "_source_file",
    )


def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items from lineitem; (order_id, order_item_id) has real duplicates."""
    li = table(spark, sf_dir, "lineitem")
    return _lineage(li).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "_load_timestamp", "_source_file",
    )


# Total order after shipping_limit_date for order-item dedup (fixed by FIXTURES.md).
ORDER_ITEM_TIE_BREAK = ["product_id", "seller_id", "price", "freight_value",
                        "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers: one row per order (customer_id) naming the person behind it."""
    # lineage is taken at the orders scan: after a join `_metadata` is ambiguous
    o = _lineage(table(spark, sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "_load_timestamp", "_source_file")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation and region are plain scans of reference tables: the planner broadcasts them
    # when their file-size statistic is under spark.sql.autoBroadcastJoinThreshold (a size
    # check without an extra job), and joins them by sort-merge otherwise
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    person = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
               .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    out = o.join(person, o.o_custkey == person.c_custkey, "left")
    return out.select(
        F.col("o_orderkey").alias("customer_id"),
        F.col("o_custkey").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
        "_load_timestamp", "_source_file",
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _lineage(p).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_size").alias("product_size"),
        F.col("p_retailprice").alias("product_list_price"),
        "_load_timestamp", "_source_file",
    )


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payments: purchase events; several per order (user_id plays order_id)."""
    e = table(spark, sf_dir, "events")
    return _lineage(e.filter(F.col("event_type") == "purchase")).select(
        F.col("user_id").alias("order_id"),
        F.col("event_id").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        F.col("value").alias("payment_value"),
        F.col("ts").alias("payment_timestamp"),
        "_load_timestamp", "_source_file",
    )


def bronze_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviews: events; review_id = (user_id, event_type) repeats many times."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")).alias("review_id"),
        F.col("user_id").alias("order_id"),
        F.col("value").alias("review_score"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
        F.col("event_id"),
    )


REVIEW_CSV_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("review_comment_message", T.StringType()),
    T.StructField("review_answer_timestamp", T.TimestampNTZType()),
])


def review_csv_text(events: DataFrame) -> DataFrame:
    """Reviews as raw CSV fields derived from every event.

    Data-driven defects: 'error' events carry a non-numeric score (corrupt
    record), 'view' events a 16-character id (fails the shape rule). Every
    message spans two lines and holds quotes (the props JSON).
    """
    rid = F.md5(F.concat_ws("|", "user_id", "event_type", "event_id"))
    return events.select(
        F.when(F.col("event_type") == "view", F.substring(rid, 1, 16)).otherwise(rid).alias("review_id"),
        F.col("user_id").cast("string").alias("order_id"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
         .otherwise(F.floor(F.col("value") / 100).cast("string")).alias("review_score"),
        F.concat(F.col("event_type"), F.lit("\n"), F.col("props")).alias("review_comment_message"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("review_answer_timestamp"),
    )


def reviews_of_csv(clean: DataFrame) -> DataFrame:
    """Bronze reviews of the clean rows of the raw review files (which have one time and no event id)."""
    return clean.select("*", F.col("review_answer_timestamp").alias("review_creation_date"),
                        F.col("review_comment_message").alias("event_id"))
