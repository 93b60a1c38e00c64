"""Layer-by-layer build: bronze -> silver -> quality gate -> gold -> analytics.

Each stage is one write (Parquet under ``out_dir``); later stages read the
written tables, so no stage recomputes another's shuffles. Every run writes
its tables to paths of its own and returns them at the end, so a failed run
leaves the previous run's tables as they were. The exception is
``fact_sales``: it is partitioned by order month and, in an incremental run,
upserted in place after everything else but the analytics is written (only
the months that lose or gain rows are rewritten, from a staged copy; the
upsert can be repeated after a failure).

    python -m medallion_ops.plans.build /root/testdata/sf0.01 /shared/out
"""

from __future__ import annotations

import sys
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion_ops.operators.dedup import latest_per_entity
from medallion_ops.operators.digest import changed_keys, digests
from medallion_ops.operators.joins import RowPreservingJoin
from medallion_ops.operators.merge import upsert_partitioned
from medallion_ops.operators.quality import enforce, orphan_check, quality_report, table_checks
from medallion_ops.operators.registry import KeyRegistry, keyed_dimension
from medallion_ops.operators.scd import current_unique_violations, scd2_apply, scd2_lookup
from medallion_ops.plans import analytics, gold, silver
from medallion_ops.sources import tables as tb
from medallion_ops.sources.files import quarantine_split
from medallion_ops.sources.sinks import register_table
from medallion_ops.sources.split_csv import split_csv_scan
from medallion_ops.sources.tables import DELIVERED

FACT_KEYS = ["order_id", "order_item_id"]
FACT_PARTITION = "order_month"          # yyyyMM of the order date


def _write(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


def _land_reviews(spark: SparkSession, sf_dir: str, out: str, run_id: str) -> dict[str, str]:
    """Raw review files, read in splits and cut in two by the quarantine."""
    raw = f"{out}/landing/reviews/{run_id}"
    tb.review_csv_text(tb.table(spark, sf_dir, "events")).write.option("header", True).option("escape", '"').csv(raw)
    parsed = split_csv_scan(spark, raw, tb.REVIEW_CSV_SCHEMA)
    clean, rejects = quarantine_split(parsed, [F.length("review_id") == tb.REVIEW_ID_LENGTH])
    return {"bronze.reviews": _write(tb.reviews_of_csv(clean), f"{out}/bronze/reviews/{run_id}"),
            "bronze.reviews_rejected": _write(rejects, f"{out}/bronze/reviews_rejected/{run_id}")}


def order_digests(so: DataFrame, soi: DataFrame, context: DataFrame) -> DataFrame:
    """One digest per order over its silver row, its items and its customer key (``context``: order_id, customer_sk)."""
    return digests({"orders": so, "items": soi, "customer": context}, "order_id")


def changed_orders(now: DataFrame, previous: dict) -> DataFrame:
    """Orders whose facts may differ from the previous run's: order_id and change (new, changed, gone).

    ``now`` are the orders' digests; the previous run's are read, or computed
    if that run stored none. What is compared does not depend on when a change
    was made, and orders and digests are all that is shuffled.
    """
    spark = now.sparkSession
    if "gold.order_digests" in previous:
        before = spark.read.parquet(previous["gold.order_digests"])
    else:
        before = order_digests(*[spark.read.parquet(previous[k]) for k in
                                 ("silver.orders", "silver.order_items", "gold.order_customer")])
    return changed_keys(before, now, "order_id")


def product_dimension(spark: SparkSession, products: DataFrame, previous: dict, path: str) -> tuple[DataFrame, str]:
    """dim_product with registered keys, and the path of the registry's keys.

    The registry lives on over runs: a product that leaves the source keeps its
    row and its number, and no number is issued twice.
    """
    keys_path = previous.get("gold.product_keys", f"{path}/keys")
    registry = KeyRegistry(spark, keys_path.removesuffix("/keys"), "product_id", "product_sk")
    before = spark.read.parquet(previous["gold.dim_product"]) if "gold.dim_product" in previous else None
    if before is not None and "gold.product_keys" not in previous:
        registry.adopt(before)
    # the gate has proved the products unique
    return keyed_dimension(registry, products, before, check_unique=False), keys_path


def run(spark: SparkSession, sf_dir: str, out_dir: str, previous: dict | None = None,
        register_prefix: str | None = None, as_of: str | None = None, changed_only: bool = False) -> dict:
    """Build every layer; returns ``{layer.table: path}``.

    ``previous`` (the result of an earlier run) makes the run incremental:
    dim_customer gets the new snapshot applied as SCD2 ``as_of`` that day
    (default: today; a first run applies its second load on
    ``gold.APPLY_AS_OF``), and fact_sales is upserted into the previous fact.
    The merge follows the source: facts whose items vanished are removed. With
    ``changed_only`` only facts of orders that changed since the previous run
    (by digest) are re-staged and merged, within the scope of these orders, so
    months without changes are neither read nor rewritten.
    Reviews are landed as raw CSV and pass the quarantine; what it rejects is
    kept as ``bronze.reviews_rejected``.
    ``register_prefix`` also exposes every table in the session catalog as
    ``<prefix>_<layer>.<table>`` (``""``: the layer name itself), creates the
    databases if missing, and adds the lazy view ``customer_current``
    (latest attributes per person, recomputed on every read, as a view is).
    """
    previous = previous or {}
    run_id = uuid.uuid4().hex[:8]
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}

    def read(name):
        return spark.read.parquet(paths[name])

    # bronze: source shape + lineage, landed as-is
    bronze = {
        "orders": tb.bronze_orders, "order_items": tb.bronze_order_items,
        "customers": tb.bronze_customers, "products": tb.bronze_products,
        "payments": tb.bronze_payments,
    }
    with ThreadPoolExecutor(len(bronze) + 1) as pool:        # independent tables are landed at once
        landed = {name: pool.submit(_write, adapter(spark, sf_dir), f"{out}/bronze/{name}/{run_id}")
                  for name, adapter in bronze.items()}
        reviews = pool.submit(_land_reviews, spark, sf_dir, out, run_id)
        paths |= {f"bronze.{name}": path.result() for name, path in landed.items()} | reviews.result()

    # silver: dedup, cast, null-key filter; orders first (others depend on it)
    paths["silver.orders"] = _write(silver.silver_orders(read("bronze.orders")), f"{out}/silver/orders/{run_id}")
    paths["silver.order_items"] = _write(
        silver.silver_order_items(read("bronze.order_items"), tb.ORDER_ITEM_TIE_BREAK), f"{out}/silver/order_items/{run_id}")
    paths["silver.customers"] = _write(silver.silver_customers(read("bronze.customers")), f"{out}/silver/customers/{run_id}")
    paths["silver.products"] = _write(silver.silver_products(read("bronze.products")), f"{out}/silver/products/{run_id}")
    paths["silver.payments"] = _write(silver.payments_collapsed(read("bronze.payments")), f"{out}/silver/payments/{run_id}")
    paths["silver.reviews"] = _write(silver.silver_reviews(read("bronze.reviews")), f"{out}/silver/reviews/{run_id}")

    so, soi = read("silver.orders"), read("silver.order_items")
    sc, sp = read("silver.customers"), read("silver.products")

    # quality gate: one pass per table, fail loudly before gold is touched
    enforce(quality_report([
        table_checks("silver.orders", so, unique="order_id", not_null=["order_id", "customer_id"]),
        table_checks("silver.order_items", soi, unique=FACT_KEYS, not_null=FACT_KEYS),
        table_checks("silver.customers", sc, unique="customer_id", not_null=["customer_id"]),
        table_checks("silver.products", sp, unique="product_id", not_null=["product_id"]),
        orphan_check("silver.order_items", soi, so, "order_id", "silver.orders"),
    ]))

    # gold dimensions
    dimp, paths["gold.product_keys"] = product_dimension(spark, sp, previous, f"{out}/gold/product_keys/{run_id}")
    paths["gold.dim_product"] = _write(dimp, f"{out}/gold/dim_product/{run_id}")
    paths["gold.dim_date"] = _write(
        gold.dim_date([(soi, ["shipping_limit_date"]), (so, ["order_purchase_timestamp"]),
                       (read("silver.reviews"), ["review_creation_date", "review_answer_timestamp"])]),
        f"{out}/gold/dim_date/{run_id}")
    if "gold.dim_customer" in previous:
        incoming = gold.customer_profile(sc, so).drop("first_order_date")
        dimc = scd2_apply(spark.read.parquet(previous["gold.dim_customer"]), incoming, "customer_unique_id",
                          gold.CUSTOMER_ATTRS, as_of or F.current_date(), sk="customer_sk")
    else:
        dimc = gold.dim_customer(sc, so, as_of=as_of or gold.APPLY_AS_OF)
    paths["gold.dim_customer"] = _write(dimc.select(*gold.DIM_CUSTOMER_COLS), f"{out}/gold/dim_customer/{run_id}")
    dimc = read("gold.dim_customer")
    if current_unique_violations(dimc, "customer_unique_id").limit(1).count():
        raise AssertionError("dim_customer has a key with several current versions")

    # fact: row-preserving lookups (output counted by the writing job, input from stored silver)
    people = so.join(sc.select("customer_id", "customer_unique_id"), "customer_id", "left")
    paths["gold.order_customer"] = _write(
        scd2_lookup(people, dimc, "customer_unique_id", sk="customer_sk").select("order_id", "customer_sk"),
        f"{out}/gold/order_customer/{run_id}")
    paths["gold.order_digests"] = _write(order_digests(so, soi, read("gold.order_customer")),
                                         f"{out}/gold/order_digests/{run_id}")
    guard = RowPreservingJoin("fact_sales")
    items, orders, scope = soi, so, None
    if changed_only and "gold.fact_sales" in previous:
        paths["gold.changed_orders"] = _write(changed_orders(read("gold.order_digests"), previous),
                                              f"{out}/gold/changed_orders/{run_id}")
        scope = read("gold.changed_orders").select("order_id")
        orders = so.join(read("gold.changed_orders"), "order_id", "left_semi")
        items = soi.join(read("gold.changed_orders"), "order_id", "left_semi")
    fact = gold.fact_sales(items, orders, sc, read("gold.dim_product"), read("gold.dim_date"), dimc, guard=guard)
    staged = _write(fact.withColumn(FACT_PARTITION, F.floor(F.col("date_key") / 100).cast("int")),
                    f"{out}/gold/fact_sales_staged/{run_id}")
    guard.check(items)
    if "gold.fact_sales" in previous:
        # keys are unique already: the gate enforced them on silver items and the guard
        # proved one fact row per item, so the merge skips its own duplicate-key shuffle
        paths["gold.fact_sales"] = upsert_partitioned(
            previous["gold.fact_sales"], spark.read.parquet(staged), FACT_KEYS, FACT_PARTITION,
            check_unique=False, delete_missing=True, scope=scope)
    else:
        paths["gold.fact_sales"] = f"{out}/gold/fact_sales/{run_id}"
        spark.read.parquet(staged).write.partitionBy(FACT_PARTITION).parquet(paths["gold.fact_sales"])

    # analytics
    f, dd, dp = read("gold.fact_sales"), read("gold.dim_date"), read("gold.dim_product")
    paths["analytics.monthly_revenue"] = _write(
        analytics.monthly_revenue(f, dd, DELIVERED), f"{out}/analytics/monthly_revenue/{run_id}")
    paths["analytics.top_products"] = _write(
        analytics.top_products(f, dp, DELIVERED), f"{out}/analytics/top_products/{run_id}")
    paths["analytics.cohort_retention"] = _write(
        analytics.cohort_retention(f, dimc, dd, DELIVERED), f"{out}/analytics/cohort_retention/{run_id}")
    if register_prefix is not None:
        for key, path in paths.items():
            layer, name = key.split(".", 1)
            db = f"{register_prefix}_{layer}" if register_prefix else layer
            register_table(spark, db, name, path, db_location=f"{out}/_catalog/{db}.db")
        current = latest_per_entity(
            sc.join(so.select("customer_id", "order_purchase_timestamp"), "customer_id", "left"),
            "customer_unique_id", "order_purchase_timestamp", tie_break=[("customer_id", "desc")])
        current.select("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state") \
            .createOrReplaceTempView(f"{register_prefix}_customer_current" if register_prefix else "customer_current")
    return paths


def main(argv):
    from medallion_ops.session import get_session

    sf_dir, out_dir = argv[1], argv[2]
    spark = get_session()
    for k, v in run(spark, sf_dir, out_dir).items():
        print(f"{k}\t{v}")


if __name__ == "__main__":
    main(sys.argv)
