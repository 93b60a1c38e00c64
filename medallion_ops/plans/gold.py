"""Gold star schema: dim_product, dim_date, dim_customer (SCD2), fact_sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion_ops.operators.calendar import date_bounds, date_dimension, date_spine
from medallion_ops.operators.keys import dense_surrogate_key
from medallion_ops.operators.scd import scd2_apply, scd2_lookup, scd2_seed
from medallion_ops.session import materialize, materialize_observed

# Fixed values of the customer scenario: spend tiers (cumulative order total)
# and the two snapshot dates of the SCD2 load.
TIER_SILVER_FROM = 1_000_000
TIER_GOLD_FROM = 2_500_000
SEED_CUTOFF = "1998-01-01"      # first load of the two-load scenario sees orders before this day
APPLY_AS_OF = "2002-01-01"      # second load sees all orders, applied on this day

CUSTOMER_ATTRS = ["customer_zip_code_prefix", "customer_city", "customer_state", "customer_tier"]
DIM_CUSTOMER_COLS = ["customer_sk", "customer_unique_id", *CUSTOMER_ATTRS,
                     "effective_date", "end_date", "is_current"]
FACT_COLS = ["order_id", "order_item_id", "price", "freight_value", "product_sk",
             "order_status", "date_key", "customer_sk"]


def dim_product(silver_products: DataFrame) -> DataFrame:
    """Dense ``product_sk`` 1..n in product_id order, key first."""
    return dense_surrogate_key(silver_products, ["product_id"], name="product_sk")


def dim_date(sources) -> DataFrame:
    """Calendar over the whole years spanned by ``sources`` [(df, [cols])]."""
    return date_dimension(date_spine(date_bounds(sources)))


def customer_profile(silver_customers: DataFrame, silver_orders: DataFrame,
                     before: str | None = None) -> DataFrame:
    """Per person: attributes of the latest order, spend tier, first order day.

    ``before`` limits the history to orders placed before that day (a
    snapshot of what was known then). One grouped aggregation: the latest
    attributes are ``max_by`` over (order time, customer_id) - null times
    sort lowest, as with DESC NULLS LAST - so partial aggregation combines
    a person's rows inside each task before the shuffle.
    """
    o = silver_orders.select("customer_id", "order_purchase_timestamp", "order_total")
    if before is not None:
        o = o.filter(F.col("order_purchase_timestamp") < F.lit(before).cast("timestamp_ntz"))
    c = silver_customers.select("customer_id", "customer_unique_id", *CUSTOMER_ATTRS[:3])
    joined = c.join(o, "customer_id", "inner" if before is not None else "left")
    latest = F.max_by(F.struct(*CUSTOMER_ATTRS[:3]),
                      F.struct("order_purchase_timestamp", "customer_id"))
    prof = joined.groupBy("customer_unique_id").agg(
        latest.alias("__a"),
        F.sum(F.col("order_total").cast("decimal(18,2)")).alias("spend"),
        F.to_date(F.min("order_purchase_timestamp")).alias("first_order_date"))
    tier = (F.when(F.col("spend") >= TIER_GOLD_FROM, "GOLD")
             .when(F.col("spend") >= TIER_SILVER_FROM, "SILVER")
             .otherwise("BRONZE"))
    return prof.filter(F.col("customer_unique_id").isNotNull()).select(
        "customer_unique_id", *[F.col(f"__a.{a}").alias(a) for a in CUSTOMER_ATTRS[:3]],
        tier.alias("customer_tier"), "first_order_date")


def customer_profiles(silver_customers: DataFrame, silver_orders: DataFrame, *before: str) -> list[DataFrame]:
    """``customer_profile`` of the orders before each of the days, and of all orders, from one join and one grouped pass.

    The pass is stored; an early profile comes from aggregates that count
    early orders only, for people who have any.
    """
    o = silver_orders.select("customer_id", "order_purchase_timestamp", "order_total")
    c = silver_customers.select("customer_id", "customer_unique_id", *CUSTOMER_ATTRS[:3])
    joined = c.filter(F.col("customer_unique_id").isNotNull()).join(o, "customer_id", "left")
    place, attrs = F.struct("order_purchase_timestamp", "customer_id"), F.struct(*CUSTOMER_ATTRS[:3])
    total, time = F.col("order_total").cast("decimal(18,2)"), F.col("order_purchase_timestamp")
    seen = [time < F.lit(day).cast("timestamp_ntz") for day in before] + [F.lit(True)]
    aggs = [x for i, known in enumerate(seen) for x in (
        F.max_by(attrs, F.when(known, place)).alias(f"a{i}"), F.sum(F.when(known, total)).alias(f"s{i}"),
        F.to_date(F.min(F.when(known, time))).alias(f"d{i}"))]
    stored = materialize(joined.groupBy("customer_unique_id").agg(*aggs), "customer_profiles")

    def profile(i: int) -> DataFrame:
        spend = F.col(f"s{i}")
        tier = F.when(spend >= TIER_GOLD_FROM, "GOLD").when(spend >= TIER_SILVER_FROM, "SILVER").otherwise("BRONZE")
        rows = stored if i == len(before) else stored.filter(F.col(f"d{i}").isNotNull())
        return rows.select("customer_unique_id", *[F.col(f"a{i}.{a}").alias(a) for a in CUSTOMER_ATTRS[:3]],
                           tier.alias("customer_tier"), F.col(f"d{i}").alias("first_order_date"))
    return [profile(i) for i in range(len(before) + 1)]


def dim_customer_seed(silver_customers: DataFrame, silver_orders: DataFrame,
                      before: str | None = None) -> DataFrame:
    """First SCD2 load: one current version per person, valid from the first order.

    ``before``: load what was known before that day (default: everything).
    """
    return _seed(customer_profile(silver_customers, silver_orders, before))


def _seed(profile: DataFrame) -> DataFrame:
    return scd2_seed(profile, "customer_unique_id", CUSTOMER_ATTRS,
                     effective=F.col("first_order_date"), sk="customer_sk").select(*DIM_CUSTOMER_COLS)


def stored_profile_seed(profile: DataFrame) -> tuple[DataFrame, int]:
    """The seed of a profile, stored, and its largest key."""
    return _stored(_seed(profile))


def _stored(seed: DataFrame) -> tuple[DataFrame, int]:
    stored, seen = materialize_observed(seed, "dim_customer_seed", max_sk=F.max("customer_sk"))
    return stored, seen["max_sk"] or 0


def stored_seed(silver_customers: DataFrame, silver_orders: DataFrame,
                seed_before: str = SEED_CUTOFF) -> tuple[DataFrame, int]:
    """The seed, stored once (an apply step reads it three times: current
    rows, history, comparison), and its largest key, observed while writing."""
    return _stored(dim_customer_seed(silver_customers, silver_orders, seed_before))


def dim_customer(silver_customers: DataFrame, silver_orders: DataFrame,
                 seed_before: str = SEED_CUTOFF, as_of: str = APPLY_AS_OF) -> DataFrame:
    """Seed from the early snapshot, then apply the full-history snapshot as SCD2."""
    early, everything = customer_profiles(silver_customers, silver_orders, seed_before)
    seed, max_sk = stored_profile_seed(early)
    # the profile is a groupBy on the person: unique by construction
    incoming = everything.drop("first_order_date")
    return scd2_apply(seed, incoming, "customer_unique_id", CUSTOMER_ATTRS, as_of, sk="customer_sk",
                      max_sk=max_sk, incoming_unique=True).select(*DIM_CUSTOMER_COLS)


def order_context(silver_orders: DataFrame, silver_customers: DataFrame, dim_date_df: DataFrame,
                  dim_customer_df: DataFrame, mode: str = "current") -> DataFrame:
    """Order-grain lookups: order -> person -> customer_sk, order day -> date_key.

    Done at order grain so the item table (the largest) is shuffled once,
    for its join to this frame on order_id.
    """
    o = silver_orders.select("order_id", "customer_id", "order_purchase_timestamp", "order_status")
    o = o.withColumn("order_date", F.to_date("order_purchase_timestamp"))
    dd = dim_date_df.select(F.col("date").alias("order_date"), "date_key")
    o = o.join(dd, "order_date", "left")
    o = o.join(silver_customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
    o = scd2_lookup(o, dim_customer_df, "customer_unique_id", sk="customer_sk", mode=mode,
                    at="order_date")
    return o.select("order_id", "order_status", "date_key", "customer_sk")


def fact_sales(silver_order_items: DataFrame, silver_orders: DataFrame, silver_customers: DataFrame,
               dim_product_df: DataFrame, dim_date_df: DataFrame, dim_customer_df: DataFrame,
               mode: str = "current", guard=None) -> DataFrame:
    """One row per order item with product, date and customer keys (left joins only).

    ``guard`` (a RowPreservingJoin) observes the fact count in the writing
    job; ``guard.check(silver_order_items)`` after the write proves no fan-out.
    """
    items = silver_order_items.select("order_id", "order_item_id", "product_id", "price", "freight_value")
    f = items.join(dim_product_df.select("product_id", "product_sk"), "product_id", "left")
    ctx = order_context(silver_orders, silver_customers, dim_date_df, dim_customer_df, mode)
    f = f.join(ctx, "order_id", "left")
    f = f.select(*FACT_COLS)
    return guard.after(f) if guard is not None else f
