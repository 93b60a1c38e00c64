"""The layered build end to end at sf0.001, first load and an incremental rerun."""

from pyspark.sql import functions as F

from medallion_ops.plans.build import run
from medallion_ops.session import scratch_path

from .conftest import SF_SMALL


def test_build_then_incremental_rerun_is_stable(spark):
    out = scratch_path(spark, "build")
    first = run(spark, SF_SMALL, out)
    fact1 = spark.read.parquet(first["gold.fact_sales"])
    items = spark.read.parquet(first["silver.order_items"])
    n1 = fact1.count()
    assert n1 == items.count()
    assert fact1.filter(F.col("product_sk").isNull() | F.col("date_key").isNull()).count() == 0
    rows1 = sorted(map(tuple, fact1.select(*sorted(fact1.columns)).collect()))

    second = run(spark, SF_SMALL, out, previous=first, register_prefix="shop", as_of="2003-01-01")
    assert spark.table("shop_gold.fact_sales").count() == n1
    assert spark.table("shop_silver.orders").count() > 0
    people = spark.table("shop_customer_current")
    assert people.count() == people.select("customer_unique_id").distinct().count() > 0
    fact2 = spark.read.parquet(second["gold.fact_sales"])
    # upsert of the same facts into the partitioned fact: idempotent, row for row
    assert sorted(map(tuple, fact2.select(*sorted(fact2.columns)).collect())) == rows1
    dim2 = spark.read.parquet(second["gold.dim_customer"])
    dim1 = spark.read.parquet(first["gold.dim_customer"])
    # the same snapshot applied again changes nothing
    assert sorted(map(tuple, dim2.collect())) == sorted(map(tuple, dim1.collect()))
    rev = spark.read.parquet(second["analytics.monthly_revenue"])
    assert rev.count() > 0


def test_changed_only_rerun_rewrites_only_months_with_changes(spark):
    import glob
    import os
    import shutil

    from medallion_ops.sources.tables import TABLES

    out = scratch_path(spark, "build_inc")
    first = run(spark, SF_SMALL, out)
    path = first["gold.fact_sales"]
    local = path[len("file:"):] if path.startswith("file:") else path
    before = {f: os.path.getmtime(f) for f in glob.glob(local + "/order_month=*/*.parquet")}
    old = {(r.order_id, r.order_item_id): r for r in spark.read.parquet(path).collect()}

    # one old order is moved by years: its facts leave their month; all else is as before
    sf = scratch_path(spark, "changed_tables")
    local_sf = sf[len("file:"):] if sf.startswith("file:") else sf
    os.makedirs(local_sf)
    for t in TABLES:
        if t != "orders":
            shutil.copy(f"{SF_SMALL}/{t}.parquet", local_sf)
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    key = o.agg(F.min("o_orderkey")).collect()[0][0]
    moved = o.withColumn("o_orderdate", F.when(F.col("o_orderkey") == key, F.col("o_orderdate") + F.expr("interval 3 years"))
                         .otherwise(F.col("o_orderdate")))
    moved.coalesce(1).write.parquet(f"{sf}/orders.parquet")
    second = run(spark, sf, out, previous=first, as_of="2003-01-01", changed_only=True)
    assert second["gold.fact_sales"] == path
    fact = spark.read.parquet(path)
    assert fact.count() == fact.select("order_id", "order_item_id").distinct().count() == len(old)
    new = {(r.order_id, r.order_item_id): r for r in fact.collect()}
    changed = {r.order_id for r in spark.read.parquet(second["gold.changed_orders"]).collect()}
    assert key in changed
    assert all(new[k].date_key // 10000 == old[k].date_key // 10000 + 3 for k in old if k[0] == key)
    assert all(new[k] == old[k] for k in old if k[0] not in changed)
    touched = {r.order_month for k, r in [*old.items(), *new.items()] if k[0] in changed}
    after = {f: os.path.getmtime(f) for f in glob.glob(local + "/order_month=*/*.parquet")}
    still = [f for f in before if f.split("order_month=")[1].split("/")[0] not in {str(t) for t in touched}]
    assert still and all(after.get(f) == before[f] for f in still)          # other months: same files
    assert not any("order_month=" + str(m) in f for m in {r.order_month for r in old.values()}
                   - {r.order_month for r in new.values()} for f in after)       # emptied months are gone


def test_incremental_run_equals_a_rebuild(spark):
    """Orders and items that vanish, move and change, products that leave: the merged fact is the rebuilt one."""
    import os
    import shutil

    from medallion_ops.sources.tables import TABLES

    out = scratch_path(spark, "build_follow")
    first = run(spark, SF_SMALL, out)
    sf = scratch_path(spark, "later_tables")
    local_sf = sf[len("file:"):] if sf.startswith("file:") else sf
    os.makedirs(local_sf)
    for t in TABLES:
        if t not in ("orders", "lineitem", "part"):
            shutil.copy(f"{SF_SMALL}/{t}.parquet", local_sf)
    o, li, p = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem", "part"))
    o = o.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 == 1, F.col("o_orderdate") + F.expr("interval 100 days"))
                     .otherwise(F.col("o_orderdate")))
    gone = (F.col("o_orderkey") % 40 == 0)
    o.filter(~gone).write.parquet(f"{sf}/orders.parquet")
    li = li.filter(~((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 7 == 0))).join(
        o.filter(gone).select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti").select(*li.columns)
    li.write.parquet(f"{sf}/lineitem.parquet")
    cut = p.agg(F.max("p_partkey")).collect()[0][0] // 2
    p.filter(F.col("p_partkey") != cut).write.parquet(f"{sf}/part.parquet")

    again = run(spark, sf, out, previous=first, as_of="2003-01-01", changed_only=True)
    full = run(spark, sf, scratch_path(spark, "build_new"))
    product = lambda paths: spark.read.parquet(paths["gold.dim_product"]).select("product_id", "product_sk")

    def facts(paths):
        f = spark.read.parquet(paths["gold.fact_sales"]).join(product(paths), "product_sk", "left")
        return sorted(map(tuple, f.select("order_id", "order_item_id", "price", "freight_value", "order_status", "date_key").collect()))
    assert facts(again) == facts(full) and len(facts(again)) < spark.read.parquet(first["silver.order_items"]).count()
    assert {r.change for r in spark.read.parquet(again["gold.changed_orders"]).collect()} >= {"changed", "gone"}
    before, after = (dict(map(tuple, product(x).collect())) for x in (first, again))
    assert before == after and cut in after                     # the product that left keeps its row and number
    assert spark.read.parquet(again["bronze.reviews_rejected"]).count() > 0
