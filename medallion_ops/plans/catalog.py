"""Registered queries: one per operator key of the inventory.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the whole driver
tables (through the fixture adapters). ``oracle.py`` holds the matching
DuckDB SQL for the same keys; computed columns carry the same aliases.
"""

from __future__ import annotations

import threading
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion_ops.functions.dates import date_key, month_index, year_end, year_month
from medallion_ops.operators import cohorts, dedup, digest, distinct, joins, keys, merge, quality, quality_state, scd, windows
from medallion_ops.operators.calendar import date_bounds, date_spine
from medallion_ops.operators.registry import KeyRegistry, keyed_dimension
from medallion_ops.plans import analytics, gold, silver
from medallion_ops.session import materialize, materialize_observed, scratch_path
from medallion_ops.sources import files, sinks, split_csv
from medallion_ops.sources import tables as tb
from medallion_ops.sources.tables import DELIVERED, table


# ---------------------------------------------------------------- shared inputs

class Star:
    """Silver and gold frames of one sf directory, built lazily and reused.

    Each layer is stored once (Parquet in the shared folder, as the layered
    design persists its tables) and read back, so the many jobs that read
    it (date bounds, size checks, key allocation, joins) do not recompute
    its dedup shuffles from the raw tables.
    """

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self._memo: dict[str, Future] = {}
        self._lock = threading.Lock()

    def _get(self, name, build, store: bool = True):
        with self._lock:
            mine, found = name not in self._memo, self._memo.setdefault(name, Future())
        if mine:
            try:
                found.set_result(materialize(build(), name) if store else build())
            except BaseException as e:
                found.set_exception(e)
        return found.result()

    def _together(self, *names) -> None:
        """Builds independent layers at once: their jobs are small and would wait for one another."""
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(lambda n: getattr(self, n), names))

    @property
    def so(self):
        return self._get("so", lambda: silver.silver_orders(tb.bronze_orders(self.spark, self.d)))

    @property
    def soi(self):
        return self._get("soi", lambda: silver.silver_order_items(
            tb.bronze_order_items(self.spark, self.d), tb.ORDER_ITEM_TIE_BREAK))

    @property
    def sc(self):
        return self._get("sc", lambda: silver.silver_customers(tb.bronze_customers(self.spark, self.d)))

    @property
    def sp(self):
        # read once (by dim_product): not worth a stored copy
        return self._get("sp", lambda: silver.silver_products(tb.bronze_products(self.spark, self.d)),
                         store=False)

    @property
    def sr(self):
        # read once (by the date bounds)
        return self._get("sr", lambda: silver.silver_reviews(tb.bronze_reviews(self.spark, self.d)), store=False)

    @property
    def dimp(self):
        return self._get("dimp", lambda: gold.dim_product(self.sp))

    @property
    def dimd(self):
        self._together("so", "soi")
        return self._get("dimd", lambda: gold.dim_date(
            [(self.soi, ["shipping_limit_date"]), (self.so, ["order_purchase_timestamp"]),
             (self.sr, ["review_creation_date", "review_answer_timestamp"])]))

    @property
    def dimc(self):
        self._together("so", "sc")
        return self._get("dimc", lambda: gold.dim_customer(self.sc, self.so))

    @property
    def fact(self):
        self._together("so", "soi", "sc", "dimp")
        self._together("dimd", "dimc")
        # read once per query: left lazy so the analytics prune its columns
        return self._get("fact", lambda: gold.fact_sales(self.soi, self.so, self.sc, self.dimp,
                                                         self.dimd, self.dimc), store=False)


# ---------------------------------------------------------------- 2.1 scans, sources, sinks

def q_table_scan(spark, d):
    return table(spark, d, "orders")


def q_limit_preview(spark, d):
    return table(spark, d, "orders").orderBy("o_orderkey").limit(5)


def q_lineage_columns(spark, d):
    landed = files.lineage_columns(table(spark, d, "orders"), load_ts=tb.LOAD_TS)
    return landed.select(
        "o_orderkey", "o_orderstatus", F.col("_load_timestamp").cast("timestamp_ntz").alias("_load_timestamp"),
        F.regexp_extract("_source_file", "([^/]+)[.]parquet", 1).alias("_source_table"))


def q_overwrite_roundtrip(spark, d):
    return sinks.overwrite_roundtrip(table(spark, d, "orders"), "orders")


def q_csv_scan(spark, d):
    part = table(spark, d, "part")
    path = sinks.write_overwrite(part, scratch_path(spark, "part_csv"), fmt="csv")
    return files.csv_scan(spark, path, schema=part.schema)


def _review_csv(spark, d, scan=split_csv.split_csv_scan) -> DataFrame:
    text = tb.review_csv_text(table(spark, d, "events"))
    path = sinks.write_overwrite(text, scratch_path(spark, "reviews_csv"), fmt="csv")
    return scan(spark, path, tb.REVIEW_CSV_SCHEMA)


def q_csv_permissive_scan(spark, d, scan=files.csv_permissive_scan):
    parsed = _review_csv(spark, d, scan)
    return parsed.select("review_id", "order_id", "review_score", "review_comment_message",
                         "review_answer_timestamp", F.col(files.CORRUPT).isNotNull().alias("is_corrupt"))


def q_csv_split_scan(spark, d):
    """The same rows from files read by as many tasks as they have splits."""
    return q_csv_permissive_scan(spark, d, split_csv.split_csv_scan)


def q_quarantine_split(spark, d):
    clean, rejects = files.quarantine_split(_review_csv(spark, d), [F.length("review_id") == tb.REVIEW_ID_LENGTH])
    return clean.withColumn("quarantined", F.lit(False)).unionByName(
        rejects.drop(files.CORRUPT).withColumn("quarantined", F.lit(True)))


INGEST_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events")


def q_bronze_ingest(spark, d):
    sources, base = {}, scratch_path(spark, "landing")
    for name in INGEST_TABLES:
        df = table(spark, d, name)
        sources[name] = (sinks.write_overwrite(df, f"{base}/csv/{name}", fmt="csv"), df.schema)
    bronze = scratch_path(spark, "bronze")
    report, observed = files.bronze_ingest(
        spark, sources, lambda n, df: sinks.write_overwrite(df, f"{bronze}/{n}"), load_ts=tb.LOAD_TS)
    wrote = F.create_map(*[F.lit(x) for kv in observed.items() for x in kv])
    return report.withColumn("as_written", F.col("n_rows") == wrote[F.col("table_name")])


CUSTOMER_DDL = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.StringType()),
    T.StructField("c_acctbal", T.DecimalType(12, 2)),
    T.StructField("c_mktsegment", T.StringType()),
    T.StructField("is_current", T.BooleanType()),
])


def q_schema_conform(spark, d):
    return sinks.schema_conform(table(spark, d, "customer"), CUSTOMER_DDL)


def q_sql_over_view(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("mo_lineitem")
    return spark.sql("""
        SELECT l_returnflag, l_linestatus,
               count(*) AS n_items,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue
        FROM mo_lineitem
        GROUP BY l_returnflag, l_linestatus""")


def q_schema_describe(spark, d):
    """Column profile: name and type from ``DESCRIBE``, non-null count from one scan."""
    li = table(spark, d, "lineitem")
    li.createOrReplaceTempView("mo_lineitem_d")
    desc = spark.sql("DESCRIBE TABLE mo_lineitem_d").select("col_name", F.upper("data_type").alias("data_type"))
    one = li.agg(*[F.count(c).alias(c) for c in li.columns])           # a single row, then stacked
    counts = one.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in li.columns]), F.array(*[F.col(c) for c in li.columns]))).alias("col_name", "non_null"))
    return desc.join(counts, "col_name", "left")


def q_csv_scan_inferred(spark, d):
    """The exploratory scan: types guessed from the text by an extra pass."""
    part = table(spark, d, "part")
    path = sinks.write_overwrite(part, scratch_path(spark, "part_csv"), fmt="csv")
    got = files.csv_scan(spark, path, infer=True)
    return got.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def q_typed_table_identity(spark, d):
    """A declared table with an allocated key: conformed rows, numbered, registered and read by name."""
    typed = sinks.schema_conform(table(spark, d, "customer"), CUSTOMER_DDL)
    keyed = keys.dense_surrogate_key(typed, ["c_custkey"], name="customer_sk")
    base = scratch_path(spark, "catalog")
    path = sinks.write_overwrite(keyed, f"{base}/typed_customer")
    name = sinks.register_table(spark, "mo_typed", f"customer_{base[-12:]}", path, db_location=f"{base}/mo_typed.db")
    return spark.table(name)


def q_view_over_table(spark, d):
    """A lazy view over a registered table, in a namespace of its own."""
    base = scratch_path(spark, "catalog")
    path = sinks.write_overwrite(table(spark, d, "customer").select("c_custkey", "c_nationkey"), f"{base}/people")
    name = sinks.register_table(spark, "mo_views", f"people_{base[-12:]}", path, db_location=f"{base}/mo_views.db")
    spark.table(name).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_people")) \
        .createOrReplaceTempView("mo_people_by_nation")
    return spark.table("mo_people_by_nation")


def q_inline_relation(spark, d):
    """A small in-line relation (status names) joined to a table."""
    names = spark.createDataFrame([("F", "fulfilled"), ("O", "open"), ("P", "pending")], "code string, status string")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return o.join(names, F.col("o_orderstatus") == F.col("code"), "left").select("o_orderkey", "status")


# ---------------------------------------------------------------- 2.2 projections, filters

def q_project_columns(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def q_drop_columns(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                            F.col("l_partkey").alias("product_id"), "l_extendedprice")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_type")
    return li.join(p, "product_id", "left").drop("product_id")


def q_derive_columns(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_orderdate").withColumns({
        "order_date": F.to_date("o_orderdate"),
        "date_key": date_key(F.to_date("o_orderdate")),
        "year_month": year_month("o_orderdate"),
        "is_weekend": F.dayofweek("o_orderdate").isin(1, 7),
    }).drop("o_orderdate")


def q_literal_columns(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        F.lit(True).alias("is_current"),
        F.lit(None).cast("string").alias("merge_key"),
        F.lit(scd.OPEN_END).cast("date").alias("end_date"))


def q_cast_types(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("ship_key"))


def q_filter_eq(spark, d):
    return table(spark, d, "orders").filter(F.col("o_orderstatus") == DELIVERED) \
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def q_filter_ne(spark, d):
    return table(spark, d, "lineitem").filter(F.col("l_linenumber") != 1) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def q_filter_not_null(spark, d):
    return table(spark, d, "lineitem").dropna(subset=["l_orderkey", "l_linenumber"]) \
        .select("l_orderkey", "l_linenumber", "l_shipdate")


def q_filter_or(spark, d):
    o = table(spark, d, "orders")
    return o.filter((F.col("o_orderstatus") == "F") | (F.col("o_orderstatus") == "P")) \
        .select("o_orderkey", "o_orderstatus")


def q_filter_in_list(spark, d):
    return table(spark, d, "orders").filter(F.dayofweek("o_orderdate").isin(1, 7)) \
        .select("o_orderkey", "o_orderdate")


def q_select_distinct(spark, d):
    return table(spark, d, "orders").select("o_custkey", year_month("o_orderdate").alias("year_month")).distinct()


def split_by(df: DataFrame, cond) -> tuple[DataFrame, DataFrame]:
    """Complementary filters; rows where ``cond`` is null are in neither."""
    return df.filter(cond), df.filter(~cond)


def q_partition_by_predicate(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    first, rest = split_by(li, F.col("l_linenumber") == 1)
    return first.withColumn("part_name", F.lit("first")).unionByName(rest.withColumn("part_name", F.lit("rest")))


def q_dq_unique_flag(spark, d):
    return quality.unique_flag(table(spark, d, "part"), "p_partkey").select(
        F.lit("part").alias("table_name"), "is_unique").unionByName(
        quality.unique_flag(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
            F.lit("lineitem").alias("table_name"), "is_unique"))


# ---------------------------------------------------------------- 2.3 joins

def _items(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_extendedprice").alias("price"))


def _delivered(spark, d):
    return table(spark, d, "orders").filter(F.col("o_orderstatus") == DELIVERED).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"))


def q_left_join_using(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"),
                                       F.col("p_type").alias("product_category_name"))
    return joins.left_join_using(_items(spark, d), p, "product_id")


def q_left_join_on(spark, d):
    """Every customer with its events' types; most customers have none."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return c.join(e, c.c_custkey == e.user_id, "left").drop("user_id")


def q_star_join_inner(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_type")
    return _items(spark, d).join(_delivered(spark, d), "order_id").join(p, "product_id") \
        .select("order_id", "order_item_id", "product_id", "p_type", "order_status", "price")


def q_orphan_anti_join(spark, d):
    """Customers without any event."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    return joins.orphans(c, table(spark, d, "events"), "user_id")


def q_row_number_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    return joins.row_number_join(o, p, ["o_orderkey"], ["p_partkey"], how="left", name="rn")


def q_fact_bridge_join(spark, d):
    s = Star(spark, d)
    items = s.soi.select("order_id", "order_item_id")
    o = s.so.select("order_id", "customer_id")
    c = s.sc.select("customer_id", "customer_unique_id")
    ctx = scd.scd2_lookup(o.join(c, "customer_id", "left"), s.dimc, "customer_unique_id", sk="customer_sk")
    return items.join(ctx, "order_id", "left").select(
        "order_id", "order_item_id", "customer_id", "customer_unique_id", "customer_sk")


def _orders_people(s: Star):
    o = s.so.select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("order_date"))
    return o.join(s.sc.select("customer_id", "customer_unique_id"), "customer_id", "left")


def q_scd2_current_lookup(spark, d):
    s = Star(spark, d)
    return scd.scd2_lookup(_orders_people(s), s.dimc, "customer_unique_id", sk="customer_sk") \
        .select("order_id", "customer_unique_id", "customer_sk")


def q_scd2_point_in_time(spark, d):
    s = Star(spark, d)
    return scd.scd2_lookup(_orders_people(s), s.dimc, "customer_unique_id", sk="customer_sk",
                           mode="point_in_time", at="order_date") \
        .select("order_id", "order_date", "customer_unique_id", "customer_sk")


# ---------------------------------------------------------------- 2.4 aggregations

def q_agg_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


def q_agg_count_distinct(spark, d):
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n_orders"),
                                         F.countDistinct("o_custkey").alias("n_customers"))


def q_group_count(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


def q_group_count_sorted(spark, d):
    return (table(spark, d, "lineitem").groupBy("l_orderkey")
            .agg(F.count("l_linenumber").alias("item_count"))
            .orderBy(F.col("item_count").desc(), F.col("l_orderkey")))


def q_group_sum(spark, d):
    return (table(spark, d, "lineitem").groupBy("l_partkey")
            .agg(F.count(F.lit(1)).alias("units_sold"),
                 F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).cast("decimal(38,2)").alias("revenue")))


def q_group_count_distinct(spark, d):
    return (table(spark, d, "orders").groupBy(year_month("o_orderdate").alias("year_month"))
            .agg(F.countDistinct("o_custkey").alias("active_customers")))


def _order_months(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderdate", year_month("o_orderdate").alias("year_month"))


def q_distinct_bitmaps(spark, d):
    """Active customers per month and in all, from the united bitmaps of two overlapping loads."""
    o = _order_months(spark, d)
    state = [materialize(distinct.distinct_state(o.filter(x), "o_custkey", "year_month"), "bitmaps") for x in (
        F.col("o_orderdate") < "1997-01-01", F.col("o_orderdate") >= "1996-01-01")]
    state = materialize(distinct.unite(state, "year_month"), "bitmaps_united")
    total = distinct.distinct_counts(state, name="active_customers").select(F.lit("all").alias("year_month"), "active_customers")
    return distinct.distinct_counts(state, "year_month", "active_customers").unionByName(total)


def q_distinct_bitmaps_dense(spark, d):
    """Distinct pairs of brand and size per type over two loads: strings counted by the dense numbers of a registry."""
    p = table(spark, d, "part").select("p_type", "p_brand", "p_size")
    registry = KeyRegistry(spark, scratch_path(spark, "pair_ids"), ["p_brand", "p_size"], "pair_id")
    state = [materialize(distinct.distinct_state(distinct.dense_ids(p.filter(x), registry), "pair_id", "p_type"), "bitmaps")
             for x in (F.col("p_size") <= 30, F.col("p_size") >= 20)]
    return distinct.distinct_counts(distinct.unite(state, "p_type"), "p_type", "n_pairs")


def q_date_bounds(spark, d):
    return date_bounds([(table(spark, d, "orders"), ["o_orderdate"]),
                        (table(spark, d, "lineitem"), ["l_shipdate"]),
                        (table(spark, d, "events"), ["ts"])])


def q_having_duplicates(spark, d):
    return merge.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_null_fk_audit(spark, d):
    """Foreign keys of the fact that found no dimension row."""
    audit = quality.null_counts(Star(spark, d).fact, ["product_sk", "customer_sk", "date_key"])
    return audit.select(F.col("null_product_sk").alias("null_prod"), F.col("null_customer_sk").alias("null_cust"),
                        F.col("null_date_key").alias("null_date"))


def q_row_preserving_fact(spark, d):
    """Rows of the items table and of the fact built from it: the lookups neither lose nor repeat any."""
    s = Star(spark, d)
    row = lambda df, i, o: df.select(F.lit(i).cast("bigint").alias("i"), F.lit(o).cast("bigint").alias("o"))
    both = row(s.soi, 1, 0).unionByName(row(s.fact, 0, 1)).agg(F.sum("i").alias("rows_in"), F.sum("o").alias("rows_out"))
    return both.withColumn("passed", F.col("rows_in") == F.col("rows_out"))


def q_first_row(spark, d):
    """The first order of the whole table by date, then key."""
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate") \
        .orderBy("o_orderdate", "o_orderkey").limit(1)


def q_filter_sql_string(spark, d):
    """The same kind of filter written as an SQL string."""
    return table(spark, d, "lineitem").filter("l_quantity >= 25 AND l_returnflag <> 'N'") \
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def q_column_lists_equal(spark, d):
    """The check before a merge, over all tables: whether a bumped copy has the table's columns."""
    out = []
    for name in ("orders", "lineitem", "part"):
        df = table(spark, d, name)
        for label, other in (("same", df.select(*reversed(df.columns))), ("fewer", df.drop(df.columns[-1]))):
            try:
                merge.assert_same_columns(df, other)
                equal = True
            except ValueError:
                equal = False
            out.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(label).alias("candidate"), F.lit(equal).alias("equal"), "n_rows"))
    return reduce(DataFrame.unionByName, out)


def q_dq_unique_key(spark, d):
    s = Star(spark, d)
    raw = tb.bronze_order_items(spark, d)
    k = ["order_id", "order_item_id"]
    return quality.quality_report([
        quality.table_checks("bronze_order_items", raw, unique=k, not_empty=False),
        quality.table_checks("silver_order_items", s.soi, unique=k, not_empty=False)])


def q_dq_not_null(spark, d):
    s = Star(spark, d)
    return quality.quality_report([
        quality.table_checks("silver_orders", s.so, not_null=["order_id", "customer_id"], not_empty=False),
        quality.table_checks("silver_order_items", s.soi, not_null=["order_id", "order_item_id"],
                             not_empty=False)])


def q_dq_report(spark, d):
    s = Star(spark, d)
    s._together("so", "soi")
    return quality.quality_report([
        quality.table_checks("silver_orders", s.so, unique="order_id", not_null=["order_id"]),
        quality.table_checks("silver_order_items", s.soi, unique=["order_id", "order_item_id"],
                             not_null=["order_id"]),
        quality.orphan_check("silver_order_items", s.soi, s.so, "order_id", "silver_orders")])


def q_dq_incremental(spark, d):
    """The gate over raw items after two loads by ship month: the second brings later months and writes those of 1996
    anew, of which the first held large lots only. Only a load's own months are scanned."""
    raw, k = tb.bronze_order_items(spark, d), ["order_id", "order_item_id"]
    month, late = F.date_format("shipping_limit_date", "yyyyMM"), F.col("shipping_limit_date")
    first = raw.filter((late < "1996-01-01") | ((late < "1997-01-01") & (F.col("freight_value") >= 25)))
    second = raw.filter((late >= "1996-01-01") | late.isNull())
    loads = [quality_state.quality_state(x, month, k, k) for x in (first, second)]
    one, two = [quality_state.QualityState(materialize(x.metrics, "dq_metrics"), materialize(x.keys, "dq_keys")) for x in loads]
    return quality_state.state_report("bronze_order_items", quality_state.replace_partitions(one, two), k, k)


def q_scd2_current_unique(spark, d):
    dim = Star(spark, d).dimc
    per = dim.filter(F.col("is_current")).groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("keys_with_current"),
                   F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("keys_with_several"))


# ---------------------------------------------------------------- 2.5 windows

LINEITEM_ORDER = [("l_shipdate", "desc")] + [(c, "desc") for c in
                 ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus"]]


def q_dedup_latest(spark, d):
    return dedup.dedup_latest(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)


def q_dedup_any(spark, d):
    return dedup.dedup_any(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_latest_per_entity(spark, d):
    s = Star(spark, d)
    j = s.sc.join(s.so.select("customer_id", "order_purchase_timestamp"), "customer_id", "left")
    return dedup.latest_per_entity(j, "customer_unique_id", "order_purchase_timestamp",
                                   tie_break=[("customer_id", "desc")]).select(
        "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state")


def q_dense_surrogate_key(spark, d):
    return keys.dense_surrogate_key(table(spark, d, "part").select("p_partkey", "p_name", "p_type"),
                                    ["p_name", "p_partkey"], name="part_sk")


def _three_loads(registry, loads):
    """The dimension after three loads through the registry, each stored as the next one's previous state."""
    dim = None
    for n, load in enumerate(loads, 1):
        dim = materialize(keyed_dimension(registry, load.withColumn("last_load", F.lit(n)), dim, check_unique=False), f"dim_load{n}")
    return dim


def q_key_registry(spark, d):
    """Products over three loads: the small ones leave in the second and return in the third, larger ones come in each."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_name", "p_size")
    registry = KeyRegistry(spark, scratch_path(spark, "product_keys"), "product_id", "product_sk")
    size = F.col("p_size")
    return _three_loads(registry, [p.filter(size <= 30), p.filter((size > 15) & (size <= 40)), p.filter((size <= 15) | (size > 40))])


def q_key_registry_nulls(spark, d):
    """Composite keys with nulls (size 10 is unknown) over three loads: each keeps the one number it was given."""
    p = table(spark, d, "part")
    pairs = lambda rows: rows.select("p_brand", F.nullif("p_size", F.lit(10)).alias("size")).distinct()
    registry = KeyRegistry(spark, scratch_path(spark, "brand_keys"), ["p_brand", "size"], "brand_sk")
    return _three_loads(registry, [pairs(p.filter("p_size <= 20")), pairs(p.filter("p_size between 10 and 35")), pairs(p)])


def q_window_sum(spark, d):
    """Every event with its user's exact total."""
    e = table(spark, d, "events").select("event_id", "user_id", "value")
    return windows.per_key_total(e, "user_id", "value", "user_total")


def q_window_min(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return windows.per_key_agg(o, "o_custkey", {"first_order_date": F.min("order_date")})


def q_window_ratio_to_max(spark, d):
    g = (table(spark, d, "orders").groupBy("o_orderstatus", year_month("o_orderdate").alias("year_month"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    return g.withColumn("share_of_peak", F.round(F.lit(100.0) * windows.ratio_to_max("n_orders", "o_orderstatus"), 5))


# ---------------------------------------------------------------- 2.6/2.7 sorts, set ops

def q_union_by_name(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    expire = c.withColumn("merge_key", F.col("c_custkey"))
    insert = c.select(F.lit(None).cast("bigint").alias("merge_key"), "c_mktsegment", "c_custkey")
    return expire.unionByName(insert)


def q_union_all(spark, d):
    parts = [table(spark, d, "orders").select(F.to_date("o_orderdate").alias("d")),
             table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("d")),
             table(spark, d, "events").select(F.to_date("ts").alias("d"))]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- 2.8 functions

def q_fn_date_parts(spark, d):
    o = table(spark, d, "orders")
    dt = F.to_date("o_orderdate")
    return o.select("o_orderkey", dt.alias("order_date"), F.year(dt).alias("year"),
                    F.quarter(dt).alias("quarter"), F.month(dt).alias("month"),
                    F.dayofmonth(dt).alias("day"), F.dayofyear(dt).alias("day_of_year"),
                    F.dayofweek(dt).alias("day_of_week"), F.weekofyear(dt).alias("week_of_year"))


def q_fn_date_format(spark, d):
    dt = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", date_key(dt).alias("date_key"), year_month(dt).alias("year_month"),
        F.date_format(dt, "MMMM").alias("month_name"), F.date_format(dt, "EEEE").alias("day_name"),
        F.concat(F.lit("Q"), F.quarter(dt).cast("string")).alias("quarter_name"))


def q_fn_date_trunc(spark, d):
    dt = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", F.trunc(dt, "month").alias("first_day_of_month"),
        F.trunc(dt, "YEAR").alias("first_day_of_year"), F.last_day(dt).alias("last_day_of_month"),
        year_end(dt).alias("last_day_of_year"))


def q_fn_month_index(spark, d):
    dt = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", month_index(dt).alias("month_index"),
        (month_index(dt) - F.lit(1995 * 12 + 1)).alias("months_since_1995"),
        (F.lit(100) * (F.month(dt) / F.lit(12))).alias("pct_of_year"))


def q_date_spine(spark, d):
    return date_spine(date_bounds([(table(spark, d, "orders"), ["o_orderdate"]),
                                   (table(spark, d, "lineitem"), ["l_shipdate"])]))


# ---------------------------------------------------------------- 2.9 DML-like

def _bump(df: DataFrame) -> DataFrame:
    return df.withColumn("price", (F.col("price") + F.lit(1)).cast("decimal(10,2)"))


def q_upsert_merge(spark, d):
    """Two overlapping loads of the whole silver table: every item is in at least
    one of them, items 3-4 in both (updated), 1-2 only in the first (kept),
    5+ only in the second (inserted)."""
    soi = Star(spark, d).soi
    target = soi.filter(F.col("order_item_id") <= 4)            # first load: items 1-4
    source = _bump(soi.filter(F.col("order_item_id") >= 3))     # second: items 3+, repriced
    return merge.upsert(target, source, ["order_id", "order_item_id"])


def q_upsert_partitioned(spark, d):
    """Two overlapping loads into a table partitioned by ship month: the second moves items 3+ by
    forty days, most of them into another month's partition."""
    month = F.date_format("shipping_limit_date", "yyyyMM").cast("int")
    soi = Star(spark, d).soi.select("order_id", "order_item_id", "price", "shipping_limit_date")
    path = scratch_path(spark, "fact_by_month")
    soi.filter(F.col("order_item_id") <= 4).withColumn("ship_month", month).write.partitionBy("ship_month").parquet(path)
    later = soi.filter(F.col("order_item_id") >= 3).withColumn(
        "shipping_limit_date", F.col("shipping_limit_date") + F.expr("interval 40 days"))
    merge.upsert_partitioned(path, later.withColumn("ship_month", month), ["order_id", "order_item_id"], "ship_month")
    return spark.read.parquet(path)


def q_merge_follow_source(spark, d):
    """A load that lost rows, merged into a table by ship month: small lots and everything before 1993 are gone from the
    source, and removed where the load is complete (all orders but the pending ones); the rest is repriced."""
    month = F.date_format("shipping_limit_date", "yyyyMM").cast("int")
    s = Star(spark, d)
    soi = s.soi.select("order_id", "order_item_id", "price", "freight_value", month.alias("ship_month"))
    path = scratch_path(spark, "fact_following")
    soi.write.partitionBy("ship_month").parquet(path)
    source = _bump(soi.filter((F.col("freight_value") >= 10) & (F.col("ship_month") >= 199301)))
    complete = s.so.filter(F.col("order_status") != "P").select("order_id")
    merge.upsert_partitioned(path, source, ["order_id", "order_item_id"], "ship_month", check_unique=False,
                             delete_missing=True, scope=complete)
    return spark.read.parquet(path)


def q_merge_changes(spark, d):
    """What that merge does, by action."""
    s = Star(spark, d)
    soi = s.soi.select("order_id", "order_item_id", "price", "freight_value")
    source = soi.filter(F.col("freight_value") >= 10).withColumn(
        "price", F.when(F.col("freight_value") >= 40, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(10,2)"))
    target = soi.filter(F.col("order_item_id") <= 4)
    complete = s.so.filter(F.col("order_status") != "P").select("order_id")
    return merge.merge_changes(target, source, ["order_id", "order_item_id"], complete).withColumnRenamed("__action", "action")


def q_order_digest_changes(spark, d):
    """Orders whose header or items differ between two loads, found by digests: the second load lacks small lots, reprices
    large ones, knows orders from 1998 on and has the status of pending orders settled."""
    s = Star(spark, d)
    header = s.so.select("order_id", "order_status", "order_purchase_timestamp")
    items = s.soi.select("order_id", "order_item_id", "price", "freight_value")
    early = header.filter(F.col("order_purchase_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz"))
    settled = header.withColumn("order_status", F.when(F.col("order_status") == "P", "F").otherwise(F.col("order_status")))
    priced = items.filter(F.col("freight_value") >= 3).withColumn(
        "price", F.when(F.col("freight_value") > 48, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(10,2)"))
    before = digest.digests({"orders": early, "items": items.join(early, "order_id", "left_semi")}, "order_id")
    now = digest.digests({"orders": settled, "items": priced}, "order_id")
    return digest.changed_keys(materialize(before, "digests_before"), materialize(now, "digests_now"), "order_id")


def q_upsert_idempotence(spark, d):
    """The merge protocol: load the first items, merge the whole table, merge it again."""
    soi = Star(spark, d).soi
    k = ["order_id", "order_item_id"]
    half = soi.filter(F.col("order_item_id") == 1)
    full = _bump(soi)
    once = merge.upsert(half, full, k)
    twice = merge.upsert(once, full, k)

    def stat(step, df):
        return df.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.sum("price").cast("decimal(38,2)").alias("total_price")).select(
            F.lit(step).alias("step"), "n_rows", "total_price")
    return stat("half", half).unionByName(stat("merge_1", once)).unionByName(stat("merge_2", twice))


def q_scd2_seed(spark, d):
    s = Star(spark, d)
    return gold.dim_customer_seed(s.sc, s.so)


SCD_MID_CUTOFF = "2000-01-01"


def _apply(dim, max_sk, incoming, check_cols, as_of):
    return scd.scd2_apply(dim, incoming, "customer_unique_id", check_cols, as_of, sk="customer_sk",
                          max_sk=max_sk, incoming_unique=True)     # profiles are grouped by person


def q_scd2_merge(spark, d):
    """Two successive loads: snapshot before 2000 applied on 2000-01-01, then all."""
    s = Star(spark, d)
    s._together("so", "sc")
    early, mid, full = gold.customer_profiles(s.sc, s.so, gold.SEED_CUTOFF, SCD_MID_CUTOFF)
    seed, seen = gold.stored_profile_seed(early)
    mid, full = mid.drop("first_order_date"), full.drop("first_order_date")
    one, seen = materialize_observed(_apply(seed, seen, mid, gold.CUSTOMER_ATTRS, SCD_MID_CUTOFF),
                                     "dim_customer_v1", max_sk=F.max("customer_sk"))
    two = _apply(one, seen["max_sk"] or 0, full, gold.CUSTOMER_ATTRS, gold.APPLY_AS_OF)
    return two.select(*gold.DIM_CUSTOMER_COLS)


def q_scd2_backdated(spark, d):
    """The loads of ``scd2_merge`` out of order: what was known before 2000 arrives after the full load of 2002."""
    s = Star(spark, d)
    s._together("so", "sc")
    early, mid, full = gold.customer_profiles(s.sc, s.so, gold.SEED_CUTOFF, SCD_MID_CUTOFF)
    seed, seen = gold.stored_profile_seed(early)
    dim, seen = materialize_observed(_apply(seed, seen, full.drop("first_order_date"), gold.CUSTOMER_ATTRS, gold.APPLY_AS_OF),
                                     "dim_customer_full", max_sk=F.max("customer_sk"))
    return scd.scd2_backdate(dim, mid, "customer_unique_id", gold.CUSTOMER_ATTRS, SCD_MID_CUTOFF, sk="customer_sk",
                             max_sk=seen["max_sk"]).select(*gold.DIM_CUSTOMER_COLS)


SNAPSHOT_CHECK_COLS = ["customer_zip_code_prefix", "customer_city", "customer_state"]


def q_snapshot_check(spark, d):
    s = Star(spark, d)
    seed, seen = gold.stored_seed(s.sc, s.so)
    full = gold.customer_profile(s.sc, s.so).drop("first_order_date")
    return scd.snapshot_check(seed, full, "customer_unique_id", SNAPSHOT_CHECK_COLS, gold.APPLY_AS_OF,
                              sk="customer_sk", max_sk=seen, incoming_unique=True).select(*gold.DIM_CUSTOMER_COLS)


# ---------------------------------------------------------------- 2.10 composite models

def q_silver_orders(spark, d):
    return silver.silver_orders(tb.bronze_orders(spark, d))


def q_silver_order_items(spark, d):
    return silver.silver_order_items(tb.bronze_order_items(spark, d), tb.ORDER_ITEM_TIE_BREAK)


def q_silver_customers(spark, d):
    return silver.silver_customers(tb.bronze_customers(spark, d))


def q_silver_products(spark, d):
    return Star(spark, d).sp


def q_silver_reviews(spark, d):
    return silver.silver_reviews(tb.bronze_reviews(spark, d))


def q_silver_reviews_clean(spark, d):
    """Silver reviews behind the quarantine: raw CSV -> clean rows -> latest per review."""
    clean, _ = files.quarantine_split(_review_csv(spark, d), [F.length("review_id") == tb.REVIEW_ID_LENGTH])
    return silver.silver_reviews(tb.reviews_of_csv(clean))


def q_payments_collapsed(spark, d):
    return silver.payments_collapsed(tb.bronze_payments(spark, d))


def q_payments_with_total(spark, d):
    return silver.payments_with_total(tb.bronze_payments(spark, d))


def q_dim_product(spark, d):
    return Star(spark, d).dimp


def q_dim_date(spark, d):
    return Star(spark, d).dimd


def q_dim_customer(spark, d):
    return Star(spark, d).dimc


def q_fact_sales(spark, d):
    return Star(spark, d).fact


def q_monthly_revenue(spark, d):
    s = Star(spark, d)
    return analytics.monthly_revenue(s.fact, s.dimd, DELIVERED)


def q_monthly_trend(spark, d):
    s = Star(spark, d)
    return analytics.monthly_revenue(s.fact, s.dimd, None)


def q_top_products(spark, d):
    s = Star(spark, d)
    return analytics.top_products(s.fact, s.dimp, DELIVERED, 10)


def q_cohort_retention(spark, d):
    s = Star(spark, d)
    return analytics.cohort_retention(s.fact, s.dimc, s.dimd, DELIVERED)


def q_cohort_state(spark, d):
    """Retention from a state of two overlapping loads, the later months first: most first months move with the second."""
    s = Star(spark, d)
    active = materialize(analytics.monthly_activity(s.fact, s.dimc, s.dimd, DELIVERED).select(
        F.col("customer_unique_id").alias("person"), F.col("activity_index").alias("month")), "cohort_load")
    state = cohorts.no_cohorts(spark)
    for load in (active.filter(F.col("month") >= 1995 * 12 + 7), active.filter(F.col("month") <= 1997 * 12 + 12)):
        state = cohorts.add_activity(state, load)
    return cohorts.retention(state)


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_") and callable(v)}
