"""DuckDB SQL for every registered key, written from the keys' specification.

Tables ``region nation customer supplier part orders lineitem events ...``
are views over the same Parquet files. Shared silver/gold relations are
CTEs composed by ``with_(...)``. Conventions that keep the two engines
comparable: NULLS FIRST/LAST spelled out, row numbers and counts BIGINT,
calendar parts INTEGER, money summed as DECIMAL and cast to DECIMAL(38,2).
"""

from __future__ import annotations

DELIVERED = "'F'"
LOAD_TS = "TIMESTAMP '2024-06-01 00:00:00'"

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, sql):
    CTE[name] = (deps, sql)


def with_(*names) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in CTE[n][0]:
            visit(dep)
        order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order) + "\n"


# ---------------------------------------------------------------- silver

cte("so", [], """
  SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_total FROM (
    SELECT o_orderkey AS order_id, o_orderkey AS customer_id, o_orderstatus AS order_status,
           o_orderdate AS order_purchase_timestamp, o_totalprice AS order_total,
           row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST,
             o_orderkey ASC NULLS LAST, o_orderstatus ASC NULLS LAST, o_totalprice ASC NULLS LAST) AS rn
    FROM orders) t
  WHERE rn = 1 AND order_id IS NOT NULL AND customer_id IS NOT NULL""")

LI_ORDER = """l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
  l_extendedprice DESC NULLS LAST, l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST,
  l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST"""

cte("soi", [], f"""
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
         CAST(price AS DECIMAL(10,2)) AS price, CAST(freight_value AS DECIMAL(10,2)) AS freight_value FROM (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
           l_quantity AS freight_value,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_ORDER}) AS rn
    FROM lineitem) t
  WHERE rn = 1 AND order_id IS NOT NULL AND order_item_id IS NOT NULL""")

cte("sc", [], """
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS LAST,
             customer_zip_code_prefix NULLS LAST, customer_city NULLS LAST, customer_state NULLS LAST) AS rn
    FROM (SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id,
                 lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
                 n.n_name AS customer_city, r.r_name AS customer_state
          FROM orders o
          LEFT JOIN customer c ON o.o_custkey = c.c_custkey
          LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
          LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) b) t
  WHERE rn = 1 AND customer_id IS NOT NULL""")

cte("sp", [], """
  SELECT product_id, product_category_name, product_name, product_brand, product_size, product_list_price FROM (
    SELECT p_partkey AS product_id, p_type AS product_category_name, p_name AS product_name,
           p_brand AS product_brand, p_size AS product_size, p_retailprice AS product_list_price,
           row_number() OVER (PARTITION BY p_partkey ORDER BY p_type NULLS LAST, p_name NULLS LAST,
             p_brand NULLS LAST, p_size NULLS LAST, p_retailprice NULLS LAST) AS rn
    FROM part) t
  WHERE rn = 1 AND product_id IS NOT NULL""")

# ---------------------------------------------------------------- gold

cte("dimp", ["sp"], """
  SELECT CAST(row_number() OVER (ORDER BY product_id NULLS FIRST) AS BIGINT) AS product_sk, *
  FROM sp""")

cte("bounds", ["soi", "so"], """
  SELECT min(d) AS min_date, max(d) AS max_date FROM (
    SELECT CAST(shipping_limit_date AS DATE) AS d FROM soi
    UNION ALL SELECT CAST(order_purchase_timestamp AS DATE) FROM so
    UNION ALL SELECT CAST(ts AS DATE) FROM events) u""")      # reviews: created and answered at the event's time

SPINE = """
  SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min_date) AS DATE),
              CAST(date_trunc('year', max_date) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE),
              INTERVAL 1 DAY)) AS DATE) AS date
  FROM {bounds}"""

cte("spine", ["bounds"], SPINE.format(bounds="bounds"))

DATE_ATTRS = """
    CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
    date,
    CAST(year(date) AS INTEGER) AS year,
    CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(month(date) AS INTEGER) AS month,
    strftime(date, '%B') AS month_name,
    CAST(day(date) AS INTEGER) AS day,
    CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
    strftime(date, '%A') AS day_name,
    CAST(dayofyear(date) AS INTEGER) AS day_of_year,
    CAST(weekofyear(date) AS INTEGER) AS week_of_year,
    dayofweek(date) IN (0, 6) AS is_weekend,
    strftime(date, '%Y-%m') AS year_month,
    'Q' || CAST(quarter(date) AS VARCHAR) AS quarter_name,
    CAST(date_trunc('month', date) AS DATE) AS first_day_of_month,
    last_day(date) AS last_day_of_month"""

cte("dimd", ["spine"], f"SELECT {DATE_ATTRS} FROM spine")

TIER = """CASE WHEN spend >= 2500000 THEN 'GOLD' WHEN spend >= 1000000 THEN 'SILVER' ELSE 'BRONZE' END"""


def profile_sql(before: str | None) -> str:
    """Per person: latest-order attributes, spend tier, first order day."""
    if before:
        j = f"""SELECT c.*, o.order_purchase_timestamp, o.order_total FROM sc c JOIN so o
                ON c.customer_id = o.customer_id WHERE o.order_purchase_timestamp < TIMESTAMP '{before}'"""
    else:
        j = """SELECT c.*, o.order_purchase_timestamp, o.order_total FROM sc c LEFT JOIN so o
               ON c.customer_id = o.customer_id"""
    return f"""
  SELECT l.customer_unique_id, l.customer_zip_code_prefix, l.customer_city, l.customer_state,
         {TIER} AS customer_tier, s.first_order_date
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
          ORDER BY order_purchase_timestamp DESC NULLS LAST, customer_id DESC NULLS LAST) AS rn
        FROM ({j}) j1) l
  JOIN (SELECT customer_unique_id, sum(CAST(order_total AS DECIMAL(18,2))) AS spend,
               CAST(min(order_purchase_timestamp) AS DATE) AS first_order_date
        FROM ({j}) j2 GROUP BY customer_unique_id) s
    ON l.customer_unique_id = s.customer_unique_id
  WHERE l.rn = 1"""


cte("prof_seed", ["sc", "so"], profile_sql("1998-01-01"))
cte("prof_mid", ["sc", "so"], profile_sql("2000-01-01"))
cte("prof_full", ["sc", "so"], profile_sql(None))

ATTRS = ["customer_zip_code_prefix", "customer_city", "customer_state", "customer_tier"]
A = ", ".join(ATTRS)

cte("dimc_seed", ["prof_seed"], f"""
  SELECT CAST(row_number() OVER (ORDER BY customer_unique_id NULLS FIRST) AS BIGINT) AS customer_sk,
         customer_unique_id, {A}, first_order_date AS effective_date,
         DATE '9999-12-31' AS end_date, true AS is_current
  FROM prof_seed""")


def scd2_apply_sql(dim: str, incoming: str, as_of: str, check_cols) -> str:
    """history + (current, expired when changed) + inserts(new, changed) with SKs after max."""
    changed = " OR ".join(f"i.{c} IS DISTINCT FROM c.{c}" for c in check_cols)
    return f"""
  SELECT * FROM (
    WITH cls AS (
      SELECT i.customer_unique_id, {", ".join("i." + a for a in ATTRS)},
             CASE WHEN c.customer_unique_id IS NULL THEN 'new'
                  WHEN {changed} THEN 'changed' ELSE 'same' END AS chg
      FROM {incoming} i
      LEFT JOIN (SELECT * FROM {dim} WHERE is_current) c ON i.customer_unique_id = c.customer_unique_id)
    SELECT customer_sk, customer_unique_id, {A}, effective_date, end_date, is_current
    FROM {dim} WHERE NOT is_current
    UNION ALL
    SELECT d.customer_sk, d.customer_unique_id, {", ".join("d." + a for a in ATTRS)}, d.effective_date,
           CASE WHEN x.k IS NOT NULL THEN DATE '{as_of}' ELSE d.end_date END,
           CASE WHEN x.k IS NOT NULL THEN false ELSE d.is_current END
    FROM (SELECT * FROM {dim} WHERE is_current) d
    LEFT JOIN (SELECT customer_unique_id AS k FROM cls WHERE chg = 'changed') x ON d.customer_unique_id = x.k
    UNION ALL
    SELECT CAST(coalesce((SELECT max(customer_sk) FROM {dim}), 0)
                + row_number() OVER (ORDER BY customer_unique_id NULLS FIRST) AS BIGINT),
           customer_unique_id, {A}, DATE '{as_of}', DATE '9999-12-31', true
    FROM cls WHERE chg <> 'same') u"""


cte("dimc_all", ["prof_full"], CTE["dimc_seed"][1].replace("prof_seed", "prof_full"))
cte("dimc", ["dimc_seed", "prof_full"], scd2_apply_sql("dimc_seed", "prof_full", "2002-01-01", ATTRS))
cte("dimc_mid", ["dimc_seed", "prof_mid"], scd2_apply_sql("dimc_seed", "prof_mid", "2000-01-01", ATTRS))
cte("dimc_two", ["dimc_mid", "prof_full"], scd2_apply_sql("dimc_mid", "prof_full", "2002-01-01", ATTRS))
cte("dimc_snap", ["dimc_seed", "prof_full"], scd2_apply_sql(
    "dimc_seed", "prof_full", "2002-01-01", ATTRS[:3]))

cte("ctx", ["so", "sc", "dimd", "dimc"], """
  SELECT o.order_id, o.order_status, d.date_key, dc.customer_sk
  FROM so o
  LEFT JOIN sc c ON o.customer_id = c.customer_id
  LEFT JOIN dimd d ON CAST(o.order_purchase_timestamp AS DATE) = d.date
  LEFT JOIN (SELECT customer_unique_id, customer_sk FROM dimc WHERE is_current) dc
    ON c.customer_unique_id = dc.customer_unique_id""")

cte("fact", ["soi", "dimp", "ctx"], """
  SELECT i.order_id, i.order_item_id, i.price, i.freight_value, p.product_sk,
         x.order_status, x.date_key, x.customer_sk
  FROM soi i
  LEFT JOIN dimp p ON i.product_id = p.product_id
  LEFT JOIN ctx x ON i.order_id = x.order_id""")

cte("orders_people", ["so", "sc"], """
  SELECT o.order_id, CAST(o.order_purchase_timestamp AS DATE) AS order_date, c.customer_unique_id
  FROM so o LEFT JOIN sc c ON o.customer_id = c.customer_id""")

# ---------------------------------------------------------------- the keys

ITEMS = """(SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
            l_extendedprice AS price FROM lineitem)"""
DELIV = f"""(SELECT o_orderkey AS order_id, o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp
            FROM orders WHERE o_orderstatus = {DELIVERED})"""

REVIEW_CSV = """(SELECT CASE WHEN event_type = 'view' THEN substr(md5(rid), 1, 16) ELSE md5(rid) END AS review_id,
           user_id AS order_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value / 100) AS INTEGER) END AS review_score,
           event_type || chr(10) || props AS review_comment_message,
           CAST(date_trunc('second', ts) AS TIMESTAMP) AS review_answer_timestamp,
           event_type = 'error' AS is_corrupt
    FROM (SELECT *, concat_ws('|', CAST(user_id AS VARCHAR), event_type, CAST(event_id AS VARCHAR)) AS rid
          FROM events) e)"""

ORACLE: dict[str, str] = {
    # 2.1
    "table_scan": "SELECT * FROM orders",
    "limit_preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "overwrite_roundtrip": "SELECT * FROM orders",
    "csv_scan": "SELECT * FROM part",
    "csv_permissive_scan": f"SELECT * FROM {REVIEW_CSV} r",
    "quarantine_split": f"""
        SELECT review_id, order_id, review_score, review_comment_message, review_answer_timestamp,
               (is_corrupt OR review_id IS NULL OR length(review_id) <> 32) AS quarantined
        FROM {REVIEW_CSV} r""",
    "bronze_ingest": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS as_written FROM {t}"
        for t in "region nation supplier customer part orders lineitem events".split()),
    "csv_scan_inferred": "SELECT * FROM part",
    "lineage_columns": f"""SELECT o_orderkey, o_orderstatus, {LOAD_TS} AS _load_timestamp, 'orders' AS _source_table
                           FROM orders""",
    "schema_describe": """
        SELECT d.column_name AS col_name,
               CASE d.column_type WHEN 'VARCHAR' THEN 'STRING' WHEN 'INTEGER' THEN 'INT'
                    WHEN 'TIMESTAMP' THEN 'TIMESTAMP_NTZ' ELSE d.column_type END AS data_type, c.non_null
        FROM (DESCRIBE lineitem) d
        JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM lineitem) ON COLUMNS(*) INTO NAME n VALUE non_null) c
          ON c.n = d.column_name""",
    "typed_table_identity": """
        SELECT CAST(row_number() OVER (ORDER BY c_custkey NULLS FIRST) AS BIGINT) AS customer_sk, c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
               CAST(NULL AS BOOLEAN) AS is_current
        FROM customer""",
    "view_over_table": "SELECT c_nationkey, count(*) AS n_people FROM customer GROUP BY c_nationkey",
    "inline_relation": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END
               AS status FROM orders""",
    "schema_conform": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
               CAST(NULL AS BOOLEAN) AS is_current
        FROM customer""",
    "sql_over_view": """
        SELECT l_returnflag, l_linestatus, count(*) AS n_items,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    # 2.2
    "project_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
    "drop_columns": """SELECT l_orderkey, l_linenumber, l_extendedprice, p_type
                       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "derive_columns": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
               strftime(o_orderdate, '%Y-%m') AS year_month,
               dayofweek(o_orderdate) IN (0, 6) AS is_weekend
        FROM orders""",
    "literal_columns": """SELECT c_custkey, true AS is_current, CAST(NULL AS VARCHAR) AS merge_key,
                          DATE '9999-12-31' AS end_date FROM customer""",
    "cast_types": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_key
        FROM lineitem""",
    "filter_eq": f"SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = {DELIVERED}",
    "filter_ne": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_linenumber <> 1",
    "filter_not_null": """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
                          WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL""",
    "filter_or": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'P'",
    "filter_in_list": "SELECT o_orderkey, o_orderdate FROM orders WHERE dayofweek(o_orderdate) IN (0, 6)",
    "select_distinct": "SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders",
    "partition_by_predicate": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, 'first' AS part_name FROM lineitem WHERE l_linenumber = 1
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_extendedprice, 'rest' FROM lineitem WHERE l_linenumber <> 1""",
    "dq_unique_flag": """
        SELECT 'part' AS table_name, count(*) = count(DISTINCT p_partkey) AS is_unique FROM part
        UNION ALL
        SELECT 'lineitem', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
    # 2.3
    "left_join_using": f"""
        SELECT i.*, p.p_type AS product_category_name FROM {ITEMS} i
        LEFT JOIN part p ON i.product_id = p.p_partkey""",
    "left_join_on": """
        SELECT c_custkey, c_nationkey, event_id, event_type FROM customer LEFT JOIN events ON c_custkey = user_id""",
    "star_join_inner": f"""
        SELECT i.order_id, i.order_item_id, i.product_id, p.p_type, o.order_status, i.price
        FROM {ITEMS} i JOIN {DELIV} o ON i.order_id = o.order_id JOIN part p ON i.product_id = p.p_partkey""",
    "orphan_anti_join": """
        SELECT c_custkey AS user_id, c_nationkey FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
    "row_number_join": """
        SELECT a.rn, a.o_orderkey, a.o_custkey, b.p_partkey, b.p_type
        FROM (SELECT CAST(row_number() OVER (ORDER BY o_orderkey NULLS FIRST) AS BIGINT) AS rn, o_orderkey, o_custkey
              FROM orders) a
        LEFT JOIN (SELECT CAST(row_number() OVER (ORDER BY p_partkey NULLS FIRST) AS BIGINT) AS rn, p_partkey, p_type
                   FROM part) b ON a.rn = b.rn""",
    "fact_bridge_join": with_("soi", "so", "sc", "dimc") + """
        SELECT i.order_id, i.order_item_id, o.customer_id, c.customer_unique_id, dc.customer_sk
        FROM soi i
        LEFT JOIN so o ON i.order_id = o.order_id
        LEFT JOIN sc c ON o.customer_id = c.customer_id
        LEFT JOIN (SELECT customer_unique_id, customer_sk FROM dimc WHERE is_current) dc
          ON c.customer_unique_id = dc.customer_unique_id""",
    "scd2_current_lookup": with_("orders_people", "dimc") + """
        SELECT op.order_id, op.customer_unique_id, dc.customer_sk FROM orders_people op
        LEFT JOIN (SELECT customer_unique_id, customer_sk FROM dimc WHERE is_current) dc
          ON op.customer_unique_id = dc.customer_unique_id""",
    "scd2_point_in_time": with_("orders_people", "dimc") + """
        SELECT op.order_id, op.order_date, op.customer_unique_id, dc.customer_sk FROM orders_people op
        LEFT JOIN dimc dc ON op.customer_unique_id = dc.customer_unique_id
          AND op.order_date >= dc.effective_date AND op.order_date < dc.end_date""",
    # 2.4
    "agg_count": "SELECT count(*) AS n_rows FROM lineitem",
    "agg_count_distinct": "SELECT count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers FROM orders",
    "group_count": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus",
    "group_count_sorted": """SELECT l_orderkey, count(l_linenumber) AS item_count FROM lineitem
                             GROUP BY l_orderkey ORDER BY item_count DESC, l_orderkey""",
    "group_sum": """SELECT l_partkey, count(*) AS units_sold,
                           CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS revenue
                    FROM lineitem GROUP BY l_partkey""",
    "group_count_distinct": """SELECT strftime(o_orderdate, '%Y-%m') AS year_month,
                                      count(DISTINCT o_custkey) AS active_customers
                               FROM orders GROUP BY 1""",
    "date_bounds": """
        SELECT min(d) AS min_date, max(d) AS max_date FROM (
          SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL
          SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION ALL
          SELECT CAST(ts AS DATE) FROM events) u""",
    "having_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
                            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "null_fk_audit": with_("fact") + """
        SELECT count(*) FILTER (WHERE product_sk IS NULL) AS null_prod,
               count(*) FILTER (WHERE customer_sk IS NULL) AS null_cust,
               count(*) FILTER (WHERE date_key IS NULL) AS null_date FROM fact""",
    "row_preserving_fact": with_("soi", "fact") + """
        SELECT (SELECT count(*) FROM soi) AS rows_in, (SELECT count(*) FROM fact) AS rows_out,
               (SELECT count(*) FROM soi) = (SELECT count(*) FROM fact) AS passed""",
    "first_row": "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1",
    "filter_sql_string": """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
                            WHERE l_quantity >= 25 AND l_returnflag <> 'N'""",
    "column_lists_equal": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS candidate, {e} AS equal, count(*) AS n_rows FROM {t}"
        for t in ("orders", "lineitem", "part") for c, e in (("same", "true"), ("fewer", "false"))),
    "dq_unique_key": with_("soi") + """
        SELECT 'bronze_order_items' AS table_name, 'unique(order_id,order_item_id)' AS check_name,
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS failures,
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) = 0 AS passed
        FROM lineitem
        UNION ALL
        SELECT 'silver_order_items', 'unique(order_id,order_item_id)',
               count(*) - count(DISTINCT (order_id, order_item_id)),
               count(*) - count(DISTINCT (order_id, order_item_id)) = 0
        FROM soi""",
    "dq_not_null": with_("so", "soi") + """
        SELECT 'silver_orders' AS table_name, 'not_null(order_id)' AS check_name,
               count(*) FILTER (WHERE order_id IS NULL) AS failures,
               count(*) FILTER (WHERE order_id IS NULL) = 0 AS passed FROM so
        UNION ALL SELECT 'silver_orders', 'not_null(customer_id)', count(*) FILTER (WHERE customer_id IS NULL),
               count(*) FILTER (WHERE customer_id IS NULL) = 0 FROM so
        UNION ALL SELECT 'silver_order_items', 'not_null(order_id)', count(*) FILTER (WHERE order_id IS NULL),
               count(*) FILTER (WHERE order_id IS NULL) = 0 FROM soi
        UNION ALL SELECT 'silver_order_items', 'not_null(order_item_id)',
               count(*) FILTER (WHERE order_item_id IS NULL),
               count(*) FILTER (WHERE order_item_id IS NULL) = 0 FROM soi""",
    "dq_report": with_("so", "soi") + """
        SELECT 'silver_orders' AS table_name, 'not_empty' AS check_name,
               CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failures, count(*) > 0 AS passed FROM so
        UNION ALL SELECT 'silver_orders', 'unique(order_id)', count(*) - count(DISTINCT order_id),
               count(*) = count(DISTINCT order_id) FROM so
        UNION ALL SELECT 'silver_orders', 'not_null(order_id)', count(*) FILTER (WHERE order_id IS NULL),
               count(*) FILTER (WHERE order_id IS NULL) = 0 FROM so
        UNION ALL SELECT 'silver_order_items', 'not_empty', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT),
               count(*) > 0 FROM soi
        UNION ALL SELECT 'silver_order_items', 'unique(order_id,order_item_id)',
               count(*) - count(DISTINCT (order_id, order_item_id)),
               count(*) = count(DISTINCT (order_id, order_item_id)) FROM soi
        UNION ALL SELECT 'silver_order_items', 'not_null(order_id)', count(*) FILTER (WHERE order_id IS NULL),
               count(*) FILTER (WHERE order_id IS NULL) = 0 FROM soi
        UNION ALL SELECT 'silver_order_items', 'orphans(order_id->silver_orders)', count(*), count(*) = 0
        FROM soi WHERE NOT EXISTS (SELECT 1 FROM so WHERE so.order_id = soi.order_id)""",
    "scd2_current_unique": with_("dimc") + """
        SELECT count(*) AS keys_with_current, CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT)
               AS keys_with_several
        FROM (SELECT customer_unique_id, count(*) AS n FROM dimc WHERE is_current GROUP BY customer_unique_id) g""",
    # 2.5
    "dedup_latest": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                         ORDER BY {LI_ORDER}) AS rn FROM lineitem) t WHERE rn = 1""",
    "dedup_any": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                     ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
                     l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST, l_returnflag NULLS LAST,
                     l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS rn FROM lineitem) t WHERE rn = 1""",
    "latest_per_entity": with_("sc", "so") + """
        SELECT customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
        FROM sc LEFT JOIN so ON sc.customer_id = so.customer_id
        QUALIFY row_number() OVER (PARTITION BY customer_unique_id
          ORDER BY order_purchase_timestamp DESC NULLS LAST, sc.customer_id DESC NULLS LAST) = 1""",
    "dense_surrogate_key": """
        SELECT CAST(row_number() OVER (ORDER BY p_name NULLS FIRST, p_partkey NULLS FIRST) AS BIGINT) AS part_sk,
               p_partkey, p_name, p_type FROM part""",
    "window_sum": """SELECT event_id, user_id, value,
                            CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id) AS DECIMAL(38,2)) AS user_total
                     FROM events""",
    "window_min": """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
                            min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS first_order_date
                     FROM orders""",
    "window_ratio_to_max": """
        SELECT o_orderstatus, year_month, n_orders,
               round(100.0 * (CAST(n_orders AS DOUBLE) / CAST(max(n_orders) OVER (PARTITION BY o_orderstatus) AS DOUBLE)), 5)
                 AS share_of_peak
        FROM (SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS n_orders
              FROM orders GROUP BY 1, 2) g""",
    # 2.6 / 2.7
    "union_by_name": """
        SELECT c_custkey, c_mktsegment, c_custkey AS merge_key FROM customer
        UNION ALL BY NAME
        SELECT CAST(NULL AS BIGINT) AS merge_key, c_mktsegment, c_custkey FROM customer""",
    "union_all": """SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL
                    SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION ALL
                    SELECT CAST(ts AS DATE) FROM events""",
    # 2.8
    "fn_date_parts": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(day(o_orderdate) AS INTEGER) AS day, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
               CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
               CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year
        FROM orders""",
    "fn_date_format": """
        SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
               strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%B') AS month_name,
               strftime(o_orderdate, '%A') AS day_name, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_name
        FROM orders""",
    "fn_date_trunc": """
        SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day_of_month,
               CAST(date_trunc('year', o_orderdate) AS DATE) AS first_day_of_year,
               last_day(CAST(o_orderdate AS DATE)) AS last_day_of_month,
               CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS last_day_of_year
        FROM orders""",
    "fn_month_index": """
        SELECT o_orderkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month_index,
               CAST(year(o_orderdate) * 12 + month(o_orderdate) - (1995 * 12 + 1) AS INTEGER) AS months_since_1995,
               100 * (month(o_orderdate) / 12) AS pct_of_year
        FROM orders""",
    "date_spine": SPINE.format(bounds="""(SELECT min(d) AS min_date, max(d) AS max_date FROM (
          SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL
          SELECT CAST(l_shipdate AS DATE) FROM lineitem) u) b"""),
    # 2.9
    "upsert_merge": with_("soi") + """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
               CAST(price + 1 AS DECIMAL(10,2)) AS price, freight_value
        FROM soi WHERE order_item_id >= 3
        UNION ALL
        SELECT * FROM soi t WHERE order_item_id <= 4 AND NOT EXISTS (
          SELECT 1 FROM soi s WHERE s.order_item_id >= 3
            AND s.order_id = t.order_id AND s.order_item_id = t.order_item_id)""",
    "upsert_partitioned": with_("soi") + """
        , moved AS (SELECT order_id, order_item_id, price, shipping_limit_date + INTERVAL 40 DAY AS shipping_limit_date
                    FROM soi WHERE order_item_id >= 3),
        kept AS (SELECT order_id, order_item_id, price, shipping_limit_date FROM soi WHERE order_item_id < 3)
        SELECT order_id, order_item_id, price, CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
               CAST(strftime(shipping_limit_date, '%Y%m') AS INTEGER) AS ship_month
        FROM (SELECT * FROM moved UNION ALL SELECT * FROM kept) a""",
    "upsert_idempotence": with_("soi") + """
        SELECT 'half' AS step, count(*) AS n_rows, CAST(sum(price) AS DECIMAL(38,2)) AS total_price
        FROM soi WHERE order_item_id = 1
        UNION ALL SELECT 'merge_1', count(*), CAST(sum(price + 1) AS DECIMAL(38,2)) FROM soi
        UNION ALL SELECT 'merge_2', count(*), CAST(sum(price + 1) AS DECIMAL(38,2)) FROM soi""",
    "scd2_seed": with_("dimc_all") + f"""
        SELECT customer_sk, customer_unique_id, {A}, effective_date, end_date, is_current FROM dimc_all""",
    "scd2_merge": with_("dimc_two") + "SELECT * FROM dimc_two",
    "snapshot_check": with_("dimc_snap") + "SELECT * FROM dimc_snap",
    # 2.10
    "silver_orders": with_("so") + "SELECT * FROM so",
    "silver_order_items": with_("soi") + "SELECT * FROM soi",
    "silver_customers": with_("sc") + "SELECT * FROM sc",
    "silver_products": with_("sp") + "SELECT * FROM sp",
    "silver_reviews": """
        SELECT review_id, order_id, review_score, review_comment_message, review_creation_date,
               review_answer_timestamp FROM (
          SELECT concat_ws('-', CAST(user_id AS VARCHAR), event_type) AS review_id, user_id AS order_id,
                 value AS review_score, props AS review_comment_message, ts AS review_creation_date,
                 ts AS review_answer_timestamp,
                 row_number() OVER (PARTITION BY concat_ws('-', CAST(user_id AS VARCHAR), event_type)
                   ORDER BY ts DESC NULLS LAST, ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
          FROM events) t
        WHERE rn = 1 AND review_id IS NOT NULL""",
    "silver_reviews_clean": f"""
        SELECT review_id, order_id, review_score, review_comment_message,
               review_answer_timestamp AS review_creation_date, review_answer_timestamp
        FROM {REVIEW_CSV} r WHERE NOT is_corrupt AND length(review_id) = 32
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_answer_timestamp DESC NULLS LAST,
          review_comment_message DESC NULLS LAST) = 1""",
    "payments_collapsed": """
        SELECT order_id, arg_max(payment_sequential, -payment_sequential) AS payment_sequential,
               arg_max(payment_type, -payment_sequential) AS payment_type,
               CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS payment_value
        FROM (SELECT user_id AS order_id, event_id AS payment_sequential, event_type AS payment_type,
                     value AS payment_value FROM events WHERE event_type = 'purchase') p
        WHERE order_id IS NOT NULL GROUP BY order_id""",
    "payments_with_total": """
        SELECT order_id, payment_sequential, payment_type, payment_value,
               CAST(sum(CAST(payment_value AS DECIMAL(18,2))) OVER (PARTITION BY order_id) AS DECIMAL(38,2))
                 AS order_total_payment
        FROM (SELECT user_id AS order_id, event_id AS payment_sequential, event_type AS payment_type,
                     value AS payment_value FROM events WHERE event_type = 'purchase') p
        WHERE order_id IS NOT NULL""",
    "dim_product": with_("dimp") + "SELECT * FROM dimp",
    "dim_date": with_("dimd") + "SELECT * FROM dimd",
    "dim_customer": with_("dimc") + "SELECT * FROM dimc",
    "fact_sales": with_("fact") + "SELECT * FROM fact",
    "monthly_revenue": with_("fact", "dimd") + f"""
        SELECT d.year_month AS month, CAST(sum(f.price) AS DECIMAL(38,2)) AS product_revenue
        FROM fact f JOIN dimd d ON f.date_key = d.date_key
        WHERE f.order_status = {DELIVERED}
        GROUP BY d.year_month ORDER BY d.year_month""",
    "monthly_trend": with_("fact", "dimd") + """
        SELECT d.year_month AS month, CAST(sum(f.price) AS DECIMAL(38,2)) AS product_revenue
        FROM fact f JOIN dimd d ON f.date_key = d.date_key
        GROUP BY d.year_month ORDER BY d.year_month""",
    "top_products": with_("fact", "dimp") + f"""
        SELECT product_sk, product_id, product_category_name, units_sold, product_revenue
        FROM (SELECT product_sk, count(*) AS units_sold, CAST(sum(price) AS DECIMAL(38,2)) AS product_revenue,
                     row_number() OVER (ORDER BY sum(price) DESC, product_sk) AS place
              FROM fact WHERE order_status = {DELIVERED} AND product_sk IS NOT NULL GROUP BY product_sk) ranked
        JOIN dimp USING (product_sk)
        WHERE place <= 10""",
    # a person's first month first, then each later month's distance from it, counted per first month
    "cohort_retention": with_("fact", "dimc", "dimd") + f""",
        person_months AS (
          SELECT customer_unique_id AS person, year_month, year * 12 + month AS m
          FROM fact JOIN dimc USING (customer_sk) JOIN dimd USING (date_key)
          WHERE order_status = {DELIVERED} GROUP BY ALL),
        starts AS (SELECT person, min(m) AS m0, min(year_month) AS cohort_month FROM person_months GROUP BY person),
        sizes AS (
          SELECT cohort_month, CAST(m - m0 AS INTEGER) AS month_offset, count(*) AS active_customers
          FROM person_months JOIN starts USING (person) GROUP BY ALL),
        peaks AS (SELECT cohort_month, max(active_customers) AS peak FROM sizes GROUP BY cohort_month)
        SELECT cohort_month, month_offset, active_customers, round(100 * (active_customers / peak), 5) AS retention_rate
        FROM sizes JOIN peaks USING (cohort_month)""",
    "csv_split_scan": f"SELECT * FROM {REVIEW_CSV} r",
    # a number is given when a key is first loaded, in key order within the load, and never again
    "key_registry": """
        SELECT row_number() OVER (ORDER BY CASE WHEN p_size <= 30 THEN 1 WHEN p_size <= 40 THEN 2 ELSE 3 END, p_partkey) AS product_sk,
               p_partkey AS product_id, p_name, p_size, CASE WHEN p_size <= 15 OR p_size > 40 THEN 3 ELSE 2 END AS last_load
        FROM part""",
    "key_registry_nulls": """
        SELECT row_number() OVER (ORDER BY min(CASE WHEN p_size <= 20 THEN 1 WHEN p_size <= 35 THEN 2 ELSE 3 END),
                                           p_brand NULLS FIRST, nullif(p_size, 10) NULLS FIRST) AS brand_sk,
               p_brand, nullif(p_size, 10) AS size, 3 AS last_load
        FROM part GROUP BY p_brand, nullif(p_size, 10)""",
    "merge_follow_source": with_("so", "soi") + """
        SELECT order_id, order_item_id, CAST(CASE WHEN in_source THEN price + 1 ELSE price END AS DECIMAL(10,2)) AS price,
               freight_value, ship_month
        FROM (SELECT i.order_id, i.order_item_id, i.price, i.freight_value, o.order_status,
                     CAST(strftime(i.shipping_limit_date, '%Y%m') AS INTEGER) AS ship_month,
                     i.freight_value >= 10 AND i.shipping_limit_date >= DATE '1993-01-01' AS in_source
              FROM soi i LEFT JOIN so o USING (order_id)) x
        WHERE in_source OR coalesce(order_status, 'P') = 'P'""",
    "merge_changes": with_("so", "soi") + """
        SELECT CASE WHEN in_source AND NOT in_target THEN 'insert'
                    WHEN in_source AND freight_value >= 40 THEN 'update'
                    WHEN in_source THEN 'same'
                    WHEN coalesce(order_status, 'P') <> 'P' THEN 'delete' ELSE 'keep' END AS action,
               order_id, order_item_id,
               CAST(CASE WHEN in_source AND freight_value >= 40 THEN price + 1 ELSE price END AS DECIMAL(10,2)) AS price,
               freight_value
        FROM (SELECT i.*, o.order_status, i.freight_value >= 10 AS in_source, i.order_item_id <= 4 AS in_target
              FROM soi i LEFT JOIN so o USING (order_id)) x
        WHERE in_source OR in_target""",
    "order_digest_changes": with_("so", "soi") + """,
        early AS (SELECT * FROM so WHERE order_purchase_timestamp < TIMESTAMP '1998-01-01'),
        old_items AS (
          SELECT order_id, list((order_item_id, price, freight_value) ORDER BY order_item_id) AS items
          FROM soi SEMI JOIN early USING (order_id) GROUP BY order_id),
        new_items AS (
          SELECT order_id, list((order_item_id, CAST(CASE WHEN freight_value > 48 THEN price + 1 ELSE price END AS DECIMAL(10,2)),
                                 freight_value) ORDER BY order_item_id) AS items
          FROM soi WHERE freight_value >= 3 GROUP BY order_id),
        a AS (SELECT order_id, o.order_status AS status, o.order_purchase_timestamp AS ts, i.items, true AS there
              FROM early o FULL JOIN old_items i USING (order_id)),
        b AS (SELECT order_id, CASE WHEN o.order_status = 'P' THEN 'F' ELSE o.order_status END AS status,
                     o.order_purchase_timestamp AS ts, i.items, true AS there
              FROM so o FULL JOIN new_items i USING (order_id))
        SELECT order_id, CASE WHEN a.there IS NULL THEN 'new' WHEN b.there IS NULL THEN 'gone' ELSE 'changed' END AS change
        FROM a FULL JOIN b USING (order_id)
        WHERE a.there IS NULL OR b.there IS NULL OR a.status IS DISTINCT FROM b.status OR a.ts IS DISTINCT FROM b.ts
           OR a.items IS DISTINCT FROM b.items""",
    "distinct_bitmaps": """
        SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(DISTINCT o_custkey) AS active_customers FROM orders GROUP BY 1
        UNION ALL SELECT 'all', count(DISTINCT o_custkey) FROM orders""",
    "distinct_bitmaps_dense": "SELECT p_type, count(DISTINCT (p_brand, p_size)) AS n_pairs FROM part GROUP BY p_type",
    "dq_incremental": """
        SELECT 'bronze_order_items' AS table_name, 'not_empty' AS check_name,
               CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failures, count(*) > 0 AS passed FROM lineitem
        UNION ALL SELECT 'bronze_order_items', 'unique(order_id,order_item_id)',
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)), count(*) = count(DISTINCT (l_orderkey, l_linenumber))
        FROM lineitem
        UNION ALL SELECT 'bronze_order_items', 'not_null(order_id)', count(*) FILTER (WHERE l_orderkey IS NULL),
               count(*) FILTER (WHERE l_orderkey IS NULL) = 0 FROM lineitem
        UNION ALL SELECT 'bronze_order_items', 'not_null(order_item_id)', count(*) FILTER (WHERE l_linenumber IS NULL),
               count(*) FILTER (WHERE l_linenumber IS NULL) = 0 FROM lineitem""",
    # the state of 2000 beside the versions of the other loads; a late row that says what held anyway is none
    "scd2_backdated": with_("dimc", "prof_mid") + f""",
        stated AS (
          SELECT customer_sk, customer_unique_id, {A}, effective_date FROM dimc
          UNION ALL
          SELECT NULL, customer_unique_id, {A}, DATE '2000-01-01' FROM prof_mid),
        compared AS (
          SELECT *, ({A}) AS says, lag(({A})) OVER (PARTITION BY customer_unique_id ORDER BY effective_date, customer_sk NULLS LAST) AS held,
                 count(*) FILTER (WHERE customer_sk IS NOT NULL AND effective_date = DATE '2000-01-01')
                   OVER (PARTITION BY customer_unique_id) AS same_day
          FROM stated),
        versions AS (
          SELECT * FROM compared
          WHERE customer_sk IS NOT NULL OR (same_day = 0 AND (held IS NULL OR says IS DISTINCT FROM held)))
        SELECT coalesce(customer_sk, CAST((SELECT max(customer_sk) FROM dimc)
                 + row_number() OVER (PARTITION BY customer_sk IS NULL ORDER BY customer_unique_id, effective_date) AS BIGINT)) AS customer_sk,
               customer_unique_id, {A}, effective_date,
               coalesce(lead(effective_date) OVER w, DATE '9999-12-31') AS end_date, lead(effective_date) OVER w IS NULL AS is_current
        FROM versions WINDOW w AS (PARTITION BY customer_unique_id ORDER BY effective_date)""",
}
ORACLE["cohort_state"] = ORACLE["cohort_retention"]
