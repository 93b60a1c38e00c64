"""Silver and gold models on small in-memory frames (edge cases of SURVEY §8)."""

import datetime as dt
from decimal import Decimal

from medallion_ops.plans import analytics, silver

T0 = dt.datetime(2024, 6, 1)
D1 = dt.datetime(2020, 1, 1)
D2 = dt.datetime(2020, 2, 1)

ORDERS = ("order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
          "order_total double, _load_timestamp timestamp_ntz, _source_file string")


def test_silver_orders_null_customer_on_newest_record_drops_the_order(spark):
    bronze = spark.createDataFrame([
        (1, 10, "F", D1, 5.0, T0, "f"), (1, None, "F", D2, 6.0, T0, "f"),   # newest has no customer
        (2, 20, "O", D1, 7.0, T0, "f"), (2, 21, "F", D2, 8.0, T0, "f"),
        (None, 30, "F", D1, 9.0, T0, "f")], ORDERS)
    got = {r.order_id: (r.customer_id, r.order_status) for r in silver.silver_orders(bronze).collect()}
    assert got == {2: (21, "F")}


def test_silver_order_items_casts_money_and_keeps_latest_ship(spark):
    schema = ("order_id long, order_item_id int, product_id long, seller_id long, shipping_limit_date timestamp_ntz, "
              "price double, freight_value double, l_discount double, l_tax double, l_returnflag string, "
              "l_linestatus string, _load_timestamp timestamp_ntz, _source_file string")
    bronze = spark.createDataFrame([
        (1, 1, 7, 8, D1, 10.005, 1.0, 0.0, 0.0, "N", "O", T0, "f"),
        (1, 1, 7, 8, D2, 12.345, 2.0, 0.0, 0.0, "N", "O", T0, "f")], schema)
    out = silver.silver_order_items(bronze, ["product_id"])
    r = out.collect()
    assert len(r) == 1 and r[0].price == Decimal("12.35") and r[0].freight_value == Decimal("2.00")
    assert dict(out.dtypes)["price"] == "decimal(10,2)"


def test_payments_collapsed_keeps_lowest_sequential_with_order_total(spark):
    schema = ("order_id long, payment_sequential long, payment_type string, payment_value double, "
              "payment_timestamp timestamp_ntz, _load_timestamp timestamp_ntz, _source_file string")
    bronze = spark.createDataFrame([
        (1, 3, "card", 10.111, D1, T0, "f"), (1, 2, "voucher", 5.0, D1, T0, "f"),
        (None, 1, "card", 1.0, D1, T0, "f")], schema)
    rows = silver.payments_collapsed(bronze).collect()
    assert [(r.order_id, r.payment_sequential, r.payment_type, r.payment_value) for r in rows] == \
        [(1, 2, "voucher", Decimal("15.11"))]


FACT = "order_id long, order_item_id int, price decimal(10,2), freight_value decimal(10,2), product_sk long, " \
       "order_status string, date_key int, customer_sk long"


def test_top_products_breaks_revenue_ties_by_key(spark):
    fact = spark.createDataFrame([
        (1, 1, Decimal("5.00"), Decimal("1.00"), 3, "F", 20200101, 1),
        (2, 1, Decimal("5.00"), Decimal("1.00"), 2, "F", 20200101, 1),
        (3, 1, Decimal("9.00"), Decimal("1.00"), 1, "O", 20200101, 1)], FACT)
    dim = spark.createDataFrame([(1, 100, "a"), (2, 200, "b"), (3, 300, "c")],
                                "product_sk long, product_id long, product_category_name string")
    got = [r.product_sk for r in analytics.top_products(fact, dim, "F", k=1).collect()]
    assert got == [2]                                    # tie at 5.00: lower key first; status O excluded


def test_monthly_revenue_excludes_freight_and_other_statuses(spark):
    fact = spark.createDataFrame([
        (1, 1, Decimal("5.00"), Decimal("100.00"), 1, "F", 20200105, 1),
        (2, 1, Decimal("7.00"), Decimal("100.00"), 1, "F", 20200220, 1),
        (3, 1, Decimal("9.00"), Decimal("100.00"), 1, "O", 20200220, 1),
        (4, 1, Decimal("1.00"), Decimal("100.00"), 1, "F", None, 1)], FACT)
    dates = spark.createDataFrame([(20200105, "2020-01"), (20200220, "2020-02")], "date_key int, year_month string")
    got = [(r.month, r.product_revenue) for r in analytics.monthly_revenue(fact, dates, "F").collect()]
    assert got == [("2020-01", Decimal("5.00")), ("2020-02", Decimal("7.00"))]
