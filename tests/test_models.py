import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordersmith.plans import dashboard, models
from ordersmith.plans.registry import Marts
from conftest import SF_SMALL, rows

T = dt.datetime
ITEMS = ("order_id string, order_item_id int, product_id string, seller_id string, "
         "shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)")
PAYS = ("order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(12,2)")


def fixture(spark):
    items = spark.createDataFrame([("A", 1, "p", "s1", None, None, None),
                                   ("A", 2, "p", "s1", None, None, None),
                                   ("A", 3, "p", "s2", None, None, None)], ITEMS)
    pays = spark.createDataFrame([("A", 1, "x", 1, Decimal("10.00")),
                                  ("A", 2, "x", 1, Decimal("5.00")),
                                  ("B", 1, "x", 1, Decimal("7.00"))], PAYS)
    sellers = spark.createDataFrame(
        [("s1", "1", "curitiba", "pr"), ("s2", "2", "manaus", "am"), ("s3", "3", "x", "sp")],
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string")
    raw_orders = spark.createDataFrame(
        [("A", "c1", "delivered", T(2017, 1, 1, 10), None, None, T(2017, 1, 3, 9), None,
          " são paulo ", "sp"),
         ("B", "c2", "shipped", T(2017, 1, 2, 10), None, None, None, None, "x", "rj")],
        "order_id string, customer_id string, order_status string, "
        "purchase_timestamp timestamp_ntz, approved_at timestamp_ntz, "
        "delivered_carrier_date timestamp_ntz, delivered_customer_date timestamp_ntz, "
        "estimated_delivery_date timestamp_ntz, customer_city string, customer_state string")
    return items, pays, sellers, raw_orders


def test_seller_revenue_fan_out(spark):
    items, pays, sellers, _ = fixture(spark)
    stg = models.stg_sellers(sellers, with_clock=False)
    for method in ("pre_aggregated", "fan_out"):
        d = models.dim_sellers(stg, items, pays, method)
        assert rows(d, "seller_id", "city", "state", "total_orders", "total_revenue") == [
            ("s1", "Curitiba", "PR", 1, Decimal("30.00")),
            ("s2", "Manaus", "AM", 1, Decimal("15.00")),
            ("s3", "X", "SP", 0, Decimal("0.00"))]


def test_fact_and_kpis(spark):
    items, pays, sellers, raw_orders = fixture(spark)
    stg_s = models.stg_sellers(sellers, with_clock=False)
    dim_c = models.dim_customers(models.stg_customers(raw_orders, with_clock=False))
    fact = models.fact_orders(models.stg_orders(raw_orders), stg_s, items, pays, dim_c,
                              with_clock=False)
    got = {r["order_id"]: r for r in fact.collect()}
    import hashlib
    assert got["A"]["seller_key"] == hashlib.md5(b"s1").hexdigest()
    assert got["A"]["payment_value"] == Decimal("15.00")
    assert got["A"]["delivery_days"] == 1 and got["A"]["is_delivered"] is True
    assert got["B"]["seller_key"] == "unknown" and got["B"]["payment_value"] == Decimal("7.00")
    assert got["B"]["customer_key"] == hashlib.md5(b"c2").hexdigest()
    k = dashboard.kpis(fact, "2017-01-01", "2017-01-31").first()
    assert (k["total_orders"], k["total_gmv"], k["active_sellers"]) == (2, 22.0, 2)
    assert k["avg_delivery_days"] == 1.0
    empty = dashboard.kpis(fact, "1990-01-01", "1990-01-31").first()
    assert tuple(empty) == (0, 0.0, 0.0, 0)
    daily = rows(models.agg_daily_gmv(fact))
    assert daily == [(dt.date(2017, 1, 1), 1, 15.0, 15.0, 1, 1.0),
                     (dt.date(2017, 1, 2), 1, 7.0, 7.0, 0, None)]


def test_stg_customers_normalise(spark):
    _, _, _, raw_orders = fixture(spark)
    c = models.stg_customers(raw_orders, with_clock=False)
    assert rows(c, "customer_id", "customer_city", "customer_state") == [
        ("c1", "São Paulo", "SP"), ("c2", "X", "RJ")]


def test_rewrites_equal_literal_forms(spark):
    """Revenue pre-aggregated = literal fan-out join; a fact with a repeated order counts
    it once."""
    m = Marts(spark, SF_SMALL)
    a = models.seller_metrics(m.raw_order_items(), m.raw_payments(), "pre_aggregated")
    b = models.seller_metrics(m.raw_order_items(), m.raw_payments(), "fan_out")
    assert rows(a) == rows(b.select(*a.columns))
    fact = m.fact_orders()
    x = models.agg_daily_gmv(fact, order_id_unique=True)
    y = models.agg_daily_gmv(fact)
    assert rows(x) == rows(y)
    twice = fact.unionByName(fact)
    assert rows(models.agg_daily_gmv(twice), "order_date", "total_orders") == \
        rows(y, "order_date", "total_orders")


def test_status_share(spark):
    dist = spark.createDataFrame([("delivered", 3), ("shipped", 1)],
                                 "order_status string, order_count long")
    out = rows(dashboard.order_status_share(dist), "order_status", "share", "percent")
    assert out == [("delivered", 0.75, 75.0), ("shipped", 0.25, 25.0)]


def test_hot_order_and_hot_seller(spark):
    """One order and one seller each hold a third of all items: the
    pre-aggregated revenue equals the literal fan-out join, and the fact keeps
    one row per order."""
    n = 30_000
    ids = spark.range(n)
    items = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") / 2).cast("long")
                                                              .cast("string")).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.lit("p").alias("product_id"),
        F.when(F.col("id") % 3 == 1, F.lit("s0"))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        F.lit(None).cast("decimal(12,2)").alias("price"),
        F.lit(None).cast("decimal(12,2)").alias("freight_value"))
    pays = spark.range(0, n, 7).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") / 2).cast("long")
                                                             .cast("string")).alias("order_id"),
        F.col("id").cast("int").alias("payment_sequential"),
        F.lit("x").alias("payment_type"), F.lit(1).alias("payment_installments"),
        (F.col("id") % 1000).cast("decimal(12,2)").alias("payment_value"))
    a = models.seller_metrics(items, pays, "pre_aggregated")
    b = models.seller_metrics(items, pays, "fan_out")
    assert rows(a) == rows(b.select(*a.columns))
    primary = models.order_primary_seller(items)
    assert primary.filter("order_id = 'hot'").first()["seller_id"] == "s0"
    assert primary.count() == items.select("order_id").distinct().count()
