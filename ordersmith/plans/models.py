"""Staging models and marts (B5 B6): the star schema as DataFrame functions.

Shuffles per mart, at any scale:
* ``fact_orders``: line items reduced to one (order, primary seller) row and
  payments to one total per order *before* any join (partial aggregation on the
  map side); the narrow (order, seller) pairs meet the sellers on ``seller_id``; order
  rows meet the customers on ``customer_id`` and then every order-level side on
  ``order_id``, so they are shuffled twice. (Joining narrow (order, customer) pairs
  instead reads the orders once more and was slower at every size tried.)
* ``dim_sellers``: the revenue fan-out is computed from per-(seller, order) item
  counts and per-order payment totals (the algebraic form of the literal
  items x payments join), never materialising the fan-out.
* ``agg_daily_gmv``: one aggregation by day with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_avg_money, round_avg_whole
from ..functions.text import normalize_city, normalize_state, surrogate_key
from ..functions.timestamps import to_ts, whole_days_between
from ..operators.dedup import distinct_on
from ..operators.lookup import enrich_skewed
from ..schemas import UNKNOWN_SELLER, VALID_ORDER_STATUSES

STG_ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "customer_city", "customer_state",
]
FACT_COLUMNS = [
    "order_id", "customer_key", "seller_key", "payment_value", "order_status",
    "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date",
    "order_estimated_delivery_date", "delivery_days", "is_delivered", "customer_state",
]


def _opt(df: DataFrame, c: str):
    return F.col(c) if c in df.columns else F.lit(None).cast("timestamp_ntz")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Rename + cast, keep valid statuses, add delivery days."""
    o = raw_orders.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
                          & F.col("order_status").isin(*VALID_ORDER_STATUSES))
    renamed = o.select(
        "order_id", "customer_id", "order_status",
        to_ts("purchase_timestamp").alias("order_purchase_timestamp"),
        to_ts("approved_at").alias("order_approved_at"),
        to_ts("delivered_carrier_date").alias("order_delivered_carrier_date"),
        to_ts("delivered_customer_date").alias("order_delivered_customer_date"),
        to_ts("estimated_delivery_date").alias("order_estimated_delivery_date"),
        "customer_city", "customer_state", _opt(raw_orders, "ingested_at").alias("ingested_at"))
    return renamed.withColumn("delivery_days", whole_days_between(
        "order_delivered_customer_date", "order_purchase_timestamp"))


def stg_customers(raw_orders: DataFrame, with_clock: bool = True) -> DataFrame:
    """Customers seen in orders (any status), one per id: the
    smallest normalised city first (nulls last), then the state."""
    src = raw_orders.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", normalize_city("customer_city").alias("customer_city"),
        normalize_state("customer_state").alias("customer_state"))
    one = distinct_on(src, ["customer_id"], [F.col("customer_city").asc_nulls_last(),
                                             F.col("customer_state").asc_nulls_last()])
    out = one.select(surrogate_key("customer_id").alias("customer_key"), "customer_id",
                     "customer_city", "customer_state")
    return out.withColumn("dbt_updated_at", F.current_timestamp()) if with_clock else out


def stg_sellers(raw_sellers: DataFrame, with_clock: bool = True) -> DataFrame:
    """One row per seller (ties broken by all columns)."""
    src = raw_sellers.filter(F.col("seller_id").isNotNull()).select(
        "seller_id", "seller_zip_code_prefix",
        normalize_city("seller_city").alias("seller_city"),
        normalize_state("seller_state").alias("seller_state"))
    one = distinct_on(src, ["seller_id"])
    out = one.select(surrogate_key("seller_id").alias("seller_key"), "seller_id",
                     "seller_zip_code_prefix", "seller_city", "seller_state")
    return out.withColumn("dbt_updated_at", F.current_timestamp()) if with_clock else out


def dim_customers(stg_customers_df: DataFrame) -> DataFrame:
    """Public names (city, state)."""
    cols = [F.col("customer_key"), F.col("customer_id"), F.col("customer_city").alias("city"),
            F.col("customer_state").alias("state")]
    if "dbt_updated_at" in stg_customers_df.columns:
        cols.append(F.col("dbt_updated_at"))
    return stg_customers_df.select(*cols)


def order_payment_total(raw_payments: DataFrame) -> DataFrame:
    """A1: ``sum(payment_value)`` per order (exact decimal)."""
    return raw_payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"))


def order_primary_seller(raw_order_items: DataFrame) -> DataFrame:
    """A2: the smallest ``seller_id`` per order (binary string order)."""
    return raw_order_items.groupBy("order_id").agg(F.min("seller_id").alias("seller_id"))


def seller_metrics(raw_order_items: DataFrame, raw_payments: DataFrame,
                   method: str = "pre_aggregated") -> DataFrame:
    """Per seller, distinct orders and revenue over the items x
    payments fan-out (each payment counted once per item row of the seller).

    ``pre_aggregated`` (default): items counted per (seller, order), payments
    summed per order, one many-to-one join, ``sum(n_items * order_payments)``;
    ``fan_out``: the literal join, for tests.
    """
    if method == "fan_out":
        j = raw_order_items.alias("oi").join(
            raw_payments.alias("p"), F.col("oi.order_id") == F.col("p.order_id"), "left")
        return j.groupBy(F.col("oi.seller_id").alias("seller_id")).agg(
            F.countDistinct(F.col("oi.order_id")).alias("total_orders"),
            F.sum(F.coalesce(F.col("p.payment_value"), F.lit(0))).alias("total_revenue"))
    items = raw_order_items.groupBy("seller_id", "order_id").agg(F.count(F.lit(1)).alias("n_items"))
    pays = raw_payments.groupBy("order_id").agg(
        F.coalesce(F.sum(F.coalesce("payment_value", F.lit(0))), F.lit(0)).alias("paid"))
    j = items.join(pays, "order_id", "left")
    return j.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.col("n_items") * F.coalesce(F.col("paid"), F.lit(0))).alias("total_revenue"))


def dim_sellers(stg_sellers_df: DataFrame, raw_order_items: DataFrame, raw_payments: DataFrame,
                method: str = "pre_aggregated") -> DataFrame:
    """Every seller, metrics or 0."""
    m = seller_metrics(raw_order_items, raw_payments, method)
    j = stg_sellers_df.join(m, "seller_id", "left")
    cols = [
        "seller_key", "seller_id", F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        # sum of 2-decimal amounts is exact: rounding to 2 digits changes nothing
        F.coalesce("total_revenue", F.lit(0)).cast("decimal(38,2)").alias("total_revenue"),
    ]
    if "dbt_updated_at" in stg_sellers_df.columns:
        cols.append("dbt_updated_at")
    return j.select(*cols)


def fact_orders(stg_orders_df: DataFrame, seller_keys: DataFrame, raw_order_items: DataFrame,
                raw_payments: DataFrame, customer_keys: DataFrame,
                with_clock: bool = True, heavy_sellers: list | None = None) -> DataFrame:
    """One row per order.

    ``seller_keys`` holds (seller_id, seller_key) of the seller dimension; an
    order without items, or whose primary seller is unknown, gets 'unknown'.

    ``customer_keys`` holds (customer_id, customer_key) of the customer dimension; an
    order whose customer is not in it has a null key.

    An order's seller is its smallest id, so a few sellers may have most orders:
    ``heavy_sellers`` (from ``operators.lookup.heavy_keys`` of the items) are looked up in a
    broadcast, and no task gets all orders of one.
    """
    primary = order_primary_seller(raw_order_items)
    with_key = enrich_skewed(primary, seller_keys.select("seller_id", "seller_key"), "seller_id",
                             heavy_sellers or [], spread="order_id").select("order_id", "seller_key")
    paid = order_payment_total(raw_payments)
    o = stg_orders_df
    o = o.join(customer_keys.select("customer_id", "customer_key"), "customer_id", "left")
    j = o.join(with_key, "order_id", "left").join(paid, "order_id", "left")
    cols = [
        F.col("order_id"), F.col("customer_key"),
        F.coalesce(F.col("seller_key"), F.lit(UNKNOWN_SELLER)).alias("seller_key"),
        F.coalesce(F.col("total_payment_value"), F.lit(0)).cast("decimal(22,2)")
        .alias("payment_value"),
        F.col("order_status"), F.col("order_purchase_timestamp"), F.col("order_approved_at"),
        F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"),
        F.col("delivery_days"), (F.col("order_status") == "delivered").alias("is_delivered"),
        F.col("customer_state"),
    ]
    if with_clock and "ingested_at" in stg_orders_df.columns:
        cols.append(F.col("ingested_at"))
    return j.select(*cols)


def agg_daily_gmv(fact: DataFrame, order_id_unique: bool = False) -> DataFrame:
    """One row per purchase date.

    Orders are counted distinctly. ``order_id_unique=True`` takes the plain count; only
    for a fact whose uniqueness a check of the same run has shown.
    """
    f = fact.filter(F.col("order_purchase_timestamp").isNotNull())
    n_orders = F.count("order_id") if order_id_unique else F.countDistinct("order_id")
    daily = f.groupBy(F.to_date("order_purchase_timestamp").alias("order_date")).agg(
        n_orders.alias("total_orders"),
        F.sum("payment_value").alias("_gmv"),
        F.count("payment_value").alias("_n_pay"),
        F.sum(F.when(F.col("is_delivered"), 1).otherwise(0)).cast("bigint")
        .alias("delivered_orders"),
        F.sum("delivery_days").alias("_dd"),
        F.count("delivery_days").alias("_n_dd"),
    )
    return daily.select(
        "order_date", F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("_gmv").cast("double").alias("total_gmv"),
        round_avg_money("_gmv", "_n_pay", 2).alias("avg_payment_value"),
        "delivered_orders",
        round_avg_whole("_dd", "_n_dd", 1).alias("avg_delivery_days"),
    ).orderBy("order_date")
