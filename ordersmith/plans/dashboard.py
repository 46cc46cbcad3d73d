"""Dashboard questions (B8 A6-A9 O1-O4 P5-P7 P14 F13) as functions of the marts.

Each returns a small DataFrame; parameters are Python values turned into
literals (never spliced into SQL text). Date filters are half-open ranges on the
raw timestamp so Parquet statistics can skip row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_avg_whole
from ..functions.text import money_text, short_id
from ..functions.timestamps import on_dates

DateLike = dt.date | str
# Partition column of a fact mart laid out by date (year * 100 + month of the purchase).
MONTH = "order_month"


def month_of(ts) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def purchased(fact: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Orders purchased on dates in [start, end]. On a mart laid out by month the range also
    names the month folders, so that the scan opens no others."""
    cond = on_dates("order_purchase_timestamp", start, end)
    if MONTH in fact.columns:
        first, last = (int(str(d)[:7].replace("-", "")) for d in (start, end))
        cond = cond & F.col(MONTH).between(first, last)
    return fact.filter(cond)


def daily_gmv(agg_daily: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Daily GMV rows with ``start <= order_date <= end`` (inclusive), by date."""
    s = F.lit(str(start)).cast("date")
    e = F.lit(str(end)).cast("date")
    return agg_daily.filter((F.col("order_date") >= s) & (F.col("order_date") <= e)).select(
        "order_date", "total_orders", "total_gmv", "avg_payment_value", "avg_delivery_days"
    ).orderBy("order_date")


def top_sellers(dim_sellers_df: DataFrame, top_n: int = 10, state: str | None = None) -> DataFrame:
    """The ``top_n`` sellers by revenue (> 0), optionally of one state.

    Ties on revenue are broken by ``seller_id`` so the cut is stable. Spark
    plans a ``TakeOrderedAndProject``: each task keeps its own top ``top_n``.
    """
    d = dim_sellers_df.filter(F.col("total_revenue") > 0)
    if state:
        d = d.filter(F.col("state") == F.lit(state))
    return d.select("seller_id", "city", "state", "total_orders",
                    F.col("total_revenue").cast("double").alias("total_revenue")) \
        .orderBy(F.col("total_revenue").desc(), F.col("seller_id").asc()).limit(top_n)


def top_seller_labels(top: DataFrame) -> DataFrame:
    """Chart labels, ascending by revenue for a horizontal bar chart."""
    return top.select(
        "seller_id",
        short_id("seller_id").alias("seller_label"),
        money_text("total_revenue").alias("revenue_label"),
        "total_revenue",
    ).orderBy(F.col("total_revenue").asc(), F.col("seller_id").desc())


def order_status_dist(fact: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Orders per status with purchase date in [start, end], largest first."""
    f = purchased(fact, start, end)
    return f.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count")) \
        .orderBy(F.col("order_count").desc(), F.col("order_status").asc())


def order_status_share(dist: DataFrame) -> DataFrame:
    """Each status's share of all orders, in percent (one decimal for labels).

    The window has no partition: it runs over the already aggregated statuses
    (a handful of rows), never over orders.
    """
    total = F.sum("order_count").over(Window.partitionBy())
    return dist.select("order_status", "order_count",
                       (F.col("order_count") / total).alias("share"),
                       round_avg_whole(F.col("order_count") * 100, total, 1).alias("percent"))


def delivery_by_state(fact: DataFrame, state: str | None = None) -> DataFrame:
    """Average delivery days (1 decimal) and orders per customer state,
    over orders with a delivery time; slowest first."""
    f = fact.filter(F.col("delivery_days").isNotNull() & F.col("customer_state").isNotNull())
    if state:
        f = f.filter(F.col("customer_state") == F.lit(state))
    g = f.groupBy("customer_state").agg(F.sum("delivery_days").alias("_s"),
                                        F.count(F.lit(1)).alias("total_orders"))
    return g.select("customer_state", round_avg_whole("_s", "total_orders", 1)
                    .alias("avg_delivery_days"), "total_orders") \
        .orderBy(F.col("avg_delivery_days").desc(), F.col("customer_state").asc())


def kpis(fact: DataFrame, start: DateLike, end: DateLike, order_id_unique: bool = False) -> DataFrame:
    """One row (even for an empty range): orders, GMV, average
    delivery days, distinct seller keys ('unknown' counts as one); null -> 0."""
    f = purchased(fact, start, end)
    n_orders = F.count("order_id") if order_id_unique else F.countDistinct("order_id")
    a = f.agg(n_orders.alias("_n"), F.sum("payment_value").alias("_gmv"),
              F.sum("delivery_days").alias("_dd"), F.count("delivery_days").alias("_n_dd"),
              F.countDistinct("seller_key").alias("_sellers"))
    return a.select(
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("_gmv").cast("double"), F.lit(0.0)).alias("total_gmv"),
        F.coalesce(round_avg_whole("_dd", "_n_dd", 1), F.lit(0.0)).alias("avg_delivery_days"),
        F.coalesce(F.col("_sellers"), F.lit(0)).cast("bigint").alias("active_sellers"),
    )
