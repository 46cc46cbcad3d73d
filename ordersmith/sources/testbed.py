"""Testbed adapter: the shared TPC-H-like test tables in the shape of the
order pipeline's inputs.

Each function is a plain projection/join of the given tables, so its work
grows with them; the oracle SQL in ``__spark_entry__`` spells out the same
mapping for DuckDB.

Mapping (k = o_orderkey):
* order status: F delivered, O shipped, P by k mod 7 (0 processing, 1 approved,
  2 invoiced, 3 unavailable, 4 canceled, 5 created (not a valid status),
  6 processing);
* purchase time = o_orderdate + (k*37 mod 86400) s; approved = o_orderdate +
  1 day unless P; carrier date = o_orderdate + 2 days for F and O; customer
  delivery (F only) = o_orderdate + (k mod 40) days + (k*53 mod 86400) s;
  estimate = o_orderdate + 30 days;
* customer city = ' ' || lower(nation name) || ' ', state = state list at the
  nation key; sellers alike without the blanks;
* payments from line items: sequence = line number, type by return flag
  (A credit_card, N boleto, R voucher), installments 1 + partkey mod 12, value
  = extended price; event time = ship date; later arrival = larger
  (partkey, suppkey, extended price).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import to_json_keep_nulls
from ..functions.numeric import to_money
from ..functions.timestamps import add_days, add_seconds, ts_text
from ..operators.dedup import keep_first
from ..operators.lookup import bounded_broadcast
from ..schemas import BRAZILIAN_STATES
from .topic import as_envelope

# Fixed values of the adapter: state by nation key (0-based), status by k mod 7.
NATION_STATES = BRAZILIAN_STATES[:25]
PENDING_STATUS_BY_MOD7 = [
    "processing", "approved", "invoiced", "unavailable", "canceled", "created", "processing",
]
RETURNFLAG_PAYMENT_TYPE = {"A": "credit_card", "N": "boleto", "R": "voucher"}
# TPC-H fixes the nation table at 25 rows; the bound is checked before a broadcast.
NATION_MAX_ROWS = 1000

# Declared schemas of the test tables (read without a schema-inference job).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


class Tables:
    """Lazy parquet readers for one scale-factor folder; each table's reader
    (file listing, footer schema) is created once per instance."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._nations: DataFrame | None = None

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            reader = self.spark.read
            if name in TABLE_SCHEMAS:
                reader = reader.schema(TABLE_SCHEMAS[name])
            df = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            self._frames[name] = df
        return self._frames[name]

    def nations(self) -> DataFrame:
        """(n_nationkey, n_name), broadcast once its size bound is proven."""
        if self._nations is None:
            self._nations = bounded_broadcast(self("nation").select("n_nationkey", "n_name"),
                                              NATION_MAX_ROWS)
        return self._nations


def _state(nationkey: Column) -> Column:
    return F.try_element_at(F.lit(NATION_STATES), nationkey.cast("int") + 1)


def _nations(t: Tables) -> DataFrame:
    return t.nations()


def order_rows(t: Tables) -> DataFrame:
    """Orders with typed timestamps (no customer city/state yet)."""
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    pending = F.try_element_at(F.lit(PENDING_STATUS_BY_MOD7),
                               F.pmod(k, F.lit(7)).cast("int") + 1)
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "shipped").otherwise(pending))
    d = F.col("o_orderdate")
    return o.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        add_seconds(d, F.pmod(k * 37, F.lit(86400))).alias("purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", add_days(d, F.lit(1))).alias("approved_at"),
        F.when(F.col("o_orderstatus").isin("F", "O"), add_days(d, F.lit(2)))
        .alias("delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F",
               add_seconds(add_days(d, F.pmod(k, F.lit(40))), F.pmod(k * 53, F.lit(86400))))
        .alias("delivered_customer_date"),
        add_days(d, F.lit(30)).alias("estimated_delivery_date"),
    )


def customer_lookup(t: Tables) -> DataFrame:
    """Customers CSV shape: (customer_id, customer_unique_id, zip, city, state)."""
    c = t("customer").select("c_custkey", "c_nationkey")
    j = c.join(_nations(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("customer_unique_id"),
        F.lpad(F.pmod(F.col("c_custkey"), F.lit(100000)).cast("string"), 5, "0")
        .alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.lower(F.col("n_name")), F.lit(" ")).alias("customer_city"),
        _state(F.col("c_nationkey")).alias("customer_state"),
    )


def raw_orders(t: Tables) -> DataFrame:
    """Staging ``raw_orders`` (without the clock column ``ingested_at``)."""
    cust = customer_lookup(t).select("customer_id", "customer_city", "customer_state")
    return order_rows(t).join(cust, "customer_id", "left").select(
        "order_id", "customer_id", "order_status", "purchase_timestamp", "approved_at",
        "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date",
        "customer_city", "customer_state")


def _as_csv_text(o: DataFrame, *extra) -> DataFrame:
    return o.select(
        "order_id", "customer_id", "order_status",
        ts_text("purchase_timestamp").alias("order_purchase_timestamp"),
        ts_text("approved_at").alias("order_approved_at"),
        ts_text("delivered_carrier_date").alias("order_delivered_carrier_date"),
        ts_text("delivered_customer_date").alias("order_delivered_customer_date"),
        ts_text("estimated_delivery_date").alias("order_estimated_delivery_date"),
        *extra,
    )


def orders_csv(t: Tables) -> DataFrame:
    """Orders as the CSV export holds them: text, empty fields null."""
    return _as_csv_text(order_rows(t))


def order_event_stream(t: Tables) -> DataFrame:
    """Two events per order, as an envelope: an earlier one ('processing', no
    delivery, event time = purchase time) and the final one (event time one day
    later). Offsets: 2k for the earlier, 2k+1 for the final."""
    from .encoders import order_event_fields

    rows = _as_csv_text(order_rows(t), "purchase_timestamp")
    k = F.col("order_id").cast("long")
    early = rows.select(
        "order_id", "customer_id", F.lit("processing").alias("order_status"),
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        F.lit(None).cast("string").alias("order_delivered_customer_date"),
        "order_estimated_delivery_date",
        ts_text("purchase_timestamp", iso_t=True).alias("__et"), (k * 2).alias("__off"))
    final = rows.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        ts_text(add_days(F.col("purchase_timestamp"), F.lit(1)), iso_t=True).alias("__et"),
        (k * 2 + 1).alias("__off"))
    both = early.unionByName(final)
    enc = both.select(
        to_json_keep_nulls(*order_event_fields(both, F.col("__et"))).alias("value"), "__off")
    return as_envelope(enc, "orders", offset_col="__off")


def payment_events(t: Tables) -> DataFrame:
    """Typed payment events with the arrival-order columns."""
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_extendedprice", "l_returnflag", "l_shipdate")
    ptype = F.coalesce(*[F.when(F.col("l_returnflag") == f, F.lit(v))
                         for f, v in RETURNFLAG_PAYMENT_TYPE.items()])
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("payment_sequential"),
        ptype.alias("payment_type"),
        (F.pmod(F.col("l_partkey"), F.lit(12)) + 1).cast("int").alias("payment_installments"),
        to_money(F.col("l_extendedprice")).alias("payment_value"),
        ts_text("l_shipdate", iso_t=True).alias("event_time"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    )


# Later arrival wins among payment events of one key.
def payment_latest_order() -> list[Column]:
    return [F.col("event_time").desc(), F.col("l_partkey").desc(),
            F.col("l_suppkey").desc(), F.col("l_extendedprice").desc()]


def payments_csv(t: Tables) -> DataFrame:
    p = payment_events(t)
    return p.select("order_id", F.col("payment_sequential").cast("string"),
                    "payment_type", F.col("payment_installments").cast("string"),
                    F.col("payment_value").cast("string"), "event_time", "l_orderkey",
                    "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def raw_payments(t: Tables) -> DataFrame:
    """Staging ``raw_payments``: the events upserted into an empty table, one row
    per (order_id, payment_sequential), the latest arrival winning."""
    p = keep_first(payment_events(t), ["order_id", "payment_sequential"], payment_latest_order())
    return p.select("order_id", "payment_sequential", "payment_type", "payment_installments",
                    "payment_value")


def item_first_order() -> list[Column]:
    return [F.col("l_shipdate").asc(), F.col("l_partkey").asc(),
            F.col("l_suppkey").asc(), F.col("l_extendedprice").asc()]


def order_item_rows(t: Tables) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_extendedprice", "l_quantity", "l_shipdate")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        to_money(F.col("l_extendedprice")).alias("price"),
        to_money(F.col("l_quantity")).alias("freight_value"),
        "l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
    )


ITEM_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                "price", "freight_value"]


def raw_order_items(t: Tables) -> DataFrame:
    """Staging ``raw_order_items``: insert-if-absent, so the first row per key."""
    return keep_first(order_item_rows(t), ["order_id", "order_item_id"], item_first_order()) \
        .select(*ITEM_COLUMNS)


def raw_sellers(t: Tables) -> DataFrame:
    s = t("supplier").select("s_suppkey", "s_nationkey")
    j = s.join(_nations(t), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return j.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.lpad(F.pmod(F.col("s_suppkey"), F.lit(100000)).cast("string"), 5, "0")
        .alias("seller_zip_code_prefix"),
        F.lower(F.col("n_name")).alias("seller_city"),
        _state(F.col("s_nationkey")).alias("seller_state"),
    )
