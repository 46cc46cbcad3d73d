"""Declared schemas and fixed value lists, shared by every module."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Order statuses accepted by the staging model, quality suite and model tests.
VALID_ORDER_STATUSES = [
    "delivered", "shipped", "processing", "approved", "invoiced", "unavailable", "canceled",
]
# Brazilian state codes accepted by the customer dimension suite.
BRAZILIAN_STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]
EVENT_SCHEMA_VERSION = "1.0"
# Seller key used in the fact table when an order has no items.
UNKNOWN_SELLER = "unknown"
# ---------------------------------------------------------------------------

MONEY = DecimalType(12, 2)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Wire format of an order event: every field is text.
ORDER_EVENT = _strings(
    "order_id", "customer_id", "order_status", "purchase_timestamp", "approved_at",
    "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date",
    "event_time", "schema_version",
)

# Numbers of a payment event may come as JSON numbers or as text: read as text, cast after.
PAYMENT_EVENT = _strings(
    "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    "event_time", "schema_version",
)

# Topic envelope (what a Kafka source yields).
ENVELOPE = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])

# CSV reference files, all text as read with a header.
ORDERS_CSV = _strings(
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
PAYMENTS_CSV = _strings(
    "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
)
CUSTOMERS_CSV = _strings(
    "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
    "customer_state",
)
SELLERS_CSV = _strings("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
ORDER_ITEMS_CSV = _strings(
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
    "freight_value",
)

# Staging tables (primary keys in STAGING_KEYS).
RAW_ORDERS = StructType([
    StructField("order_id", StringType(), False),
    StructField("customer_id", StringType(), False),
    StructField("order_status", StringType(), True),
    StructField("purchase_timestamp", TimestampNTZType(), True),
    StructField("approved_at", TimestampNTZType(), True),
    StructField("delivered_carrier_date", TimestampNTZType(), True),
    StructField("delivered_customer_date", TimestampNTZType(), True),
    StructField("estimated_delivery_date", TimestampNTZType(), True),
    StructField("customer_city", StringType(), True),
    StructField("customer_state", StringType(), True),
    StructField("ingested_at", TimestampNTZType(), True),
])
RAW_PAYMENTS = StructType([
    StructField("order_id", StringType(), False),
    StructField("payment_sequential", IntegerType(), False),
    StructField("payment_type", StringType(), True),
    StructField("payment_installments", IntegerType(), True),
    StructField("payment_value", MONEY, True),
    StructField("ingested_at", TimestampNTZType(), True),
])
RAW_SELLERS = StructType([
    StructField("seller_id", StringType(), False),
    StructField("seller_zip_code_prefix", StringType(), True),
    StructField("seller_city", StringType(), True),
    StructField("seller_state", StringType(), True),
])
RAW_ORDER_ITEMS = StructType([
    StructField("order_id", StringType(), False),
    StructField("order_item_id", IntegerType(), False),
    StructField("product_id", StringType(), True),
    StructField("seller_id", StringType(), True),
    StructField("shipping_limit_date", TimestampNTZType(), True),
    StructField("price", MONEY, True),
    StructField("freight_value", MONEY, True),
])

STAGING_KEYS = {
    "raw_orders": ["order_id"],
    "raw_payments": ["order_id", "payment_sequential"],
    "raw_sellers": ["seller_id"],
    "raw_order_items": ["order_id", "order_item_id"],
}
# Columns an order upsert overwrites; the others keep the stored value.
ORDER_UPDATE_COLUMNS = [
    "order_status", "purchase_timestamp", "delivered_customer_date", "customer_city",
    "customer_state",
]
PAYMENT_UPDATE_COLUMNS = ["payment_value", "payment_type"]
