"""Ingest (B1 B2 J1 B3 B4): topic messages -> clean, deduplicated, enriched
staging rows -> upserted staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import parse_messages, to_json_keep_nulls
from ..functions.numeric import to_money
from ..functions.text import loader_city, loader_state
from ..functions.timestamps import parse_ts
from ..operators.dedup import distinct_on, keep_first
from ..operators.lookup import enrich
from ..operators.upsert import insert_new, upsert
from ..schemas import (
    ORDER_EVENT, ORDER_UPDATE_COLUMNS, PAYMENT_EVENT, PAYMENT_UPDATE_COLUMNS, RAW_ORDERS,
    RAW_ORDER_ITEMS, RAW_PAYMENTS, RAW_SELLERS, STAGING_KEYS,
)
from ..sources.files import FILE_PLACE

ORDER_TS_COLUMNS = ["purchase_timestamp", "approved_at", "delivered_carrier_date",
                    "delivered_customer_date", "estimated_delivery_date"]
ORDER_COLUMNS = ["order_id", "customer_id", "order_status", *ORDER_TS_COLUMNS]


# Where a message stands among the others of its topic: micro-batch, file, place in it.
ARRIVAL = ("batch", "source", "offset")


def _later_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ARRIVAL]


def _present(c: str) -> Column:
    """Python truthiness of a text field: not null and not ''."""
    return F.col(c).isNotNull() & (F.col(c) != "")


def order_records(envelope: DataFrame, text: bool = True) -> DataFrame:
    """Every order message, typed, with ``event_time``, its place among the messages,
    and ``reason``: the field for which it is left out (bad JSON, a missing or empty ``order_id``,
    a missing ``customer_id``), or null. With ``text``, ``value`` holds the text of messages
    left out."""
    parsed = parse_messages(envelope, ORDER_EVENT, keep=(*(["value"] if text else []), *ARRIVAL))
    reason = (F.when(~F.coalesce(_present("order_id"), F.lit(False)), F.lit("order_id"))
              .when(F.col("customer_id").isNull(), F.lit("customer_id")))
    return parsed.select("order_id", "customer_id", "order_status",
                         *[parse_ts(c).alias(c) for c in ORDER_TS_COLUMNS], "event_time", *ARRIVAL,
                         reason.alias("reason"), *_text_of(reason, text))


def _text_of(reason: Column, text: bool) -> list[Column]:
    return [F.when(reason.isNotNull(), F.col("value").cast("string")).alias("value")] if text else []


def accepted(records: DataFrame) -> DataFrame:
    return records.filter("reason is null").drop("reason", "value")


def rejected(records: DataFrame) -> DataFrame:
    """(value, reason) of the records left out."""
    return records.filter("reason is not null").select("value", "reason")


def parse_orders(envelope: DataFrame) -> DataFrame:
    """The order messages that can be used."""
    return accepted(order_records(envelope, text=False))


def clean_orders(envelope: DataFrame, with_ingest_time: bool = True,
                 keep_event_time: bool = False) -> DataFrame:
    """B1: parse, filter, type, then keep the latest event per ``order_id``."""
    return latest_orders(parse_orders(envelope), with_ingest_time, keep_event_time)


def latest_orders(rows: DataFrame, with_ingest_time: bool = True,
                  keep_event_time: bool = False) -> DataFrame:
    """The latest event per ``order_id`` of parsed messages.

    Latest = largest ``event_time`` (ISO text, compared as text; a missing time
    loses); equal times: the later message wins (by batch, file, place in it), then the row
    values decide, so the kept row never depends on partitioning.
    """
    order = [F.col("event_time").desc_nulls_last(), *_later_first(),
             *[F.col(c).asc_nulls_last() for c in ORDER_COLUMNS[1:]]]
    latest = keep_first(rows, ["order_id"], order)
    cols = list(ORDER_COLUMNS) + (["event_time"] if keep_event_time else [])
    out = latest.select(*cols)
    if with_ingest_time:
        out = out.withColumn("ingested_at", F.localtimestamp())
    return out


def customer_lookup(customers_csv: DataFrame, normalize: bool = False) -> DataFrame:
    """Customer city/state by id, one row per id (W5 made deterministic).

    ``normalize`` applies the loader's ``strip().title()`` / ``strip().upper()``.
    """
    c = customers_csv.select("customer_id", "customer_city", "customer_state")
    if normalize:
        c = c.select("customer_id", loader_city("customer_city").alias("customer_city"),
                     loader_state("customer_state").alias("customer_state"))
    return distinct_on(c.filter(F.col("customer_id").isNotNull()), ["customer_id"])


def enrich_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join on ``customer_id``; a customer missing from the lookup
    gives null city and state, and the order is kept."""
    return enrich(orders, customers, "customer_id")


def payment_records(envelope: DataFrame, text: bool = True) -> DataFrame:
    """Every payment message, typed, with its place and ``reason``, as :func:`order_records`.

    Numbers come as JSON numbers or as text (casts ignore white space around them). An absent
    sequence or instalment count is 1, an absent value 0; a field that is there but is no
    number is the reason for leaving the message out.
    """
    parsed = parse_messages(envelope, PAYMENT_EVENT, keep=(*(["value"] if text else []), *ARRIVAL))
    typed = _numbers(PAYMENT_NUMBERS)
    reason = F.coalesce(
        F.when(~F.coalesce(_present("order_id"), F.lit(False)), F.lit("order_id")),
        *[F.when(typed[c].isNull(), F.lit(c)) for c in PAYMENT_NUMBERS])
    return parsed.select("order_id", *[typed[c].alias(c) if c in typed else c for c in PAYMENT_COLUMNS[1:]],
                         "event_time", *ARRIVAL, reason.alias("reason"), *_text_of(reason, text))


PAYMENT_COLUMNS = ["order_id", "payment_sequential", "payment_type", "payment_installments",
                   "payment_value"]
PAYMENT_NUMBERS = {"payment_sequential": ("int", 1), "payment_installments": ("int", 1),
                   "payment_value": ("double", 0.0)}
ITEM_NUMBERS = {"order_item_id": ("int", 1), "price": ("double", 0.0), "freight_value": ("double", 0.0)}
# Reasons for which a record is left out, by source.
REASONS = {
    "orders": ("order_id", "customer_id"),
    "payments": ("order_id", *PAYMENT_NUMBERS),
    "sellers": ("seller_id",),
    "order_items": ("order_id", *ITEM_NUMBERS),
}


def _numbers(columns: dict) -> dict[str, Column]:
    """Number fields: the default where absent, null where there is text that is no number."""
    return {c: F.when(F.col(c).isNull(), F.lit(d)).otherwise(F.col(c).try_cast(t))
            for c, (t, d) in columns.items()}


def clean_payments(envelope: DataFrame, with_ingest_time: bool = True,
                   keep_event_time: bool = False) -> DataFrame:
    """B2: parse, type, leave out what cannot be used (see :func:`payment_records`). No
    dedup: the upsert into staging reduces repeats."""
    return usable_payments(accepted(payment_records(envelope, text=False)), with_ingest_time, keep_event_time)


def usable_payments(rows: DataFrame, with_ingest_time: bool = True,
                    keep_event_time: bool = False) -> DataFrame:
    out = rows.select(*PAYMENT_COLUMNS, *(["event_time", *ARRIVAL] if keep_event_time else []))
    if with_ingest_time:
        out = out.withColumn("ingested_at", F.localtimestamp())
    return out


def rejected_payments(envelope: DataFrame) -> DataFrame:
    """(value, reason) of the payment messages that the ingest leaves out."""
    return rejected(payment_records(envelope))


def rejected_orders(envelope: DataFrame) -> DataFrame:
    """(value, reason) of the order messages that the ingest leaves out."""
    return rejected(order_records(envelope))


def latest_payments(payments: DataFrame) -> DataFrame:
    """One payment per (order_id, payment_sequential): the later message wins."""
    order = [F.col("event_time").desc_nulls_last(), *_later_first(),
             *[F.col(c).asc_nulls_last() for c in ("payment_type", "payment_installments",
                                                   "payment_value")]]
    return keep_first(payments, STAGING_KEYS["raw_payments"], order)


def staged_orders(clean: DataFrame, customers: DataFrame) -> DataFrame:
    """Clean orders in the ``raw_orders`` shape, ready for the upsert."""
    e = enrich_orders(clean, customers)
    if "ingested_at" not in e.columns:
        e = e.withColumn("ingested_at", F.localtimestamp())
    extra = ["event_time"] if "event_time" in e.columns else []
    return e.select(*[f.name for f in RAW_ORDERS.fields], *extra)


def staged_payments(clean: DataFrame) -> DataFrame:
    p = latest_payments(clean) if "offset" in clean.columns else clean
    p = p.withColumn("payment_value", to_money("payment_value"))
    if "ingested_at" not in p.columns:
        p = p.withColumn("ingested_at", F.localtimestamp())
    extra = ["event_time"] if "event_time" in p.columns else []
    return p.select(*[f.name for f in RAW_PAYMENTS.fields], *extra)


def update_columns(table: str, timed: bool = True) -> list[str]:
    """Columns that an upsert into ``table`` overwrites; the event time moves with them."""
    own = {"raw_orders": ORDER_UPDATE_COLUMNS, "raw_payments": PAYMENT_UPDATE_COLUMNS}[table]
    return [*own, *(["event_time"] if timed else [])]


def upsert_orders(target: DataFrame, source: DataFrame, only_newer: bool = False) -> DataFrame:
    """K4 (+R2 with ``only_newer``: needs ``event_time`` on both sides). The event time
    moves with every update that is taken."""
    timed = "event_time" in target.columns and "event_time" in source.columns
    return upsert(target, source, STAGING_KEYS["raw_orders"], update_columns("raw_orders", timed),
                  newer_col="event_time" if only_newer else None)


def upsert_payments(target: DataFrame, source: DataFrame, only_newer: bool = False) -> DataFrame:
    """K5 (+R2 with ``only_newer``, as for orders)."""
    timed = "event_time" in target.columns and "event_time" in source.columns
    return upsert(target, source, STAGING_KEYS["raw_payments"], update_columns("raw_payments", timed),
                  newer_col="event_time" if only_newer else None)


def _place(rows: DataFrame) -> list[str]:
    return [c for c in FILE_PLACE if c in rows.columns]


def seller_records(sellers_csv: DataFrame) -> DataFrame:
    """Sellers file -> ``raw_sellers`` rows (``strip().title()``, ``strip().upper()``), with the
    rows' place in the file where it was read, and ``reason`` / ``value`` of rows without an id."""
    names = [c for c in sellers_csv.columns if c not in FILE_PLACE]
    reason = F.when(F.col("seller_id").isNull(), F.lit("seller_id"))
    return sellers_csv.select(
        "seller_id", "seller_zip_code_prefix",
        loader_city(F.coalesce("seller_city", F.lit(""))).alias("seller_city"),
        loader_state(F.coalesce("seller_state", F.lit(""))).alias("seller_state"),
        *_place(sellers_csv), reason.alias("reason"),
        F.when(reason.isNotNull(), to_json_keep_nulls(*names)).alias("value"))


def seller_rows(sellers_csv: DataFrame) -> DataFrame:
    """The rows of the sellers file that have an id."""
    return accepted(seller_records(sellers_csv)).drop(*FILE_PLACE)


def item_records(items_csv: DataFrame) -> DataFrame:
    """Order items file -> ``raw_order_items`` rows (F3 on the date, money), with their place in
    the file where it was read. An absent item number is 1, an absent amount 0; a row without an
    order, or whose number or amount cannot be read, has a ``reason`` and its text in ``value``."""
    names = [c for c in items_csv.columns if c not in FILE_PLACE]
    typed = _numbers(ITEM_NUMBERS)
    reason = F.coalesce(
        F.when(~F.coalesce(_present("order_id"), F.lit(False)), F.lit("order_id")),
        *[F.when(typed[c].isNull(), F.lit(c)) for c in ITEM_NUMBERS])
    return items_csv.select(
        "order_id", typed["order_item_id"].alias("order_item_id"), "product_id", "seller_id",
        parse_ts("shipping_limit_date").alias("shipping_limit_date"),
        to_money(typed["price"]).alias("price"), to_money(typed["freight_value"]).alias("freight_value"),
        *_place(items_csv), reason.alias("reason"),
        F.when(reason.isNotNull(), to_json_keep_nulls(*names)).alias("value"))


def item_rows(items_csv: DataFrame) -> DataFrame:
    """The rows of the items file that the load takes."""
    return accepted(item_records(items_csv)).drop(*FILE_PLACE)


def rejected_items(items_csv: DataFrame) -> DataFrame:
    """(value, reason) of the item rows that the load leaves out."""
    return rejected(item_records(items_csv))


def first_in_file(rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Per key the row that comes first: by ``order``, else by the place in the file, else (rows
    of no file) by value."""
    if order is None and _place(rows):
        rest = [c for c in rows.columns if c not in (*keys, *FILE_PLACE)]
        order = [F.col(c).asc_nulls_last() for c in (*FILE_PLACE, *rest)]
    kept = keep_first(rows, keys, order) if order else distinct_on(rows, keys)
    return kept.drop(*FILE_PLACE)


def insert_new_sellers(target: DataFrame, source: DataFrame) -> DataFrame:
    """K6: first row per ``seller_id`` wins (within the file and against the table)."""
    src = first_in_file(source, STAGING_KEYS["raw_sellers"])
    return insert_new(target, src.select(*[f.name for f in RAW_SELLERS.fields]),
                      STAGING_KEYS["raw_sellers"])


def insert_new_items(target: DataFrame, source: DataFrame,
                     order: list[Column] | None = None) -> DataFrame:
    """K6 for order items; ``order`` decides which of repeated keys is first."""
    keys = STAGING_KEYS["raw_order_items"]
    src = first_in_file(source, keys, order)
    return insert_new(target, src.select(*[f.name for f in RAW_ORDER_ITEMS.fields]), keys)
