import datetime as dt
import json

from pyspark.sql import functions as F

from ordersmith.plans import ingest
from ordersmith.sources.encoders import encode_orders, encode_payments
from ordersmith.sources.topic import as_envelope
from conftest import rows

T = dt.datetime


def envelope(spark, messages):
    df = spark.createDataFrame([(m, i) for i, m in enumerate(messages)], "value string, pos long")
    return as_envelope(df, "t", offset_col="pos")


def order(oid, cust, status, purchase, delivered=None, event_time="2017-01-01T00:00:00"):
    return json.dumps({"order_id": oid, "customer_id": cust, "order_status": status,
                       "purchase_timestamp": purchase, "approved_at": None,
                       "delivered_carrier_date": None, "delivered_customer_date": delivered,
                       "estimated_delivery_date": None, "event_time": event_time,
                       "schema_version": "1.0"})


def test_clean_orders_fixture(spark):
    msgs = [
        order("order1", "cust1", "delivered", "2017-09-13 08:59:02", "2017-09-23 00:00:00"),
        order("order2", "cust2", "shipped", "2017-10-01 12:00:00"),
        order("dup_order", "c1", "delivered", "2017-01-01 10:00:00",
              event_time="2017-01-01T10:00:00"),
        order("dup_order", "c1", "shipped", "2017-01-01 10:00:00",
              event_time="2017-01-01T11:00:00"),
        order(None, "c9", "shipped", "2017-01-01 10:00:00"),
        order("", "c9", "shipped", "2017-01-01 10:00:00"),
        order("o9", None, "shipped", "2017-01-01 10:00:00"),
        "not json",
    ]
    out = ingest.clean_orders(envelope(spark, msgs))
    assert out.schema["purchase_timestamp"].dataType.typeName() == "timestamp_ntz"
    assert out.filter(F.col("ingested_at").isNull()).count() == 0
    got = rows(out, "order_id", "order_status", "purchase_timestamp", "delivered_customer_date")
    assert got == sorted([
        ("dup_order", "shipped", T(2017, 1, 1, 10), None),
        ("order1", "delivered", T(2017, 9, 13, 8, 59, 2), T(2017, 9, 23)),
        ("order2", "shipped", T(2017, 10, 1, 12), None),
    ], key=repr)


def test_equal_event_times_later_message_wins(spark):
    msgs = [order("o", "c", "approved", "2017-01-01 10:00:00"),
            order("o", "c", "invoiced", "2017-01-01 10:00:00")]
    assert rows(ingest.clean_orders(envelope(spark, msgs)), "order_status") == [("invoiced",)]


def test_clean_payments_fixture(spark):
    def pay(oid, seq, typ, inst, val):
        return json.dumps({"order_id": oid, "payment_sequential": seq, "payment_type": typ,
                           "payment_installments": inst, "payment_value": val,
                           "event_time": "x", "schema_version": "1.0"})
    msgs = [pay("order1", 1, "credit_card", 3, 125.50), pay(None, 1, "boleto", 1, 50.0),
            pay("o2", 1, "credit_card", 1, 99.0)]
    got = rows(ingest.clean_payments(envelope(spark, msgs), with_ingest_time=False))
    assert got == [("o2", 1, "credit_card", 1, 99.0), ("order1", 1, "credit_card", 3, 125.5)]


def test_customer_lookup_and_enrich(spark):
    csv = spark.createDataFrame(
        [("c1", "u", "1", "são paulo", "sp"), ("c2", "u", "2", "rio de janeiro", "rj"),
         ("c3", "u", "3", None, "sp"), ("c3", "u", "3", "campinas", "sp")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string")
    lk = ingest.customer_lookup(csv, normalize=True)
    assert rows(lk) == [("c1", "São Paulo", "SP"), ("c2", "Rio De Janeiro", "RJ"),
                        ("c3", "Campinas", "SP")]
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "missing")],
                                   "order_id string, customer_id string")
    e = ingest.enrich_orders(orders, lk)
    assert e.columns[0] == "customer_id"
    assert rows(e, "order_id", "customer_city", "customer_state") == [
        ("o1", "São Paulo", "SP"), ("o2", None, None)]


def test_encoders(spark):
    csv = spark.createDataFrame(
        [("o1", "c1", "delivered", None, None, None, None, None)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string")
    msg = json.loads(encode_orders(csv, F.lit("2024-01-01T00:00:00+00:00")).first()["value"])
    assert msg["approved_at"] is None and "approved_at" in msg
    assert msg["purchase_timestamp"] == ""
    assert msg["schema_version"] == "1.0"
    pays = spark.createDataFrame(
        [("o1", " 2 ", "boleto", "3", "10.5"), ("o2", "1.0", "boleto", "1", "1"),
         ("o3", "1", "boleto", "1", "abc")],
        "order_id string, payment_sequential string, payment_type string, "
        "payment_installments string, payment_value string")
    out = [json.loads(r["value"]) for r in encode_payments(pays, F.lit("t")).collect()]
    assert [(m["order_id"], m["payment_sequential"], m["payment_value"]) for m in out] == [
        ("o1", 2, 10.5)]
    # a missing column takes the default
    short = spark.createDataFrame([("o1",)], "order_id string")
    m = json.loads(encode_payments(short, F.lit("t")).first()["value"])
    assert (m["payment_sequential"], m["payment_type"], m["payment_installments"],
            m["payment_value"]) == (1, "unknown", 1, 0.0)


def test_encode_then_clean_round_trip(spark):
    from ordersmith.sources import testbed as tb
    from conftest import SF_SMALL
    t = tb.Tables(spark, SF_SMALL)
    enc = encode_orders(tb.orders_csv(t), F.lit("2024-01-01T00:00:00"))
    env = as_envelope(enc.withColumn("pos", F.monotonically_increasing_id()), "orders",
                      offset_col="pos")
    back = ingest.clean_orders(env, with_ingest_time=False)
    orig = tb.order_rows(t)
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


def test_seller_and_item_rows(spark):
    sellers = spark.createDataFrame(
        [("s1", "12345", " curitiba ", "pr"), ("s2", "54321", "manaus", " am"),
         (None, "0", "x", "sp")],
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string")
    assert rows(ingest.seller_rows(sellers)) == [("s1", "12345", "Curitiba", "PR"),
                                                 ("s2", "54321", "Manaus", "AM")]
    items = spark.createDataFrame(
        [("o1", "1", "p1", "s1", "2017-09-19 09:45:35", "58.90", "13.29"),
         ("o1", None, "p2", "s2", "bad", None, None), ("o2", "1", "p2", "s2", None, "1", "x")],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string")
    got = rows(ingest.item_rows(items), "order_id", "order_item_id", "shipping_limit_date",
               "price", "freight_value")
    from decimal import Decimal
    assert got == sorted([("o1", 1, T(2017, 9, 19, 9, 45, 35), Decimal("58.90"), Decimal("13.29")),
                          ("o1", 1, None, Decimal("0.00"), Decimal("0.00"))], key=repr)


def test_kafka_source_is_wired(spark):
    """The Kafka connector jar is not installed here: the read must fail in
    Spark's data-source lookup, i.e. the options reached ``format("kafka")``."""
    import pytest
    from ordersmith.sources.topic import read_topic
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "orders", "broker:9092", format="kafka").schema
