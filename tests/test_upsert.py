import datetime as dt

from pyspark.sql import functions as F

from ordersmith.operators.dedup import distinct_on, keep_first, keep_max, latest_per_key
from ordersmith.operators.upsert import insert_new, upsert
from ordersmith.plans import ingest
from conftest import SF_SMALL, rows

T = dt.datetime
ORD = ("order_id string, customer_id string, order_status string, purchase_timestamp "
       "timestamp_ntz, approved_at timestamp_ntz, delivered_carrier_date timestamp_ntz, "
       "delivered_customer_date timestamp_ntz, estimated_delivery_date timestamp_ntz, "
       "customer_city string, customer_state string, ingested_at timestamp_ntz")


def test_order_upsert_partial_columns(spark):
    t1, t2, d1 = T(2017, 1, 1), T(2017, 1, 2), T(2017, 1, 5)
    target = spark.createDataFrame(
        [("o1", "c1", "processing", t1, t1, None, d1, None, "A", "SP", t1),
         ("o2", "c2", "shipped", t1, None, None, None, None, "B", "RJ", t1)], ORD)
    source = spark.createDataFrame(
        [("o1", "cX", "delivered", t2, t2, t2, None, t2, "Z", "MG", t2),
         ("o3", "c3", "approved", t2, t2, None, None, None, "C", "PR", t2)], ORD)
    out = {r["order_id"]: r for r in ingest.upsert_orders(target, source).collect()}
    o1 = out["o1"]
    assert o1["order_status"] == "delivered"
    assert o1["approved_at"] == t1                   # not in the update list
    assert o1["delivered_customer_date"] is None     # updated to null
    assert o1["customer_id"] == "c1" and o1["customer_city"] == "Z"
    assert o1["ingested_at"] == t1
    assert out["o2"]["order_status"] == "shipped"    # only in target: kept
    assert out["o3"]["customer_id"] == "c3"          # only in source: inserted
    twice = ingest.upsert_orders(ingest.upsert_orders(target, source), source)
    assert rows(twice) == rows(ingest.upsert_orders(target, source))


def test_payment_upsert_keeps_installments(spark):
    sch = ("order_id string, payment_sequential int, payment_type string, "
           "payment_installments int, payment_value decimal(12,2), ingested_at timestamp_ntz")
    tgt = spark.createDataFrame([("o1", 1, "boleto", 3, None, None)], sch) \
        .withColumn("payment_value", F.lit(10).cast("decimal(12,2)"))
    src = spark.createDataFrame([("o1", 1, "voucher", 5, None, None)], sch) \
        .withColumn("payment_value", F.lit(12).cast("decimal(12,2)"))
    r = ingest.upsert_payments(tgt, src).first()
    assert (r["payment_type"], r["payment_installments"], float(r["payment_value"])) == (
        "voucher", 3, 12.0)


def test_only_newer_ignores_late_events(spark):
    sch = "k string, v string, event_time string"
    tgt = spark.createDataFrame([("a", "new", "2"), ("b", "old", "1")], sch)
    src = spark.createDataFrame([("a", "late", "1"), ("b", "newer", "3")], sch)
    out = upsert(tgt, src, ["k"], ["v"], newer_col="event_time")
    assert rows(out) == [("a", "new", "2"), ("b", "newer", "3")]


def test_insert_new_first_wins(spark):
    tgt = spark.createDataFrame([("s1", "a")], "seller_id string, c string")
    src = spark.createDataFrame([("s1", "b"), ("s2", "c")], "seller_id string, c string")
    assert rows(insert_new(tgt, src, ["seller_id"])) == [("s1", "a"), ("s2", "c")]


def test_window_and_aggregate_dedup_agree(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = latest_per_key(ev, ["user_id"], "ts", [F.col("event_id").desc()])
    b = latest_per_key(ev, ["user_id"], "ts", [F.col("event_id")], method="aggregate")
    assert rows(a) == rows(b.select(*a.columns))


def test_distinct_on_prefers_non_null_city(spark):
    df = spark.createDataFrame([("c1", None, "SP"), ("c1", "Campinas", "SP"), ("c2", "B", None)],
                               "customer_id string, customer_city string, customer_state string")
    out = distinct_on(df, ["customer_id"], [F.col("customer_city").asc_nulls_last()])
    assert rows(out) == [("c1", "Campinas", "SP"), ("c2", "B", None)]


def test_keep_first_hot_key(spark):
    """One key holding most rows still gives exactly one row per key."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    out = keep_first(df, ["k"], [F.col("v").desc()])
    assert out.count() == 1 + 20000 - 14000
    assert out.filter("k = 0").first()["v"] == 19996
    best = keep_max(df, ["k"], [F.col("v")])
    assert best.filter("k = 0").first()["v"] == 19996
