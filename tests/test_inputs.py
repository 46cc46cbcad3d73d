"""Inputs the test tables do not hold: awkward CSV, broken messages, ties, late events."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordersmith import session
from ordersmith.functions.numeric import to_money
from ordersmith.functions.text import loader_city
from ordersmith.plans import ingest, jobs
from ordersmith.schemas import RAW_PAYMENTS, SELLERS_CSV
from ordersmith.sources.files import first_rows_by_key, read_csv
from ordersmith.sources.topic import as_envelope, read_topic


def test_csv_columns_by_name_and_quotes(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text('seller_city,extra,seller_id,seller_state\n'
                    '"say ""hi"", x",1,s1,PR\n"two\nlines",2,s2,SP\n')
    got = rows(read_csv(spark, str(path), SELLERS_CSV, {"seller_zip_code_prefix": "0"}),
               "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
    assert got == [("s1", "0", 'say "hi", x', "PR"), ("s2", "0", "two\nlines", "SP")]


@pytest.mark.parametrize("k", [0, 1, 40, 60, 99, 100, 150])
def test_first_rows_keep_null_keys(spark, k):
    df = spark.range(100).select(F.when(F.col("id") >= 50, F.col("id")).alias("key"))
    got = first_rows_by_key(df, "key", k).collect()
    assert len(got) == min(k, 100)
    assert sum(r["key"] is None for r in got) == min(k, 50)


def test_money_out_of_range_is_an_error(spark):
    df = spark.createDataFrame([("1.005",), ("x",), (None,)], "v string")
    assert [r[0] if r[0] is None else float(r[0]) for r in df.select(to_money("v")).collect()] == [
        1.01, None, None]
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(1e10,)], "v double").select(to_money("v")).collect()


def test_loader_text_forms(spark):
    df = spark.createDataFrame([("\tbairro 2a \n",)], "c string")
    assert df.select(loader_city("c")).first()[0] == "Bairro 2A"


PAYMENTS = [
    {"order_id": "a", "payment_type": "x"},
    {"order_id": "b", "payment_sequential": "2", "payment_installments": " 3", "payment_value": "7.5"},
    {"order_id": "c", "payment_sequential": "two", "payment_value": 1},
    {"order_id": "", "payment_value": 1},
]


def envelope(spark, messages):
    text = [(json.dumps(m), i) for i, m in enumerate(messages)] + [('{"order_id": "d", "pay', 99)]
    return as_envelope(spark.createDataFrame(text, "value string, pos long"), "payments",
                       offset_col="pos")


def test_broken_payments(spark):
    env = envelope(spark, PAYMENTS)
    clean = ingest.clean_payments(env, with_ingest_time=False)
    assert rows(clean) == [("a", 1, "x", 1, 0.0), ("b", 2, None, 3, 7.5)]
    assert sorted(r["reason"] for r in ingest.rejected_payments(env).collect()) == [
        "order_id", "order_id", "payment_sequential"]


def test_same_payments_twice_give_the_same_rows(spark):
    staged = ingest.staged_payments(ingest.clean_payments(envelope(spark, PAYMENTS),
                                                          keep_event_time=True))
    empty = spark.createDataFrame([], RAW_PAYMENTS).withColumn("event_time", F.lit("").cast("string"))
    once = ingest.upsert_payments(empty, staged)
    twice = ingest.upsert_payments(once, staged)
    assert once.count() == twice.count() == 2


def test_event_time_moves_with_every_update(spark):
    sch = "order_id string, order_status string, event_time string"
    at = lambda s, t: spark.createDataFrame([("o", s, t)], sch)
    stored = ingest.upsert_orders(at("old", "1"), at("new", "3"))
    late = ingest.upsert_orders(stored, at("late", "2"), only_newer=True)
    assert late.first()["event_time"] == "3"


def test_unreadable_items_are_rejected(spark):
    df = spark.createDataFrame(
        [("o", "1", "p", "s", None, "1.5", None), ("o", "x", "p", "s", None, "1", "1"),
         ("o", None, "p", "s", None, None, "2")],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string")
    got = rows(ingest.item_rows(df), "order_item_id", "price", "freight_value")
    assert [(a, float(b), float(c)) for a, b, c in got] == [(1, 0.0, 2.0), (1, 1.5, 0.0)]
    assert [r["reason"] for r in ingest.rejected_items(df).collect()] == ["order_item_id"]


def test_later_run_wins_on_equal_times(spark, tmp_path):
    def line(status):
        return json.dumps({"order_id": "o", "customer_id": "c", "order_status": status,
                           "event_time": "2020-01-01T00:00:00"}) + "\n"
    for run, status, pad in (("run-000000001", "old", 0), ("run-000000002", "new", 5000)):
        (tmp_path / run).mkdir()
        (tmp_path / run / "part-0.txt").write_text("\n" * pad + line(status))
    got = ingest.clean_orders(read_topic(spark, "orders", f"{tmp_path}/*"))
    assert got.first()["order_status"] == "new"


def test_run_numbers_of_incremental_runs(spark, tmp_path):
    orders = tmp_path / "orders.csv"
    orders.write_text("order_id,customer_id,order_status,order_purchase_timestamp\n"
                      "o1,c1,delivered,2017-01-01 10:00:00\n")
    cfg = jobs.Config(root=str(tmp_path / "lake"), incremental=True, orders_csv=str(orders))
    seen = []
    for _ in range(3):
        run = jobs.next_run(spark, cfg)
        seen.append(run)
        assert jobs.publish_events(spark, cfg, run) == {"orders": 1}
    assert seen == [1, 2, 3]
    with pytest.raises(Exception, match="(?i)exist"):
        jobs.publish_events(spark, cfg, 1)


def test_no_shared_folder_on_a_cluster_is_an_error():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
