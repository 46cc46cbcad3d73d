import csv
import os

import pytest

from ordersmith.operators.quality import QualityError
from ordersmith.plans import jobs as pipeline
from ordersmith.sinks.staging import committed_versions
from ordersmith.sources.files import read_csv
from ordersmith.schemas import SELLERS_CSV


def write_csv(path, header, data):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(data)
    return str(path)


def files(tmp_path, extra_orders=()):
    orders = [
        ("o1", "c1", "delivered", "2017-09-13 08:59:02", "2017-09-13 09:10:00", "",
         "2017-09-20 10:00:00", "2017-10-01 00:00:00"),
        ("o2", "c2", "shipped", "2017-09-14 10:00:00", "", "2017-09-15 10:00:00", "", ""),
        ("o3", "c1", "canceled", "2017-09-15 11:00:00", "", "", "", ""),
        *extra_orders,
    ]
    return dict(
        orders_csv=write_csv(tmp_path / "orders.csv", [
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"], orders),
        payments_csv=write_csv(tmp_path / "payments.csv", [
            "order_id", "payment_sequential", "payment_type", "payment_installments",
            "payment_value"], [("o1", "1", "credit_card", "3", "125.50"),
                               ("o1", "2", "voucher", "1", "10"),
                               ("o2", "1", "boleto", "1", "99.99")]),
        customers_csv=write_csv(tmp_path / "customers.csv", [
            "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
            "customer_state"], [("c1", "u1", "01000", "são paulo", "sp"),
                                ("c2", "u2", "20000", "rio de janeiro", "rj")]),
        sellers_csv=write_csv(tmp_path / "sellers.csv", [
            "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
            [("s1", "12345", "curitiba", "pr"), ("s2", "54321", "manaus", "am")]),
        order_items_csv=write_csv(tmp_path / "items.csv", [
            "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
            "price", "freight_value"], [("o1", "1", "p1", "s2", "2017-09-19 09:00:00", "100", "5"),
                                        ("o1", "2", "p2", "s1", "2017-09-19 09:00:00", "20", "5")]),
    )


def test_daily_run_passes_and_is_idempotent(spark, tmp_path):
    cfg = pipeline.Config(root=str(tmp_path / "lake"), buckets=4, keep_versions=1, **files(tmp_path))
    r1 = pipeline.run_daily(spark, cfg)
    assert r1["run"] == 1
    # one message per exported row (3 orders, 3 payments)
    assert spark.read.text(f"{cfg.topic_dir('orders')}/run-000000001").count() == 3
    assert spark.read.text(f"{cfg.topic_dir('payments')}/run-000000001").count() == 3
    assert r1["staged"] == {"raw_orders": 3, "raw_payments": 3, "raw_sellers": 2,
                            "raw_order_items": 2}
    fact = {r["order_id"]: r for r in pipeline.marts(spark, cfg)["fact_orders"].collect()}
    assert float(fact["o1"]["payment_value"]) == 135.5
    assert fact["o1"]["delivery_days"] == 7
    assert fact["o3"]["seller_key"] == "unknown"
    dim = {r["customer_id"]: r for r in pipeline.marts(spark, cfg)["dim_customers"].collect()}
    assert (dim["c1"]["city"], dim["c1"]["state"]) == ("São Paulo", "SP")
    before = sorted(tuple(r) for r in pipeline.marts(spark, cfg)["fact_orders"]
                    .drop("ingested_at").collect())
    r2 = pipeline.run_daily(spark, cfg)          # same input again: same tables
    assert r2["run"] == 2 and r2["staged"]["raw_orders"] == 3
    after = sorted(tuple(r) for r in pipeline.marts(spark, cfg)["fact_orders"]
                   .drop("ingested_at").collect())
    assert before == after
    # keep_versions=1: the first run's versions are gone
    assert committed_versions(spark, cfg.mart("fact_orders")) == [2]
    assert committed_versions(spark, f"{cfg.root}/quality") == [2]
    assert pipeline.table(spark, cfg, "raw_orders").versions() == [(0, 2)]


def test_daily_run_stops_on_quality_failure(spark, tmp_path):
    bad = [("o4", "c2", "created", "2017-09-16 10:00:00", "", "", "", "")]
    cfg = pipeline.Config(root=str(tmp_path / "lake"), buckets=4, **files(tmp_path, bad))
    with pytest.raises(QualityError, match="raw_orders"):
        pipeline.run_daily(spark, cfg)
    # the report was written before stopping
    rep = spark.read.parquet(f"{cfg.root}/quality/version-000000001")
    assert rep.filter("not success").count() >= 1


def test_missing_file_is_empty(spark, tmp_path):
    df = read_csv(spark, str(tmp_path / "nope.csv"), SELLERS_CSV)
    assert df.count() == 0 and df.columns == SELLERS_CSV.fieldNames()
    assert os.path.exists(tmp_path)


def test_incremental_daily_runs(spark, tmp_path):
    """R1 in the daily job: the second run ingests only the new drop of events,
    and the staged tables equal the batch-mode ones."""
    f = files(tmp_path)
    inc = pipeline.Config(root=str(tmp_path / "inc"), incremental=True, buckets=4, **f)
    bat = pipeline.Config(root=str(tmp_path / "bat"), buckets=4, **f)
    r1 = pipeline.run_daily(spark, inc)
    b1 = pipeline.run_daily(spark, bat)
    assert r1["staged"]["raw_orders"] == b1["staged"]["raw_orders"] == 3
    # same exports published again: nothing changes in either mode
    r2 = pipeline.run_daily(spark, inc)
    pipeline.run_daily(spark, bat)

    def fact(cfg):
        return sorted(tuple(r) for r in pipeline.marts(spark, cfg)["fact_orders"]
                      .drop("ingested_at").collect())
    assert r2["staged"]["raw_payments"] == 3
    assert fact(inc) == fact(bat)


def test_fact_mart_row_groups_are_time_clustered(spark, tmp_path):
    """Each written file of the fact mart is sorted by purchase time, so its
    Parquet statistics allow row-group skipping for date filters."""
    import glob
    import pyarrow.parquet as pq
    cfg = pipeline.Config(root=str(tmp_path / "lake"), buckets=4, **files(tmp_path))
    pipeline.run_daily(spark, cfg)
    parts = glob.glob(f"{cfg.mart('fact_orders')}/version-*/**/*.parquet", recursive=True)
    assert parts
    for f in parts:
        ts = pq.read_table(f, columns=["order_purchase_timestamp"]).column(0).to_pylist()
        present = [t for t in ts if t is not None]
        assert present == sorted(present)
