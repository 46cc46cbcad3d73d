"""What a daily run leaves on disk while it goes on."""
import glob
import os
import time

import pytest

from conftest import SF_SMALL
from ordersmith.plans import jobs, registry
from ordersmith.sinks import staging
from ordersmith.sources import testbed as tb
from ordersmith.sources.files import read_csv, read_order_items
from test_jobs import files, write_csv


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def settled(spark, before):
    """The shuffle files that are new, once the cleaner had its time."""
    for _ in range(20):
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.5)
    return new


def config(tmp_path, **more):
    return jobs.Config(root=str(tmp_path / "lake"), buckets=4, **{**files(tmp_path), **more})


def test_steps_of_a_run_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    cfg, left = config(tmp_path), {}

    def watched(name):
        step = getattr(jobs, name)

        def run(*args, **kw):
            before = shuffle_files(spark)
            out = step(*args, **kw)
            left[name] = settled(spark, before)
            return out
        monkeypatch.setattr(jobs, name, run)

    for name in ("ingest_job", "load_reference_files", "build_marts"):
        watched(name)
    jobs.run_daily(spark, cfg)
    assert left == {"ingest_job": set(), "load_reference_files": set(), "build_marts": set()}


def test_topics_are_compressed_in_small_files_and_read_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "MESSAGES_PER_FILE", 2)
    # the same payment five times: the last in the file is kept
    payments = write_csv(tmp_path / "p5.csv", ["order_id", "payment_sequential", "payment_type", "payment_installments",
                                               "payment_value"],
                         [("o1", "1", "voucher", "1", str(v)) for v in (5, 4, 3, 2, 9)])
    cfg = config(tmp_path, payments_csv=payments)
    staged = jobs.load_all(spark, cfg, (jobs.publish_events(spark, cfg, 1), 1)[1])
    sent = glob.glob(f"{cfg.topic_dir('payments')}/run-000000001/part-*")
    assert len(sent) == 3 and all(f.endswith(".gz") for f in sent)
    assert staged["raw_payments"] == 1
    assert float(jobs.staged(spark, cfg, "raw_payments").first()["payment_value"]) == 9


def test_the_first_row_of_an_item_wins_over_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "MESSAGES_PER_FILE", 2)
    names = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    data = [("o1", "1", f"p{k}", "s1", "2017-09-19 09:00:00", "5", "1") for k in (7, 3, 9, 1, 4)]
    path = str(tmp_path / "items")
    staging.in_small_files(spark.createDataFrame(data, names).coalesce(1).write).csv(path, header=True)
    assert len(glob.glob(f"{path}/part-*.csv.gz")) == 3 and read_order_items(spark, path).count() == 5
    cfg = config(tmp_path, order_items_csv=path)
    assert jobs.load_reference_files(spark, cfg, 1) == {"raw_sellers": 2, "raw_order_items": 1}
    assert jobs.staged(spark, cfg, "raw_order_items").first()["product_id"] == "p7"


@pytest.mark.parametrize("broken", [False, True])
def test_exports_hold_the_rows_of_the_tables(spark, tmp_path, monkeypatch, broken):
    monkeypatch.setattr(staging, "MESSAGES_PER_FILE", 100)
    t = tb.Tables(spark, SF_SMALL)
    paths = registry._csv_files(t, str(tmp_path), broken)
    df = tb.raw_payments(t)
    df = df.select(*[df[c].cast("string") for c in df.columns])
    got = read_csv(spark, paths["payments_csv"], df.schema)
    assert len(glob.glob(f"{paths['payments_csv']}/part-*.gz")) > 1
    if not broken:
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert got.count() == df.count()


def test_tables_are_written_by_the_smaller_codec(spark, tmp_path):
    cfg = config(tmp_path)
    jobs.load_all(spark, cfg, (jobs.publish_events(spark, cfg, 1), 1)[1])
    written = glob.glob(f"{cfg.root}/staging/*/data/**/*.parquet", recursive=True)
    assert written and all(os.path.basename(f).endswith(".zstd.parquet") for f in written)
