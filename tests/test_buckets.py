"""Bucketed staging tables: touched buckets only, failed and repeated loads, epochs, retention."""
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ordersmith.operators.upsert import insert_new, upsert
from ordersmith.session import list_dirs
from ordersmith.sinks import buckets as B
from ordersmith.sinks.buckets import BucketTable
from ordersmith.streaming.ingest import order_table, rejected_messages, run_order_stream
from test_streaming import drop, msg

SCHEMA = "k long, v string, w string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def table(spark, tmp_path, buckets=64):
    return BucketTable(spark, str(tmp_path / "t"), frame(spark, []).schema, ["k"], buckets)


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs
               if f.endswith(".parquet"))


def test_upserts_equal_the_full_join(spark, tmp_path):
    t = table(spark, tmp_path, 8)
    target = frame(spark, [])
    loads = [[(i, f"a{i}", "x") for i in range(40)], [(i, None if i % 3 else "b", "y") for i in range(30, 55)],
             [(None, "never", "z"), (7, "c", "z")], []]
    for n, data in enumerate(loads, 1):
        source = frame(spark, data)
        done = t.upsert(source, (0, n), ["v"])
        target = upsert(target, source, ["k"], ["v"])
        assert rows(t.read()) == rows(target)
        assert done.rows == t.count() == target.count()
    assert t.versions() == [(0, 1), (0, 2), (0, 3), (0, 4)]
    assert rows(t.read(before=(0, 2))) == rows(frame(spark, loads[0]))


def test_an_upsert_writes_the_touched_buckets_only(spark, tmp_path):
    t = table(spark, tmp_path)
    everything = spark.range(64_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"),
                                            F.lit("w").alias("w"))
    t.upsert(everything, (0, 1), ["v"])
    one = everything.where(t._bucket(64) == 5).where("k % 2 = 0").withColumn("v", F.lit("new"))
    done = t.upsert(one, (0, 2), ["v"])
    first, second = sorted(list_dirs(spark, f"{t.root}/data"))
    assert done.buckets == 1 and done.rows == 64_000
    assert list_dirs(spark, f"{t.root}/data/{second}") == [f"{B.BUCKET}=5"]
    # about 1/64 of the bytes (less: half of its values are one word now)
    assert folder_bytes(f"{t.root}/data/{second}") < folder_bytes(f"{t.root}/data/{first}") / 50
    plan = t.read()
    assert plan.where("v = 'new'").count() == one.count()
    assert plan.count() == 64_000


def test_inserts_add_folders_and_keep_what_is_there(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "MAX_PARTS", 3)
    t, target = table(spark, tmp_path, 2), frame(spark, [])
    for n in range(1, 8):
        source = frame(spark, [(i, f"load{n}", "") for i in range(n * 3, n * 3 + 9)])
        t.insert_new(source, (0, n))
        target = insert_new(target, source, ["k"])
        assert rows(t.read()) == rows(target)
        owners, _ = t._current(None)
        assert max(sum(o.bucket == b for o in owners) for b in (0, 1)) <= 3


def test_a_failed_load_leaves_the_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, 4)
    t.upsert(frame(spark, [(1, "a", "x"), (2, "b", "x")]), (0, 1), ["v"])
    before = rows(t.read())

    def fail(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_write_list", fail)
        with pytest.raises(RuntimeError, match="lost"):
            t.upsert(frame(spark, [(1, "z", "x")]), (0, 2), ["v"])
    assert rows(t.read()) == before and t.versions() == [(0, 1)]
    again = t.upsert(frame(spark, [(1, "z", "x")]), (0, 2), ["v"])
    assert again.rows == 2 and rows(t.read()) == [(1, "z", "x"), (2, "b", "x")]
    t.upsert(frame(spark, [(1, "y", "x")]), (0, 2), ["v"])          # a repeated version replaces itself
    assert rows(t.read()) == [(1, "y", "x"), (2, "b", "x")]
    assert t.prune(1) == 2                                          # the failed one and the replaced one
    assert rows(t.read()) == [(1, "y", "x"), (2, "b", "x")]


def test_pruning_keeps_what_readers_need(spark, tmp_path):
    t = table(spark, tmp_path, 4)
    for n in range(1, 6):
        t.upsert(frame(spark, [(n, "v", "w"), (100, str(n), "w")]), (0, n), ["v"])
    old = t.read(before=(0, 5))
    want = rows(old)
    t.prune(2)
    assert t.versions() == [(0, 4), (0, 5)]
    assert rows(old) == want and t.count() == 6
    assert table(spark, tmp_path / "none").prune() == 0


def test_the_number_of_buckets_is_the_first_loads(spark, tmp_path):
    table(spark, tmp_path, 4).upsert(frame(spark, [(i, "a", "") for i in range(50)]), (0, 1), ["v"])
    t = table(spark, tmp_path, 16)
    t.upsert(frame(spark, [(i, "b", "") for i in range(25, 60)]), (0, 2), ["v"])
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert got == {i: "a" if i < 25 else "b" for i in range(60)}


def test_a_lost_checkpoint(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "table")
    ckpt = str(tmp_path / "ckpt")
    drop(src, "d1", [msg("1", "processing", "2017-01-01T10:00:00"), msg("2", "shipped", "2017-01-01T10:00:00")])
    run_order_stream(spark, f"{src}/*", root, ckpt)
    drop(src, "d2", [msg("1", "shipped", "2017-01-02T10:00:00")])
    run_order_stream(spark, f"{src}/*", root, ckpt)
    drop(src, "d3", [msg("1", "delivered", "2017-01-03T10:00:00"), msg("3", "approved", "2017-01-03T10:00:00"),
                     "{not json"])
    out = run_order_stream(spark, f"{src}/*", root, str(tmp_path / "new-ckpt"))
    want = [("1", "delivered"), ("2", "shipped"), ("3", "approved")]
    assert rows(out.select("order_id", "order_status")) == want
    assert order_table(spark, root).versions()[-1] == (2, 0)
    drop(src, "d4", [msg("2", "canceled", "2017-01-04T10:00:00")])
    out = run_order_stream(spark, f"{src}/*", root, str(tmp_path / "new-ckpt"))
    assert ("2", "canceled") in rows(out.select("order_id", "order_status"))
    assert [r["value"] for r in rejected_messages(spark, f"{root}-rejects").collect()] == ["{not json"]


@pytest.mark.parametrize("statuses", [["processing", "shipped"],
                                      ["shipped", "delivered", "processing", "shipped"]])
def test_ties_in_a_stream_go_to_the_later_line(spark, tmp_path, statuses):
    when = "2020-01-01T00:00:00"
    pad = [msg(f"p{i}", "approved", when) for i in range(500)]
    drop(tmp_path / "in", "d1", [*pad, *[msg("1", s, when) for s in statuses], *pad])
    out = run_order_stream(spark, f"{tmp_path}/in/*", str(tmp_path / "t"), str(tmp_path / "c"))
    assert json.loads(msg("1", "x", when))["order_id"] == "1"
    assert out.where("order_id = '1'").first()["order_status"] == statuses[-1]
