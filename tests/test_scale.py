"""Steps whose files, rows or joins are to stay in proportion to the input."""
import glob
import gzip
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ordersmith.plans import registry
from ordersmith.session import scratch_path, shared_dir
from ordersmith.sinks import buckets, staging
from ordersmith.sources.topic import read_topic
from ordersmith.streaming.ingest import _ranked
from test_buckets import frame, table


def test_same_time_files_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(registry, "FILE_BYTES", 1 << 14)
    base = shared_dir(spark).split(":", 1)[-1]
    before = set(glob.glob(f"{base}/topic-ties-*"))
    assert registry.q_same_time_orders(spark, SF_SMALL).count() > 0
    (new,) = set(glob.glob(f"{base}/topic-ties-*")) - before
    first, second = (len(glob.glob(f"{new}/run-00000000{k}/part-*")) for k in (1, 2))
    assert 1 < first < second


def test_message_files_are_compressed_small_and_in_order(spark, monkeypatch):
    monkeypatch.setattr(staging, "MESSAGES_PER_FILE", 700)
    path = scratch_path(spark, "messages")
    staging.write_messages(spark.range(0, 5000, 1, 2).select(
        F.concat(F.lit("a message of the same length, number "), F.col("id")).alias("value")), path)
    files = sorted(glob.glob(f"{path.split(':', 1)[-1]}/part-*"))
    texts = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert max(map(len, texts)) <= 700 and len(files) == 8
    assert [int(t.split()[-1]) for part in texts for t in part] == list(range(5000))
    assert sum(map(os.path.getsize, files)) < 5000 * 40 / 2
    placed = read_topic(spark, "t", path).orderBy("source", "offset").select(F.col("value").cast("string"))
    assert [int(r[0].split()[-1]) for r in placed.collect()] == list(range(5000))


def test_sources_are_ranked_in_their_order(spark):
    names = ["file:/b/part-2#0", "file:/a/part-1#0", "file:/a/part-10#0", None, "file:/a/part-1#7", "file:/a/part-1#0"]
    got = _ranked(spark.createDataFrame([(n, i) for i, n in enumerate(names)], "source string, offset long"))
    rank = {r["offset"]: r["source"] for r in got.collect()}
    assert rank[3] is None and len(rank) == len(names)
    known = [i for i, n in enumerate(names) if n]
    assert all((names[i] < names[j]) == (rank[i] < rank[j]) for i in known for j in known)


def test_a_first_load_looks_nothing_up(spark, tmp_path, monkeypatch):
    def never(*_):
        raise AssertionError("an empty table needs no look-up")

    monkeypatch.setattr(buckets._Incoming, "__enter__", never)
    data = [(1, "a", None), (2, None, "y"), (None, "b", "z")]
    t = table(spark, tmp_path)
    assert t.upsert(frame(spark, data).drop("w"), (0, 1), ["v"]).rows == 2
    assert rows(t.read()) == [(1, "a", None), (2, None, None)]
    other = table(spark, tmp_path / "other")
    assert other.insert_new(frame(spark, data), (0, 1)).rows == 2
    assert rows(other.read()) == [(1, "a", None), (2, None, "y")]
