"""What a task holds at once, and how texts reach it."""
import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
from ordersmith.llm import arrays as ar
from ordersmith.llm import repeats, suffix_dedup

WORDS = [f"{w}{i}" for i in range(400) for w in ("alpha", "Beta", "gam-ma", "d")]


def texts(n_bytes, seed=1):
    rng = np.random.default_rng(seed)
    out, size = [], 0
    while size < n_bytes:
        out.append(" ".join(rng.choice(WORDS, 300)))
        size += len(out[-1])
    return out


def peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_windows_of_a_batch_are_not_in_memory_together():
    rows = texts(4_000_000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows)], names=["doc", "text"])
    spec = repeats.Spec(words=False, size=100, k=32, by_doc=False)
    run = repeats._anchor_rows(spec, np.zeros(0, ar.U64))
    ar.powers(1 << 21)
    assert peak(lambda: [None for _ in run(iter([batch]))]) < 64 << 20


def test_texts_reach_the_pipelines_tasks_in_small_batches(spark, monkeypatch):
    """Rows of 4 KB: 10,000 of them would be a batch of 40 MB."""
    rows = spark.range(6000).selectExpr("id as doc_id", "repeat(concat(id, ' word '), 400) as text").coalesce(1)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def sized(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["b"])

    seen = []
    monkeypatch.setattr(corpus_pipeline, "remove_repeats", lambda docs: seen.append(
        [r["b"] for r in docs.mapInArrow(sized, "b long").collect()]) or docs)
    try:
        corpus_pipeline.repeated_text(spark, rows, "")
        assert sum(seen[0]) > 16e6 and max(seen[0]) < 10e6
    finally:
        spark.conf.set(key, before)


def test_suffix_sort_does_not_depend_on_the_blocks(spark, monkeypatch):
    some = texts(30_000, 8)
    rows = [(i, t) for i, t in enumerate([*some, some[0][:400], "x" * 300 + some[1][50:700], "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cols = ["doc_id", "n_removed", "n_spans", "kept"]

    def result():
        return sorted(map(tuple, suffix_dedup.suffix_dedup(docs).select(*cols).collect()))

    whole = result()
    assert sum(r[1] for r in whole) > 1000
    monkeypatch.setattr(repeats, "BLOCK", 2000)
    assert result() == whole
