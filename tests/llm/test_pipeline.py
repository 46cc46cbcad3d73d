"""The corpus pipeline: every stage on its own input, against brute force where there is one."""
import corpus_pipeline
from conftest import SF_SMALL
from ordersmith.llm.decontaminate import _item_words, lcs_length
from ordersmith.llm.staging import stage
from test_documents import components, cut_bytes


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination",
        "mixing_to_weights"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in
              spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    items = [_item_words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        df = stage(step(spark, docs, SF_SMALL), "test-pipeline")
        rows = df.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(after) and after.keys() <= before.keys()
        if k < 4:
            assert df.columns == docs.columns
        if k == 0:
            clean = [i for i in before if labels.get(i) == (1, 0)]
            assert sum(i in after for i in clean) >= 0.95 * len(clean)
            assert all(after[i] == before[i] for i in after)
        if k == 1:
            roots, _ = components(list(before.items()))
            assert after == {i: t for i, t in before.items() if roots[i] == i}
        if k == 2:
            want = {i: n - cut for i, n, cut, _, _ in cut_bytes(list(before.items()), 100)}
            gone = {i for i, t in before.items() if t and not want[i]}
            assert before.keys() - after.keys() == gone
            for i, t in after.items():
                assert 0 <= want[i] - len((t or "").encode()) <= 3 * 200
        if k == 3:
            for i, t in before.items():
                words = _item_words(t) if t else []
                whole = any(lcs_length(x, words[s:s + 2 * len(x)]) >= 0.95 * len(x)
                            for x in items for s in range(0, max(1, len(words) - len(x)), max(1, len(x) // 2)))
                assert not (whole and i in after)
            assert len(after) >= 0.8 * len(before)
        if k == 4:
            assert after == before
            assert len({r["position"] for r in rows}) == len(rows)
        docs, before = df, after


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "text", "slot", "position", "on_target"} <= set(out.columns)
    assert 0 < out.count() <= spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
