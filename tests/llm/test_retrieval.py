"""Retrieval in the latent space: every passage is compared with every benchmark item."""
import random

import numpy as np
import pyarrow as pa
import pytest
from ordersmith.llm import arrays as ar
from ordersmith.llm import decontaminate as dc
from ordersmith.llm.decontaminate import CELL, contamination, remove_contaminated

WORDS = [f"word{i}" for i in range(500)]


class Sent:
    """Stands for a broadcast."""
    def __init__(self, value):
        self.value = value


def words_of(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def space(items, rank=24, seed=3, texts=()):
    """Weights, scaled basis (that of the texts, or any), the pieces' vectors and items."""
    rng = np.random.default_rng(seed)
    idf = (rng.random(dc.FEATURES) + 0.5).astype(np.float32)
    pieces = [(p, i) for i, it in enumerate(items) for p in it.pieces]
    if texts:
        products = np.zeros((dc.FEATURES, rank + dc.OVERSAMPLING), np.float32)
        dc._add_products(products, pa.array(texts), idf, dc._test_matrix(7, products.shape[1]) * idf[:, None])
        basis = dc.latent_basis(products * idf[:, None], [p for p, _ in pieces], idf, rank)
    else:
        basis = np.linalg.qr(rng.standard_normal((dc.FEATURES, rank)))[0].astype(np.float32)
    scaled = basis * idf[:, None]
    vec, owner = dc._item_vectors(pieces, idf, scaled)
    return idf, scaled, vec, owner


def items_of(texts):
    return dc._next_items(iter([{"item_id": 100 + k, "text": t} for k, t in enumerate(texts)]))


@pytest.mark.parametrize("folded", [True, False])
def test_cosines_of_all_passages_with_all_items(folded, monkeypatch):
    monkeypatch.setattr(dc, "PROJECTED", 5)
    rng = random.Random(1)
    items = items_of([words_of(rng, n) for n in (10, 150, 1, 64, 65)])
    idf, scaled, vec, owner = space(items)
    assert len(owner) == 8
    docs = ["", words_of(rng, 3), words_of(rng, 16), None, words_of(rng, 17), words_of(rng, 300), "", words_of(rng, 80)]
    block = next(ar.blocks(pa.array(docs)))
    table, turn = dc._projection(scaled, vec) if folded else (scaled, vec)
    assert (turn is None) == folded
    lead = np.searchsorted(owner, np.arange(len(items)))
    got, passages = dc._cosines(block.words(lower=True), idf, table, turn, lead)
    want = []
    for text in docs:
        f = dc._feature(np.array(dc._item_words(text), ar.U64)) if text else np.zeros(0, np.int64)
        cells = -(-len(f) // CELL)
        for p in range(max(cells - 1, min(cells, 1))):
            own = f[p * CELL:(p + 2) * CELL]
            close = scaled[own].sum(0) @ vec.T / np.sqrt((idf[own].astype(float) ** 2).sum())
            want.append([close[owner == k].max() for k in range(len(items))])
    assert passages.tolist() == [0, 0, 1, 2, 2, 3, 21, 21, 25] and len(got) == len(want)
    assert np.allclose(got, want, atol=1e-5)


def test_the_narrower_table_is_sent():
    items = items_of([" ".join(WORDS[:200]), "a b c"])
    _, scaled, vec, _ = space(items, rank=5)
    assert dc._projection(scaled, vec)[0].shape == (dc.FEATURES, len(vec)) == (dc.FEATURES, 5)
    _, scaled, vec, _ = space(items, rank=4)
    assert dc._projection(scaled, vec)[0] is scaled


def found(texts, items, monkeypatch, threshold, by_words):
    idf, scaled, vec, owner = space(items, rank=64, texts=texts)
    table, turn = dc._projection(scaled, vec)
    known = dc._candidates
    if not by_words:                       # no span is a candidate by its words
        def none(words, vocab, first_of, held, need, reach):
            d, lo, hi, k, own, word = known(words, vocab, first_of, held, need, reach)
            return d[:0], lo[:0], hi[:0], k[:0], own, word
        monkeypatch.setattr(dc, "_candidates", none)
    run = dc._matches(idf, Sent(table), turn, owner, items, threshold, 0.5, 0.7, 0.7)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc", "text"])
    out = [tuple(r.values()) for b in run(iter([batch])) for r in b.to_pylist()]
    monkeypatch.setattr(dc, "_candidates", known)
    return sorted(out)


def test_passages_that_are_close_are_candidates_by_themselves(monkeypatch):
    rng = random.Random(2)
    asked = [words_of(rng, n) for n in (30, 40, 90)]
    texts = [words_of(rng, 60) + " " + asked[k % 3] + " " + words_of(rng, 25) if k % 2 else words_of(rng, 90)
             for k in range(24)] + [None, "", asked[0]]
    items = items_of(asked)
    close = found(texts, items, monkeypatch, 0.3, by_words=False)
    assert {(d, k) for d, k, *_ in close} >= {(d, 100 + d % 3) for d in range(1, 24, 2)} | {(26, 100)}
    whole = found(texts, items, monkeypatch, 0.3, by_words=True)
    assert found(texts, items, monkeypatch, 2.0, by_words=True) == whole == close
    assert found(texts, items, monkeypatch, 2.0, by_words=False) == []
    assert found(texts, items, monkeypatch, -2.0, by_words=False) == whole


def test_no_leak_depends_on_the_threshold(spark):
    rng = random.Random(4)
    asked = [(k, words_of(rng, 20 + k)) for k in range(6)] + [(9, " "), (10, " "), (None, "x")]
    rows = [(k, words_of(rng, 50) + " " + (asked[k % 6][1] if k % 4 else "")) for k in range(60)]
    docs = spark.createDataFrame([*rows, (None, asked[0][1]), (99, None)], "doc_id long, text string")
    bench = spark.createDataFrame(asked, "item_id long, text string")
    out = {t: sorted(map(str, contamination(docs, bench, rank=20, threshold=t).collect())) for t in (0.3, 2.0)}
    assert out[0.3] == out[2.0] and len(out[0.3]) >= 46


def test_the_pipeline_drops_the_same_documents(spark):
    rng = random.Random(6)
    asked = [(k, words_of(rng, 25)) for k in range(3)]
    rows = [(k, words_of(rng, 70) + (" " + asked[k % 3][1] if k % 5 == 0 else "")) for k in range(30)]
    docs = spark.createDataFrame([*rows, (None, words_of(rng, 20)), (31, None)], "doc_id long, text string")
    bench = spark.createDataFrame(asked, "item_id long, text string")
    left = {t: {r["doc_id"] for r in remove_contaminated(docs, bench, rank=20, threshold=t).collect()} for t in (0.3, 2.0)}
    assert left[0.3] == left[2.0] == {k for k in range(30) if k % 5} | {None, 31}
