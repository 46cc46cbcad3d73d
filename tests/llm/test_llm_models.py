"""Language models, decontamination, mixing, embeddings."""
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from ordersmith.llm import embedding_dedup as ed
from ordersmith.llm import quality_lm as ql
from ordersmith.llm import decontaminate as dc
from ordersmith.llm.decontaminate import contamination, lcs_length, remove_contaminated
from ordersmith.llm.elias_fano import EliasFano, from_buffer, to_bytes
from ordersmith.llm import arrays as ar
from ordersmith.llm import lm_scoring
from ordersmith.llm.lm_scoring import score_texts
from ordersmith.session import list_dirs, shared_dir
from ordersmith.llm.mixing import edf_frame, frame_shares, mix_sources
from test_documents import AWKWARD, SCHEMA, WORD, awkward


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.integers(0, 50))
def test_elias_fano_finds_what_it_holds(values, shift):
    v = np.unique(np.array(values, np.uint64) >> np.uint64(shift))
    e = EliasFano(from_buffer(to_bytes(EliasFano.build(v))))
    assert (e.at(np.arange(len(v))) == v).all()
    assert (e.find(v) == np.arange(len(v))).all()
    other = v ^ np.uint64(1)
    assert (e.find(other) == [int(np.searchsorted(v, x)) if x in v else -1 for x in other]).all()


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def brute_scores(pairs):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in pairs]
    uni, bi = Counter(), Counter()
    for (_, t), h in zip(pairs, held):
        if not h:
            ts = tokens(t)
            uni.update(ts)
            bi.update(zip([None] + ts[:-1], ts))
    n, bottom = sum(uni.values()), sum(uni.values()) + len(uni) + 1
    mass = Counter()
    for (v, _), c in bi.items():
        if c >= 2:
            mass[v] += c - 0.75
    for (i, t), h in zip(pairs, held):
        ts = tokens(t)
        base = score = 0.0
        for v, w in zip([None] + ts[:-1], ts):
            p = (uni[w] + 1) / bottom
            base += math.log10(p)
            if uni[v]:
                c = bi[v, w]
                p = (c - 0.75 if c >= 2 else 0) / uni[v] + (1 - mass[v] / uni[v]) * p
            score += math.log10(p)
        yield i, h, len(ts), sum(uni[w] > 0 for w in ts), n, base, score


@pytest.mark.parametrize("source", ["table", "awkward"])
def test_scores_equal_brute_force(spark, source):
    if source == "table":
        df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
        pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    else:
        df, pairs = awkward(spark), [r[:2] for r in AWKWARD]
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   r["base_score"], r["score"]) for r in score_texts(df).collect()), key=repr)
    want = sorted(brute_scores(pairs), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=0.05)      # probabilities are quantised
    held = [(g, w) for g, w in zip(got, want) if g[1]]
    if source == "table":
        assert sum(g[6] for g, _ in held) > sum(g[5] for g, _ in held)


def test_words_that_agree_in_forty_bits_of_their_hash(spark):
    """A frequent and a rare second word, told apart only by the last bits of their hashes."""
    text = " ".join(f"w{i}" for i in range(3_000_000))
    hashes = np.concatenate([b.words().hashes for b in ar.blocks(pa.array([text]))])
    order = np.argsort(hashes)
    near = np.flatnonzero((hashes[order][1:] >> np.uint64(24)) == (hashes[order][:-1] >> np.uint64(24)))
    frequent, rare = (f"w{order[near[0] + k]}" for k in (0, 1))
    pairs = [(i, f"x {frequent} y") for i in range(40)] + [(100 + i, f"x {rare} z x {rare}") for i in range(9)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in score_texts(df).collect()}
    for i, *_, score in brute_scores(pairs):
        assert got[i] == pytest.approx(score, rel=1e-6)


@pytest.mark.parametrize("words", [0, 3, 60])
def test_scores_do_not_depend_on_the_tables_of_common_words(spark, monkeypatch, words):
    """Words beyond the bounded tables are written out and their counts asked for by join."""
    monkeypatch.setattr(lm_scoring, "COMMON_WORDS", words)
    monkeypatch.setattr(lm_scoring, "BOOK_WORDS", words)
    monkeypatch.setattr(lm_scoring, "SAMPLE", 1.0)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in score_texts(df).collect())
    want = sorted(brute_scores(pairs))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=0.05)


def test_counts_are_deleted_once_the_tries_are_written(spark):
    before = set(list_dirs(spark, shared_dir(spark)))
    df = spark.createDataFrame([(i, "a b c a b") for i in range(20)], "doc_id long, text string")
    assert score_texts(df).count() == 20
    new = set(list_dirs(spark, shared_dir(spark))) - before
    assert [n.rsplit("-", 1)[0] for n in new] == ["lm-tries"]


def test_scores_of_an_empty_table(spark):
    assert score_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def small(spark):
    return (spark.read.parquet(f"{SF_SMALL}/documents.parquet"),
            spark.read.parquet(f"{SF_SMALL}/labels.parquet"))


def test_kneser_ney_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([("a b a c b a d a b",), ("b a b c c a",), ("a a b d",)], "text string")
    for order in (2, 3):
        table, n, unknown = ql.fit_terms(texts, order)
        model = ql.QualityModel(table, n, unknown, order)
        for head in ("a", "a b", "c"):
            words = ["a", "b", "c", "d", "zz"]
            df = spark.createDataFrame([(f"{head} {w}",) for w in words] + [(head,)], "text string")
            got = {r["text"]: r["log10_prob"] for r in ql.log_probs(df, "text", model).collect()}
            total = sum(10 ** (got[f"{head} {w}"] - got[head]) for w in words)
            assert total == pytest.approx(1.0, abs=1e-4)


def test_quality_classifier(spark):
    docs, labels = small(spark)
    model = ql.fit_quality_model(docs, labels)
    out = ql.classify(docs, model)
    by_join = ql.log_probs(docs, "text", model, in_tasks_up_to=0)
    a = {r["doc_id"]: r["log10_prob"] for r in out.collect()}
    b = {r["doc_id"]: r["log10_prob"] for r in by_join.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-2) for k in a)
    judged = out.join(labels, "doc_id")
    clean = judged.where("quality = 1 and toxic = 0")
    assert clean.where("accepted").count() >= 0.95 * clean.count()
    odd = ql.classify(awkward(spark).withColumnRenamed("source", "lang"), model)
    assert odd.count() == len(AWKWARD)
    assert odd.where("n_words = 0 and accepted and perplexity is null").count() == 3
    assert ql.keep_accepted(docs, labels).columns == docs.columns


def test_quality_classifier_trains_on_half_of_all_trusted_documents(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "'en' as lang", "concat('w', id) as text")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    model = ql.fit_quality_model(docs, labels)
    half = sum(int(hashlib.md5(str(i).encode()).hexdigest()[-1], 16) % 2 == 0 for i in range(9000))
    assert model.n_terms == 2 * half + 1          # a word and a bigram each, one context
    counted = spark.createDataFrame([("w1 w2 w3 w1",), ("w1 w2 w3 w1",), ("w5 w5 q",), ("",), (None,)], "text string")
    texts = spark.createDataFrame([("a a b a b c",), ("a b d",), ("w1 w2",)], "text string")
    table, n, unknown = ql.fit_terms(texts.unionByName(counted.where("text is not null")), 2)
    model = ql.QualityModel(table, n, unknown, 2)
    whole = sorted(map(repr, ql.log_probs(counted, "text", model).selectExpr("text", "round(log10_prob, 4)").collect()))
    for some in (0, 3, 8):                        # the most frequent terms in the tasks, the others by join
        parts = ql.log_probs(counted, "text", model, in_tasks_up_to=some)
        assert sorted(map(repr, parts.selectExpr("text", "round(log10_prob, 4)").collect())) == whole


def test_pair_hash_is_that_of_spark(spark):
    rows = [(0, 0), (-1, 7), (2 ** 62, -2 ** 63)]
    want = spark.createDataFrame(rows, "a long, b long").selectExpr("xxhash64(a, b) as h").collect()
    a, b = (np.array(x, np.int64).view(np.uint64) for x in zip(*rows))
    assert [r["h"] for r in want] == ql._pair_hash(a, b).view(np.int64).tolist()


def test_packed_keys_come_back():
    rng = np.random.default_rng(3)
    for n in (1, 2, 500):
        keys = np.sort(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        for kind in (np.uint16, np.float32):
            values = rng.integers(0, 60000, n).astype(kind)
            got = ql._unpack(ql._pack(keys, values), kind)
            assert (got[0] == keys).all() and (got[1] == values).all()


@pytest.mark.parametrize("order", [2, 3])
def test_quality_model_and_scores_in_slices(spark, monkeypatch, order):
    """Contexts joined and texts asked a slice at a time, without broadcast, with copies of texts."""
    docs = small(spark)[0].limit(60).select("text")
    docs = docs.unionByName(docs.limit(20)).unionByName(spark.createDataFrame([(None,), ("",)], "text string"))

    def scores(**options):
        model = ql.QualityModel(*ql.fit_terms(docs.limit(30), order), order)
        return sorted((r["text"] or "", r["n_words"], round(r["log10_prob"], 2))
                      for r in ql.log_probs(docs, "text", model, **options).collect())

    whole = scores()
    for name, value in (("WORDS", 0), ("SLICE_BYTES", 0), ("SLICES", 3)):
        monkeypatch.setattr(ql, name, value)
    parts = scores(in_tasks_up_to=5)
    assert [w[:2] for w in whole] == [p[:2] for p in parts] and len(parts) == 82
    assert all(abs(w[2] - p[2]) <= 0.02 for w, p in zip(whole, parts))


def test_rejection_with_a_large_model_does_not_shuffle_texts(spark, monkeypatch):
    docs, labels = small(spark)
    whole = {r["doc_id"] for r in ql.keep_accepted(docs, labels).collect()}
    monkeypatch.setattr(ql, "MODEL_ROWS", 100)
    kept = ql.keep_accepted(docs, labels)
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"] for r in kept.collect()} == whole and kept.columns == docs.columns


def plans_of(monkeypatch, name):
    """Plans of the tables that are staged under ``name`` from here on."""
    plans, stage = [], ql.stage

    def staged(df, to):
        if to == name:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, to)

    monkeypatch.setattr(ql, "stage", staged)
    return plans


def test_texts_are_asked_once_and_terms_dealt_once(spark, monkeypatch):
    docs, labels = small(spark)
    whole = {r["doc_id"]: r["log10_prob"] for r in
             ql.classify(docs, ql.fit_quality_model(docs, labels)).collect()}
    for name, value in (("MODEL_ROWS", 100), ("SLICE_BYTES", 0), ("SLICES", 3)):
        monkeypatch.setattr(ql, name, value)
    plans = plans_of(monkeypatch, "kn-sums")
    model = ql.fit_quality_model(docs, labels)
    got = {r["doc_id"]: r["log10_prob"] for r in ql.classify(docs, model).collect()}
    assert got.keys() == whole.keys() and all(got[k] == pytest.approx(whole[k], abs=1e-2) for k in got)
    assert len(plans) == 3                        # for thresholds and decisions together
    for p in plans:                               # the terms lie by shard, only what is asked is shuffled
        assert "InMemoryTableScan" in p
        above = p.split("InMemoryRelation")[0]
        assert above.count("hashpartitioning(shard") == 1, p
    other = docs.limit(5)                         # not the frame that was scored
    assert ql.classify(other, model).count() == 5 and len(plans) > 3


def test_many_words_are_not_broadcast(spark, monkeypatch):
    plans = plans_of(monkeypatch, "kn-terms")
    monkeypatch.setattr(ql, "SLICES", 2)
    texts = spark.range(120_000).selectExpr("concat('a', id, ' b', id) as text")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)      # only what the library asks for
    try:
        _, n, _ = ql.fit_terms(texts, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert n == 240_000 + 120_001 + 240_000       # words, contexts, bigrams
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)


def test_quality_classifier_without_trusted_documents(spark):
    docs, labels = small(spark)
    assert ql.fit_quality_model(docs, labels.limit(0)) is None
    assert ql.keep_accepted(docs, labels.limit(0)).count() == docs.count()
    assert ql.keep_accepted(docs.limit(0), labels).count() == 0


def test_lcs_length():
    assert lcs_length([1, 2, 3, 4], [2, 9, 4, 1]) == 2
    assert lcs_length([], [1]) == 0 and lcs_length([5], []) == 0


def test_lcs_of_many_texts_at_once():
    rng = np.random.default_rng(5)
    vocab = np.arange(12, dtype=np.uint64)
    items = [rng.integers(0, 12, n).tolist() for n in (0, 1, 7, 63, 64)]
    word = rng.integers(0, 12, 400)
    k, begin = rng.integers(0, 5, 300), rng.integers(0, 400, 300)
    end = np.minimum(begin + rng.integers(0, 90, 300), 400)
    got = dc._lcs_lengths(dc._word_bits(items, vocab), np.array([len(i) for i in items]), k, word, begin, end)
    assert got.tolist() == [lcs_length(items[i], word[a:b].tolist()) for i, a, b in zip(k, begin, end)]


def test_words_are_found_by_leading_bits():
    rng = np.random.default_rng(2)
    vocab = np.unique(np.append(rng.integers(0, 2 ** 64, 300, dtype=np.uint64), np.arange(9, dtype=np.uint64) * 3))
    asked = np.append(rng.choice(vocab, 500), rng.integers(0, 40, 500).astype(np.uint64))
    place, number = dc._known(asked, vocab, dc._directory(vocab))
    assert place.tolist() == np.flatnonzero(np.isin(asked, vocab)).tolist()
    assert (vocab[number] == asked[place]).all()


def test_cells_that_hold_a_feature_and_products_of_cells():
    texts = pa.array(["a b a c " * 9, "", None, "a " * 40, "q"])
    df, total, y = Counter(), 0, np.zeros((dc.FEATURES, 4), np.float32)
    w = dc._test_matrix(7, 4)
    for block in ar.blocks(texts):
        words = block.words(lower=True)
        for lo, hi in zip(words.offs[:-1], words.offs[1:]):
            for at in range(lo, hi, dc.CELL):
                cell = dc._feature(words.hashes[at:min(at + dc.CELL, hi)])
                df.update(set(cell.tolist()))
                total += 1
                for f in cell:
                    y[f] += w[cell].sum(0)
    rows = next(dc._frequencies(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    assert dict(zip(*(c.to_pylist() for c in rows.columns))) == {**df, -1: total}
    out = np.zeros_like(y)
    dc._add_products(out, texts, np.ones(dc.FEATURES, np.float32), w)
    assert np.allclose(out, y, rtol=1e-4, atol=1e-3)


def test_contamination_finds_copies_and_paraphrases(spark):
    docs, _ = small(spark)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    chosen = sorted(items)[:4]
    rows = []
    clean = [r["text"] for r in docs.orderBy("doc_id").limit(12).collect()]
    for k, i in enumerate(chosen):
        words = items[i].split()
        changed = [w if j % 8 else "changed" for j, w in enumerate(words)]
        rows.append((9000 + 2 * k, clean[k] + " " + items[i].upper() + " " + clean[k + 1]))
        rows.append((9001 + 2 * k, clean[k + 2] + " " + " ".join(changed) + " " + clean[k + 3]))
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in
           contamination(docs.select("doc_id", "text").unionByName(planted), bench).collect()}
    assert {(9000 + 2 * k + d, i) for k, i in enumerate(chosen) for d in (0, 1)} <= got
    assert len({d for d, _ in got if d < 9000}) < 0.2 * docs.count()


def test_contamination_learns_its_space_from_every_text(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 300, 40)) for _ in range(4000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    idf = np.linspace(0.1, 2, dc.FEATURES).astype(np.float32)
    rank = 24
    got = dc.corpus_products(docs, idf, rank)
    rows, cols = [], []
    for t in texts:                               # A'(A W) by the book
        feature = dc._feature(np.array(dc._item_words(t), np.uint64))
        for at in range(0, len(feature), dc.CELL):
            rows.append(feature[at:at + dc.CELL])
    used = np.unique(np.concatenate(rows))
    a = np.zeros((len(rows), len(used)))
    for i, r in enumerate(rows):
        np.add.at(a[i], np.searchsorted(used, r), idf[r])
    w = dc._test_matrix(7, rank + dc.OVERSAMPLING)
    want = a.T @ (a @ w[used])
    assert np.allclose(got[used], want, rtol=1e-3, atol=1e-3 * abs(want).max())
    assert not got[np.setdiff1d(np.arange(dc.FEATURES), used)].any()
    basis = dc.latent_basis(got, ["v1 v2 v3"], idf, rank)
    assert basis.shape == (dc.FEATURES, rank) and np.allclose(basis.T @ basis, np.eye(rank), atol=1e-4)
    best = np.linalg.eigvalsh(a.T @ a)[::-1][:rank].sum()
    kept = ((a @ basis[used]) ** 2).sum()
    assert 0.7 * best <= kept <= best * 1.001


def test_contamination_awkward_rows(spark):
    bench = spark.createDataFrame([(1, AWKWARD[0][1]), (2, None), (3, ""), (None, "x y z")],
                                  "item_id long, text string")
    df = awkward(spark)
    got = [(r["doc_id"], r["item_id"]) for r in contamination(df, bench).collect()]
    assert sorted(got, key=repr) == sorted([(r[0], 1) for r in AWKWARD if "part0" in (r[1] or "")], key=repr)
    kept = remove_contaminated(df, bench)
    assert kept.columns == df.columns
    assert kept.where("doc_id in (1, 5, 7)").count() == 0 and kept.where("doc_id is null").count() == 2
    assert contamination(df, bench.limit(0)).count() == 0
    assert contamination(df.limit(0), bench).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.floats(0.01, 100), min_size=1,
                       max_size=12))
def test_frame_keeps_every_source_within_one_block(weights):
    share, frame = frame_shares(weights, 240)
    assert sum(share.values()) == frame == 240
    slots = edf_frame(share, frame)
    assert sorted(t for _, _, t in slots) == list(range(frame))
    done = Counter()
    for s, j, t in sorted(slots, key=lambda x: x[2]):
        assert j * frame // share[s] <= t < -(-(j + 1) * frame // share[s])
        done[s] += 1
        for x in share:
            assert abs(done[x] - share[x] * (t + 1) / frame) < 1


def test_mixing_places_every_row(spark):
    docs, _ = small(spark)
    out = mix_sources(docs, block_rows=4).toPandas()
    assert len(out) == docs.count() and out["position"].is_unique
    assert ((out["slot"] >= out["release"]) & (out["slot"] < out["deadline"])).all()
    sizes = out.groupby(["source", "block"]).size()
    for s, g in sizes.groupby(level=0):
        assert (g.values[:-1] == 4).all() and list(g.index.get_level_values(1)) == list(range(len(g)))


def test_mixing_awkward_rows(spark):
    df = awkward(spark).withColumnRenamed("events", "block")
    out = mix_sources(df, {"s": 1.0, "": 3.0}, block_rows=2)
    assert out.count() == len(AWKWARD) and out.where("slot is null").count() == 0
    some = mix_sources(df, {"s": 1.0}, block_rows=2)
    assert some.where("slot is null and not on_target").count() == len(AWKWARD) - 2
    assert mix_sources(df.limit(0)).count() == 0


def brute_links(rows):
    root = {i: i for i, _, _ in rows}
    links = Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    for a, (i, v, lab) in enumerate(rows):
        for j, w, lab2 in rows[a + 1:]:
            if lab is not None and lab == lab2 and sound(v) and sound(w) and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    u, r = sorted((find(i), find(j)))
                    root[r] = u
    return links, {i: find(i) for i in root}


@pytest.mark.parametrize("block", [3, 1024])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for g in range(12):
        base = rng.standard_normal(64)
        for k in range(10):
            v = base + (0.28 if k % 2 else 0.05) * rng.standard_normal(64) if k else base
            rows.append((len(rows), [float(np.float32(x)) for x in v], g % 3))
    for k in range(5):
        rows.append((len(rows), rows[k][1], rows[k][2]))          # exact copies
    rows += [(len(rows) + i, v, lab) for i, (v, lab) in enumerate([
        (None, 1), ([0.0] * 64, 1), ([float("nan")] + [1.0] * 63, 1), ([float("inf")] * 64, 1),
        ([None] + [1.0] * 63, 1), (rows[0][1], None), ([1.0] * 5, 1), ([1.0] * 5, 1), ([], 1)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    links, comp = brute_links(rows)
    out = {r["vec_id"]: r for r in ed.embedding_links(df).collect()}
    assert len(out) == len(rows)
    true = sum(links.values())
    assert sum(r["n_links"] for r in out.values()) >= 0.9 * true
    assert all(out[i]["n_links"] <= links[i] for i in out)
    close = [i for i in out if out[i]["component_id"] == comp[i]]
    assert len(close) >= 0.95 * len(out)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_embedding_links_repeated_and_missing_ids(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(1, v, 1), (1, v, 1), (None, v, 1), (2, [3.0, -1.0, 0.0], 1)],
                               "vec_id long, embedding array<float>, label int")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"])
                  for r in ed.embedding_links(df).collect()), key=repr)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (None, 0, None, True)]
    assert ed.embedding_links(df.limit(0)).count() == 0
