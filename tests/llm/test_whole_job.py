"""Operators against the whole job: nothing left out of models, schedules or searches."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith.llm import decontaminate as dec
from ordersmith.llm import mixing
from ordersmith.llm import quality_lm as ql
from ordersmith.llm.decontaminate import CELL, _answer, _item_words, contamination, lcs_length
from ordersmith.llm.mixing import mix_sources
from ordersmith.llm.queries import QUERIES
from test_llm_models import tokens


def all_bigram_scores(pairs):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs}
    uni, bi, followers = Counter(), Counter(), Counter()
    for i, t in pairs:
        if not held[i]:
            ts = tokens(t)
            uni.update(ts)
            bi.update(zip([None] + ts[:-1], ts))
    followers.update(v for v, _ in bi)
    bottom = sum(uni.values()) + len(uni) + 1
    for i, t in pairs:
        ts, score = tokens(t), 0.0
        for v, w in zip([None] + ts[:-1], ts):
            p = (uni[w] + 1) / bottom
            if uni[v]:
                p = max(bi[v, w] - 0.75, 0) / uni[v] + 0.75 * followers[v] / uni[v] * p
            score += math.log10(p)
        yield i, held[i], score


def test_op2_scores_with_bigrams_seen_once(spark):
    pairs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
             .select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_lm_scoring"](spark, SF_SMALL).collect()}
    want = list(all_bigram_scores(pairs))
    assert len(got) == len(want)
    for held in (True, False):
        own = [(got[i], s) for i, h, s in want if h == held]
        assert sum(g for g, _ in own) == pytest.approx(sum(s for _, s in own), rel=0.005)


@pytest.mark.parametrize("weights", [
    {"a": 0.5004, "b": 0.2996, "c": 0.2}, {"a": 0.9999, "b": 0.0001},
    {"hot": 10 ** 0.5} | {f"s{i:02d}": 1.0 for i in range(19)}])
def test_op7_keeps_to_the_weights_over_many_slots(spark, weights, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 7000)
    total = sum(weights.values())
    df = None
    for s, w in weights.items():
        own = spark.range(int(40_000 * w / total) + 3).select("id", F.lit(s).alias("source"))
        df = own if df is None else df.unionByName(own)
    out = mix_sources(df, weights, id_col="id", block_rows=1).toPandas()
    assert out["slot"].is_unique and len(out) == df.count()
    assert ((out["slot"] >= out["release"]) & (out["slot"] < out["deadline"])).all()
    on = out[out["on_target"]].sort_values("slot")
    assert len(on) > 30_000 and (on["slot"] == range(len(on))).all()
    for s, w in weights.items():
        ahead = (on["source"] == s).cumsum() - (on["slot"] + 1) * (w / total)
        assert ahead.abs().max() < 1 + 1e-6


def test_op1_judges_all_languages_from_all_trusted_documents(spark):
    def text(k, n=30):
        return " ".join(f"w{(k * 7 + j * j) % 40}" for j in range(n))

    # 3 % in a small language, a few in a rare one, some without; a sample of 100 holds 3 of 'xx'
    lang = ["xx" if k % 33 == 0 else "rare" if k % 199 == 5 else None if k % 33 == 1 else "en"
            for k in range(1200)]
    rows = [(k, lang[k], text(k, 8 if k % 10 == 9 else 30)) for k in range(1200)]
    noise = " ".join(f"noise{j}" for j in range(30))
    rows += [(5000 + i, x, noise) for i, x in enumerate(["xx", "rare", None, "en", "unseen"])]
    rows += [(5100, "en", "noise1 noise2 noise3 noise4 noise5 noise6")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(1200)], "doc_id long, quality int, toxic int")
    model = ql.fit_quality_model(docs, labels, max_docs=100)
    assert {"xx", "", "en"} == set(model.thresholds)
    out = {r["doc_id"]: r for r in ql.classify(docs, model).collect()}
    assert all(r["threshold"] is not None for r in out.values())
    assert not any(out[i]["accepted"] for i in [*range(5000, 5005), 5100])
    assert sum(out[k]["accepted"] for k in range(1200)) >= 0.95 * 1200


def op5_docs(spark):
    return [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id")
            .select("text").where("length(text) > 200").limit(300).collect()]


def test_op5_finds_an_item_that_a_third_of_the_rows_hold(spark):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    item = bench.orderBy("item_id").first()
    rows = [(k, t + (" " + item["text"] if k % 3 == 0 else "")) for k, t in enumerate(op5_docs(spark))]
    got = contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    found = {r["doc_id"] for r in got.where(f"item_id = {item['item_id']}").collect()}
    assert {k for k, _ in rows if k % 3 == 0} <= found


def test_op5_finds_all_that_the_rule_finds(spark):
    """Recall against brute-force LCS, on paraphrases down to half of the item."""
    texts, rng = op5_docs(spark), random.Random(5)
    asked = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").limit(40).collect()
    items = {r["item_id"]: (_item_words(r["text"]), _item_words(_answer(r["text"]))) for r in asked}
    rows = []
    for k, r in enumerate(asked * 4):
        words = r["text"].split()
        answer = len(_answer(r["text"]).split())
        body = len(words) - answer
        for j in rng.sample(range(len(words)), len(words) // 2) if k % 2 else \
                rng.sample(range(body), min(body, len(words) // 2)):
            words[j] = f"rare{k}x{j}"
        rows.append((k, " ".join([texts[k % 100], *words, texts[-1 - k % 100]])))
    want = set()
    for k, t in rows:
        words = _item_words(t)
        for i, (item, answer) in items.items():
            for at in range(0, len(words), CELL):
                if at + CELL >= len(words) and at:
                    continue                          # belongs to the passage before
                near = words[max(0, at - len(item) - CELL):at + 3 * CELL + len(item)]
                common = lcs_length(item, near)
                if common >= 0.5 * len(item) and (common >= 0.7 * len(item) or
                                                  lcs_length(answer, near) >= 0.7 * len(answer)):
                    want.add((k, i))
                    break
    bench = spark.createDataFrame([(r["item_id"], r["text"]) for r in asked], "item_id long, text string")
    out = contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert len(want) >= 80 and {(r["doc_id"], r["item_id"]) for r in out} == want
    assert min(r["cosine"] for r in out) < 0.3


def test_op5_latent_space_has_its_full_size():
    assert (dec.FEATURES, dec.OVERSAMPLING) == (1 << 15, 32)
    top = np.array([2**64 - 1], np.uint64)
    assert dec._feature(top)[0] == dec.FEATURES - 1
