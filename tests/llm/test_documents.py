"""Operators on documents against brute force, with the awkward rows."""
import hashlib
import itertools
import re

import pytest

from conftest import SF_SMALL
from ordersmith.llm import jaccard_join as jj
from ordersmith.llm.jaccard_join import jaccard_join, keep_one_per_component
from ordersmith.llm.substring_dedup import substring_dedup
from ordersmith.llm.suffix_dedup import multikey_order, remove_repeats, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, kept string, __doc int, events string, source string"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
PART = " ".join(f"part{i}" for i in range(80))
AWKWARD = [
    (1, PART, "a", 1, "e", "s"), (1, PART, "a", 1, "e", "s"), (2, None, None, None, None, None),
    (3, "", "", 0, "", ""), (4, " \t\n ", "x", 1, "", ""), (None, PART, "n", 1, "", ""),
    (None, "alone " + PART, "n", 1, "", ""), (5, "Alone", "", 1, "", ""), (6, "alone", "", 1, "", ""),
    (7, "x " + PART + " y", "", 1, "", ""), (8, LONG, "", 1, "", ""), (9, LONG + " end", "", 1, "", ""),
    (10, "é" * 150, "", 1, "", ""), (11, "ab" * 200, "", 1, "", ""), (5, "other " + PART, "", 1, "", ""),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def shingle_set(text, size=5):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def components(pairs):
    """Brute force over (id, text) rows; rows of one id are one node."""
    sets = [(i, shingle_set(t)) for i, t in pairs]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
            u, v = sorted((find(a), find(b)))
            root[v] = u
    return {i: find(i) for i in root}, sets


def small_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("block", [2, 1024])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jj, "BLOCK", block)
    df, pairs = small_documents(spark)
    if block == 2:                     # near copies of one text and of each other's edges
        base = [f"t{i}" for i in range(120)]
        pairs = pairs[:60] + [(1000 + k, " ".join(base[:k] + ["new"] * (k % 5) + base[k + 3:]))
                              for k in range(0, 100, 2)]
        df = spark.createDataFrame(pairs, "doc_id long, text string")
    want, sets = components(pairs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join(df).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets}


def test_jaccard_join_awkward_rows(spark):
    want, sets = components([r[:2] for r in AWKWARD])
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                  for r in jaccard_join(awkward(spark)).collect()), key=repr)
    assert got == sorted(((i, len(s), want.get(i)) for i, s in sets), key=repr)
    kept = keep_one_per_component(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for c in want.values()})
    assert ids.count(None) == 2


def test_document_operators_on_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard_join(empty).count() == 0
    assert keep_one_per_component(empty).count() == 0
    assert suffix_dedup(empty).count() == 0
    assert substring_dedup(empty).count() == 0


def rank_of(doc_id, text):
    return (1, doc_id) if doc_id is not None else (0, text or "")


def cut_bytes(pairs, size):
    """Brute force of the byte removal; rows without an id rank by text hash, unknown here,
    so they are compared only where their texts do not meet."""
    first = {}
    for i, t in pairs:
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            w = b[p:p + size]
            first[w] = min(first.get(w, ((9,), 0)), (rank_of(i, t), p))
    out = []
    for i, t in pairs:
        b = (t or "").encode()
        cover, end = [], 0
        for p in range(len(b)):
            if p + size <= len(b) and first[b[p:p + size]] < (rank_of(i, t), p):
                end = p + size
            cover.append(p < end)
        out.append((i, len(b), sum(cover), len(re.findall("1+", "".join("01"[c] for c in cover))),
                    hashlib.sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest()))
    return out


def cut_words(pairs, size):
    first = {}
    for i, t in pairs:
        w = WORD.findall(t or "")
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            first[k] = min(first.get(k, (9,)), rank_of(i, t))
    out = []
    for i, t in pairs:
        w, cover, end = WORD.findall(t or ""), [], 0
        for p in range(len(w)):
            if p + size <= len(w) and first[tuple(w[p:p + size])] < rank_of(i, t):
                end = p + size
            cover.append(p < end)
        kept = " ".join(x for x, c in zip(w, cover) if not c)
        out.append((i, len(w), sum(cover), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def digests(df, *cols):
    return sorted((tuple(r[c] for c in cols) + (hashlib.sha256(bytes(r["kept"])).hexdigest(),)
                   for r in df.collect()), key=repr)


def test_suffix_dedup_equals_brute_force(spark):
    df, pairs = small_documents(spark)
    got = digests(suffix_dedup(df), "doc_id", "n_tokens", "n_removed", "n_spans")
    assert got == sorted(cut_bytes(pairs, 100), key=repr)


def test_suffix_dedup_awkward_rows(spark):
    known = [r for r in AWKWARD if r[0] is not None]
    df = spark.createDataFrame(known, SCHEMA)
    out = suffix_dedup(df, size=40, k=16)
    assert out.columns == ["doc_id", "text", "__doc", "events", "source", "n_tokens", "n_removed",
                           "n_spans", "removed", "kept"]
    got = digests(out, "doc_id", "n_tokens", "n_removed", "n_spans")
    assert got == sorted(cut_bytes([r[:2] for r in known], 40), key=repr)
    assert [r["__doc"] for r in out.orderBy("doc_id", "__doc", "kept").select("__doc", "doc_id", "kept").collect()] \
        == [r["__doc"] for r in df.orderBy("doc_id", "__doc").collect()]
    everything = suffix_dedup(awkward(spark), size=40, k=16)
    assert everything.count() == len(AWKWARD)
    assert everything.where("doc_id is null and n_removed > 0").count() == 1


def test_remove_repeats_keeps_valid_text(spark):
    rows = [(1, "é" * 120, "a"), (2, "xx" + "é" * 120, "b"), (3, None, "c"), (4, "é" * 120, "d"),
            (5, "é" + "a" * 99, "e"), (6, "ok ©" + "a" * 99, "f")]       # both end in byte A9
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r["text"] for r in remove_repeats(df).collect()}
    assert out[3] is None and 4 not in out and out[2].startswith("xx")
    assert set(out[2]) <= set("xé")
    assert out[6] == "ok "


def test_multikey_order_sorts():
    import numpy as np
    rng = np.random.default_rng(0)
    keys = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(4)]
    order = multikey_order(keys)
    assert (np.lexsort(keys[::-1]) == order).all() or \
        [tuple(k[i] for k in keys) for i in order] == sorted(zip(*keys))


def test_substring_dedup_equals_brute_force(spark):
    df, pairs = small_documents(spark)
    got = digests(substring_dedup(df), "doc_id", "n_tokens", "n_removed")
    assert got == sorted(cut_words(pairs, 50), key=repr)


def test_substring_dedup_awkward_rows(spark):
    known = [r for r in AWKWARD if r[0] is not None]
    got = digests(substring_dedup(spark.createDataFrame(known, SCHEMA), size=12, k=4),
                  "doc_id", "n_tokens", "n_removed")
    assert got == sorted(cut_words([r[:2] for r in known], 12), key=repr)
    assert substring_dedup(awkward(spark), size=12, k=4).count() == len(AWKWARD)


def test_cut_texts_keep_columns_named_like_inner_ones(spark):
    """Columns of the table that are named like the operators' own come out as they went in."""
    rows = [(1, PART, "k1", 7, 8, 5), (2, "before " + PART, "k2", None, 9, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, __doc int, __th int, __t int")
    got = sorted(tuple(r) for r in remove_repeats(df, size=40).collect())
    assert remove_repeats(df, size=40).columns == df.columns
    assert got[0] == rows[0] and got[1][2:] == rows[1][2:] and got[1][1].strip() == "before"
    own = substring_dedup(df)
    assert {c: own.schema[c].dataType for c in ("__doc", "__th", "__t")} \
        == {c: df.schema[c].dataType for c in ("__doc", "__th", "__t")}
    assert sorted(r["__th"] for r in own.collect()) == [8, 9]
