"""Exact dedup and fill-in-middle against brute force, with the awkward rows."""
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith.llm import fill_in_middle as fim
from ordersmith.llm.arrays import blocks
from ordersmith.llm.exact_dedup import drop_copies, exact_dedup
from ordersmith.llm.oracles import ORACLES
from ordersmith.llm.queries import QUERIES

NEW = ["op11_periodic_runs", "op12_fill_in_middle", "op13_exact_dedup"]


@pytest.mark.parametrize("name", NEW)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, want))


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


COPIES = [(5, "a  b", "x"), (3, "a\tb", "y"), (9, "a b", "z"), (3, "a b", "again"), (1, "c", ""),
          (None, "c", ""), (None, "only without id", ""), (None, "only without id", ""), (2, None, ""),
          (4, "", None), (6, " ", None), (7, "\n\n", ""), (8, " ", ""), (10, "x" * 300_000, "")]
SCHEMA = "doc_id long, text string, row string"


def groups(rows):
    """(id, keeper, size, sha, kept) with one kept row a group."""
    by = {}
    for i, t, *_ in rows:
        by.setdefault(norm(t), []).append(i)
    out = []
    for t, ids in by.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        kept = [k == ids.index(keep) for k in range(len(ids))]
        out += [(i, keep, len(ids), sha, k) for i, k in zip(ids, kept)]
    return sorted(out, key=repr)


def found(df):
    cols = ("doc_id", "keep_id", "group_size", "text_sha256", "kept")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("weak", [None, 0, 1])
def test_exact_dedup_awkward_rows_and_collisions(spark, weak):
    """A hash of one byte, and of none: bytes must still tell the texts apart."""
    df = spark.createDataFrame(COPIES, SCHEMA).repartition(5)
    hash_of = {} if weak is None else {"hash_of": lambda c: F.substring(F.unhex(F.md5(c)), 1, weak)}
    assert found(exact_dedup(df, **hash_of)) == groups(COPIES)


def test_exact_dedup_hot_group(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 700}", "") for i in range(3000)]
    assert found(exact_dedup(spark.createDataFrame(rows, SCHEMA).repartition(16))) == groups(rows)


def test_drop_copies(spark):
    df = spark.createDataFrame(COPIES, SCHEMA)
    out = drop_copies(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], norm(r["text"])) for r in out.collect()), key=repr) == sorted(
        ((i, t) for i, t in {(g[0], norm(t)) for g, t in ((g, t) for t in {norm(r[1]) for r in COPIES}
                                                          for g in groups(COPIES) if g[4] and
                                                          g[3] == hashlib.sha256(t.encode()).hexdigest())}), key=repr)
    assert exact_dedup(df.limit(0)).count() == 0 and drop_copies(df.limit(0)).count() == 0


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (n, "plain", None, None, text)
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 80:
        return (n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")
    return (n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


def odd_texts():
    rng = np.random.default_rng(3)
    parts = ["word", "été", "あい", "😀", " ", "\n", "\t ", "<", "<P", "S>", "x" * 90, "  "]
    shared = " ".join(f"shared{i}" for i in range(900))
    out = [None, "", " ", "a", " a", "a ", "<P>", "x <M> y", "é" * 5000, " " * 5000, "a" * 70_000, shared * 12]
    for k in range(300):
        out.append("".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(1, 400))))
        out.append(shared[:int(rng.integers(1, 6000))] + out[-1] + shared)
    return [(i if i != 11 else None, t, i, "a", "b") for i, t in enumerate(out)]


def test_middle_equals_brute_force_and_restores(spark, monkeypatch):
    rows = odd_texts()
    df = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, n int, row string, form string")
    out = fim.fill_in_middle(df).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    assert out.columns == ["doc_id", "text", "row", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    got = out.collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == middle(
            r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [200, 1 << 20])
def test_chunks_are_shared_and_the_cache_is_bounded(limit):
    import pyarrow as pa
    shared = " ".join(f"token{i * i}" for i in range(3000))
    cache = fim.ChunkCache(limit)
    texts = [f"start {k} " + "pad" * k + shared for k in range(8)]
    for block in blocks(pa.array(texts)):
        counted = fim.Counted(block, cache)
        assert counted.tokens.tolist() == [len(UNIT.findall(t)) for t in texts]
        for d, t in enumerate(texts):
            units = UNIT.findall(t)
            for k in range(0, len(units) + 1, 37):
                at, chars = counted.cut(d, k)
                assert at - block.offs[d] == chars == len("".join(units[:k]))
    assert cache.held <= max(limit, fim.LARGEST_CACHED)
    if limit > 200:
        assert cache.hits > 100


def test_crc_of_the_sql_is_zlibs():
    from ordersmith.llm.oracles import _CRC
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT range AS doc_id FROM range(0, 5000, 13)")
    assert all(h == zlib.crc32(d.encode()) for d, h in con.execute(_CRC).fetchall())
