"""Exact similarity join of documents on word shingles (Jaccard), by set relations.

The join works on distinct shingle sets. Copies share a set, so they meet once
as its members. Shingles are ordered by (frequency in a bounded sample, hash);
two sets with Jaccard >= t share a shingle among the first
``n - ceil(t n) + 1`` of each, so only those are indexed.

Set relations take the place of comparing all pairs of an index list:

* position blocks: entry i of a set of n shingles is indexed only while i lies in
  the prefix block, and list entries of incompatible size are skipped;
* every list compares its members with its pivot (the list's first document);
* the answers of the other members are derived from the pivot's: members
  that the pivot's links already join need no comparison, and
  ``|d(p,x) - d(p,y)| > 1 - t`` (Jaccard distance is a metric) rules a pair out.
  Only pairs of different components that survive are compared;
* before texts meet, parity bitmaps of the sets do (two bits a shingle): the bits in
  which they differ are at most the shingles in which the sets differ.

A pair shares a list, so it shares that list's pivot: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as ar
from .components import connected_components
from .staging import partitions_for, release, require, stage

BROADCAST_IDS = 1 << 21  # most ids (8 bytes each) sent to all tasks; beyond, a shuffled join
BLOCK = 1024             # members of one pivot that are compared with each other in one place
SAMPLE = 1 / 16          # share of documents whose shingles rank the common ones
COMMON = 65536           # most shingles on the ranked list (8 bytes each, in the task closure)


def _sets(block: ar.TextBlock, size: int):
    """Per block: (document, shingle) distinct and sorted, and each document's range."""
    d, h = ar.shingles(block.words(lower=True), size)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    if len(d):
        keep = np.ones(len(d), bool)
        keep[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
        d, h = d[keep], h[keep]
    return d, h, np.searchsorted(d, np.arange(block.n + 1))


def _set_ids(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One 64-bit identity per document's set (0 for an empty set)."""
    sums = np.concatenate([np.zeros(1, ar.U64), np.cumsum(ar.fmix(h), dtype=ar.U64)])
    n = (offs[1:] - offs[:-1]).astype(ar.U64)
    return np.where(n > 0, ar.fmix(sums[offs[1:]] - sums[offs[:-1]] + n), ar.U64(0))


def _prefix_len(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def _parity_bitmaps(d: np.ndarray, h: np.ndarray, n: np.ndarray) -> pa.Array:
    """Per document the parity of its shingles per bit; a power of two of bits, 2n at least."""
    size = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1) * 2)).astype(np.int64))
    size[n == 0] = 0
    offs = np.concatenate([[0], np.cumsum(size)])
    bit = offs[d] + (h & (size[d] - 1).astype(ar.U64)).astype(np.int64)
    parity = (np.bincount(bit, minlength=offs[-1]) & 1).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(n), [
        None, pa.py_buffer((offs // 8).astype(np.int32).tobytes()),
        pa.py_buffer(np.packbits(parity, bitorder="little").tobytes())])


INDEX = "kind int, token long, sid long, doc long, n int, bits binary"


def _index_rows(size: int, percent: int, common: np.ndarray):
    """Member rows (kind 1, keyed by set) and prefix rows (kind 0, keyed by shingle)."""
    rank_of = np.arange(len(common), dtype=np.int64)
    order = np.argsort(common)
    common, rank_of = common[order], rank_of[order] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            has_id = ids.is_valid().to_numpy(zero_copy_only=False)
            docs = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for block in ar.blocks(batch.column(1)):
                d, h, offs = _sets(block, size)
                mine = slice(block.lo, block.lo + block.n)
                doc, valid = docs[mine], has_id[mine]
                n = np.diff(offs)
                sid = _set_ids(h, offs)
                yield _batch(np.ones(block.n), sid, sid, pa.array(doc, mask=~valid), n,
                             _parity_bitmaps(d, h, n))
                # copies within the block are indexed once, as their smallest document
                first = np.lexsort((doc, sid))
                first = first[valid[first] & (n[first] > 0)]
                lead = np.zeros(block.n, bool)
                if len(first):
                    head = np.ones(len(first), bool)
                    head[1:] = sid[first[1:]] != sid[first[:-1]]
                    lead[first[head]] = True
                keep = lead[d]
                d, h = d[keep], h[keep]
                if len(common):
                    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                    rank = np.where(common[at] == h, rank_of[at], 0)
                    order = np.lexsort((h, rank, d))
                    d, h = d[order], h[order]
                start = np.searchsorted(d, d)
                prefix = np.arange(len(d)) - start < _prefix_len(n, percent)[d]
                d, h = d[prefix], h[prefix]
                yield _batch(np.zeros(len(d)), h, sid[d], pa.array(doc[d]), n[d])

    return run


def _batch(kind, token, sid, doc, n, bits=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind.astype(np.int32)), pa.array(token.view(np.int64)),
         pa.array(sid.view(np.int64)), doc, pa.array(n.astype(np.int32)),
         pa.nulls(len(n), pa.binary()) if bits is None else bits],
        names=["kind", "token", "sid", "doc", "n", "bits"])


STARS = "kind int, p long, x long, p_doc long, x_doc long, p_n int, x_n int, bits binary"


def _star_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index lists of one partition -> (pivot, member) pairs; member rows pass through."""
    parts = list(batches)
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    col = {c: table.column(c).combine_chunks() for c in table.column_names}
    kind = col["kind"].to_numpy(zero_copy_only=False)
    member = np.flatnonzero(kind == 1)
    take = pa.array(member)
    zero = pa.array(np.zeros(len(member), np.int64))
    yield _stars(np.ones(len(member), np.int32), col["sid"].take(take), zero,
                 col["doc"].take(take), zero, col["n"].take(take), zero,
                 bits=col["bits"].take(take))
    rows = np.flatnonzero(kind == 0)
    token, sid, doc, n = (col[c].take(pa.array(rows)).to_numpy(zero_copy_only=False)
                          for c in ("token", "sid", "doc", "n"))
    order = np.lexsort((doc, sid, token))
    token, sid, doc, n = token[order], sid[order], doc[order], n[order]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid, doc, n = token[keep], sid[keep], doc[keep], n[keep]
    order = np.lexsort((sid, doc, token))          # each list by document: the pivot leads
    token, sid, doc, n = token[order], sid[order], doc[order], n[order]
    lead = np.searchsorted(token, token)
    x = np.flatnonzero(lead != np.arange(len(token)))
    p = lead[x]
    order = np.lexsort((sid[x], sid[p]))
    p, x = p[order], x[order]
    new = np.ones(len(x), bool)
    new[1:] = (sid[p[1:]] != sid[p[:-1]]) | (sid[x[1:]] != sid[x[:-1]])
    p, x = p[new], x[new]
    yield _stars(np.zeros(len(x), np.int32), sid[p], sid[x], doc[p], doc[x], n[p], n[x])


def _stars(*cols, bits=None) -> pa.RecordBatch:
    types = [pa.int32()] + [pa.int64()] * 4 + [pa.int32()] * 2
    out = [c.cast(t) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c).cast(t)
           for c, t in zip(cols, types)]
    out.append(pa.nulls(len(out[0]), pa.binary()) if bits is None else bits)
    return pa.RecordBatch.from_arrays(out, names=["kind", "p", "x", "p_doc", "x_doc", "p_n", "x_n",
                                                  "bits"])


def _common(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in ar.blocks(batch.column(0)):
            _, h, _ = _sets(block, size)
            token, count = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(count.astype(np.int64))],
                names=["token", "c"])


def _compare(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Exact intersection and union sizes of the two texts of each row."""
    for batch in batches:
        sets = [[(block.lo, h, offs) for block in ar.blocks(batch.column(c))
                 for _, h, offs in [_sets(block, size)]] for c in (2, 3)]
        flat = [[h[offs[i]:offs[i + 1]] for lo, h, offs in side for i in range(len(offs) - 1)]
                for side in sets]
        both = np.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(*flat)],
                        np.int64)
        total = np.array([len(a) + len(b) for a, b in zip(*flat)], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both),
                                          pa.array(total - both)], names=["p", "x", "common", "all"])


def _may_link(percent: int):
    """Keeps the pairs whose bitmaps allow the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (4, 5))
            most = (100 - percent) * n // (100 + percent)
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column(6), batch.column(7))):
                a, b = (np.frombuffer(v.as_py(), np.uint8) for v in (a, b))
                size = min(len(a), len(b))
                a, b = (np.bitwise_xor.reduce(v.reshape(-1, size)) for v in (a, b))
                keep[i] = np.bitwise_count(a ^ b).sum(dtype=np.int64) <= most[i]
            yield batch.filter(pa.array(keep)).select(["p", "x", "p_doc", "x_doc"])

    return run


CROSS = "p long, x long, p_doc long, x_doc long"


def _cross_pairs(percent: int):
    """Pairs of members of one pivot (rows of one partition, grouped here by pivot and pair of
    blocks) that lie in different components and that sizes, distances from the
    pivot and bitmaps allow to be linked. Compared in blocks; only these leave."""
    reach = (100 - percent) / 100 + 1e-9

    def folded(bits: list, size: int) -> np.ndarray:
        return np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint8).reshape(-1, size))
                         for b in bits]).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        p, i, j, side, x, doc, n, c, dist = (table.column(k).to_numpy() for k in (
            "p", "i", "j", "side", "x", "x_doc", "x_n", "c", "dist"))
        bits = table.column("bits")
        order = np.lexsort((n, j, i, p))
        new = np.append(True, (p[order][1:] != p[order][:-1]) | (i[order][1:] != i[order][:-1])
                        | (j[order][1:] != j[order][:-1]))
        for rows in np.split(order, np.flatnonzero(new)[1:]):
            if len(rows) < 2 or len(np.unique(c[rows])) < 2:
                continue
            raw = [bits[int(r)].as_py() for r in rows]
            across = i[rows[0]] != j[rows[0]]
            size, least, far = n[rows].astype(np.int64), np.array([len(b) for b in raw]), dist[rows]
            for lo in range(0, len(rows), 128):          # rows are in order of size
                hi = min(lo + 128, len(rows))
                end = np.searchsorted(size * percent, size[hi - 1] * 100, "right")
                width = least[lo:end].min()
                a, b = folded(raw[lo:hi], width), folded(raw[lo:end], width)
                differ = np.zeros((len(a), len(b)), np.int64)
                for word in range(a.shape[1]):
                    differ += np.bitwise_count(a[:, word, None] ^ b[None, :, word])
                both = size[lo:hi, None] + size[None, lo:end]
                u, v = rows[lo:hi, None], rows[None, lo:end]
                ok = differ <= (100 - percent) * both // (100 + percent)
                ok &= size[lo:hi, None] * 100 >= size[None, lo:end] * percent
                ok &= size[None, lo:end] * 100 >= size[lo:hi, None] * percent
                ok &= c[u] != c[v]
                gap = np.abs(far[lo:hi, None] - far[None, lo:end])
                ok &= ~(gap > reach)
                if across:
                    ok &= side[u] != side[v]
                ok &= np.arange(lo, hi)[:, None] < np.arange(lo, end)[None, :]
                k, m = np.nonzero(ok)
                k, m = rows[lo + k], rows[lo + m]
                k, m = np.where(x[k] < x[m], k, m), np.where(x[k] < x[m], m, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[k]), pa.array(x[m]), pa.array(doc[k]), pa.array(doc[m])],
                    names=["p", "x", "p_doc", "x_doc"])

    return run


def _verify(pairs: DataFrame, texts: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(p, x, common, all) of the pairs (p, x, p_doc, x_doc) that their bitmaps let through.

    Texts meet the ids in question where they are read, if these are few enough to be
    sent there, else in a shuffle; the texts that stay are a written table, and only they
    move again, to meet in the pair's row.
    """
    one, other = (sets.select(F.col("sid").alias(c), F.col("n").alias(f"{c}_n"),
                              F.col("bits").alias(f"{c}_bits")) for c in ("p", "x"))
    pairs = stage(pairs.select("p", "x", "p_doc", "x_doc").join(one, "p").join(other, "x")
                  .select("p", "x", "p_doc", "x_doc", "p_n", "x_n", "p_bits", "x_bits")
                  .mapInArrow(_may_link(percent), "p long, x long, p_doc long, x_doc long"),
                  "jaccard-pairs")
    ids = stage(pairs.select(F.col("p_doc").alias("doc")).union(pairs.select("x_doc")).distinct(),
                "jaccard-ids")
    few = ids.count() <= BROADCAST_IDS
    asked = stage(texts.join(F.broadcast(ids) if few else ids.hint("merge"), "doc", "left_semi"),
                  "jaccard-texts")
    release(texts.sparkSession)
    left = asked.select(F.col("doc").alias("p_doc"), F.col("text").alias("p_text"))
    right = asked.select(F.col("doc").alias("x_doc"), F.col("text").alias("x_text"))
    rows = (pairs.join(left, "p_doc").select("p", "x", "x_doc", "p_text")
            .join(right, "x_doc").select("p", "x", "p_text", "x_text"))
    return rows.mapInArrow(lambda it: _compare(it, size),
                           "p long, x long, common long, all long")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                 percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_id), one row per input row.

    ``percent``: two documents link when 100 * intersection >= percent * union
    of their distinct ``size``-word shingles (words lower-cased A-Z; fewer words:
    the whole sequence is the one shingle). ``component_id`` is the smallest
    id reachable by links, itself included.

    Null or empty text: no shingles, linked with nothing. Null id: keeps its
    row, links nothing, component null. Rows that repeat an id count as one
    document with the links of each of its texts. Other columns are ignored.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    n = partitions_for(docs)
    sample = (src.select("text").sample(SAMPLE, seed=5)
              .mapInArrow(lambda it: _common(it, size), "token long, c long")
              .groupBy("token").agg(F.sum("c").alias("c")).where("c >= 3"))
    common = np.array([r["token"] for r in sample.orderBy(F.desc("c"), "token").limit(COMMON)
                       .orderBy("c", "token").collect()],
                      np.int64).view(ar.U64)
    found = stage(src.mapInArrow(_index_rows(size, percent, common), INDEX)
                  .repartition(n, "token").mapInArrow(_star_rows, STARS), "jaccard-index")
    release(spark)
    members = found.where("kind = 1").select(F.col("p").alias("sid"), F.col("p_doc").alias("doc"),
                                             F.col("p_n").alias("n"))
    reps = (members.where("n > 0 and doc is not null").groupBy("sid")
            .agg(F.min("doc").alias("rep")))
    sets = (found.where("kind = 1 and p_n > 0 and p_doc is not null")
            .groupBy(F.col("p").alias("sid"), F.col("p_n").alias("n"))
            .agg(F.min("bits").alias("bits")))
    stars = (found.where("kind = 0").groupBy("p", "x", "p_n", "x_n")
             .agg(F.min("p_doc").alias("p_doc"), F.min("x_doc").alias("x_doc")))
    one_text = src.where("doc is not null")
    fit = F.expr(f"100 * least(p_n, x_n) >= {percent} * greatest(p_n, x_n)")
    # a repeated id may stand for several texts: compare the text whose set was indexed
    tested = stage(_verify(stars.where(fit), one_text, sets, size, percent)
                   .groupBy("p", "x").agg(F.max(F.struct("common", "all")).alias("m"))
                   .select("p", "x", "m.*"), "jaccard-stars")
    release(spark)
    link = F.expr(f"100 * common >= {percent} * all")
    same_doc = (members.where("n > 0 and doc is not null").select("sid", "doc").distinct()
                .groupBy("doc").agg(F.min("sid").alias("p"), F.max("sid").alias("hi"),
                                    F.collect_set("sid").alias("sids"))
                .where("p != hi").select("p", F.explode("sids").alias("x")))
    links = stage(tested.where(link).select("p", "x").unionByName(same_doc), "jaccard-links")
    comp = stage(connected_components(links, "p", "x"), "jaccard-components")

    star = (stars.join(tested, ["p", "x"], "left")
            .join(comp.withColumnRenamed("node", "x").withColumnRenamed("component", "x_c"), "x",
                  "left")
            .select("p", "x", "x_n", "x_doc", F.coalesce("x_c", "x").alias("c"),
                    (1 - F.col("common") / F.col("all")).alias("dist")))
    open_ = (star.groupBy("p").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                   F.count("*").alias("m")).where("lo != hi")
             .select("p", F.ceil(F.col("m") / BLOCK).alias("nb")))
    part = F.pmod(F.xxhash64("x"), F.col("nb"))
    star = (star.join(open_, "p").withColumn("a", part)
            .withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
            .select("p", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"),
                    (F.col("a") > F.col("b")).cast("int").alias("side"), "x", "x_doc", "x_n", "c",
                    F.coalesce("dist", F.lit(float("nan"))).alias("dist")))
    rest = (star.join(sets.select(F.col("sid").alias("x"), "bits"), "x").repartition(n, "p", "i", "j")
            .mapInArrow(_cross_pairs(percent), CROSS)
            .groupBy("p", "x").agg(F.min("p_doc").alias("p_doc"), F.min("x_doc").alias("x_doc")))
    more = _verify(rest, one_text, sets, size, percent).where(link).select("p", "x").distinct()
    comp = stage(connected_components(stage(links.unionByName(more), "jaccard-links"), "p", "x"),
                 "jaccard-components")
    release(spark)

    of_set = (reps.join(comp.withColumnRenamed("node", "sid"), "sid", "left")
              .select("sid", "rep", F.coalesce("component", "sid").alias("component")))
    low = of_set.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_set = of_set.join(low, "component").select("sid", "component_id")
    return (members.join(of_set, "sid", "left")
            .select(F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("doc").isNull(), None)
                    .otherwise(F.coalesce("component_id", "doc")).alias("component_id"),
                    F.col("sid").alias("set_id")))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           size: int = 5, percent: int = 75) -> DataFrame:
    """Documents whose id is their component's smallest, with all their columns.

    Documents without an id are kept; of rows that repeat an id, the one with the
    smallest text hash stays.
    """
    kept = (jaccard_join(docs, id_col, text_col, size, percent)
            .where(F.col("component_id") == F.col(id_col)).select(F.col(id_col).alias("__id"))
            .distinct())
    known = docs.where(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col("__id")).drop("__id")
    w = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col))
    first = known.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    return first.unionByName(docs.where(F.col(id_col).isNull()))
