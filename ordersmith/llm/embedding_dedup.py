"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random sign flips and a fast Hadamard transform;
its hash is the coordinate axis (with sign) that it comes closest to. ``depth`` such
hashes make a bucket, ``tables`` sets of buckets make the index. Each vector also
goes to ``probes`` further buckets per table, those where its next-closest axis loses
least. Pairs that meet in a bucket are verified by their cosine in double precision.

Equal vectors of a label are one class that is hashed once. A bucket of more than
``BLOCK`` classes is cut into blocks whose pairs go to different tasks, so every pair is
still compared, by matrix products, and no task holds the whole bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .staging import partitions_for, release, require, stage

BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two wide)."""
    x, h = x.copy(), 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), -1)
        h *= 2
    return x


def bucket_codes(vectors: np.ndarray, tables: int, depth: int, probes: int,
                 seed: int = 31) -> np.ndarray:
    """(rows, tables, 1 + probes) codes: the own bucket, then the nearest others."""
    rows, dim = vectors.shape
    wide = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((rows, wide))
    padded[:, :dim] = vectors
    out = np.empty((rows, tables, 1 + probes), np.int64)
    at = np.arange(rows)
    for t in range(tables):
        flips = np.random.Generator(np.random.PCG64([seed, t, wide])).integers(
            0, 2, (depth, 3, wide)) * 2.0 - 1
        own, nxt, gap = [], [], []
        for d in range(depth):
            x = padded
            for r in range(3):
                x = hadamard(x * flips[d, r]) / np.sqrt(wide)
            size = np.abs(x)
            top = np.argpartition(-size, min(1, wide - 1), axis=1)[:, :2]
            order = np.argsort(-size[at[:, None], top], axis=1)
            top = top[at[:, None], order]
            axis = top * 2 + (x[at[:, None], top] < 0)
            own.append(axis[:, 0])
            nxt.append(axis[:, -1])
            gap.append(size[at, top[:, 0]] - size[at, top[:, -1]])
        own, nxt, gap = np.array(own), np.array(nxt), np.array(gap)

        def code(axes):
            c = np.zeros(rows, np.int64)
            for a in axes:
                c = c * (2 * wide) + a
            return c

        out[:, t, 0] = code(own)
        near = np.argsort(gap, axis=0)
        for p in range(probes):
            axes = own.copy()
            if p < depth:                       # one axis replaced, the cheapest first
                axes[near[p], at] = nxt[near[p], at]
            else:                               # then the cheapest two
                for q in range(min(2, depth)):
                    axes[near[q], at] = nxt[near[q], at]
            out[:, t, 1 + p] = code(axes)
    return out


def _matrices(col: pa.Array):
    """Rows of equal width: (row numbers, matrix of doubles)."""
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offs = col.offsets.to_numpy().astype(np.int64)
    for width in np.unique(sizes):
        rows = np.flatnonzero(sizes == width)
        yield rows, flat[offs[rows][:, None] + np.arange(width)]


def _bucket_rows(tables: int, depth: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, label, vec = batch.columns
            for rows, m in _matrices(vec):
                m = m / np.linalg.norm(m, axis=1)[:, None]
                codes = bucket_codes(m, tables, depth, probes)
                each = codes.shape[1] * codes.shape[2]
                table = np.tile(np.repeat(np.arange(tables), codes.shape[2]), len(rows))
                own = pa.array(np.repeat(rows, each))
                code = codes.reshape(-1)
                # vectors of another width have tables of their own
                yield pa.RecordBatch.from_arrays(
                    [cls.take(own), label.take(own), pa.array(table + tables * m.shape[1]),
                     pa.array(code)], names=["cls", "label", "tab", "code"])

    return run


def _links(cosine: float):
    """Verified pairs of every group of one partition (rows sorted here by group)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        names = ("label", "tab", "code", "i", "j")
        keys = [table.column(c).to_numpy() for c in names]
        order = np.lexsort(keys)
        keys = [k[order] for k in keys]
        new = np.zeros(len(order), bool)
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        starts = np.append(np.flatnonzero(new), len(order))
        cls, side = table.column("cls").to_numpy(), table.column("side").to_numpy()
        vec = table.column("vec").chunk(0)
        offs, flat = vec.offsets.to_numpy(), vec.values.to_numpy(zero_copy_only=False)
        found: list[np.ndarray] = []
        for lo, hi in zip(starts[:-1], starts[1:]):
            if hi - lo < 2:
                continue
            rows = order[lo:hi]
            m = np.stack([flat[offs[r]:offs[r + 1]] for r in rows]).astype(np.float64)
            m /= np.linalg.norm(m, axis=1)[:, None]
            c, s = cls[rows], side[rows]
            across = keys[3][lo] != keys[4][lo]
            for at in range(0, len(rows), BLOCK):
                x, y = np.nonzero(m[at:at + BLOCK] @ m.T >= cosine)
                x += at
                ok = c[x] < c[y]
                if across:
                    ok = (c[x] != c[y]) & (s[x] < s[y])
                a, b = c[x[ok]], c[y[ok]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                                         names=["a", "b"])

    return run


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", cosine: float = 0.93, tables: int = 10, depth: int = 2,
                    probes: int = 2) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors of the same label link at ``cosine`` or more (double precision).
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable by links, itself included, ``kept`` says that it is the row's own.

    Vectors that are null, zero or hold null or non-finite components, rows without a
    label and rows without an id link with nothing (an id that is null: component null,
    kept). Rows that repeat an id are vectors of their own. Vectors of different length
    never link. Other columns are ignored.
    """
    require(vectors, id_col, vec_col, label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).alias("vec"))
    sound = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
             & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists("vec", lambda x: x != 0))
    live = rows.where(F.coalesce(sound, F.lit(False)))
    classes = stage(live.groupBy("label", "vec").agg(F.count("*").alias("size"))
                    .select("label", "vec", "size",
                            F.xxhash64("label", "vec").alias("cls")), "embedding-classes")
    n = partitions_for(vectors)
    buckets = stage(classes.select("cls", "label", "vec").mapInArrow(
        _bucket_rows(tables, depth, probes),
        f"cls long, label {rows.schema['label'].dataType.simpleString()}, tab long, code long"),
        "embedding-buckets")
    key = ["label", "tab", "code"]
    crowd = buckets.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1")
    part = F.pmod(F.xxhash64("cls"), F.col("nb"))
    shared = (buckets.join(crowd, key).withColumn("nb", F.ceil(F.col("m") / BLOCK))
              .withColumn("p", part)
              .withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
              .select("cls", *key, F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"),
                      (F.col("p") > F.col("q")).cast("int").alias("side")))
    pairs = (shared.join(classes.select("cls", "vec"), "cls").drop("q")
             .repartition(n, *key, "i", "j")
             .select("cls", "label", "tab", "code", "i", "j", "side", "vec")
             .mapInArrow(_links(cosine), "a long, b long"))
    links = stage(pairs.distinct(), "embedding-links")
    release(vectors.sparkSession)
    sizes = classes.select("cls", "size")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = (both.join(sizes.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls"))
              .agg(F.sum("size").alias("around")))
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "cls")
    mine = (live.withColumn("cls", F.xxhash64("label", "vec")).select("id", "cls"))
    lows = mine.groupBy("cls").agg(F.min("id").alias("low"))
    of = (lows.join(comp, "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    best = of.groupBy("component").agg(F.min("low").alias("component_id"))
    of = (of.join(best, "component").join(sizes, "cls").join(around, "cls", "left")
          .select("cls", "component_id",
                  (F.col("size") - 1 + F.coalesce("around", F.lit(0))).alias("n_links")))
    out = mine.join(of, "cls").select("id", "n_links", "component_id")
    alone = (rows.where(~F.coalesce(sound, F.lit(False)))
             .select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return (out.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"),
                                                                F.lit(True)))
            .withColumnRenamed("id", id_col))
