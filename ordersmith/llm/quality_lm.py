"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney n-gram model over words, trained on
half of all documents labelled as trusted (by a hash of the id). Its counts, continuation
counts, discounts and probabilities come from grouped counts and joins sharded by
n-gram. The interpolated recursion is stored so that a text's log probability is
a sum over its n-grams: every word starts from the unknown word's probability,
and each known unigram, context and n-gram adds its own term.

Perplexities of all trusted documents of the other half give each language
its threshold (a high quantile); documents above it are rejected. Languages with few of them
are held against the threshold of all languages together, short texts against that of
short texts.

The model grows with the corpus. Its ``MODEL_ROWS`` most frequent terms at most go to the
tasks, where texts are scored as they are read; n-grams that are not among them go, packed
by block of texts, to the other terms' shards, which send back sums. The other terms are dealt
out once and stay where they are; every text is asked for once, for thresholds and decisions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lookup import bounded_broadcast
from ..session import table_bytes
from . import arrays as ar
from .staging import UNKNOWN, partitions_for, release, require, stage, unstage

MODEL_ROWS = 1_000_000
IDS = 1_000_000           # ids of trusted documents that are broadcast; more meet the texts by shuffle
START = ar.U64(0x5851F42D4C957F2D)
CONTEXT = ar.U64(0xA0761D6478BD642F)
LEAST = 20                # trusted documents that a threshold of their own takes
COUNTS = 4096             # counts that are told apart when the most frequent terms are chosen
WORDS = 100_000           # words or contexts that are broadcast; more meet the n-grams by shuffle
SLICES = 8                # of what is asked or joined by shuffle; one is on disk at a time
SLICE_BYTES = 64 << 20    # of a table that is scored in slices
ASKED = 4 << 20           # bytes of text whose n-grams are asked for together
GRID = 10_000             # steps of a perplexity's logarithm that quantiles tell apart
ADDED = ["n_words", "log10_prob", "perplexity", "threshold", "accepted"]


_P1, _P2, _P3, _P4, _P5 = (ar.U64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << ar.U64(by)) | (x >> ar.U64(64 - by))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64(a, b)`` gives."""
    h = np.full(len(a), 42, ar.U64)
    for x in (a, b):
        h = h + _P5 + ar.U64(8)
        h ^= _turn(x * _P2, 31) * _P1
        h = _turn(h, 27) * _P1 + _P4
        h ^= h >> ar.U64(33)
        h *= _P2
        h ^= h >> ar.U64(29)
        h *= _P3
        h ^= h >> ar.U64(32)
    return h


def _grams(block: ar.TextBlock, order: int):
    """Per n: (document, n-gram hash, its first n-1 words, its last n-1 words); the words
    before the first are start marks, so every word ends one n-gram of each order. From two
    words on, an n-gram's hash is that of the other two."""
    w = block.words()
    lengths = np.diff(w.offs)
    pad = order - 1
    doc = ar.owners(w.offs, len(w.hashes))
    padded = np.full(len(w.hashes) + pad * block.n, START, ar.U64)
    at = np.arange(len(w.hashes)) + pad * (doc + 1)
    padded[at] = w.hashes
    none = np.zeros(len(at), ar.U64)
    gram = ar.fmix(padded * ar._SHINGLE[0] + ar.U64(2))
    out = [(doc, gram[at], none, none)]
    for n in range(2, order + 1):
        h, s = gram[at - 1], gram[at]
        out.append((doc, _pair_hash(h, s), h, s))
        if n < order:
            gram = np.append(gram[:1], _pair_hash(gram[:-1], gram[1:]))
    return lengths, out


def _train_rows(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in ar.blocks(batch.column(0)):
                _, grams = _grams(block, order)
                for n, (_, g, h, s) in enumerate(grams, 1):
                    if n == 1 < order:          # words are counted from the bigrams
                        continue
                    if n == 1:
                        s = g
                    _, first, count = np.unique(g, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), n, np.int32)), pa.array(h[first].view(np.int64)),
                         pa.array(s[first].view(np.int64)), pa.array(count.astype(np.int64))],
                        names=["n", "h", "s", "c"])

    return run


@dataclass
class QualityModel:
    """Terms by n-gram key, the unknown word's log10 probability, thresholds by language, of
    all languages together (``overall``) and of short texts."""

    terms: DataFrame | None
    n_terms: int
    unknown: float
    order: int
    thresholds: dict[str, float] = field(default_factory=dict)
    overall: float | None = None
    short: float | None = None
    splits: dict = field(default_factory=dict)       # by how many terms go to the tasks
    scored: tuple | None = None                      # frame, its text column, sums of its texts

    def sums_of(self, docs: DataFrame, text_col: str) -> DataFrame | None:
        """What ``text_log_probs`` gave for the frame that the model was fitted on."""
        known = self.scored is not None and self.scored[0] is docs and self.scored[1] == text_col
        return self.scored[2] if known else None


def _cut(counts: DataFrame) -> Column:
    """Discount of a row's count, from how many of ``counts`` are 1, 2, 3 and 4."""
    seen = {r["k"]: r["m"] for r in counts.groupBy(F.least("c", F.lit(5)).alias("k"))
            .agg(F.count("*").alias("m")).collect()}
    n1, n2, n3, n4 = (seen.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    nxt = [k - (k + 1) * y * b / a if a else 0.5 * k
           for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    d1, d2, d3 = (F.lit(float(min(max(d, 0.05), k - 0.05))) for k, d in zip((1, 2, 3), nxt))
    return F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)


def fit_terms(texts: DataFrame, order: int) -> tuple[DataFrame, int, float]:
    """(key, term, c) of every unigram, context and n-gram of ``texts`` (column text); c: how
    often it counts.

    Contexts and lower probabilities meet the n-grams by broadcast up to ``WORDS`` rows; beyond,
    by join, a slice of the contexts at a time, so that shuffles stay small on disk.
    """
    spark = texts.sparkSession
    raw = stage(texts.select("text").mapInArrow(_train_rows(order),
                                                "n int, h long, s long, c long")
                .groupBy("n", "h", "s").agg(F.sum("c").alias("c")), "kn-counts")
    release(spark)

    def before(n: int) -> DataFrame:
        # below the highest order a count is the number of different words before the n-gram
        return raw.where(F.col("n") == n + 1).groupBy(F.col("s").alias("g")).agg(F.count("*").alias("c"))

    words = stage(before(1) if order > 1 else raw.select(F.col("s").alias("g"), "c"), "kn-words")
    release(spark)
    cut = _cut(words)
    total, saved, vocabulary = words.agg(F.sum("c"), F.sum(cut), F.count("*")).first()
    unknown = (saved / total if total else 1.0) / (vocabulary + 1)
    used, lower, n_lower = [raw, words], words.select(
        "g", "c", ((F.col("c") - cut) / F.lit(total) + F.lit(unknown)).alias("p")), vocabulary
    parts, n_terms = [stage(lower.select(F.col("g").alias("key"), F.log10(F.col("p") / F.lit(unknown))
                                         .cast("float").alias("term"), "c"), "kn-terms")], vocabulary
    for n in range(2, order + 1):
        level, name = raw.where(F.col("n") == n).select("h", "s", "c"), F.xxhash64("h", "s").alias("g")
        if n < order:
            level = stage(level.select("h", "s", name).join(before(n), "g").drop("g"), "kn-adjusted")
            used.append(level)
        cut = _cut(level)
        heads = stage(level.groupBy("h").agg(F.sum("c").alias("total"),
                                             (F.sum(cut) / F.sum("c")).alias("share")), "kn-heads")
        release(spark)
        used.append(heads)
        n_heads = heads.count()
        parts.append(stage(heads.select(
            F.col("h").bitwiseXOR(F.lit(int(CONTEXT.view(np.int64)))).alias("key"),
            F.log10("share").cast("float").alias("term"), F.col("total").alias("c")), "kn-terms"))
        back = lower.select(F.col("g").alias("s"), F.col("p").alias("back"))
        slices = 1 if max(n_heads, n_lower) <= WORDS else SLICES
        done = []
        for i in range(slices):
            rows = level.where(F.pmod("h", F.lit(slices)) == i) if slices > 1 else level
            rows = (rows.join(bounded_broadcast(heads, WORDS), "h").join(bounded_broadcast(back, WORDS), "s")
                    .withColumn("p", (F.col("c") - cut) / F.col("total") + F.col("share") * F.col("back")))
            term = F.log10(F.col("p") / (F.col("back") * F.col("share"))).cast("float")
            rows = rows.select(name, "p", "back", "share", "c")
            if n < order:
                rows = stage(rows, "kn-level")
                done.append(rows)
            parts.append(stage(rows.select(F.col("g").alias("key"), term.alias("term"), "c"), "kn-terms"))
            release(spark)
        used += done
        if n < order:
            lower = done[0]
            for rows in done[1:]:
                lower = lower.unionByName(rows)
            n_lower = lower.count()
        n_terms += n_heads + (n_lower if n < order else level.count())
    table = parts[0]
    for t in parts[1:]:
        table = table.unionByName(t)
    for t in used:
        unstage(t)
    release(spark)
    return table, n_terms, float(np.log10(unknown))


def _keys(block: ar.TextBlock, order: int):
    lengths, grams = _grams(block, order)
    for n, (doc, g, h, _) in enumerate(grams, 1):
        yield lengths, doc, g
        if n > 1:
            yield lengths, doc, h ^ CONTEXT


def _head(model: QualityModel, at_most: int) -> tuple[DataFrame, int]:
    """The terms that count most, ``at_most`` of them, and their least count (ties stay out)."""
    if model.n_terms <= at_most:
        return model.terms, 0
    sizes = (model.terms.groupBy(F.least("c", F.lit(COUNTS)).alias("k")).agg(F.count("*").alias("m"))
             .orderBy(F.desc("k")).collect())                     # at most COUNTS rows
    least, n = COUNTS + 1, 0
    for r in sizes:
        n += r["m"]
        if n > at_most:
            break
        least = r["k"]
    return model.terms.where(F.least("c", F.lit(COUNTS)) >= least), least


class _Table:
    """Terms by sorted key; a directory of the keys' leading bits says where to look."""

    def __init__(self, keys: np.ndarray, terms: np.ndarray):
        self.shift = ar.U64(64 - max(1, min(26, len(keys).bit_length())))
        self.keys, self.terms = keys, terms
        held = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << (64 - int(self.shift)))
        self.first = np.append(0, np.cumsum(held)).astype(np.int32)

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per key its term (0: it has none), and whether it has one."""
        out, found = np.zeros(len(g), np.float32), np.zeros(len(g), bool)
        lead = (g >> self.shift).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        own = np.flatnonzero(at < end)
        at, end, key = at[own], end[own], g[own]
        while len(own):
            held = self.keys[at]
            hit = held == key
            out[own[hit]], found[own[hit]] = self.terms[at[hit]], True
            at = at + 1
            left = (held < key) & (at < end)
            own, at, end, key = own[left], at[left], end[left], key[left]
        return out, found


def _score_in_tasks(docs: DataFrame, text_col: str, model: QualityModel, table) -> DataFrame:
    """Adds n_words and log10_prob by the terms of the broadcast ``table``, without a shuffle."""
    at, unknown, n = docs.columns.index(text_col), model.unknown, model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Table(*table.value)
        for batch in batches:
            words, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for block in ar.blocks(batch.column(at)):
                rows = slice(block.lo, block.lo + block.n)
                for lengths, doc, g in _keys(block, n):
                    words[rows] = lengths
                    sums[rows] += np.bincount(doc, known.find(g)[0], minlength=block.n)
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(words), pa.array(sums + words * unknown)],
                names=list(batch.schema.names) + ["n_words", "log10_prob"])

    schema = StructType(docs.schema.fields
                        + StructType.fromDDL("n_words long, log10_prob double").fields)
    return docs.mapInArrow(run, schema)


PACKED = "shard int, block long, kind int, data binary"     # kind 0: asked, 1: a block's texts, 2: terms


def _packed(*rows: tuple) -> pa.RecordBatch:
    shard, block, kind, data = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(block, pa.int64()),
                                       pa.array(kind, pa.int32()), pa.array(data, pa.binary())],
                                      names=["shard", "block", "kind", "data"])


def _pack(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys by their differences in as few bytes as the widest takes, then the values."""
    step = np.diff(keys, prepend=ar.U64(0))
    step[:1] = 0
    width = max(1, -(-int(step.max(initial=0)).bit_length() // 8))
    low = np.ascontiguousarray(step).view(np.uint8).reshape(-1, 8)[:, :width]
    return (np.array([len(keys), width], np.int64).tobytes() + keys[:1].tobytes()
            + low.tobytes() + values.tobytes())


def _unpack(data: bytes, kind) -> tuple[np.ndarray, np.ndarray]:
    n, width = (int(x) for x in np.frombuffer(data, np.int64, 2))
    step = np.zeros((n, 8), np.uint8)
    step[:, :width] = np.frombuffer(data, np.uint8, n * width, 24).reshape(n, width)
    keys = step.view(ar.U64).ravel()
    keys[:1] = np.frombuffer(data, ar.U64, 1, 16)
    return np.cumsum(keys, dtype=ar.U64), np.frombuffer(data, kind, n, 24 + n * width)


def _shards(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> ar.U64(32)) * ar.U64(shards) >> ar.U64(32)).astype(np.int64)


def _parts(keys: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of sorted keys."""
    edge = np.searchsorted(_shards(keys, shards), np.arange(shards + 1))
    return [(int(i), int(edge[i]), int(edge[i + 1])) for i in np.flatnonzero(np.diff(edge))]


def _tail_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed terms of each shard (columns: shard, key, term)."""
    columns = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    if not columns:
        return
    shard, key, term = (np.concatenate(c) for c in zip(*columns))
    order = np.lexsort((key.view(ar.U64), shard))
    shard, key, term = shard[order], key.view(ar.U64)[order], term[order].astype(np.float32)
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    for lo, hi in zip(first, np.append(first[1:], len(shard))):
        yield _packed((int(shard[lo]), 0, 2, _pack(key[lo:hi], term[lo:hi])))


def _ask_rows(model: QualityModel, table, shards: int):
    """Blocks of different texts (columns: text, th): their n-grams that are not among the
    broadcast terms, by shard, and a row of their hashes, words and sums so far."""
    order, unknown = model.order, model.unknown

    def flush(ths, words, sums, docs, keys):
        th, words, sums = np.concatenate(ths), np.concatenate(words), np.concatenate(sums)
        doc, key = np.concatenate(docs), np.concatenate(keys)
        name = int(ar.fmix(th.view(ar.U64) + np.arange(len(th), dtype=ar.U64) * CONTEXT)
                   .sum(dtype=ar.U64).view(np.int64))
        by = np.argsort(key)
        key, doc = key[by], doc[by].astype(np.uint16 if len(th) <= 1 << 16 else np.uint32)
        own = np.array([len(th)], np.int64).tobytes() + th.tobytes() + words.tobytes() \
            + (sums + words * unknown).tobytes()
        yield _packed((abs(name) % shards, name, 1, own))
        for i, lo, hi in _parts(key, shards):
            yield _packed((i, name, 0, _pack(key[lo:hi], doc[lo:hi])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Table(*table.value)
        for batch in batches:
            th, first = np.unique(batch.column(1).to_numpy(), return_index=True)
            texts = batch.column(0).take(pa.array(first))
            held, n, size = ([], [], [], [], []), 0, 0
            for block in ar.blocks(texts):
                sums, far_doc, far = np.zeros(block.n), [], []
                for lengths, doc, g in _keys(block, order):
                    term, found = known.find(g)
                    sums += np.bincount(doc, term, minlength=block.n)
                    far_doc.append(doc[~found] + n)
                    far.append(g[~found])
                for old, new in zip(held, ([th[block.lo:block.lo + block.n]], [lengths.astype(np.int64)],
                                           [sums], far_doc, far)):
                    old.extend(new)
                n, size = n + block.n, size + len(block.data)
                if size >= ASKED:
                    yield from flush(*held)
                    held, n, size = ([], [], [], [], []), 0, 0
            if n:
                yield from flush(*held)

    return run


def _answers(key: tuple, asked: pa.Table, terms: pa.Table) -> pa.Table:
    """A shard's answers to blocks: sums of the terms found, by document; the blocks' own
    rows pass through."""
    out = []
    keys, values = _unpack(terms.column("data")[0].as_py(), np.float32) if terms.num_rows else (None, None)
    for shard, block, kind, data in zip(*(asked.column(c) for c in ("shard", "block", "kind", "data"))):
        shard, block, kind, data = (x.as_py() for x in (shard, block, kind, data))
        if kind == 1:
            out.append(_packed((shard, block, kind, data)))
            continue
        if keys is None:
            continue
        n, width = (int(x) for x in np.frombuffer(data, np.int64, 2))
        g, doc = _unpack(data, np.uint16 if len(data) == 24 + n * (width + 2) else np.uint32)
        at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == g)
        if len(hit):
            doc, which = np.unique(doc[hit], return_inverse=True)
            sums = np.bincount(which, values[at[hit]]).astype(np.float32)
            out.append(_packed((shard, block, 0, _pack(doc.astype(ar.U64), sums))))
    return pa.Table.from_batches(out, _packed((0, 0, 0, b"")).schema)


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts' hashes, words and sums of log probabilities, from each block and its answers."""
    owners, answers = {}, {}
    for b in batches:
        for shard, block, kind, data in zip(*(c.to_pylist() for c in b.columns)):
            if kind == 1:
                owners[block] = data
            else:                                    # a repeated block has the same answers
                answers.setdefault(block, {})[shard] = data
    for block, data in owners.items():
        n = int(np.frombuffer(data, np.int64, 1)[0])
        th, words = (np.frombuffer(data, np.int64, n, 8 + k * 8 * n) for k in (0, 1))
        sums = np.frombuffer(data, np.float64, n, 8 + 16 * n).copy()
        for shard in sorted(answers.get(block, {})):
            doc, part = _unpack(answers[block][shard], np.float32)
            sums[doc.astype(np.int64)] += part
        yield pa.RecordBatch.from_arrays([pa.array(th), pa.array(words), pa.array(sums)],
                                         names=["__th", "n_words", "log10_prob"])


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


@dataclass
class _Split:
    """The most frequent terms, broadcast, and the packed others (None: there are none)."""

    table: object
    tail: DataFrame | None
    shards: int


def _split(model: QualityModel, at_most: int) -> _Split:
    if at_most not in model.splits:
        spark = model.terms.sparkSession
        head, least = _head(model, at_most)
        rows = head.select("key", "term").toArrow()
        key = rows.column("key").to_numpy().view(ar.U64)
        by = np.argsort(key)
        table = spark.sparkContext.broadcast((key[by], rows.column("term").to_numpy()[by]))
        tail, shards = None, 4 * partitions_for(model.terms)
        if least:
            at = F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(shards), 32).cast("int")
            tail = stage(model.terms.where(F.least("c", F.lit(COUNTS)) < least)
                         .select(at.alias("shard"), "key", "term")
                         .repartition(shards // 4, "shard").mapInArrow(_tail_rows, PACKED), "kn-tail")
            release(spark)
        model.splits[at_most] = _Split(table, tail, shards)
    return model.splits[at_most]


def text_log_probs(docs: DataFrame, text_col: str, model: QualityModel, split: _Split,
                   slices: int) -> DataFrame:
    """(__th, n_words, log10_prob) of every different text, by the hash of it.

    N-grams that are not among the broadcast terms go to the others' shards, packed by block
    of texts, and come back as sums; a slice of the texts at a time, so that what is
    shuffled stays small on disk. The terms go to their shards once, for all slices.
    """
    spark, parts = docs.sparkSession, partitions_for(docs)
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                        _text_hash(text_col).alias("__th"))
    slices = slices if SLICE_BYTES <= table_bytes(docs) < UNKNOWN else 1
    out, tail = None, split.tail
    if slices > 1:
        tail = tail.repartition(split.shards // 4, "shard").persist(StorageLevel.DISK_ONLY)
        tail.count()
        release(spark)
    for i in range(slices):
        some = texts.where(F.pmod("__th", F.lit(slices)) == i) if slices > 1 else texts
        sums = (some.mapInArrow(_ask_rows(model, split.table, split.shards), PACKED).groupBy("shard")
                .cogroup(tail.groupBy("shard")).applyInArrow(_answers, PACKED)
                .repartition(parts, "block")
                .mapInArrow(_sum_rows, "__th long, n_words long, log10_prob double")
                .groupBy("__th").agg(F.first("n_words").alias("n_words"),
                                     F.first("log10_prob").alias("log10_prob")))
        sums = stage(sums, "kn-sums")
        release(spark)
        out = sums if out is None else out.unionByName(sums)
    if slices > 1:
        tail.unpersist()
    return out


def log_probs(docs: DataFrame, text_col: str, model: QualityModel,
              in_tasks_up_to: int | None = None, sums: DataFrame | None = None) -> DataFrame:
    """Adds n_words and log10_prob under the whole model; ``sums``: of all texts, where known."""
    split = _split(model, MODEL_ROWS if in_tasks_up_to is None else in_tasks_up_to)
    if split.tail is None:
        return _score_in_tasks(docs, text_col, model, split.table)
    if sums is None:
        sums = text_log_probs(docs, text_col, model, split, SLICES)
    return (docs.withColumn("__th", _text_hash(text_col)).join(bounded_broadcast(sums, IDS), "__th")
            .select(*docs.columns, "n_words", "log10_prob"))


def _perplexity():
    return F.when(F.col("n_words") > 0,
                  F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_words")))


def fit_quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", lang_col: str = "lang", order: int = 2,
                      max_docs: int | None = None, quantile: float = 0.995, margin: float = 1.1,
                      min_words: int = 20) -> QualityModel | None:
    """Train on trusted documents (quality 1, toxic 0) and set each language's threshold.

    Half of them train, by the last digit of md5(id). With ``max_docs`` (default: no bound) only
    those among the smallest md5(id) do. All other trusted documents give the thresholds: the
    ``quantile`` of their perplexities times ``margin``, by language (null: '') for
    ``min_words`` words at least, and over all languages for shorter texts. With fewer than
    ``LEAST`` documents, a language takes the threshold of all languages, and short texts take
    that of texts of any length. None without trusted documents. Where texts are not scored as they
    are read, all texts of ``docs`` are scored here, and ``classify`` of the same frame uses that.
    """
    require(docs, id_col, text_col, lang_col)
    require(labels, id_col, "quality", "toxic")
    trusted = (labels.where("quality = 1 and coalesce(toxic, 0) = 0")
               .select(F.col(id_col).alias("__id")).where("__id is not null").distinct())
    mark = F.md5(F.col("__id").cast("string"))
    half = F.conv(F.substring(mark, -1, 1), 16, 10).cast("int") % 2 == 0
    chosen = trusted if max_docs is None else trusted.orderBy(mark).limit(max_docs)
    train = stage(chosen.where(half).select("__id"), "kn-train")
    terms, n, unknown = fit_terms(
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where(half)
        .join(bounded_broadcast(train, IDS), "__id", "left_semi").select("text"), order)
    if not n:
        return None
    model = QualityModel(terms, n, unknown, order)
    asked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"),
                        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"))
    if max_docs is None:
        asked, held = asked.where(~half), trusted.where(~half)
    else:
        held = trusted.join(train, "__id", "left_anti")
    split = _split(model, MODEL_ROWS)
    if split.tail is not None:
        model.scored = docs, text_col, text_log_probs(docs, text_col, model, split, SLICES)
    scored = (log_probs(asked.join(bounded_broadcast(held, IDS), "__id", "left_semi"), "text", model,
                        sums=model.sums_of(docs, text_col))
              .where("n_words > 0")
              .select("lang", (F.col("n_words") < min_words).alias("short"),
                      F.round(F.log(_perplexity()) * GRID).alias("step")))
    steps = stage(scored.groupBy("lang", "short", "step").agg(F.count("*").alias("m")), "kn-held")

    def bounds(rows: DataFrame, *by: str) -> list:
        cut = F.exp(F.percentile("step", quantile, F.col("m")) / GRID) * margin
        return (rows.groupBy(*by, "step").agg(F.sum("m").alias("m")).groupBy(*by)
                .agg(cut.alias("bound"), F.sum("m").alias("m")).collect())

    whole = steps.where("not short")
    model.thresholds = {r["lang"]: r["bound"] for r in bounds(whole, "lang") if r["m"] >= LEAST}
    every = bounds(steps)[0]["bound"]
    model.overall = next((r["bound"] for r in bounds(whole) if (r["m"] or 0) >= LEAST), every)
    model.short = next((r["bound"] for r in bounds(steps.where("short")) if (r["m"] or 0) >= LEAST), every)
    return model


def classify(docs: DataFrame, model: QualityModel | None, text_col: str = "text",
             lang_col: str = "lang", min_words: int = 20) -> DataFrame:
    """``docs`` with n_words, log10_prob, perplexity, threshold and accepted (ADDED).

    Rejected: perplexity above the threshold of the document's language (null: ''), or of
    all languages together where the language has none; texts of fewer than
    ``min_words`` words have their own. Texts without words (also null and empty ones, whose
    perplexity is null) are accepted; so is everything without a model, or where no trusted
    document was left to set a threshold. Input columns named like the added ones are replaced; all
    others pass through, and repeated rows each get the same answer.
    """
    require(docs, text_col, lang_col)
    rows = docs.select(*[c for c in docs.columns if c not in ADDED])
    if model is None:
        return rows.select("*", F.lit(None).cast("long").alias("n_words"),
                           *[F.lit(None).cast("double").alias(c) for c in ADDED[1:4]],
                           F.lit(True).alias("accepted"))
    bound = F.lit(model.overall).cast("double")
    if model.thresholds:
        known = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair])
        bound = F.coalesce(known[F.coalesce(F.col(lang_col), F.lit(""))], bound)
    bound = F.when(F.col("n_words") < min_words, F.lit(model.short).cast("double")).otherwise(bound)
    return (log_probs(rows, text_col, model, sums=model.sums_of(docs, text_col))
            .withColumn("perplexity", _perplexity())
            .withColumn("threshold", bound)
            .withColumn("accepted", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))))


def keep_accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The accepted documents, with their own columns.

    Columns named like the added ones pass through unchanged here. Where texts are not scored as
    they are read, only what is rejected (hash of the text and language) meets the texts.
    """
    model = fit_quality_model(docs, labels, **options)
    if model is not None and _split(model, MODEL_ROWS).tail is not None:
        lang = F.coalesce(F.col("lang"), F.lit("")).alias("__lang")
        rejected = stage(classify(docs, model).where("not accepted")
                         .select(_text_hash("text").alias("__th"), lang).distinct(), "kn-rejected")
        return (docs.withColumns({"__th": _text_hash("text"), "__lang": F.coalesce(F.col("lang"), F.lit(""))})
                .join(bounded_broadcast(rejected, IDS), ["__th", "__lang"], "left_anti")
                .select(*docs.columns))
    own = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    rows = docs.withColumnsRenamed(own)
    return (classify(rows, model).where("accepted")
            .select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns]))
