"""Log probability of texts under a bigram model kept in Elias-Fano tries.

The model learns from the training documents' whole texts: P1 is the add-one unigram
probability, and for a context v that was seen

    P2(w | v) = max(c(v w) - D, 0) / c(v) + g(v) P1(w)

over the bigrams seen at least ``min_count`` times; g(v) is what they leave. A document's
score is the sum over its tokens. Each token but the marks is once the context of a
bigram, so  score = base + sum of d(v w),  d = log10(P2(w | v) / P1(w)), and every part
is a lookup by context: bigrams are sharded by their first word, and a shard answers for
all its bigrams alone.

* count: tasks pack the distinct bigrams of their training text per shard, shards add up.
* model: a shard's bigrams meet their second words' counts (those of common words from a
  bounded table, the others asked for once per shard), and each shard becomes a
  trie: contexts, their monotone pointers into the successors, successors relative to
  their context, all Elias-Fano coded, with probabilities quantised to a byte.
* score: blocks of documents ask for their distinct bigrams, packed per shard; the shard's
  trie, memory-mapped in the task, answers with the contexts' counts and the gains. The answers
  meet the block's lists of documents, and are summed there.

Very common words (from a bounded list, found in a sample) are spread over the shards by
their successor; their totals (a bounded table) go to all tasks.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .elias_fano import EliasFano, from_buffer, to_bytes
from .staging import partitions_for, release, require, stage, unstage

END = ar.U64(0x452821E638D01377)
FLUSH = 1 << 19           # tokens of a block of documents
DISCOUNT = 0.75
HOT_WORDS = 512
SAMPLE = 1 / 32
COMMON_WORDS = 1 << 17    # at most so many words, with their counts, go to all tasks
BOOK_WORDS = (1 << 16) - 1  # words with a two-byte code in what is shuffled; 0 stands for others
QUERIES = 1 << 18         # bigrams of several blocks that a trie is asked at once


def _tokens(block: ar.TextBlock):
    """Context and word of every token, and its document: words, then one end; the first
    word's context is the end too."""
    w = block.words(lower=True)
    doc = ar.owners(w.offs, len(w.hashes))
    word = np.full(len(w.hashes) + block.n, END, ar.U64)
    word[np.arange(len(w.hashes)) + doc] = w.hashes
    return np.roll(word, 1), word, np.repeat(np.arange(block.n, dtype=np.int32), np.diff(w.offs) + 1)


def _squeeze(arrays: list[np.ndarray]) -> bytes:
    raw = to_bytes(arrays)
    return np.array([len(raw)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unsqueeze(data: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(data[:8], np.int64)[0])
    return from_buffer(pa.decompress(data[8:], size, "zstd"))


def _narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


class Book:
    """Two-byte codes of common words, in the order of the sample; other words go as they are.
    Only how words are written down depends on it."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.order = np.argsort(words)
        self.sorted = words[self.order]

    def encode(self, words: np.ndarray) -> list[np.ndarray]:
        at, known = _among(words, self.sorted)
        code = np.zeros(len(words), np.uint16)
        code[known] = self.order[at[known]] + 1
        return [code, words[~known]]

    def decode(self, code: np.ndarray, others: np.ndarray) -> np.ndarray:
        out = np.empty(len(code), ar.U64)
        known = code > 0
        out[known] = self.words[code[known].astype(np.int64) - 1]
        out[~known] = others
        return out


PACKED = "shard int, kind int, block long, data binary"


def _packed(shard, kind, block, data) -> pa.RecordBatch:
    n = len(data)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([block] * n, pa.int64()),
         pa.array(data, pa.binary())], names=["shard", "kind", "block", "data"])


def _bigram_rows(shards: int, hot: np.ndarray, book: Book, with_docs: bool):
    """Distinct bigrams of a block of documents, packed per shard (kind 0): contexts, how many
    successors each, successors (both by the code book), how often each. with_docs: no counts, but a row of the block
    (kind 1) with its documents, the shards asked and the number of bigrams each, how often
    each bigram occurs and the document of each occurrence. Columns: doc_id, held_out, text."""
    hot = np.sort(hot)

    def flush(parts, docs, block):
        v, w, doc = (np.concatenate(c) for c in zip(*parts))
        pair = np.argsort(ar.fmix(v * ar.BASE + w))
        v, w, doc = v[pair], w[pair], doc[pair]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        lead = np.flatnonzero(new)
        count = np.diff(np.append(lead, len(v)))
        v1, w1 = v[lead], w[lead]
        spread = v1
        if len(hot):
            is_hot = hot[np.minimum(np.searchsorted(hot, v1), len(hot) - 1)] == v1
            spread = np.where(is_hot, ar.fmix(v1 ^ (w1 * ar.BASE)), v1)
        shard = ((spread >> ar.U64(20)) % ar.U64(shards)).astype(np.int64)
        order = np.argsort((shard.astype(ar.U64) << ar.U64(44)) | (v1 >> ar.U64(20)))
        v1, w1, count, shard, lead = v1[order], w1[order], count[order], shard[order], lead[order]
        cut = np.searchsorted(shard, np.arange(shards + 1))
        rows, ids = [], np.unique(shard)
        for s in ids:
            lo, hi = cut[s], cut[s + 1]
            head = np.flatnonzero(np.append(True, v1[lo + 1:hi] != v1[lo:hi - 1]))
            data = book.encode(v1[lo:hi][head]) + [_narrow(np.diff(np.append(head, hi - lo)))] \
                + book.encode(w1[lo:hi])
            rows.append(_squeeze(data if with_docs else data + [_narrow(count[lo:hi])]))
        yield _packed(ids, 0, block, rows)
        if with_docs:
            occurrence, _ = ar.expand(lead, lead + count - 1)
            own = [np.concatenate(c) for c in zip(*docs)]
            yield _packed([block % shards], 1, block, [_squeeze(
                own + [_narrow(ids), _narrow(np.diff(cut)[ids]), _narrow(count), _narrow(doc[occurrence])])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, held, n_docs = [], [], 0, 0
        block_id = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            out = batch.column(1).to_numpy(zero_copy_only=False)
            for block in ar.blocks(batch.column(2)):
                v, w, doc = _tokens(block)
                rows = slice(block.lo, block.lo + block.n)
                if with_docs:
                    docs.append((ids[rows], known[rows], out[rows], np.bincount(doc, minlength=block.n)))
                parts.append((v, w, doc + np.int32(n_docs)))
                n_docs += block.n
                held += len(v)
                if held >= FLUSH:
                    yield from flush(parts, docs, block_id)
                    block_id += 1
                    parts, docs, held, n_docs = [], [], 0, 0
        if parts:
            yield from flush(parts, docs, block_id)

    return run


def _by_shard(batches, kinds=(0,)):
    """(shard, rows of each kind as (block, data)) of one partition."""
    rows: dict[int, dict[int, list]] = {}
    for b in batches:
        for shard, kind, block, data in zip(*(c.to_pylist() for c in b.columns)):
            rows.setdefault(shard, {k: [] for k in kinds})[kind].append((block, data))
    yield from sorted(rows.items())


COUNTS = "shard int, data binary, v long, c long, mass double"


def _table(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _count_rows(min_count: int, hot: np.ndarray, book: Book):
    """Per shard one packed row (data: contexts, their counts and kept mass, kept bigrams each,
    their words and counts), and a row (v, c) of every context; those of hot words, which
    several shards hold parts of, with their mass."""
    hot = np.sort(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            parts = []
            for _, data in rows[0]:
                v, v_rest, sizes, w, w_rest, count = _unsqueeze(data)
                parts.append((np.repeat(book.decode(v, v_rest), sizes), book.decode(w, w_rest),
                              count.astype(np.int64)))
            v, w, c = (np.concatenate(x) for x in zip(*parts))
            del parts
            order = np.lexsort((w, v))
            v, w, c = v[order], w[order], c[order]
            lead = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])))
            c = np.add.reduceat(c, lead)
            v, w = v[lead], w[lead]
            head = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            keep = c >= min_count
            total = np.add.reduceat(c, head)
            mass = np.add.reduceat(np.where(keep, c - DISCOUNT, 0.0), head)
            sizes = np.add.reduceat(keep.astype(np.int64), head)
            n, own = len(head), v[head]
            packed = _squeeze([own, _narrow(total), mass, _narrow(sizes), w[keep], _narrow(c[keep])])
            yield _table({"shard": pa.array([shard], pa.int32()), "data": pa.array([packed], pa.binary()),
                          "v": pa.nulls(1, pa.int64()), "c": pa.nulls(1, pa.int64()),
                          "mass": pa.nulls(1, pa.float64())})
            yield _table({"shard": pa.nulls(n, pa.int32()), "data": pa.nulls(n, pa.binary()),
                          "v": pa.array(own.view(np.int64)), "c": pa.array(total),
                          "mass": pa.array(mass, mask=~_among(own, hot)[1])})

    return run


def _among(x: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted ``keys``, and whether each of ``x`` stands there."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


def _asked(common: np.ndarray):
    """(shard, w): the second words of each shard that are not in the table of common words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(*(c.to_pylist() for c in batch.columns)):
                w = np.unique(_unsqueeze(data)[4])
                w = w[~_among(w, common)[1]]
                yield _table({"shard": pa.array(np.full(len(w), shard, np.int32)),
                              "w": pa.array(w.view(np.int64))})

    return run


def _common_words(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words and their counts, as many whole classes of counts (an eighth of
    a doubling each) as make ``most`` words or fewer."""
    level = F.floor(F.log2("c") * 8).cast("int")
    least, room = None, most
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, ar.U64), np.zeros(0, np.int64)
    table = counts.where(level >= least).select("v", "c").toArrow()
    v, c = (table.column(i).combine_chunks().to_numpy().copy() for i in range(2))
    order = np.argsort(v.view(ar.U64))
    return v.view(ar.U64)[order], c[order]


def _quantise(x: np.ndarray) -> list[np.ndarray]:
    """Byte codes and their code book. Up to 256 values are kept as they are; more fall
    into bins between quantiles and even steps, each standing for its mean."""
    if not len(x):
        return [np.zeros(0, np.uint8), np.zeros(1)]
    values, code = np.unique(x, return_inverse=True)
    if len(values) <= 256:
        return [code.astype(np.uint8), values]
    edges = np.unique(np.concatenate([np.quantile(x, np.linspace(0, 1, 129)[1:-1]),
                                      np.linspace(values[0], values[-1], 130)[1:-1]]))
    code = np.searchsorted(edges, x, "right")
    size = np.bincount(code, minlength=len(edges) + 1)
    book = np.bincount(code, x, minlength=len(edges) + 1) / np.maximum(size, 1)
    return [code.astype(np.uint8), book]


def _trie_rows(hot: "_Hot", common: tuple[np.ndarray, np.ndarray], n: int, vocabulary: int):
    """Packed trie of every shard (kind 2). Rows: a shard's packed counts (data), or a second
    word that it asked for and its count (w, c)."""
    bottom = float(n + vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, replies = {}, []
        for batch in batches:
            shard, data, w, c = batch.columns
            full = data.is_valid()
            packed.update(zip(shard.filter(full).to_pylist(), data.filter(full).to_pylist()))
            rest = w.is_valid()
            replies.append([x.filter(rest).to_numpy(zero_copy_only=False) for x in (shard, w, c)])
        if not packed:
            return
        of, word, number = (np.concatenate(x) for x in zip(*replies))
        order = np.lexsort((word.view(ar.U64), of))
        of, word, number = of[order], word.view(ar.U64)[order], number[order]
        for s in sorted(packed):
            v, total, mass, sizes, w, c = _unsqueeze(packed.pop(s))
            total = total.astype(np.int64)
            at, is_hot = _among(v, hot.words)      # a common word's totals replace the shard's part
            if len(hot.words):
                total, mass = np.where(is_hot, hot.counts[at], total), np.where(is_hot, hot.masses[at], mass)
            left = 1.0 - mass / total
            words = np.unique(w)
            second = np.zeros(len(words), np.int64)
            own = slice(*np.searchsorted(of, [s, s + 1]))
            for keys, values in (common, (word[own], number[own])):
                at, found = _among(words, keys)
                second[found] = values[at[found]]
            ctx, rank = np.repeat(np.arange(len(v)), sizes), np.searchsorted(words, w)
            p1 = (second[rank] + 1) / bottom
            p2 = (c - DISCOUNT) / total[ctx] + left[ctx] * p1
            value = ctx.astype(ar.U64) * ar.U64(max(1, len(words))) + rank.astype(ar.U64)
            counts, code = np.unique(total, return_inverse=True)
            levels = (EliasFano.build(v) + EliasFano.build(words)
                      + EliasFano.build(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(ar.U64))
                      + EliasFano.build(value))
            arrays = levels + [_narrow(code), counts] + _quantise(np.log10(left)) \
                + _quantise(np.log10(p2 / p1))
            yield _packed([int(s)], 2, 0, [to_bytes(arrays)])

    return run


class _Hot:
    """Counts and kept masses of the very common words, by their hash."""

    def __init__(self, totals: dict[int, tuple[int, float]]):
        self.words = np.array(sorted(totals), ar.U64)
        self.counts = np.array([totals[int(k)][0] for k in self.words], np.int64)
        self.masses = np.array([totals[int(k)][1] for k in self.words], np.float64)


class Trie:
    """A shard's levels, memory-mapped from a file."""

    def __init__(self, path: str):
        arrays = from_buffer(np.memmap(path, np.uint8, "r"))
        k = EliasFano.PARTS
        self.contexts, self.words, self.pointers, self.successors = (
            EliasFano(arrays[i * k:i * k + k]) for i in range(4))
        (self.code, self.counts, self.left, self.left_book, self.gain, self.gain_book) = arrays[4 * k:]

    def context(self, v: np.ndarray):
        """Place (-1: unseen), count and log10 of what is left to unlisted successors."""
        at = self.contexts.find(v)
        seen = at >= 0
        count, left = np.zeros(len(v), np.int64), np.zeros(len(v))
        count[seen] = self.counts[self.code[at[seen]]]
        left[seen] = self.left_book[self.left[at[seen]]]
        return at, count, left

    def gains(self, at: np.ndarray, w: np.ndarray, left: np.ndarray) -> np.ndarray:
        """log10(P2 / P1) of the bigrams of contexts at places ``at``: the word's place relative
        to its context is searched among that context's successors."""
        out = left.copy()
        rows = np.flatnonzero(at >= 0)
        span = self.pointers.at(at[rows] + 1) > self.pointers.at(at[rows])
        rows = rows[span]
        rank = self.words.find(w[rows])
        rows, rank = rows[rank >= 0], rank[rank >= 0]
        value = at[rows].astype(ar.U64) * ar.U64(max(1, self.words.n)) + rank.astype(ar.U64)
        place = self.successors.find(value)
        hit = place >= 0
        out[rows[hit]] = self.gain_book[self.gain[place[hit]]]
        return out


def _score_rows(hot: _Hot, book: Book):
    """The shards' answers to blocks of documents (kind 0): counts of the contexts asked for,
    how many bigrams each, and the bigrams' gains; the blocks' own rows pass through (kind 1)."""
    lefts = np.log10(1.0 - hot.masses / hot.counts)

    def answer(trie, shard, asked):
        v, sizes, w = (np.concatenate([a[i] for a in asked]) for i in (1, 2, 3))
        if trie:
            at, count, left = trie.context(v)
        else:
            at, count, left = np.full(len(v), -1), np.zeros(len(v), np.int64), np.zeros(len(v))
        if len(hot.words):
            i, common = _among(v, hot.words)
            count, left = np.where(common, hot.counts[i], count), np.where(common, lefts[i], left)
        ctx = np.repeat(np.arange(len(v)), sizes)
        gain = (trie.gains(at[ctx], w, left[ctx]) if trie else left[ctx]).astype(np.float32)
        of_v, of_w = (np.cumsum([0] + [len(a[i]) for a in asked]) for i in (1, 3))
        data = [_squeeze([_narrow(count[of_v[k]:of_v[k + 1]]), a[2], gain[of_w[k]:of_w[k + 1]]])
                for k, a in enumerate(asked)]
        n = len(asked)
        return _table({"shard": pa.array([shard] * n, pa.int32()), "kind": pa.array([0] * n, pa.int32()),
                       "block": pa.array([a[0] for a in asked], pa.int64()), "data": pa.array(data, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches, (0, 1, 2)):
            for block, data in rows[1]:
                yield _packed([shard], 1, block, [data])
            trie = None
            if rows[2]:
                fd, path = tempfile.mkstemp(prefix="trie-")
                with os.fdopen(fd, "wb") as f:
                    f.write(rows[2][0][1])
                trie = Trie(path)
                os.unlink(path)                      # the map keeps the file until it is closed
            asked, held = [], 0
            for block, data in rows[0]:
                v, v_rest, sizes, w, w_rest = _unsqueeze(data)
                asked.append((block, book.decode(v, v_rest), sizes, book.decode(w, w_rest)))
                held += len(w)
                if held >= QUERIES:
                    yield answer(trie, shard, asked)
                    asked, held = [], 0
            if asked:
                yield answer(trie, shard, asked)

    return run


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def _block_scores(n: int, vocabulary: int):
    """Scores of the documents of each block, from its own row and its shards' answers."""
    bottom = math.log10(n + vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[int, dict] = {}
        owners: dict[int, bytes] = {}
        for b in batches:
            for shard, kind, block, data in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 1:
                    owners[block] = data
                else:
                    answers.setdefault(block, {})[shard] = data
        for block in sorted(owners):
            ids, valid, held, tokens, shards, asked, times, doc = _unsqueeze(owners.pop(block))
            count, gain = np.zeros(len(times), np.int64), np.zeros(len(times))
            got, at = answers.pop(block), 0
            for shard, size in zip(shards.tolist(), asked.tolist()):
                c, each, g = _unsqueeze(got.pop(shard))
                count[at:at + size], gain[at:at + size] = np.repeat(c, each), g
                at += size
            size = len(ids)
            known = np.bincount(doc, np.repeat(count > 0, times), minlength=size).astype(np.int64)
            base = np.bincount(doc, np.repeat(np.log10(count + 1.0), times), minlength=size) - tokens * bottom
            gain = np.bincount(doc, np.repeat(gain, times), minlength=size)
            yield _table({"doc_id": pa.array(ids, mask=~valid), "held_out": pa.array(held),
                          "n_tokens": pa.array(tokens), "n_known": pa.array(known),
                          "train_tokens": pa.array(np.full(size, n, np.int64)),
                          "base_score": pa.array(base), "score": pa.array(base + gain)})

    return run


def _sampled_words(texts: DataFrame) -> np.ndarray:
    """Words of a sample of the texts, the most frequent first, ``BOOK_WORDS`` at most."""
    def run(batches):
        for batch in batches:
            for block in ar.blocks(batch.column(0)):
                v, _, _ = _tokens(block)
                word, count = np.unique(v, return_counts=True)
                yield _table({"v": pa.array(word.view(np.int64)), "c": pa.array(count)})

    counts = (texts.sample(SAMPLE, seed=3).mapInArrow(run, "v long, c long").groupBy("v")
              .agg(F.sum("c").alias("c")).where("c >= 2"))
    words, c = _common_words(counts, BOOK_WORDS)
    return words[np.lexsort((words, -c))]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
                held_fold: int = 2, min_count: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row.

    The model learns from documents whose crc32(id as text) modulo ``folds`` is not
    ``held_fold``. Tokens: words (lower-cased A-Z), then one end. ``base_score`` is the
    add-one unigram log10 probability, ``score`` the model's.

    Null or empty text: the end alone. A null id counts as the empty text in the fold.
    Repeated rows each get their row. An empty table gives none. Other columns are ignored.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      (F.crc32(name.cast("binary")) % folds == held_fold).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    n_parts = partitions_for(docs)
    shards = 4 * n_parts
    book = Book(_sampled_words(src.select("text")))
    hot = book.words[:HOT_WORDS]
    counts = stage(src.where("not held_out").mapInArrow(_bigram_rows(shards, hot, book, False), PACKED)
                   .repartition(n_parts, "shard").mapInArrow(_count_rows(min_count, hot, book), COUNTS),
                   "lm-counts")
    release(spark)
    contexts = counts.where("data is null").select("v", "c", "mass")
    totals = _Hot({int(np.int64(r["v"]).view(ar.U64)): (r["c"], r["mass"]) for r in
                   contexts.where("mass is not null").groupBy("v")
                   .agg(F.sum("c").alias("c"), F.sum("mass").alias("mass")).collect()})
    rest = contexts.where("mass is null").select("v", "c")
    row = rest.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n = row["n"] + int(totals.counts.sum())
    vocabulary = row["v"] + len(totals.words)

    words, numbers = _common_words(rest, COMMON_WORDS)
    words, numbers = np.append(words, totals.words), np.append(numbers, totals.counts)
    order = np.argsort(words)
    common = words[order], numbers[order]
    shard_rows = counts.where("data is not null").select("shard", "data")
    replies = (shard_rows.mapInArrow(_asked(common[0]), "shard int, w long").hint("merge")
               .join(rest.withColumnRenamed("v", "w"), "w"))
    none = F.lit(None).cast("long")
    tries = stage(shard_rows.select("shard", "data", none.alias("w"), none.alias("c"))
                  .unionByName(replies.select("shard", F.lit(None).cast("binary").alias("data"), "w", "c"))
                  .repartition(n_parts, "shard").mapInArrow(_trie_rows(totals, common, n, vocabulary), PACKED),
                  "lm-tries")
    del contexts, rest, shard_rows, replies
    unstage(counts)                                  # the tries hold all that is needed of it
    release(spark)
    packed = src.mapInArrow(_bigram_rows(shards, hot, book, True), PACKED)
    return (packed.unionByName(tries).repartition(n_parts, "shard")
            .mapInArrow(_score_rows(totals, book), PACKED).repartition(n_parts, "block")
            .mapInArrow(_block_scores(n, vocabulary), SCORES)
            .withColumnRenamed("doc_id", id_col))
