"""Repeated windows across a corpus: anchors, their classes, and what is left to compare.

Shared by the suffix sort over bytes (``suffix_dedup``) and the seed-and-extend
join over words (``substring_dedup``). A window is ``size`` consecutive tokens of
one document. Content chooses anchors (``arrays.Windows``): equal windows hold the
same anchor k-gram at the same place. An anchor extended to everything its windows
cover is its context; anchors with equal contexts form a class whose
windows are all equal, so only the class's first member needs a closer look:

1. ``anchor_events``: per class the first member, and which parts of its windows may
   equal windows of another class: those whose shared middle (a 16-bit signature) also
   stands around the same k-gram elsewhere.
2. ``open_windows``: documents meet their events. An anchor that is not its class's
   first repeats earlier text; parts with a signature of their own repeat nothing; the
   other windows, at the edges of repeats, are compared one by one.

A first row per class and task is kept before the shuffle, so copies travel once per
task. K-grams that a sample shows in very many contexts are spread by context (they
count as ``MULTI``, which only sends their windows to the exact comparison).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .staging import partitions_for, stage

BLOCK = 1 << 18          # bytes of text whose windows are in memory together (some 80 bytes for each)
FLUSH = 1 << 18          # rows a task sorts at once: tens of MB of arrays and their sorted copies
SAMPLE = 1 / 16
HOT_KEYS = 4096          # most k-grams spread by context: a bounded list in the task closure
SALTS = 64
C1, C2 = ar.U64(0x9E3779B97F4A7C15), ar.U64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Spec:
    """``words``: tokens are words, else bytes. ``by_doc``: an earlier window counts only
    in a document with a smaller id, else also at an earlier place in the same document."""

    words: bool
    size: int
    k: int
    by_doc: bool

    def windows(self, block: ar.TextBlock) -> tuple[ar.Windows, ar.Words | None]:
        if self.words:
            w = block.words()
            return ar.Windows(w.hashes, w.offs, self.size, self.k), w
        return ar.Windows(ar.BYTE_MIX[block.data], block.offs, self.size, self.k), None

    def codes(self, win: ar.Windows, contexts: np.ndarray) -> np.ndarray:
        """60-bit name of each anchor within its document; equal names: the same event."""
        return self.code((win.at - win.offs[win.doc]), contexts)

    def code(self, at: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        if self.by_doc:
            return contexts >> ar.U64(4)
        return (at.astype(ar.U64) << ar.U64(29)) | (contexts >> ar.U64(35))


KEYS = ("__doc", "__th")


def set_aside(df: DataFrame, taken) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that are named as in ``taken`` renamed, and their new names."""
    used, names = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.lower() in taken:
            names[c] = f"__own_{c}"
            while names[c].lower() in used:
                names[c] = "_" + names[c]
            used.add(names[c].lower())
    return (df.withColumnsRenamed(names) if names else df), names


def put_back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({new: old for old, new in names.items()}) if names else df


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``__th`` (hash of the text) and ``__doc`` (the id; without one, a rank before
    all ids, by text hash)."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    unnamed = F.lit(-(2**63) + 1) + text_hash.bitwiseAND(F.lit(2**62 - 1))
    return (docs.withColumn("__th", text_hash)
            .withColumn("__doc", F.coalesce(F.col(id_col).cast("long"), unnamed)))


# --- 1. classes -------------------------------------------------------------------------

ANCHORS = "key long, ctx long, sig long, doc long, at int, salt int"


def _anchor_rows(spec: Spec, hot: np.ndarray):
    hot = np.sort(hot)

    def flush(parts):
        key, ctx, sig, doc, at = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((at, doc, ar.fmix(key + ctx * C1)))
        key, ctx = key[order], ctx[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
        lead = order[new]
        key, ctx, sig, doc, at = key[new], ctx[new], sig[lead], doc[lead], at[lead]
        salt = np.zeros(len(key), np.int32)
        if len(hot):
            is_hot = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
            salt = np.where(is_hot, 1 + (ctx % ar.U64(SALTS)).astype(np.int32), 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)),
             pa.array(sig.view(np.int64)), pa.array(doc), pa.array(at.astype(np.int32)),
             pa.array(salt.astype(np.int32))],
            names=["key", "ctx", "sig", "doc", "at", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in ar.blocks(batch.column(1), BLOCK):
                win, _ = spec.windows(block)
                if not len(win.at):
                    continue
                parts.append((win.key, win.contexts(), win.signatures(),
                              ids[block.lo + win.doc], win.at - win.offs[win.doc]))
                size += len(win.at)
                if size >= FLUSH:
                    yield flush(parts)
                    parts, size = [], 0
        if parts:
            yield flush(parts)

    return run


def _first_rows(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        key, ctx, sig, doc, at, salt = (table.column(c).combine_chunks()
                                        .to_numpy(zero_copy_only=False) for c in
                                        ("key", "ctx", "sig", "doc", "at", "salt"))
        order = np.lexsort((at, doc, ctx, key))
        new = np.ones(len(key), bool)
        new[1:] = (key[order[1:]] != key[order[:-1]]) | (ctx[order[1:]] != ctx[order[:-1]])
        lead = order[new]
        key, ctx, sig = (c[lead].view(ar.U64) for c in (key, ctx, sig))
        doc, at, spread = doc[lead], at[lead], salt[lead] > 0
        mask = np.zeros(len(key), ar.U64)
        for q in range(ar.Windows.PARTS):
            own = (sig >> ar.U64(16 * q)) & ar.U64(0xFFFF)
            _, group, count = np.unique(ar.fmix(key + own * C1), return_inverse=True,
                                        return_counts=True)
            shared = (own > 0) & ((count[group] > 1) | spread)
            mask |= shared.astype(ar.U64) << ar.U64(q)
        event = (spec.code(at, ctx) << ar.U64(4)) | mask
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(event.view(np.int64))],
                                         names=["doc", "event"])

    return run


def anchor_events(docs: DataFrame, spec: Spec, text_col: str) -> DataFrame:
    """(doc, event): the first member of every class of ``keyed`` documents, staged."""
    src = docs.select("__doc", F.col(text_col).cast("string").alias("text"))
    none = np.zeros(0, ar.U64)
    sample = (src.sample(SAMPLE, seed=11).mapInArrow(_anchor_rows(spec, none), ANCHORS)
              .groupBy("key").agg(F.count("*").alias("c")).where("c >= 16"))
    hot = np.array([r["key"] for r in sample.orderBy(F.desc("c"), "key").limit(HOT_KEYS).collect()],
                   np.int64).view(ar.U64)
    rows = src.mapInArrow(_anchor_rows(spec, hot), ANCHORS)
    return stage(rows.repartition(partitions_for(docs), "key", "salt")
                 .mapInArrow(_first_rows(spec), "doc long, event long"), "repeat-events")


# --- 2. windows that need a comparison ---------------------------------------------------

OPEN = ("kind int, doc long, th long, pos int, lead long, window long, "
        "repeated array<int>, open array<int>")


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column (null: empty)."""
    offs = col.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.where(col.is_valid().to_numpy(zero_copy_only=False), np.diff(offs), 0)
    values = col.values.to_numpy(zero_copy_only=False)
    which, _ = ar.expand(offs[:-1], offs[:-1] + sizes - 1)
    return values[which], np.concatenate([[0], np.cumsum(sizes)])


def _pairs_column(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int) -> pa.Array:
    """List column of [lo, hi, lo, hi, ...] per document; rows are in document order."""
    flat = np.empty(2 * len(lo), np.int32)
    flat[0::2], flat[1::2] = lo, hi
    offs = 2 * np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(flat))


def _open_rows(spec: Spec):
    """Per document its repeated and its open windows; per open window its leading bytes
    and its hash, once per flush with the first place."""

    def windows(parts):
        doc, th, pos, lead, window = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((pos, doc, ar.fmix(window + lead * C2)))
        doc, th, pos, lead, window = (c[order] for c in (doc, th, pos, lead, window))
        new = np.ones(len(doc), bool)
        new[1:] = (window[1:] != window[:-1]) | (lead[1:] != lead[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        keep = (doc == doc[first]) & ((pos == pos[first]) | spec.by_doc)
        doc, th, pos, lead, window = (c[keep] for c in (doc, th, pos, lead, window))
        n = len(doc)
        none = pa.nulls(n, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n, np.int32)), pa.array(doc), pa.array(th),
             pa.array(pos.astype(np.int32)), pa.array(lead.view(np.int64)),
             pa.array(window.view(np.int64)), none, none],
            names=["kind", "doc", "th", "pos", "lead", "window", "repeated", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids, ths = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            events, event_offs = _lists(batch.column(3))
            for block in ar.blocks(batch.column(2), BLOCK):
                win, _ = spec.windows(block)
                lo, hi = event_offs[block.lo], event_offs[block.lo + block.n]
                mine = events[lo:hi].view(ar.U64)
                owner = ar.owners(event_offs[block.lo:block.lo + block.n + 1], hi - lo)
                name = ar.fmix((mine >> ar.U64(4)) + owner.astype(ar.U64) * C1)
                order = np.argsort(name)
                name, masks = name[order], (mine & ar.U64(15))[order]
                code = ar.fmix(spec.codes(win, win.contexts())
                               + win.doc.astype(ar.U64) * C1) if len(win.at) else win.key
                if len(name):
                    at = np.minimum(np.searchsorted(name, code), len(name) - 1)
                    found = name[at] == code
                    mask = np.where(found, masks[at], ar.U64(0))
                else:
                    found, mask = np.zeros(len(code), bool), code
                old = np.flatnonzero(~found)
                ask, first, last = [], [], []
                for q in range(win.PARTS):
                    lo, hi = win.part(q)
                    own = np.flatnonzero((((mask >> ar.U64(q)) & ar.U64(1)) > 0) & (lo <= hi))
                    ask.append(own)
                    first.append(lo[own])
                    last.append(hi[own])
                ask, first, last = (np.concatenate(c) for c in (ask, first, last))
                order = np.argsort(first)
                ask, first, last = ask[order], first[order], last[order]
                base = win.offs[:-1]
                n = block.n
                rows = slice(block.lo, block.lo + n)
                blank = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(ids[rows]), pa.array(ths[rows]),
                     pa.nulls(n, pa.int32()), blank, blank,
                     _pairs_column(win.doc[old], win.first[old] - base[win.doc[old]],
                                   win.last[old] - base[win.doc[old]], n),
                     _pairs_column(win.doc[ask], first - base[win.doc[ask]],
                                   last - base[win.doc[ask]], n)],
                    names=["kind", "doc", "th", "pos", "lead", "window", "repeated", "open"])
                if not len(ask):
                    continue
                start, which = ar.expand(first, last)
                doc = win.doc[ask][which]
                lead = np.zeros(len(start), ar.U64)
                if not spec.words:                     # the suffix's leading eight bytes
                    for j in range(8):
                        lead = (lead << ar.U64(8)) | block.data[start + j].astype(ar.U64)
                parts.append((ids[rows][doc], ths[rows][doc], start - base[doc], lead,
                              win.window_hashes(start)))
                held += len(start)
                if held >= FLUSH:
                    yield windows(parts)
                    parts, held = [], 0
        if parts:
            yield windows(parts)

    return run


def open_windows(docs: DataFrame, events: DataFrame, spec: Spec, text_col: str) -> DataFrame:
    """Staged rows: kind 0 per document (ranges of window starts: ``repeated`` and
    ``open``), kind 1 per open window (its place, leading bytes and hash)."""
    of_doc = events.groupBy(F.col("doc").alias("__doc")).agg(F.collect_list("event").alias("events"))
    rows = (docs.select("__doc", "__th", F.col(text_col).cast("string").alias("text"))
            .join(of_doc, "__doc", "left").select("__doc", "__th", "text", "events"))
    return stage(rows.mapInArrow(_open_rows(spec), OPEN), "repeat-windows")


# --- 3. documents with what they keep -----------------------------------------------------

ADDED = ["n_tokens", "n_removed", "n_spans", "removed", "kept"]


def _outcome(spec: Spec, text_at: int, columns: int):
    """Cut the repeated windows out of the texts (columns: the document's own columns, then
    repeated, open, firsts)."""

    def cut(block, win_offs, words, mask):
        n = len(mask)
        doc = ar.owners(win_offs, n)
        before = np.zeros(n, bool)
        before[1:] = mask[:-1]
        after = np.zeros(n, bool)
        after[:-1] = mask[1:]
        filled = win_offs[1:] > win_offs[:-1]
        before[win_offs[:-1][filled]] = False
        after[win_offs[1:][filled] - 1] = False
        lo, hi = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
        base = win_offs[:-1]
        span_offs = np.searchsorted(lo, win_offs)
        spans = pa.ListArray.from_arrays(
            pa.array(span_offs.astype(np.int32)),
            pa.StructArray.from_arrays([pa.array((lo - base[doc[lo]]).astype(np.int32)),
                                        pa.array((hi - base[doc[lo]]).astype(np.int32))],
                                       names=["start", "end"]))
        sums = np.concatenate([[0], np.cumsum(mask)])
        removed = sums[win_offs[1:]] - sums[win_offs[:-1]]
        if words is None:
            kept = block.data[~mask]
            ends = np.concatenate([[0], np.cumsum(~mask)])[win_offs]
        else:
            stay = np.flatnonzero(~mask)
            size = words.ends[stay] - words.starts[stay] + 1
            index, which = ar.expand(words.starts[stay], words.ends[stay])
            kept = np.append(block.data, np.uint8(32))[index]
            last = np.cumsum(size) - 1
            kept[last] = 32
            drop = np.zeros(len(kept), bool)
            if len(stay):
                d = doc[stay]
                drop[last[np.append(d[1:] != d[:-1], True)]] = True
            per_doc = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(stay, win_offs)]
            ends = per_doc - np.concatenate([[0], np.cumsum(drop)])[per_doc]
            kept = kept[~drop]
        text = pa.Array.from_buffers(pa.large_binary(), block.n,
                                     [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                      pa.py_buffer(kept.tobytes())])
        return removed, np.diff(span_offs), spans, text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated, rep_offs = _lists(batch.column(columns))
            opened, open_offs = _lists(batch.column(columns + 1))
            firsts, first_offs = _lists(batch.column(columns + 2))
            for block in ar.blocks(batch.column(text_at), BLOCK):
                rows = slice(block.lo, block.lo + block.n + 1)
                if spec.words:
                    win, words = spec.windows(block) if spec.by_doc else (None, block.words())
                    offs = words.offs
                else:
                    win, words, offs = None, None, block.offs
                n = int(offs[-1])
                edge = np.zeros(n + 1, np.int64)
                first_doc = ar.owners(first_offs[rows], first_offs[rows][-1] - first_offs[rows][0])
                first = firsts[first_offs[rows][0]:first_offs[rows][-1]]
                for values, value_offs, is_open in ((repeated, rep_offs, False),
                                                    (opened, open_offs, True)):
                    own = value_offs[rows]
                    pairs = values[own[0]:own[-1]].astype(np.int64)
                    at = offs[:-1][ar.owners(own // 2, len(pairs) // 2)]
                    lo, hi = pairs[0::2] + at, pairs[1::2] + at
                    if is_open and spec.by_doc and len(lo):
                        start, which = ar.expand(lo, hi)
                        doc = np.searchsorted(offs, start, "right") - 1
                        name = ar.fmix(win.window_hashes(start) + doc.astype(ar.U64) * C1)
                        known = ar.fmix(first.view(ar.U64) + first_doc.astype(ar.U64) * C1)
                        lo = start[~np.isin(name, known)]
                        hi = lo
                    np.add.at(edge, lo, 1)
                    np.add.at(edge, hi + 1, -1)
                flagged = np.cumsum(edge[:n]) > 0
                if not spec.by_doc and len(first):
                    flagged[offs[:-1][first_doc] + first] = False
                mask = ar.covered(np.flatnonzero(flagged), spec.size, n)
                removed, n_spans, spans, kept = cut(block, offs, words, mask)
                part = batch.slice(block.lo, block.n)
                yield pa.RecordBatch.from_arrays(
                    part.columns[:columns] + [pa.array(np.diff(offs)), pa.array(removed),
                                              pa.array(n_spans.astype(np.int64)), spans,
                                              kept.cast(pa.binary())],
                    names=list(batch.schema.names[:columns]) + ADDED)

    return run


def outcome(docs: DataFrame, found: DataFrame, firsts: DataFrame, spec: Spec,
            text_col: str) -> DataFrame:
    """``docs`` with ADDED columns; ``firsts`` (doc, th, first): open windows that stay."""
    own = [c for c in docs.columns if c not in ADDED and c not in KEYS]
    ranges = (found.where("kind = 0").groupBy(F.col("doc").alias("__doc"), F.col("th").alias("__th"))
              .agg(F.first("repeated").alias("__repeated"), F.first("open").alias("__open")))
    stay = (firsts.groupBy(F.col("doc").alias("__doc"), F.col("th").alias("__th"))
            .agg(F.collect_list("first").alias("__firsts")))
    rows = (docs.select(*own, "__doc", "__th").join(ranges, ["__doc", "__th"], "left")
            .join(stay, ["__doc", "__th"], "left").select(*own, "__repeated", "__open", "__firsts"))
    schema = docs.select(*own).schema
    added = (", ".join(["n_tokens long", "n_removed long", "n_spans long",
                        "removed array<struct<start:int,end:int>>", "kept binary"]))
    from pyspark.sql.types import StructType

    full = StructType(schema.fields + StructType.fromDDL(added).fields)
    return rows.mapInArrow(_outcome(spec, own.index(text_col), len(own)), full)
