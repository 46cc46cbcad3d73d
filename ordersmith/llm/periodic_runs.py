"""Periodic runs of words in documents, and texts with the repeats collapsed.

A run is a stretch of words whose smallest period is at most half its length and that no
neighbouring word extends. Words become letters, and runs come from Lyndon roots
(``lyndon.py``): Baier's grouping gives the Lyndon arrays of both orders, and roots are extended
through common extensions.

The string that is sorted holds the words that can lie in a run. All windows of half the least
length that begin in a run, but for its last period, stand in the document again one period
later; together the two cover the run. A stretch of words outside all windows that stand
twice in their document therefore meets no run, and becomes one letter of its own: the runs
of the shorter string are those of the text. ``shorten=False`` sorts every word and gives
the same (tests hold both against brute force); on ordinary text it costs some ten times more.

Texts are independent: one pass in Arrow batches, no shuffle. A block of about a megabyte of
texts is sorted as one string, texts kept apart by letters of their own; a longer text is a
block of its own (about 100 bytes a word while it is sorted).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import lyndon
from .arrays import BASE, U64, TextBlock, Words, blocks, covered, fmix, owners
from .staging import require

ADDED = ["n_words", "runs", "collapsed"]


def repeated_words(w: Words, size: int) -> np.ndarray:
    """Mask of the words in a window of ``size`` words that its document holds twice."""
    h, offs = w.hashes, w.offs
    n = len(h)
    if n < size:
        return np.zeros(n, bool)
    doc = owners(offs, n)
    m = n - size + 1
    key = doc[:m].astype(U64) * U64(0x9E3779B97F4A7C15)
    for j in range(size):
        key *= BASE
        key += h[j:j + m]
    at = np.flatnonzero(doc[:m] == doc[size - 1:])
    key = fmix(key[at])
    order = np.argsort(key)
    again = np.flatnonzero(key[order][1:] == key[order][:-1])
    return covered(at[np.union1d(order[again], order[again + 1])], size, n)


def block_runs(w: Words, least: int, shorten: bool = True) -> np.ndarray:
    """(document, start, length, period) of the runs in a block's documents, sorted."""
    n = len(w.hashes)
    doc = owners(w.offs, n)
    at = np.flatnonzero(repeated_words(w, -(-least // 2))) if shorten else np.arange(n)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    _, letter = np.unique(w.hashes[at], return_inverse=True)
    begins = np.append(True, (np.diff(at) > 1) | (np.diff(doc[at]) > 0))
    stretch = np.cumsum(begins)
    place = np.arange(len(at)) + stretch            # one letter of its own before each stretch
    string = np.empty(len(at) + int(stretch[-1]), np.int64)
    string[place] = letter
    string[place[begins] - 1] = len(at) + np.arange(int(stretch[-1]))
    word = np.full(len(string), -1, np.int64)
    word[place] = at
    found = lyndon.runs(string, least)
    first = word[found[:, 0]]
    owner = doc[first]
    return np.stack([owner, first - w.offs[owner], found[:, 1], found[:, 2]], axis=1)


def collapse(block: TextBlock, w: Words, found: np.ndarray) -> pa.Array:
    """Texts without the words that repeat a run's first period, joined by one space."""
    n = len(w.hashes)
    edge = np.zeros(n + 1, np.int64)
    start = w.offs[found[:, 0]] + found[:, 1]
    np.add.at(edge, start + found[:, 3], 1)
    np.add.at(edge, start + found[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(edge[:n]) == 0)
    doc = owners(w.offs, n)[kept]
    later = np.zeros(len(kept), bool)
    later[1:] = doc[1:] == doc[:-1]
    data = block.data.copy()
    begin = w.starts[kept] - later                  # the separator before a later word: its space
    data[begin[later]] = 0x20
    mark = np.zeros(len(data) + 1, np.int64)
    np.add.at(mark, begin, 1)
    np.add.at(mark, w.ends[kept], -1)
    keep = np.cumsum(mark[:-1]) > 0
    sizes = np.concatenate([[0], np.cumsum(keep)])[block.offs]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), block.n, [None, pa.py_buffer(sizes.astype(np.int64).tobytes()),
                                     pa.py_buffer(data[keep].tobytes())]).cast(pa.string())


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = 12,
                  shorten: bool = True) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start, then period) and collapsed.

    Words are separated by ASCII white space and numbered from 0; ``least`` is the least
    length of a run in words. ``collapsed`` is the text without the words that stand in a run
    behind its first period.

    Null, empty and white texts have no words, no runs and an empty collapsed text. Input
    columns named like the added ones are replaced; all others pass through, and so do
    repeated rows and rows without an id. An empty table gives none. Words are compared by
    64-bit hashes.
    """
    require(docs, text_col)
    if least < 2:
        raise ValueError("a run has at least two words")
    kept = [c for c in docs.columns if c not in ADDED or c == text_col]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("string").alias("text"))
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                w = block.words()
                found = block_runs(w, least, shorten)
                offs = np.searchsorted(found[:, 0], np.arange(block.n + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays(
                    [pa.array(found[:, c]) for c in (1, 2, 3)], fields=list(triple))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.lo, block.n), pa.array(np.diff(w.offs), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offs), items), collapse(block, w, found)],
                    names=["row"] + ADDED)

    fields = StructType.fromDDL("n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                "collapsed string").fields
    out = rows.mapInArrow(run, StructType([rows.schema["row"]] + fields))
    return out.select(*[F.col(f"row.`{c}`") for c in kept], *ADDED)


__all__ = ["periodic_runs", "block_runs", "repeated_words", "collapse"]
