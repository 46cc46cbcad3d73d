"""Exact removal of repeated byte strings by a distributed sparse suffix sort.

Suffixes are sorted only where an answer is open. The shared engine
(``repeats``) first drops every suffix whose leading k-gram occurs once in the corpus
and those that copy, with all their surroundings, an earlier place. The suffixes that
remain are range-partitioned by their leading bytes: Spark samples them for
splitters, each bucket sorts its own by a multikey sort (leading eight bytes, ties by
the fingerprint of the whole window, ties by place), and neighbours are compared.
Splitters are window values, so equal suffixes never lie on two sides of a boundary;
copies of one suffix are reduced to its first place per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .repeats import ADDED, KEYS, Spec, anchor_events, keyed, open_windows, outcome, put_back, set_aside
from .staging import partitions_for, release, require, stage


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Sort order by several keys: the first key splits all rows, each further key
    sorts only the rows still tied."""
    order = np.argsort(keys[0], kind="stable")
    tied = np.arange(len(order))
    for depth in range(1, len(keys)):
        same = np.ones(len(tied), bool)
        seen = [k[order[tied]] for k in keys[:depth]]
        adjacent = np.zeros(len(tied), bool)
        if len(tied) > 1:
            adjacent[1:] = np.diff(tied) == 1
            for s in seen:
                adjacent[1:] &= s[1:] == s[:-1]
        group = np.cumsum(~adjacent)
        same = np.bincount(group)[group] > 1
        tied, group = tied[same], group[same]
        if not len(tied):
            break
        rows = order[tied]
        order[tied] = rows[np.lexsort((keys[depth][rows], group))]
    return order


def _bucket_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The earliest place of every window value of one bucket."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    doc, th, pos, lead, window = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
                                  for c in ("doc", "th", "pos", "lead", "window"))
    order = multikey_order([lead.view(ar.U64), window.view(ar.U64), doc, pos])
    doc, th, pos, lead, window = (c[order] for c in (doc, th, pos, lead, window))
    new = np.ones(len(doc), bool)
    new[1:] = (lead[1:] != lead[:-1]) | (window[1:] != window[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    keep = (doc == doc[first]) & (pos == pos[first])
    yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(th[keep]), pa.array(pos[keep])],
                                     names=["doc", "th", "first"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = 100, k: int = 32) -> DataFrame:
    """``docs`` with n_tokens (bytes), n_removed, n_spans, removed (spans) and kept (bytes).

    Every byte covered by a ``size``-byte string that also starts earlier (smaller
    id, or same document, earlier start) is removed; strings are judged on the input.

    Null or empty text: nothing kept, nothing removed. Rows without an id rank before
    all others, by text hash; rows that share an id rank equal: at the same start neither is earlier, and rows
    that repeat id and text get the same answer. Input columns named like the added
    ones are replaced; all others pass through.
    """
    require(docs, id_col, text_col)
    docs, names = set_aside(docs, KEYS)
    id_col, text_col = names.get(id_col, id_col), names.get(text_col, text_col)
    spec = Spec(words=False, size=size, k=k, by_doc=False)
    rows = keyed(docs, id_col, text_col)
    n = partitions_for(docs)
    events = anchor_events(rows, spec, text_col)
    release(docs.sparkSession)
    found = open_windows(rows, events, spec, text_col)
    release(docs.sparkSession)
    firsts = (found.where("kind = 1").select("doc", "th", "pos", "lead", "window")
              .repartitionByRange(n, "lead", "window")
              .mapInArrow(_bucket_firsts, "doc long, th long, first int"))
    return put_back(outcome(rows, found, stage(firsts, "suffix-firsts"), spec, text_col), names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = 100) -> DataFrame:
    """``docs`` with repeated strings cut out of the text, all columns kept.

    A character cut in two is dropped whole (so is a replacement character in a cut text); ``n_chars``, if there, is counted anew;
    a document that nothing is left of is dropped (an empty one stays).
    """
    columns = docs.columns
    docs, names = set_aside(docs, [*ADDED, "__t"])
    id_col, text_col = names.get(id_col, id_col), names.get(text_col, text_col)
    out = suffix_dedup(docs, id_col, text_col, size)
    text = F.when(F.col("n_removed") == 0, F.col(text_col)).otherwise(
        F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit("")))
    out = out.where("n_removed < n_tokens or n_tokens = 0").withColumn("__t", text)
    cols = [F.col("__t").alias(c) if c == text_col else
            F.length("__t").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
            for c in docs.columns]
    return put_back(out.select(*cols), names).select(*[F.col(f"`{c}`") for c in columns])
