"""Fill-in-middle: cut documents at token counts, counted by content-defined chunks.

A token is a word with the white space before it; white space at the end of a text is a
token of its own. Each text is cut into chunks where a rolling hash over its bytes says so,
so equal passages give equal chunks wherever they stand. A chunk has a boundary summary

    (word ends inside, begins with white space, ends in a word, code points)

and two neighbours combine: their word ends add up, plus one if the first ends in a word
and the second begins with white space. Summaries of chunks seen before come from a cache
keyed by content (found by hash, verified byte by byte); only new chunks are read. Running
sums of the combined counts show which chunk holds a document's cut, and only that chunk is
searched for the place.

The cache belongs to a task and holds at most ``CACHE_BYTES`` of chunks; it is emptied when
full, which costs time and changes nothing. There is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrays import BYTE_MIX, SEPARATOR, U64, TextBlock, blocks, fmix, powers
from .staging import require

WINDOW = 32                   # bytes under the rolling hash, and the shortest chunk's size
CHUNK_BITS = 9                # a chunk ends after 2**9 bytes on average
CACHE_BYTES = 32 << 20
LARGEST_CACHED = 1 << 16
MARKS = ("<P>", "<S>", "<M>")
ADDED = ["n", "form", "prefix_chars", "middle_chars", "output"]


def chunk_starts(block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of all texts begin, and the text each belongs to."""
    data, offs = block.data, block.offs
    n = len(data)
    first = offs[:-1][offs[1:] > offs[:-1]]
    starts = first
    if n > WINDOW:
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE_MIX[data] * up[:n], dtype=U64, out=sums[1:])
        at = np.arange(WINDOW, n)
        h = fmix((sums[at] - sums[at - WINDOW]) * down[at - WINDOW])
        cut = (h & U64((1 << CHUNK_BITS) - 1)) == 0
        cut &= (data[at] & 0xC0) != 0x80
        at = at[cut]
        inside = at - offs[np.searchsorted(offs, at, "right") - 1] >= WINDOW
        starts = np.union1d(first, at[inside])
    return starts, np.searchsorted(offs, starts, "right") - 1


def word_ends(data: np.ndarray) -> np.ndarray:
    """Positions of white space that follows a word's byte."""
    white = SEPARATOR[data]
    return np.flatnonzero(white[1:] & ~white[:-1]) + 1


def summarise(chunks: list[bytes]) -> np.ndarray:
    """Boundary summaries of chunks: one row each of (ends, begins white, ends in word, chars)."""
    sizes = np.array([len(c) for c in chunks], np.int64)
    data = np.frombuffer(b"".join(chunks), np.uint8)
    stop = np.cumsum(sizes)
    start = stop - sizes
    white = SEPARATOR[data]
    end = np.zeros(len(data), np.int64)
    end[1:] = white[1:] & ~white[:-1]
    end[start] = 0
    return np.stack([np.add.reduceat(end, start), white[start].astype(np.int64),
                     (~white[stop - 1]).astype(np.int64),
                     np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), start)], axis=1)


class ChunkCache:
    """Summaries of chunks by their bytes, in bounded memory."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held, self.hits, self.rows = limit, 0, 0, {}

    def summaries(self, chunks: list[bytes]) -> np.ndarray:
        known = [self.rows.get(c) for c in chunks]
        new = list({c: None for c, row in zip(chunks, known) if row is None})
        self.hits += len(chunks) - len(new)
        fresh = dict(zip(new, summarise(new))) if new else {}
        out = np.array([fresh[c] if row is None else row for c, row in zip(chunks, known)], np.int64)
        for c, row in fresh.items():
            if len(c) <= LARGEST_CACHED:
                if self.held + len(c) > self.limit:
                    self.rows, self.held = {}, 0
                self.rows[c] = row
                self.held += len(c)
        return out.reshape(-1, 4)


class Counted:
    """Token counts of a block's texts, and the places of cuts in them."""

    def __init__(self, block: TextBlock, cache: ChunkCache):
        self.block = block
        self.raw = block.data.tobytes()
        self.starts, owner = chunk_starts(block)
        stops = np.append(self.starts[1:], len(self.raw)).astype(np.int64)
        summary = cache.summaries([self.raw[a:b] for a, b in zip(self.starts, stops)])
        ends, white, word, chars = summary.T
        self.stops = stops
        same = np.zeros(len(owner), bool)
        same[1:] = owner[1:] == owner[:-1]
        self.joint = np.zeros(len(owner), np.int64)
        self.joint[1:] = word[:-1] & white[1:] & same[1:]
        self.ends = np.concatenate([[0], np.cumsum(ends + self.joint)])
        self.chars = np.concatenate([[0], np.cumsum(chars)])
        self.first = np.searchsorted(owner, np.arange(block.n))
        self.past = np.searchsorted(owner, np.arange(block.n), "right")
        filled = (block.offs[1:] > block.offs[:-1]).astype(np.int64)
        self.tokens = self.ends[self.past] - self.ends[self.first] + filled

    def cut(self, doc: int, k: int) -> tuple[int, int]:
        """(byte of the block, code points of the text before it) after ``k`` tokens."""
        lo, hi = int(self.block.offs[doc]), int(self.block.offs[doc + 1])
        base = int(self.chars[self.first[doc]])
        if k <= 0:
            return lo, 0
        if k >= self.tokens[doc]:
            return hi, int(self.chars[self.past[doc]]) - base
        want = int(self.ends[self.first[doc]]) + k
        c = int(np.searchsorted(self.ends, want)) - 1
        rank = want - int(self.ends[c]) - int(self.joint[c])
        start = int(self.starts[c])
        before = int(self.chars[c]) - base
        if rank == 0:
            return start, before
        chunk = self.block.data[start:int(self.stops[c])]
        place = int(word_ends(chunk)[rank - 1])
        return start + place, before + int(np.count_nonzero((chunk[:place] & 0xC0) != 0x80))


def seeds(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``docs`` with n (tokens), form, prefix_chars, middle_chars and output.

    The text's prefix ends after the smaller of two seeded token counts in 0..n, its middle
    after the larger. ``form`` is ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle), ``spm``
    (suffix first) or ``plain``: the text as it is, for empty texts, texts that hold a mark, and
    the share of documents that is not transformed; the two lengths (code points) are then null.

    Null texts count as empty. A null id takes the seed of the empty id; rows that repeat an id
    and text give the same output. Input columns named like the added ones are replaced; others
    pass through, also the text. An empty table gives none.
    """
    require(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h = seeds(F.col(id_col), seed)
    marked = F.contains(text, F.lit(MARKS[0]))
    for m in MARKS[1:]:
        marked = marked | F.contains(text, F.lit(m))
    form = (F.when((text == "") | marked | (h[2] % 100 >= fim_percent), F.lit("plain"))
            .when(h[3] % 100 < spm_percent, F.lit("spm")).otherwise(F.lit("psm")))
    kept = [c for c in docs.columns if c not in ADDED or c in (id_col, text_col)]
    rows = docs.select(F.struct(*kept).alias("row"), text.alias("text"), h[0].alias("a"),
                       h[1].alias("b"), form.alias("form"))
    out_fields = StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, "
                                    "output string").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in batches:
            for block in blocks(batch.column(1)):
                part = batch.slice(block.lo, block.n)
                columns = transform(block, cache, part.column(4).to_pylist(),
                                    part.column(2).to_numpy(), part.column(3).to_numpy())
                yield pa.RecordBatch.from_arrays([part.column(0)] + columns, names=["row"] + ADDED)

    schema = StructType([rows.schema["row"]] + out_fields)
    return rows.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`") for c in kept], *ADDED)


def transform(block: TextBlock, cache: ChunkCache, forms: list[str], a: np.ndarray,
              b: np.ndarray) -> list[pa.Array]:
    """The added columns of a block."""
    counted = Counted(block, cache)
    raw, offs, n = counted.raw, block.offs, counted.tokens
    one, two = a % (n + 1), b % (n + 1)
    p, s, m = (x.encode() for x in MARKS)
    prefix, middle, output = [], [], []
    for d, form in enumerate(forms):
        lo, hi = int(offs[d]), int(offs[d + 1])
        if form == "plain":
            prefix.append(None)
            middle.append(None)
            output.append(raw[lo:hi])
            continue
        x, chars_x = counted.cut(d, int(min(one[d], two[d])))
        y, chars_y = counted.cut(d, int(max(one[d], two[d])))
        prefix.append(chars_x)
        middle.append(chars_y - chars_x)
        pre, mid, suf = raw[lo:x], raw[x:y], raw[y:hi]
        output.append(b"".join((s, suf, p, pre, m, mid) if form == "spm" else (p, pre, s, suf, m, mid)))
    return [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64()),
            pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]


def restore(output: Column, form: Column) -> Column:
    """The text, rebuilt from an output and its form alone."""
    p, s, m = MARKS

    def between(left: str, right: str | None) -> Column:
        start = F.instr(output, left) + F.lit(len(left))
        stop = F.instr(output, right) if right else F.length(output) + F.lit(1)
        return F.substring(output, start, stop - start)

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


__all__ = ["fill_in_middle", "restore", "ChunkCache", "chunk_starts", "summarise"]
