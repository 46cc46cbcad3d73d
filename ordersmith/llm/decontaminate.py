"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all passages of the corpus give TF-IDF
   weights; however common a word is, it keeps a weight (``FLOOR`` at least).
2. A randomised SVD spans the latent space: Y = A'(A W) over all cells of the corpus, in one
   pass, and over the benchmark's own; one partial product per task, summed by feature in
   Spark; then the leading eigenvectors of A'A's Nystrom approximation Y (W'Y)^-1 Y'.
3. Every passage of every document is projected into the latent space and compared by cosine
   with every item; passages and items at ``threshold`` or more are candidates.
4. A passage and an item are candidates too when a span of the document, wider than any
   text the item is compared with, holds enough of the item's words: what the decision
   needs, so no leak is lost that the cosine misses, however it is spread or weighted.
5. Candidates are checked word by word: the longest common subsequence of the
   item and the text around the passage, and of the item's answer (its last
   sentence), decide. The cosine is returned and picks among equally good passages. Cosines
   use the passage's whole TF-IDF norm, so unrelated text does not come close by being poorly
   represented.

What reaches the tasks is bounded: features x rank floats, and one block of items at a
time; longer benchmarks take several passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import table_bytes
from . import arrays as ar
from .staging import UNKNOWN, release, require

FEATURES = 1 << 15
RANK = 256
OVERSAMPLING = 32
SVD_TASKS = 4             # at least; each sends one FEATURES x rank matrix
SVD_BYTES = 32 << 20      # of the table a task of these, so what is sent stays in proportion
CELL = 16                 # words; a passage is two neighbouring cells
FLOOR = 0.1               # of the IDF: no word is left out
ITEM_WEIGHT = 50.0        # of benchmark rows in the SVD: the space is to represent them
PIECE = 64                # words; longer items are compared in pieces
ITEM_BLOCK = 240          # pieces per pass: below the rank, so the space holds them all
BLOCK = 1 << 16           # bytes of text whose word vectors are in memory together: fits the cache
SCAN = 1 << 18            # bytes of text whose words are looked at together
LCS_BITS = 64             # words of items whose subsequences are taken for many spans at once
LCS_CELLS = 1 << 20       # words of spans that are laid out together for it
PROJECTED = 1 << 10       # cells whose latent vectors are in memory together: they fit the cache


def _feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> ar.U64(49)).astype(np.int64)


def _cells(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each cell, and each document's range of cells."""
    n = -(-np.diff(offs) // CELL)
    cell_offs = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n)), n)
    return offs[:-1][doc] + (np.arange(len(doc)) - cell_offs[doc]) * CELL, cell_offs


def _cell_of(starts: np.ndarray, n: int) -> np.ndarray:
    """The cell of each of n words."""
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells that hold each feature, and all cells (feature -1), summed over the task."""
    df, total = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for block in ar.blocks(batch.column(0), SCAN):
            w = block.words(lower=True)
            starts, _ = _cells(w.offs)
            if not len(starts):
                continue
            total += len(starts)
            feature = _feature(w.hashes)
            place = np.minimum(starts[:, None] + np.arange(CELL), len(feature) - 1)
            size = np.diff(np.append(starts, len(feature)))
            laid = np.where(np.arange(CELL) < size[:, None], feature[place], FEATURES).astype(np.uint16)
            laid.sort(axis=1)
            again = laid[:, 1:][laid[:, 1:] == laid[:, :-1]]             # in a cell once more
            df += (np.bincount(feature, minlength=FEATURES)
                   - np.bincount(again, minlength=FEATURES + 1)[:FEATURES])
    used = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(df[used], total))],
                                     names=["feature", "df"])


def idf_weights(docs: DataFrame, text_col: str) -> np.ndarray:
    """Smooth IDF of every feature over all passages, ``FLOOR`` at least."""
    rows = (docs.select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_frequencies, "feature long, df long").groupBy("feature")
            .agg(F.sum("df").alias("df")).collect())          # at most FEATURES + 1 rows
    df = np.zeros(FEATURES)
    total = 0
    for r in rows:
        if r["feature"] < 0:
            total = r["df"]
        else:
            df[r["feature"]] = r["df"]
    return np.maximum(np.log((1.0 + total) / (1.0 + df)), FLOOR).astype(np.float32)


def _cosines(words: ar.Words, idf: np.ndarray, table: np.ndarray, vectors: np.ndarray | None,
             first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of every passage with every item (its closest piece), and where each document's
    passages begin. table, vectors: see :func:`_projection`; first: the items' first pieces."""
    starts, cell_offs = _cells(words.offs)
    n = np.diff(cell_offs)
    # a last cell belongs to the passage before it, if there is one
    begin = np.ones(len(starts), bool)
    begin[cell_offs[1:][n > 1] - 1] = False
    paired = begin.copy()
    paired[cell_offs[:-1][n == 1]] = False
    feature = _feature(words.hashes)
    weight = idf[feature]
    sq = np.add.reduceat(weight * weight, starts)
    sq[:-1] += np.where(paired[:-1], sq[1:], 0)
    norm = np.maximum(np.sqrt(sq), 1e-6)[:, None]
    out = np.empty((int(begin.sum()), len(first)), np.float32)
    ends, done = np.append(starts, len(feature)), 0
    room = np.empty((3, min(PROJECTED, len(starts)) + 1, table.shape[1]), table.dtype)
    for lo in range(0, len(starts), PROJECTED):
        hi = min(lo + PROJECTED, len(starts))
        last = min(hi + 1, len(starts))                              # the pair of the last
        sums, by = _row_sums(table, feature[:ends[last]], starts[lo:last], *room[:2])
        vec = room[2, :len(sums)]
        vec[by] = sums
        own, pair = lo + np.flatnonzero(begin[lo:hi]), lo + np.flatnonzero(paired[lo:hi])
        vec[pair - lo] += vec[pair - lo + 1]
        close = vec[own - lo] if vectors is None else vec[own - lo] @ vectors.T
        close /= norm[own]
        if close.shape[1] > len(first):
            close = np.maximum.reduceat(close, first, axis=1)
        out[done:done + len(own)] = close
        done += len(own)
    return out, np.concatenate([[0], np.cumsum(np.maximum(n - 1, np.minimum(n, 1)))])


def _projection(scaled: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """What a passage's words are summed over to be compared with the ``vectors`` in the latent
    space: the basis (``scaled``: its rows times their feature's weight), and the vectors that
    the sum is multiplied with. Of no more vectors than latent dimensions the product of both is
    taken here, once: (x B) V' = x (B V')."""
    return (scaled, vectors) if len(vectors) > scaled.shape[1] else (scaled @ vectors.T, None)


def _test_matrix(seed: int, rank: int) -> np.ndarray:
    """W: the same in every task, and in the driver."""
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((FEATURES, rank), np.float32)


def _add_products(out: np.ndarray, texts: pa.Array, idf: np.ndarray, scaled: np.ndarray) -> None:
    """Adds A'(A W) of the texts' cells to ``out``; ``scaled``: W with its rows times their
    feature's weight. The weight of A' itself is left to the end (:func:`corpus_products`)."""
    room = np.empty((3, 0, out.shape[1]), out.dtype)       # kept from block to block
    for block in ar.blocks(texts, BLOCK):
        words = block.words(lower=True)
        starts, _ = _cells(words.offs)
        if not len(starts):
            continue
        feature = _feature(words.hashes)
        cell = _cell_of(starts, len(feature))
        most = max(len(starts), min(len(feature), FEATURES))
        if room.shape[1] < most:
            room = np.empty((3, most, out.shape[1]), out.dtype)
        sums, by = _row_sums(scaled, feature, starts, *room[:2])
        latent = room[2, :len(sums)]
        latent[by] = sums
        order = np.argsort(feature.astype(np.uint16), kind="stable")     # 16 bits: a radix sort
        lead = np.flatnonzero(np.append(True, np.diff(feature[order]) > 0))
        sums, by = _row_sums(latent, cell[order], lead, *room[:2])
        own = feature[order[lead[by]]]
        before = room[1, :len(own)]
        np.take(out, own, axis=0, mode="clip", out=before)
        sums += before
        out[own] = sums


def _row_sums(table: np.ndarray, at: np.ndarray, starts: np.ndarray, room: np.ndarray,
              part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows ``at`` of ``table`` over the stretches that begin at ``starts``, the
    longest first, and which stretch each is: place by place, for all that are long enough at once.
    The sums lie in ``room``; ``part``, of as many rows, is written over."""
    size = np.diff(np.append(starts, len(at)))
    by = np.argsort(-size, kind="stable")
    starts, size = starts[by], size[by]
    longer = np.searchsorted(-size, -np.arange(CELL + 1))           # stretches of more than j rows
    out = room[:len(starts)]
    np.take(table, at[starts], axis=0, mode="clip", out=out)
    for j in range(1, CELL):
        n = longer[j]
        if n:
            np.take(table, at[starts[:n] + j], axis=0, mode="clip", out=part[:n])
            out[:n] += part[:n]
    for i in range(longer[CELL]):
        out[i] += table[at[starts[i] + CELL:starts[i] + size[i]]].sum(0)
    return out, by


def _sketch(idf: np.ndarray, seed: int, rank: int):
    """Task's part of Y = A'(A W) (column: text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled = _test_matrix(seed, rank) * idf[:, None]
        out = np.zeros((FEATURES, rank), np.float32)
        for batch in batches:
            _add_products(out, batch.column(0), idf, scaled)
        yield from _tiles(out)

    return run


TILE = 1024
_TILES = "tile int, v binary"


def _tiles(matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(matrix), TILE):
        yield pa.RecordBatch.from_arrays(
            [pa.array([i // TILE], pa.int32()),
             pa.array([matrix[i:i + TILE].astype(np.float32).tobytes()], pa.binary())],
            names=["tile", "v"])


def _add_tiles(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.float32).astype(np.float64) for v in table.column("v"))
    return pa.table({"tile": table.column("tile").slice(0, 1),
                     "v": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _tile_sums(rows: DataFrame, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows) of the sum of the tasks' partial matrices, one tile at a time."""
    for r in rows.groupBy("tile").applyInArrow(_add_tiles, _TILES).toLocalIterator():
        yield r["tile"] * TILE, np.frombuffer(r["v"], np.float32).reshape(-1, width)


def _orthonormal(y: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span those of ``y``, in place and by blocks of rows: the
    eigenvectors of y'y, twice, because one pass of it loses digits."""
    for _ in range(2):
        gram = np.zeros((y.shape[1], y.shape[1]))
        for i in range(0, len(y), TILE):
            part = y[i:i + TILE].astype(np.float64)
            gram += part.T @ part
        values, vectors = np.linalg.eigh(gram)
        keep = values > values.max() * 1e-9
        turn = vectors[:, keep] / np.sqrt(values[keep])
        for i in range(0, len(y), TILE):
            y[i:i + TILE, :turn.shape[1]] = y[i:i + TILE].astype(np.float64) @ turn
        y = y[:, :turn.shape[1]]
    return y


def corpus_products(texts: DataFrame, idf: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Y = A'(A W) over every text (column text), FEATURES x (rank + OVERSAMPLING)."""
    wide = rank + OVERSAMPLING
    size = table_bytes(texts)
    tasks = max(SVD_TASKS, size // SVD_BYTES) if size < UNKNOWN else SVD_TASKS
    y = np.zeros((FEATURES, wide), np.float32)
    for i, part in _tile_sums(texts.coalesce(int(tasks)).mapInArrow(_sketch(idf, seed, wide), _TILES), wide):
        y[i:i + len(part)] = part * idf[i:i + len(part), None]
    release(texts.sparkSession)
    return y


def latent_basis(products: np.ndarray, pieces: list[str], idf: np.ndarray, rank: int,
                 seed: int = 7) -> np.ndarray:
    """Orthonormal (FEATURES, rank) basis of the corpus, whose ``products`` are given, and of the
    ``pieces`` of benchmark items, which count ``ITEM_WEIGHT`` times."""
    wide = products.shape[1]
    w = _test_matrix(seed, wide)
    y = np.zeros_like(products)
    _add_products(y, pa.array(pieces, pa.string()), idf, w * idf[:, None])
    y *= (ITEM_WEIGHT ** 2 * idf)[:, None].astype(np.float32)
    y += products
    core = np.zeros((wide, wide))
    for i in range(0, FEATURES, TILE):
        core += w[i:i + TILE].T.astype(np.float64) @ y[i:i + TILE]
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > max(values.max(), 0) * 1e-7
    root = vectors[:, keep] / np.sqrt(values[keep])          # E = Y root, A'A is about E E'
    gram = np.zeros((root.shape[1], root.shape[1]))
    for i in range(0, FEATURES, TILE):
        part = y[i:i + TILE] @ root
        gram += part.T @ part
    values, vectors = np.linalg.eigh(gram)
    turn = root @ vectors[:, np.argsort(-values)[:rank]]
    if not turn.shape[1]:
        return np.zeros((FEATURES, rank), np.float32)
    for i in range(0, FEATURES, TILE):
        y[i:i + TILE, :turn.shape[1]] = y[i:i + TILE].astype(np.float64) @ turn
    return _orthonormal(y[:, :turn.shape[1]])


def lcs_length(a: list[int], b: list[int]) -> int:
    """Longest common subsequence, bit-parallel over ``a``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: list[int]
    pieces: list[str]


def _next_items(rows) -> list[Item]:
    """The next items, of ITEM_BLOCK pieces together (at least one item)."""
    items, n = [], 0
    for r in rows:
        words = _item_words(r["text"])
        if not words:
            continue
        text = r["text"].split()
        pieces = [" ".join(text[i:i + PIECE]) for i in range(0, len(text), PIECE)] or [r["text"]]
        items.append(Item(r["item_id"], words, _item_words(_answer(r["text"])), pieces))
        n += len(pieces)
        if n >= ITEM_BLOCK:
            break
    return items


def _item_vectors(pieces, idf: np.ndarray, scaled: np.ndarray):
    """Unit vectors of the pieces' words in the latent space, and their items."""
    vec = np.zeros((len(pieces), scaled.shape[1]), np.float32)
    for i, (text, _) in enumerate(pieces):
        feature = _feature(np.array(_item_words(text), ar.U64))
        weight = idf[feature]
        norm = float(np.sqrt((weight * weight).sum()))
        if norm:
            vec[i] = scaled[feature].sum(0) / norm
    return vec, np.array([i for _, i in pieces])


def _answer(text: str) -> str:
    """Last sentence of the item: what follows the last sentence end before its own."""
    body = text.rstrip()
    cut = max(body.rfind(c, 0, max(len(body) - 1, 0)) for c in (". ", ".\n", "? ", "?\n", "! ", "!\n"))
    return body[cut + 1:] if cut >= 0 else body


def _item_words(text: str) -> list[int]:
    block = next(ar.blocks(pa.array([text])))
    return block.words(lower=True).hashes.tolist()


def _reach(item: Item) -> int:
    """Words of the text around a passage that the item is compared with."""
    return 2 * len(item.words) + 4 * CELL


def _directory(vocab: np.ndarray) -> np.ndarray:
    """Where the hashes of each 16 leading bits begin in the sorted ``vocab``."""
    sizes = np.bincount((vocab >> ar.U64(48)).astype(np.int64), minlength=1 << 16)
    return np.append(0, np.cumsum(sizes)).astype(np.int32)


def _known(hashes: np.ndarray, vocab: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that ``vocab`` holds, and their numbers in it."""
    lead = (hashes >> ar.U64(48)).astype(np.int64)
    at, end = first[lead], first[lead + 1]
    own = np.flatnonzero(at < end)
    at, end, key = at[own], end[own], hashes[own]
    while len(go := np.flatnonzero((vocab[at] != key) & (at + 1 < end))):
        at[go] += 1
    hit = vocab[at] == key
    return own[hit], at[hit].astype(np.int64)


def _candidates(words: ar.Words, vocab: np.ndarray, first_of: np.ndarray, held: np.ndarray, need: np.ndarray, reach: int):
    """Spans of 2 x ``reach`` words, every ``reach`` words, in which an item's words that occur
    make up ``need``: arrays of document, first and last word + 1, item; and the places and
    numbers of the words of ``vocab`` (``first_of``: its :func:`_directory`). held: times of each
    of these in each item."""
    own, word = _known(words.hashes, vocab, first_of)
    n = np.maximum(1, -(-np.diff(words.offs) // reach))
    first = np.concatenate([[0], np.cumsum(n)])
    doc = ar.owners(words.offs, len(words.hashes))[own]
    turn = (own - words.offs[doc]) // reach
    span = first[doc] + turn
    again = np.flatnonzero(turn > 0)                  # also in the span that began before
    pieces, size = [], max(16, (1 << 21) // len(vocab))
    for lo in range(0, int(first[-1]), size):
        there = np.zeros((min(size, int(first[-1]) - lo), len(vocab)), np.float32)
        i, j = np.searchsorted(span, [lo, lo + size])
        there[span[i:j] - lo, word[i:j]] = 1
        i, j = np.searchsorted(span[again], [lo + 1, lo + size + 1])
        there[span[again[i:j]] - 1 - lo, word[again[i:j]]] = 1
        s, k = np.nonzero(there @ held >= need)
        pieces.append((s + lo, k))
    s, k = (np.concatenate(x) for x in zip(*pieces))
    d = np.searchsorted(first, s, "right") - 1
    start = words.offs[d] + (s - first[d]) * reach
    return d, start, np.minimum(start + 2 * reach, words.offs[d + 1]), k, own, word


def _word_bits(texts: list[list[int]], vocab: np.ndarray) -> np.ndarray:
    """Per text and word of ``vocab`` the places of the word in the text, as bits; the last
    column, of no word, is 0. Texts of more than ``LCS_BITS`` words have none."""
    bits = np.zeros((len(texts), len(vocab) + 1), np.uint64)
    for k, text in enumerate(texts):
        if 0 < len(text) <= LCS_BITS:
            at = np.searchsorted(vocab, np.array(text, ar.U64))
            np.bitwise_or.at(bits[k], at, np.uint64(1) << np.arange(len(at), dtype=np.uint64))
    return bits


def _lcs_lengths(bits: np.ndarray, sizes: np.ndarray, k: np.ndarray, word: np.ndarray,
                 begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """:func:`lcs_length` of items ``k`` (``LCS_BITS`` words at most) with the words
    ``begin:end`` of ``word``, for many at once."""
    out = np.zeros(len(k), np.int64)
    steps = int((end - begin).max(initial=0))
    flat, wide = bits.ravel(), bits.shape[1]
    size = max(1, LCS_CELLS // max(1, steps))
    for lo in range(0, len(k), size):
        one = slice(lo, lo + size)
        at = begin[one] + np.arange(steps)[:, None]
        laid = np.where(at < end[one], word[np.minimum(at, len(word) - 1)], wide - 1) + k[one] * wide
        full = np.where(sizes[k[one]] > 0, np.uint64(2 ** 64 - 1) >> (64 - np.maximum(sizes[k[one]], 1))
                        .astype(np.uint64), np.uint64(0))
        row = full.copy()
        for places in laid:
            hit = row & flat[places]
            row = ((row + hit) | (row - hit)) & full
        out[one] = sizes[k[one]] - np.bitwise_count(row)
    return out


def _matches(idf, table, vectors, owner, items: list[Item], threshold, lcs_share, full_share,
             answer_share):
    """Leaks of the ``items`` in batches of (id, text). table, vectors: see :func:`_projection`;
    owner: the pieces' items."""
    vocab = np.unique(np.array([w for it in items for w in it.words], ar.U64))
    held = np.zeros((len(vocab), len(items)), np.float32)
    for k, it in enumerate(items):
        np.add.at(held, (np.searchsorted(vocab, np.array(it.words, ar.U64)), k), 1)
    need = np.array([lcs_share * len(it.words) for it in items])
    reach = max(_reach(it) for it in items)
    bits, sizes = _word_bits([it.words for it in items], vocab), np.array([len(it.words) for it in items])
    answer_bits = _word_bits([it.answer for it in items], vocab)
    answers = np.array([len(it.answer) for it in items])
    sets = [set(it.words) for it in items]
    first = _directory(vocab)
    lead = np.searchsorted(owner, np.arange(len(items)))

    def shares(it: Item, own: set, text: list[int]):
        """Shares of the item and its answer in a text that holds it, else None."""
        text = [w for w in text if w in own]
        common = lcs_length(it.words, text)
        if common < lcs_share * len(it.words):
            return None
        answer = lcs_length(it.answer, text) / max(1, len(it.answer))
        if common < full_share * len(it.words) and answer < answer_share:
            return None
        return common / len(it.words), answer

    def judged(item, word, lo, hi, text):
        """Which of the items (numbers ``item``) the texts hold, and the shares of each and of its
        answer. lo, hi: the texts' ranges of ``word``; text(i): all words of the i-th."""
        common, answer = np.zeros(len(item)), np.zeros(len(item))
        short = np.flatnonzero(sizes[item] <= LCS_BITS)
        common[short] = _lcs_lengths(bits, sizes, item[short], word, lo[short], hi[short])
        ok = np.zeros(len(item), bool)
        ok[short] = common[short] >= lcs_share * sizes[item[short]]
        short = np.flatnonzero(ok)
        answer[short] = _lcs_lengths(answer_bits, answers, item[short], word, lo[short], hi[short])
        common, answer = common / sizes[item], answer / np.maximum(1, answers[item])
        ok[short] = ((common * sizes[item] >= full_share * sizes[item]) | (answer >= answer_share))[short]
        for i in np.flatnonzero(sizes[item] > LCS_BITS):
            share = shares(items[item[i]], sets[item[i]], text(i))
            if share:
                ok[i], common[i], answer[i] = True, *share
        return ok, common, answer

    def surroundings(offs, d, p, item):
        """First and last word + 1 of the texts that items are compared with: passages ``p`` of
        documents ``d`` and what is around them."""
        at, around = offs[d] + p * CELL, sizes[item] + CELL
        return np.maximum(offs[d], at - around), np.minimum(offs[d + 1], at + 2 * CELL + around)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = table.value
        for batch in batches:
            ids = batch.column(0)
            out: dict[tuple, tuple] = {}
            for block in ar.blocks(batch.column(1), SCAN):
                words = block.words(lower=True)
                if not len(words.hashes):
                    continue
                cosine, passages = _cosines(words, idf, basis, vectors, lead)
                close = cosine >= threshold
                g, near = np.nonzero(close)
                doc = np.searchsorted(passages, g, "right") - 1
                # documents, passages and items that the cosine leaves out, by their words
                d, lo, hi, item, own, word = _candidates(words, vocab, first, held, need, reach)
                ok, _, _ = judged(item, word, np.searchsorted(own, lo), np.searchsorted(own, hi),
                                  lambda i: words.hashes[lo[i]:hi[i]].tolist())  # a part cannot hold more
                d, lo, hi, item = (x[ok] for x in (d, lo, hi, item))
                # the passages of the documents whose surroundings meet the spans
                begin, end, around = words.offs[d], words.offs[d + 1], sizes[item] + CELL
                last = np.maximum(0, -(-(end - begin) // CELL) - 2)
                p, span = ar.expand(np.clip((lo - begin - around - 2 * CELL) // CELL, 0, last),
                                    np.clip((hi - begin + around) // CELL, 0, last))
                d, lo, hi, item = (x[span] for x in (d, lo, hi, item))
                a, b = surroundings(words.offs, d, p, item)
                more = (b > lo) & (a < hi) & ~close[passages[d] + p, item]
                d, p, item = (np.concatenate(x) for x in (
                    (doc, d[more]), (g - passages[doc], p[more]), (near, item[more])))
                a, b = surroundings(words.offs, d, p, item)
                ok, common, answer = judged(item, word, np.searchsorted(own, a), np.searchsorted(own, b),
                                            lambda i: words.hashes[a[i]:b[i]].tolist())
                for i in np.flatnonzero(ok):
                    key = (block.lo + int(d[i]), items[item[i]].item_id)
                    row = (float(cosine[passages[d[i]] + p[i], item[i]]), float(common[i]), float(answer[i]))
                    if key not in out or (row[1], row[0]) > (out[key][1], out[key][0]):
                        out[key] = row
            if out:
                where = pa.array([k[0] for k in out])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(where), pa.array([k[1] for k in out], pa.int64())]
                    + [pa.array([r[i] for r in out.values()], pa.float64()) for i in range(3)],
                    names=["doc", "item_id", "cosine", "lcs_share", "answer_share"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  lcs_share: float = 0.5, full_share: float = 0.7, answer_share: float = 0.7,
                  rank: int = RANK, threshold: float = 0.3) -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answer_share): leaks of benchmark items.

    A document holds an item when the longest common subsequence of words (lower-cased
    A-Z) with the text around one of its passages covers ``full_share`` of the item, or
    ``lcs_share`` of it together with ``answer_share`` of the item's answer. One row per
    document and item, with its best passage and that passage's latent cosine. ``threshold`` is
    the cosine from which a passage is checked whatever words it has; no leak depends on it.

    Null or empty texts and items match nothing; rows without an item id or text are
    left out. Null document ids appear as null. Repeated rows give a row each. Empty
    tables give no rows. Other columns are ignored.
    """
    require(docs, id_col, text_col)
    require(benchmark, item_col, text_col)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    idf = idf_weights(docs, text_col)
    asked = (benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(item_col).cast("long").alias("item_id"),
                     F.col(text_col).cast("string").alias("text")).distinct())
    out = spark.createDataFrame([], "doc " + docs.schema[id_col].dataType.simpleString()
                                + ", item_id long, cosine double, lcs_share double, answer_share double")
    rows = asked.orderBy(F.length("text"), "item_id", "text").toLocalIterator()     # one block at a time
    products = None
    while items := _next_items(rows):
        pieces = [(p, i) for i, item in enumerate(items) for p in item.pieces]
        if products is None:                          # one pass, whatever the number of items
            products = corpus_products(texts.select("text"), idf, rank)
        basis = latent_basis(products, [p for p, _ in pieces], idf, rank)
        scaled = basis * idf[:, None]
        vec, owner = _item_vectors(pieces, idf, scaled)
        table, turn = _projection(scaled, vec)
        run = _matches(idf, spark.sparkContext.broadcast(table), turn, owner, items, threshold,
                       lcs_share, full_share, answer_share)
        out = out.unionByName(texts.mapInArrow(run, out.schema))
    return out.withColumnRenamed("doc", id_col)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                        **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; ids that are null stay."""
    found = contamination(docs, benchmark, id_col, **options).select(id_col).distinct()
    return docs.join(found, id_col, "left_anti").select(*docs.columns)
