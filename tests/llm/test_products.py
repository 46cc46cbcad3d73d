"""Words of a block, and the products that span the latent space."""
import re

import numpy as np
import pyarrow as pa
import pytest
from ordersmith.llm import arrays as ar
from ordersmith.llm import decontaminate as dc

WORDS = [f"{w}{i}" for i in range(400) for w in ("alpha", "Beta", "gam-ma", "d")]


def texts(n_bytes, seed=1):
    rng = np.random.default_rng(seed)
    out, size = [], 0
    while size < n_bytes:
        out.append(" ".join(rng.choice(WORDS, 300)))
        size += len(out[-1])
    return out


@pytest.mark.parametrize("lower", [True, False])
def test_words_are_those_of_each_text(lower):
    rows = ["A b\tC\n", "", None, "  ", "x", "\x0bÄ É\x0c\x1fz\r", "AZ[ az{ @`", " a  A "]
    block = next(ar.blocks(pa.array(rows)))
    got = block.words(lower)
    low = "".maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    want = [[p for p in re.split("[\\x20\\x09-\\x0D]+", r or "") if p] for r in rows]
    found = [bytes(block.data[s:e]).decode() for s, e in zip(got.starts, got.ends)]
    assert found == [w for r in want for w in r]
    names = {}
    for word, h in zip(found, got.hashes):
        assert names.setdefault(word.translate(low) if lower else word, h) == h
    assert len(set(names.values())) == len(names)
    assert np.diff(got.offs).tolist() == [len(r) for r in want]


def test_products_take_the_same_room_for_every_block():
    """Blocks of different sizes, one of them a long text, share the arrays; sums are those of the cells."""
    rows = ["one", *texts(60_000, 2), " ".join(texts(200_000, 3)), *texts(100_000, 4), "", "two two one"]
    idf = np.random.default_rng(5).random(dc.FEATURES).astype(np.float32)
    w = dc._test_matrix(7, 12)
    out = np.zeros((dc.FEATURES, 12), np.float32)
    dc._add_products(out, pa.array(rows), idf, w * idf[:, None])
    want = np.zeros((dc.FEATURES, 12))
    for row in rows:
        f = dc._feature(np.array(dc._item_words(row), ar.U64)) if row else np.zeros(0, np.int64)
        for i in range(0, len(f), dc.CELL):
            cell = f[i:i + dc.CELL]
            np.add.at(want, cell, (w[cell] * idf[cell, None]).astype(np.float64).sum(0))
    assert np.allclose(out, want, rtol=1e-4, atol=1e-3)


def test_sums_lie_in_the_room_that_is_given():
    """No place of a cell makes an array of its own."""
    rng = np.random.default_rng(6)
    table, at = rng.random((50, 12)).astype(np.float32), rng.integers(0, 50, 100)
    starts = np.array([0, 16, 20, 21, 60])             # the last but one has 39 rows, the last 40
    room, part = np.empty((2, 9, 12), np.float32)
    sums, by = dc._row_sums(table, at, starts, room, part)
    assert np.shares_memory(sums, room) and sorted(by) == list(range(5))
    ends = np.append(starts[1:], len(at))
    for row, i in zip(sums, by):
        assert np.allclose(row, table[at[starts[i]:ends[i]]].sum(0), rtol=1e-5)
