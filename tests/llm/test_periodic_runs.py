"""Lyndon arrays and periodic runs against brute force."""
import random
import re

import numpy as np
import pytest

from ordersmith.llm import lyndon
from ordersmith.llm.periodic_runs import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lyndon(s):
    return [max(k for k in range(1, len(s) - i + 1)
                if all(s[i:i + k] < s[i + j:i + k] for j in range(1, k))) for i in range(len(s))]


def brute_runs(s, least):
    best = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                best[i, j - i + q] = min(q, best.get((i, j - i + q), q))
            i = max(j, i) + 1
    return sorted(((a, n, q) for (a, n), q in best.items()), key=lambda t: (t[0], t[2]))


def strings():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(0, 26), rng.randint(1, 4)
        s = [rng.randrange(k) for _ in range(n)]
        if n > 4 and rng.random() < 0.5:
            p = rng.randint(1, n // 2)
            s = [s[i % p] for i in range(n)]
            s[rng.randrange(n)] = rng.randrange(k)
        yield s
    yield [0] * 300
    yield [int(c) for c in "".join("ab"[bin(i).count("1") % 2] for i in range(512)).replace(
        "a", "0").replace("b", "1")]


def test_lyndon_arrays_of_both_orders():
    for s in strings():
        if len(s) > 30:
            continue
        a = np.array(s, np.int64)
        assert lyndon.lyndon_array(a).tolist() == brute_lyndon(s)
        assert lyndon.lyndon_array(5 - a).tolist() == brute_lyndon([5 - x for x in s])


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    for s in strings():
        got = [tuple(x) for x in lyndon.runs(np.array(s, np.int64), least).tolist()]
        assert got == brute_runs(s, least)


def documents():
    rng = random.Random(9)
    rows = [None, "", " \n\t ", "a", "a " * 40, "a b " * 30 + "a", "x a b x a b", "été " * 12,
            "w\x0bw\x0cw\rw w\tw\nw w w w w w w", "long " + " ".join(f"w{i % 4001}" for i in range(30_000))]
    for _ in range(120):
        n = rng.randint(1, 90)
        words = [rng.choice("abcdefg") * rng.randint(1, 2) for _ in range(n)]
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
        rows.append(rng.choice(" \t\n") .join(words[a + (i - a) % p] if i >= a and a + (i - a) % p < n else w
                                              for i, w in enumerate(words)) + rng.choice(["", " "]))
    return [(i if i != 7 else None, t, "n", i, "kept") for i, t in enumerate(rows)]


@pytest.mark.parametrize("shorten", [True, False])
def test_periodic_runs_awkward_rows(spark, shorten):
    rows = documents()
    df = spark.createDataFrame(rows + rows[4:5], "doc_id long, text string, runs string, row int, a string")
    out = periodic_runs(df, least=12, shorten=shorten)
    assert out.columns == ["doc_id", "text", "row", "a", "n_words", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(rows) + 1
    for r in got:
        words = WORD.findall(r["text"] or "")
        if len(words) > 5000:
            want = [(1, 30_000, 4001)]
        else:
            want = brute_runs(words, 12)
        assert [tuple(x) for x in r["runs"]] == want, r["text"]
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r["n_words"] == len(words)
    assert periodic_runs(df.limit(0)).count() == 0
