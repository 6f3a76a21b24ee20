"""Periodic runs: against comparing words at every distance."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from listmill.llm import queries
from listmill.llm.common import parts
from listmill.llm.periodic_runs import WaveletTree, Words, find_runs, runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(words):
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p) and j > i:
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_text(rng):
    words, letters = [], "abcdefé"[: rng.choice([2, 3, 5, 7])]
    while len(words) < rng.randint(0, 70):
        words += [rng.choice(letters) for _ in range(rng.randint(1, 9))] * rng.choice([1, 1, 2, 4, 5, 7])
        if rng.random() < 0.3:
            words.pop()
    return rng.choice([None, "", " ".join(words), "\t".join(words) + "\n", "\r\n \x0b" + " \x0c".join(words)])


def test_equals_all_distances():
    rng = random.Random(2)
    n_runs = 0
    for _ in range(800):
        texts = [some_text(rng) for _ in range(rng.randint(1, 5))]
        words = Words(pa.array(texts, pa.string()))
        assert words.counts.tolist() == [len(words_of(t)) for t in texts]
        want = [(b + s, n, p) for t, b in zip(texts, words.begins.tolist()) for s, n, p in plain(words_of(t))]
        assert [tuple(r) for r in runs(words.symbols(), int(words.counts.max())).tolist()] == want
        n_runs += len(want)
    assert n_runs > 1000


def test_periods_up_to_a_quarter_of_a_long_text():
    rng = random.Random(3)
    for period in (1, 2, 3, 4, 5, 63, 64, 65, 1000, 1999):
        before = [str(rng.random()) for _ in range(rng.randint(0, 2 * period))]
        base = [str(i) for i in range(period)]
        words = before + (base * 6)[: max(6, 4 * period)] + [str(rng.random()) for _ in range(period)]
        table = Words(pa.array([" ".join(words)]))
        assert runs(table.symbols(), len(words)).tolist() == [[len(before), max(6, 4 * period), period]]
        short = before + (base * 6)[: max(6, 4 * period) - 1]
        table = Words(pa.array([" ".join(short)]))
        assert runs(table.symbols(), len(short)).tolist() == []


def test_one_word_repeated():
    table = Words(pa.array(["a " * 100_000]))
    assert runs(table.symbols(), 100_000).tolist() == [[0, 100_000, 1]]


def test_wavelet_tree():
    rng = np.random.default_rng(0)
    for n in (1, 2, 63, 64, 65, 300):
        values = rng.permutation(n)
        tree = WaveletTree(values)
        low = rng.integers(0, n, 200)
        high = np.array([rng.integers(a, n) + 1 for a in low])
        x = rng.integers(0, n, 200)
        assert tree.below(low, high, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, x)]
        nth = np.array([rng.integers(0, b - a) for a, b in zip(low, high)])
        assert tree.entry(low, high, nth).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(low, high, nth)]


def test_slices_of_a_batch():
    texts = pa.array(["x y", None, "a a a a a a", "b " * 10, "", "c d c d c d c d"])
    batch = pa.RecordBatch.from_arrays([texts], names=["t"]).slice(2)
    for part in parts(batch, 0):
        words = Words(part.column(0))
        assert words.counts.tolist() == [6, 10, 0, 8]
        assert runs(words.symbols(), 10).tolist() == [[0, 6, 1], [6, 10, 1], [16, 8, 2]]
        assert words.joined(np.ones(24, bool)).to_pylist()[2:] == ["", "c d c d c d c d"]


def test_operator_and_edge_cases(spark):
    rng = random.Random(4)
    texts = [None, "", "  \n", "a", "a a a a a a", "a a a a a a", *(some_text(rng) for _ in range(60)), " ".join(["x", "y", "z"] * 30_000) + " é"]
    df = spark.createDataFrame([(i if i % 7 else None, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, length string").repartition(3)
    got = find_runs(df)
    assert got.columns == ["doc_id", "length", "n_words", "runs", "collapsed"]

    def row(i, t):
        found = plain(words_of(t)) if len(t or "") < 10_000 else [(0, 90_000, 3)]
        return (i, len(words_of(t)), found, collapsed(words_of(t), found))

    have = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect())
    assert have == sorted(row(i if i % 7 else 0, t) for i, t in enumerate(texts))
    assert find_runs(spark.createDataFrame([], "text string")).collect() == []
    with pytest.raises(ValueError, match="n_words"):
        find_runs(spark.createDataFrame([("a", 1)], "text string, Runs int"))


def test_planted_periods(spark):
    import zlib

    rows = [(i, None if i % 13 == 0 else " ".join(f"w{j}" for j in range(i % 37))) for i in range(400)]

    def planted(i, t):
        words, h = words_of(t), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 or n == 0:
            return words
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]

    got = {r.doc_id: words_of(r.text) for r in queries.planted_periods(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: planted(i, t) for i, t in rows}
    assert any(got[i] != words_of(t) for i, t in rows)
