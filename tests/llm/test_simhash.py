"""SimHash groups against a plain version that compares all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from listmill.llm import simhash

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """{fp: root} by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3 and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {f: new if r == old else r for f, r in root.items()}
    return root


def expected(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    root = plain_groups(f for _, f in prints)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in prints), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_nulls_empty_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (None, "A B"), (4, "one two three four"), (4, "one two three four"),
            (5, "one two three four" + " x" * 70_000), (6, "one"), (7, " ")]
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    assert got(simhash.near_duplicates(docs)) == expected(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {g for _, _, g in expected(rows)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(groups, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_id_in_many_groups(spark):
    """Each group keeps a row, also where an id stands in several groups."""
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    near = next(t for i in range(60) if (t := " ".join(a[:i] + ["z"] + a[i + 1 :])) and 0 < (plain_fingerprint(t) ^ plain_fingerprint(" ".join(a))).bit_count() <= 3)
    a, b, c = map(" ".join, (a, b, c))
    rows = [(1, a), (1, b), (2, near), (2, c), (2, c), (None, c), (None, "no id"), (None, "No  id")]
    rows += [(7, " ".join(f"{i}w{j}" for j in range(40))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = got(simhash.drop_near_duplicates(docs))
    prints = {t: plain_fingerprint(t) for _, t in rows}
    root = plain_groups(prints.values())
    assert root[prints[a]] == root[prints[near]] and len({root[f] for f in prints.values()}) == 34
    assert [r for r in kept if r[0] in (1, 2)] == sorted([(1, a), (1, b), (2, c)], key=str)
    assert sum(i is None for i, _ in kept) == 1 and [r for r in kept if r[0] == 7] == sorted(rows[-30:], key=str)


def flipped(rng, fp, n):
    for b in rng.sample(range(64), n):
        fp ^= 1 << b
    return fp


@pytest.mark.parametrize("compared", [simhash.COMPARED, 3])
def test_links_lose_no_pair(spark, compared):
    """With ``compared`` 3 nearly every anchor is taken apart by the other half."""
    rng = random.Random(5)
    points = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        points.add(base)
        for _ in range(12):
            points.add(flipped(rng, base, rng.randint(1, 4)))
    points = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "doc_id long, fp long")
    roots = plain_groups(p & (1 << 64) - 1 for p in points)
    least = {}
    for i, p in enumerate(points):
        r = roots[p & (1 << 64) - 1]
        least[r] = min(i, least.get(r, i))
    want = sorted((i, least[roots[p & (1 << 64) - 1]]) for i, p in enumerate(points))
    found = simhash.near_groups(df, compared=compared).select("doc_id", "component_id")
    assert got(found) == sorted(want, key=str)


def test_anchors_are_the_near_code_words(spark):
    rng = random.Random(1)
    rows = [(rng.getrandbits(15),) for _ in range(50)]
    found = spark.createDataFrame(rows, "x long").select("x", simhash.anchors(F.col("x"), 4).alias("a")).collect()

    def syndrome(x):
        s = 0
        for i in range(15):
            if x >> i & 1:
                s ^= i + 1
        return s

    code = [c for c in range(1 << 15) if syndrome(c) == 0]
    for x, near in found:
        assert sorted(near) == [c for c in code if (c ^ x).bit_count() <= 2]
        assert (near[0] ^ x).bit_count() <= 1


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1000, 1200)], "a long, b long")
    rows = simhash.components(links).collect()
    assert {r.root for r in rows} == {1000} and sorted(r.node for r in rows) == list(range(1001, 1201))
