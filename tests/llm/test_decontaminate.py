"""Leaks against a plain edit-distance search, and recall on edited passages."""

import pickle
import random

import numpy as np
import pytest

from listmill.llm import decontaminate as dec

FOLDER = "/root/testdata/sf0.001"


def plain_best(item, text):
    """Least word edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        before, row = row, [i]
        for j, other in enumerate(text, 1):
            row.append(min(before[j - 1] + (word != other), before[j] + 1, row[j - 1] + 1))
    return min(row)


def plain_leaks(docs, items):
    out = []
    for doc_id, text in docs:
        words = dec.words_of(text)
        for item_id, item in items:
            goal = dec.words_of(item)
            if goal:
                edits = plain_best(goal, words)
                if edits <= dec.edits_allowed(len(goal), 0.8):
                    out.append((doc_id, item_id, edits, len(goal)))
    return sorted(out, key=str)


def edited(rng, words, edits, vocabulary):
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.choice("sid")
        if kind == "s":
            out[at] = rng.choice(vocabulary)
        elif kind == "i":
            out.insert(at, rng.choice(vocabulary))
        elif len(out) > 1:
            del out[at]
    return out


def test_alignment_against_plain():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 30))]
        edits, end = dec.best_alignment(np.array(item), np.array(text))
        assert edits == plain_best(item, text)
        assert edits == len(item) or plain_best(item, text[:end]) == edits


def test_recall_on_edited_passages(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    index = dec.Index(0.8, dec.WALKS, dec.SAMPLES).build(items)
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(500)] + [w for _, t in items[:5] for w in dec.words_of(t)]
    found = total = 0
    for item_id, text in items:
        words = dec.words_of(text)
        for edits in range(dec.edits_allowed(len(words), 0.8) + 1):
            filler = [rng.choice(vocabulary) for _ in range(60)]
            doc = filler[:30] + edited(rng, words, edits, vocabulary) + filler[30:]
            exact = plain_best(words, doc)
            got = {m[1]: m[2] for m in index.matches([dec.WordIds(index).of(" ".join(doc))])}
            total += 1
            found += got.get(item_id) == exact
    assert found >= 0.95 * total


@pytest.mark.parametrize("block_bytes", [dec.BLOCK_BYTES, 3000])
def test_query_against_plain(spark, block_bytes):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rng = random.Random(3)
    rows += [(1000 + i, "An opening, " + " ".join(edited(rng, t.split(), 3, ["x", "y"])).upper() + " and an end.") for i, t in items]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dec.find_leaks(df, benchmark, block_bytes=block_bytes).select("doc_id", "item_id", "edits", "item_words").collect()
    assert sorted(map(tuple, got), key=str) == plain_leaks(rows, items)


def test_nulls_short_items_and_extra_columns(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, None), (3, "..."), (None, "two words"), (4, "alone"), (5, long)]
    docs = [(1, f"a b {long} c"), (1, f"a b {long} c"), (None, "Two WORDS!"), (2, None), (3, ""), (4, "x " * 150_000 + long), (5, "Alone."), (6, "clean text")]
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    df = spark.createDataFrame([(*r, "e") for r in docs], "doc_id long, text string, edits string")
    got = dec.find_leaks(df, benchmark).select("doc_id", "item_id", "edits", "item_words").collect()
    want = [(i, j, 0, 40) for i in (1, 1, 4) for j in (1, 5)] + [(None, None, 0, 2), (5, 4, 0, 1)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = dec.drop_leaks(df, benchmark)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 6]
    assert dec.find_leaks(df.limit(0), benchmark).count() == 0
    assert dec.find_leaks(df, benchmark.limit(0)).count() == 0 and dec.drop_leaks(df, benchmark.limit(0)).count() == len(docs)


def test_a_long_item_is_sent_in_few_bytes():
    """Nothing that is sent grows with steps times words; texts too short for an item get no windows."""
    words = [f"w{i}" for i in range(3000)]
    index = dec.Index(0.8, dec.WALKS, dec.SAMPLES).build([(1, " ".join(words)), (2, "w1 w2 w3 other words")])
    assert len(pickle.dumps(index)) < 1 << 20
    texts = ["x y " + " ".join(words[:1500] + ["new"] + words[1502:]) + " z", " ".join(words[:2300])]
    ids = dec.WordIds(index)
    assert [m[:4] for m in index.matches([ids.of(t) for t in texts])] == [(0, 1, 2, 3000)]
    short = [ids.of(" ".join(words[:2399]))]
    assert 3000 not in index.windows(np.append(short[0], index.other), np.array([0]), np.array([2399]))


def test_blocks_are_bounded_and_hold_each_item_once(spark):
    rng = random.Random(4)
    items = [(i, f"item {i} " + "w " * rng.randint(1, 400)) for i in range(300)] + [(1000, "long " * 2000), (1001, "longer " * 2000)]
    copies = [(2000, "the same row " * 20)] * 200
    benchmark = spark.createDataFrame(items + copies + [(5, None)], "item_id long, text string").repartition(4)
    rows, count = dec.in_blocks(benchmark, "item_id", "text", 4000)
    found = {}
    for r in rows.collect():
        found.setdefault(r.block, []).append((r.item_id, r.text))
    assert sorted(found) == list(range(count))
    assert sorted(x for block in found.values() for x in block) == sorted(items + copies[:1])
    sizes = {b: sum(len(t) + 64 for _, t in block) for b, block in found.items()}
    assert all(n <= 4000 or len(found[b]) == 1 for b, n in sizes.items())
    assert sum(n > 4000 for n in sizes.values()) == 2


def test_forty_blocks_are_one_scan_and_one_step(spark):
    """However many blocks: the documents are read once, by one Python step, with one index in memory."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(8, 60)))) for i in range(800)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = []
    for i in range(0, 800, 5):
        filler = rng.choices(words, k=40)
        docs.append((i, " ".join(filler[:20] + edited(rng, items[i][1].split(), i // 5 % 2, words) + filler[20:])))
    docs += [(10_000 + i, " ".join(rng.choices(words, k=80))) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    block_bytes = sum(len(t) + 64 for _, t in items) // 40
    paths = dec.stored_indexes(benchmark, "item_id", "text", dec.SIMILARITY, dec.WALKS, dec.SAMPLES, block_bytes)
    assert len(paths) >= 40
    leaks = dec.find_leaks(df, benchmark, block_bytes=block_bytes)
    kept = dec.drop_leaks(df, benchmark, block_bytes=block_bytes)
    for out in (leaks, kept):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and plan.count("Scan") == 1 and "Union" not in plan
    found = {(r.doc_id, r.item_id) for r in leaks.collect()}
    want = {(i, i) for i in range(0, 800, 5)}
    assert len(want & found) >= 0.95 * len(want)
    assert found == {(r.doc_id, r.item_id) for r in dec.find_leaks(df, benchmark).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in found}
    indexes = dec.Opened(paths)
    assert [index for index, _ in indexes][0].items and len(pickle.dumps(indexes.one[0])) < 100 * block_bytes
