"""The hidden Markov model against sums over all paths, and scores against plain counts."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from listmill.llm import hmm_lm as hmm
from listmill.llm import queries


def small_model(k, classes):
    rng = np.random.default_rng(k)
    start, moves, emits = rng.random(k), rng.random((k, k)), rng.random((classes, k))
    return hmm.Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def paths(model, sequence):
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emits[sequence[0], path[0]]
        for a, b, w in zip(path, path[1:], sequence[1:]):
            p *= model.moves[a, b] * model.emits[w, b]
        yield path, p


@pytest.mark.parametrize("together", [hmm.TOGETHER, 4])
def test_forward_and_counts_against_all_paths(monkeypatch, together):
    monkeypatch.setattr(hmm, "TOGETHER", together)
    model = small_model(3, 5)
    sequences = [np.array(s, np.uint16) for s in ([0], [1, 2, 3], [4, 4, 4, 4, 1], [2, 0], [3, 1, 2, 0, 4])]
    starts, moves, emits, total = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for seq, got in zip(sequences, model.log_likelihoods(sequences)):
        every = list(paths(model, seq))
        likelihood = sum(p for _, p in every)
        assert math.isclose(got, math.log(likelihood), rel_tol=1e-9)
        total += math.log(likelihood)
        for path, p in every:
            starts[path[0]] += p / likelihood
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / likelihood
            for s, w in zip(path, seq):
                emits[w, s] += p / likelihood
    found = model.expected_counts(sequences)
    for got, want in zip(found[:3], (starts, moves, emits)):
        assert np.allclose(got, want, atol=1e-4)
    assert abs(found[3] - total) < 1e-3


def test_rounds_never_lower_the_likelihood(monkeypatch):
    monkeypatch.setattr(hmm, "SHARED", 0.0)
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 5, rng.integers(1, 30)).astype(np.uint16) for _ in range(50)]
    model, before = small_model(3, 5), -math.inf
    for _ in range(6):
        starts, moves, emits, likelihood = model.expected_counts(sequences)
        assert likelihood > before - 0.5
        before = likelihood
        model = hmm.estimated(starts, moves, emits, np.full(5, 0.2))


def plain_base(rows):
    tokens = {i: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None] for i, t in enumerate(t for _, t in rows)}
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(w for i, ws in tokens.items() if not fold[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        ((rows[i][0], fold[i], len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens.items()),
        key=str,
    )


def got(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_query_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = queries.op4_hmm_scores(spark, folder).cache()
    assert got(df) == plain_base(rows)
    held = [r for r in df.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_score_is_a_distribution():
    """Over one word and the end, the probabilities of all texts of n words add up to no more than one."""
    words = [b"a", b"b", b"c"]
    classes = np.array([0] + [hmm.class_of(w) for w in words])
    counts = np.array([4, 6.0, 3.0, 1.0])
    emits = np.zeros((hmm.CLASSES, 2))
    emits[classes] = np.array([[0.3, 0.2], [0.4, 0.1], [0.2, 0.3], [0.1, 0.4]])
    model = hmm.Model(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), emits)
    totals, kinds = np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES)
    totals[classes], kinds[classes] = counts, 1
    scorer = hmm.Scorer(model, int(counts.sum()), 4, totals, kinds)
    ids = [np.array(x) for x in itertools.product(range(5), repeat=3)]
    scores = scorer.score(ids, classes, counts)[3]  # word 4 is unseen
    assert math.isclose((10**scores).sum(), 1, rel_tol=1e-6)


def test_classes_are_the_same_in_sql(spark):
    words = [b"", b"a", "ä".encode(), b"the", b"x" * 1000]
    rows = spark.createDataFrame([(bytearray(w),) for w in words], "word binary").selectExpr("word", f"{hmm.CLASS_SQL} as c").collect()
    assert {bytes(r.word): r.c for r in rows} == {w: hmm.class_of(w) for w in words}


def test_odd_inputs(spark, monkeypatch):
    rows = [(None, None), (1, ""), (2, "A a Ä b"), (2, "A a Ä b"), (3, "one " * 30_000), (4, "b\tb\x0bc\x1cd"), (9, "new words only")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, chunk int")
    assert got(hmm.score_texts(docs)) == plain_base(rows)
    assert hmm.score_texts(docs.limit(0)).count() == 0
    held = [(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    only = hmm.score_texts(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score for r in only)


def test_a_round_reads_several_partitions_in_a_task(spark, tmp_path):
    """The rows that a round shuffles grow with its tasks: fewer tasks than stored partitions."""
    rows = [(i, hmm.packed_tokens(np.array([i % 7, 1, 0], np.uint16))) for i in range(160)]
    path, tracker = str(tmp_path / "in"), spark.sparkContext.statusTracker()
    cores = spark.sparkContext.defaultParallelism
    spark.createDataFrame(rows, "doc_id long, classes binary").repartition(cores * 10).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20)), spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        texts = spark.read.parquet(path)
        stored = texts.rdd.getNumPartitions()
        assert stored > 4 * cores
        spark.sparkContext.setJobGroup("round", "round")
        model = small_model(2, hmm.CLASSES)
        got = hmm.train_round(texts, model)
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("round") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes"), spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(tasks) <= -(-stored // 4)
    want = model.expected_counts([hmm.unpacked(r[1], "<u2") for r in rows])
    for a, b in zip(got, want):
        assert np.allclose(a, b, rtol=1e-4, atol=1e-3)


def test_only_different_words_are_looked_up():
    class Counting(hmm.Words):
        asked = 0

        def __getitem__(self, word):
            Counting.asked += 1
            return super().__getitem__(word)

    texts = [" One two\tONE ", None, "", "\x1c one\x0b\x0ctwo\n", " \r\n", "Ä ä É one"] * 50
    words = Counting()
    got = hmm.numbered(pa.array(["x", *texts])[1:], words)
    assert Counting.asked <= 8
    listed = list(words)
    for text, ids in zip(texts, got):
        assert [listed[i] for i in ids] == [*(text or "").encode().lower().split(), b""]


def test_rounds_over_the_corpus_go_on_while_the_likelihood_rises(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["a b c", "d e f"], p=[0.9, 0.1] if i % 2 else [0.1, 0.9]) for _ in range(30))) for i in range(200)]
    stored = hmm.cut(hmm.chunked(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    texts = stored.where("word is null and classes is not null")
    shared = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    sequences = [hmm.unpacked(r.classes, "<u2") for r in texts.collect()]
    tokens = sum(map(len, sequences))
    begin = hmm.first_guess(sequences[:4], shared, 2)
    _, risen = hmm.trained(texts, begin, shared, tokens, rounds=6, least_gain=-1)
    assert len(risen) == 6 and all(b > a - 1e-4 for a, b in zip(risen, risen[1:]))
    assert math.isclose(risen[0], sum(begin.expected_counts([s])[3] for s in sequences) / tokens, rel_tol=1e-4)
    assert len(hmm.trained(texts, begin, shared, tokens, rounds=6, least_gain=10)[1]) == 2
