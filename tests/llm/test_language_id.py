"""The byte network: gradients against differences, forward pass against a plain one, held-out accuracy, odd inputs."""

import math

import numpy as np

from listmill.llm import language_id as lid
from listmill.llm import queries


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    network = lid.Network(["a", "b", "c"], hidden=3)
    for part in (network.forward, network.backward):
        part.inputs, part.recurrent, part.bias = (x.astype(np.float64) for x in part.parameters)
    network.output = rng.normal(size=network.output.shape)
    steps = rng.integers(0, 256, (7, 5)).astype(np.uint8)
    lengths, labels = np.array([7, 3, 1, 5, 7]), np.array([0, 1, 2, 1, 0])
    _, gradients = network.loss_and_gradients(steps, lengths, labels)
    for parameter, gradient in zip(network.parameters, gradients):
        touched = np.argwhere(np.abs(gradient) > 1e-9)
        for at in map(tuple, touched[rng.permutation(len(touched))[:12]]):
            kept, step = parameter[at], 1e-2
            parameter[at] = kept + step
            above = network.loss_and_gradients(steps, lengths, labels)[0]
            parameter[at] = kept - step
            below = network.loss_and_gradients(steps, lengths, labels)[0]
            parameter[at] = kept
            assert abs((above - below) / (2 * step) - gradient[at]) < 2e-3


def plain_states(direction, data):
    """The unit's states for each byte, one number at a time."""
    h = direction.hidden
    inputs, recurrent, bias = (p.astype(float).tolist() for p in direction.parameters)
    squeeze = lambda x: 1 / (1 + math.exp(-x))
    state, out = [0.0] * h, []
    for byte in data:
        own = [sum(state[k] * recurrent[k][j] for k in range(h)) for j in range(3 * h)]
        update = [squeeze(inputs[byte][j] + own[j]) for j in range(h)]
        reset = [squeeze(inputs[byte][h + j] + own[h + j]) for j in range(h)]
        fresh = [math.tanh(inputs[byte][2 * h + j] + reset[j] * (own[2 * h + j] + bias[j])) for j in range(h)]
        state = [update[j] * state[j] + (1 - update[j]) * fresh[j] for j in range(h)]
        out.append(state)
    return out


def plain_pooled(network, text, span, context):
    """The mean of the labels' distributions, window by window with its surroundings."""
    output, offset = network.output.astype(float).tolist(), network.offset.astype(float).tolist()
    sums = [0.0] * len(network.languages)
    for a in range(0, len(text), span):
        low, high = max(0, a - context), min(len(text), a + span + context)
        ahead = plain_states(network.forward, text[low:high])
        behind = plain_states(network.backward, text[low:high][::-1])[::-1]
        for i in range(a, min(len(text), a + span)):
            both = ahead[i - low] + behind[i - low]
            scores = [math.exp(sum(x * output[k][j] for k, x in enumerate(both)) + offset[j]) for j in range(len(sums))]
            sums = [s + x / sum(scores) for s, x in zip(sums, scores)]
    return [s / max(1, len(text)) for s in sums]


def test_forward_pass_against_a_plain_one():
    rng = np.random.default_rng(3)
    network = lid.Network(["a", "b", "c"], hidden=3)
    network.forward.bias += 0.3
    network.backward.bias -= 0.2
    network.output *= 8
    network.offset += np.array([0.1, 0, -0.2], np.float32)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 7, 8, 9, 16, 17, 40, 41, 90, 8)]
    for span, context in ((8, 3), (8, 0), (16, 16), (8, 20), (100, 5)):
        got = network.pooled(texts, span, context)
        assert np.allclose(got, [plain_pooled(network, t, span, context) for t in texts], atol=1e-5)
    # with all of a text around it, a window is labelled as the whole text is
    assert np.allclose(network.pooled(texts, 8, 90), network.pooled(texts, 90, 0), atol=1e-5)


def test_whole_characters_train():
    assert lid.whole_characters("a\u00e9\u4e2d\u4e2d", 7) == "a\u00e9\u4e2d".encode() and lid.whole_characters("", 5) == b""


def test_rows_against_the_plain_network(spark):
    """The query's labels and scores of whole documents, recomputed one number at a time."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    network = lid.learn(docs)
    rows = {r.doc_id: r for r in lid.predict(docs, network).collect()}
    some = sorted((r for r in rows.values() if r.lang_pred != "und"), key=lambda r: len(r.text))[:: max(1, len(rows) // 8)]
    assert len({r.doc_id for r in some}) >= 5
    for r in some:
        p = plain_pooled(network, r.text.encode(), lid.SPAN, lid.CONTEXT)
        assert abs(max(p) - r.score) < 1e-4 and network.languages[p.index(max(p))] == r.lang_pred


def test_pooling_covers_every_byte():
    network = lid.Network(["a", "b"], hidden=4)
    texts = [b"", b"x", b"y" * lid.SPAN, bytes(range(256)) * 3, b"z" * (lid.SPAN + 1)]
    seen = np.zeros(len(texts), int)
    for _, text, lengths, _ in network.label_bytes(texts):
        np.add.at(seen, text, lengths)
    assert seen.tolist() == [len(t) for t in texts]
    pooled = network.pooled(texts)
    assert np.allclose(pooled.sum(axis=1), [0, 1, 1, 1, 1], atol=1e-5)
    alone = np.vstack([network.pooled([t]) for t in texts])
    assert np.allclose(pooled, alone, atol=1e-5)


def test_copies_take_no_place_in_the_sample(spark):
    """All of 50 distinct texts among 20,000 rows, and as many as are wanted of 1,000."""
    docs = spark.range(60_000).selectExpr(
        "case when id < 20000 then 'X' else 'Y' end lang",
        "case when id < 20000 then concat('few ', id % 50) when id < 50000 then concat('many ', id % 1000) when id % 2 = 0 then '12' end text",
    )
    pairs = lid.sample_windows(docs, "text", "lang")
    assert {w for language, w in pairs if language == "X"} == {f"few {i}" for i in range(50)}
    assert sum(language == "Y" for language, _ in pairs) == lid.DOCS_PER_LANGUAGE


def test_held_out_accuracy(spark):
    rows = queries.op7_gru_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 100 < len(held) < 300
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.96


def test_odd_inputs(spark, monkeypatch):
    monkeypatch.setattr(lid, "STEPS", 60)
    monkeypatch.setattr(lid.Network.train, "__defaults__", (60, 64, 0.03, 1))
    x, y = "aaba abab baab", "xyyx yxyx xxyy"
    rows = [(i, (x if i % 2 else y) * 4, "X" if i % 2 else "Y") for i in range(40)]
    rows += [(None, x, None), (100, None, "X"), (101, "", "Y"), (102, "12 !?", "X"), (103, x * 20_000, None), (103, x * 20_000, None)]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, score double")
    network = lid.learn(docs)
    assert network.languages == ["X", "Y"]
    found = lid.predict(docs, network)
    assert found.columns == ["doc_id", "text", "lang", "score", "lang_pred", "_score"]
    got = [(r.doc_id, r.lang_pred) for r in found.collect()]
    assert got[:40] == [(i, "X" if i % 2 else "Y") for i in range(40)]
    assert got[40:] == [(None, "X"), (100, "und"), (101, "und"), (102, "und"), (103, "X"), (103, "X")]
    kept = lid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 43
    assert lid.learn(docs.where("lang is null")) is None
    assert {r.lang_pred for r in lid.predict(docs, None).collect()} == {"und"}
    assert lid.predict(docs.limit(0), network).count() == 0
    runs = lid.language_runs(docs.where("doc_id in (0, 1)"), network).collect()
    assert {i: sum(r.n_bytes for r in runs if r.doc_id == i) for i in (0, 1)} == {0: 56, 1: 56}


def test_labels_equal_the_probabilities_of_training():
    rng = np.random.default_rng(3)
    network = lid.Network(["a", "b", "c"])
    for lengths in (np.full(6, 20), np.array([1, 20, 7, 20, 13, 2])):
        steps = rng.integers(0, 256, (20, 6)).astype(np.uint8)
        inside = np.arange(20)[:, None] < lengths
        kept, labelled = network.probabilities(steps, lengths)[0], network.labels(steps, lengths)
        assert np.allclose(kept[inside], labelled[inside], atol=1e-6)
