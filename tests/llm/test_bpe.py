"""Byte-level BPE against the tiktoken library, and the round trip."""

import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from listmill.llm import bpe, common, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    content = bpe.rank_file(public_tokenizers.path(request.param))
    coder = bpe.Encoder(bpe.RankTable(content), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.table.ranks, special_tokens={})
    return coder, library


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_random_texts(both):
    coder, library = both
    rng = random.Random(2)
    alphabet = "aab the THE'sé\n\t  \x1c\xa0 1 23!!中文🙂ß"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "   ", "  a", " \n b", "\n", "a\n  b", "it's we'll I'M", "<|endoftext|>", "a   b  ", "\r\n\r\n x"]
    for text, got in zip(texts, coder.encode(texts)):
        assert ids(got) == library.encode_ordinary(text), repr(text)


def test_very_long_pre_tokens(both):
    coder, library = both
    rng = random.Random(4)
    texts = ["a" * 30_000, "ab" * 9000, "the" * 9000, " " * 2000, "x" + " " * 501 + "y", "中" * 2000, "=" * 5000,
             "".join(rng.choice("abcdefghi") for _ in range(60_000))]
    for text, got in zip(texts, coder.encode(texts)):
        assert ids(got) == library.encode_ordinary(text)


def test_forgetting_changes_nothing(both, monkeypatch):
    coder, library = both
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for text in ["one two three four", "four three  two", "one"]:
        assert ids(coder.encode([text])[0]) == library.encode_ordinary(text)


def test_white_space_around_a_space_is_one_pre_token():
    tokens = [*(bytes([b]) for b in range(256)), b"\n ", b" a"]
    content = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    coder = bpe.Encoder(bpe.RankTable(content), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.table.ranks, special_tokens={})
    for text in ["a\n \nb", "a \nb a", "a\n a", " \n \n a"]:
        assert ids(coder.encode([text])[0]) == library.encode_ordinary(text), repr(text)


def test_pre_tokens_of_a_task_are_merged_once(both, monkeypatch):
    merged, merge = [], bpe.merge_pieces
    monkeypatch.setattr(bpe, "merge_pieces", lambda table, pieces: merged.extend(pieces) or merge(table, pieces))
    coder = bpe.Encoder(both[0].table, public_tokenizers.PATTERN)
    suffixes = [f"{x}{y}{z}" for x in "abcdefghijklmn" for y in "abcdefghijklmn" for z in "abcdefghijklmn"]
    text = " ".join(f"{a}x{b}q{c}" for a in "abcdefgh" for b in "ijklmnop" for c in suffixes)
    for _ in range(2):
        coder.encode([text])
    assert len(merged) == len(set(merged)) > 150_000


@pytest.mark.parametrize("width", [2, 4])
def test_columns_in_either_width(both, width):
    coder, library = both
    texts = pa.array(["", "one two", " two  one", "one two", "\n \n", "zwölf"])[1:]
    got = [np.frombuffer(x, f"<u{width}").tolist() for x in coder.encode_column(texts, width).to_pylist()]
    assert got == [library.encode_ordinary(t) for t in texts.to_pylist()]
    assert len(coder.encode_column(texts[:0], width)) == 0


def test_slices_change_nothing(both, monkeypatch):
    coder, library = both
    rng = random.Random(6)
    texts = ["".join(rng.choice("aab the é\n  1!中ß") for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["ab" * 300]
    want = [library.encode_ordinary(t) for t in texts]
    for name, least in [("HANDED_ON", 100), ("MATCHED", 7), ("HELD", 5), ("STRETCH", 3)]:
        monkeypatch.setattr(bpe, name, least)
    coder._forget()
    slices = list(coder.encode_slices(pa.array(texts), 2))
    assert len(slices) > 50
    assert [np.frombuffer(x, "<u2").tolist() for part in slices for x in part.to_pylist()] == want
    coder._forget()
    assert list(map(ids, coder.encode(texts))) == want


@pytest.mark.parametrize("gap, different, times", [(" ", 120_000, 34), ("  ", 300, 6)])
def test_memory_beside_the_texts(both, gap, different, times):
    """Many different words are merged together; white space before a space has texts matched whole."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(different)]
    texts = pa.array([gap.join(words[i % different : i % different + 300]) for i in range(0, 240_000, 300)])
    coder = bpe.Encoder(both[0].table, public_tokenizers.PATTERN)
    tracemalloc.start()
    try:
        coder.encode_column(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < times * sum(map(len, texts.to_pylist())), most / sum(map(len, texts.to_pylist()))


def test_queue_gives_ranks_in_order():
    rng = random.Random(1)
    queue, want = bpe.RankQueue(300_000), {}
    for _ in range(2000):
        rank, at = rng.randrange(300_000), rng.randrange(99)
        queue.push(rank, np.array([at]))
        want.setdefault(rank, []).append(at)
    got = []
    while (popped := queue.pop()) is not None:
        got.append((popped[0], popped[1].tolist()))
    assert got == sorted(want.items())


def test_query_on_documents(spark, both):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    library = both[1]
    if library.n_vocab != 50256:
        pytest.skip("the query uses the other file")
    content = bpe.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ranks = bpe.rank_of_tokens(content)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: tuple(r) for r in queries.bpe_digests(docs).collect()}
    for row in docs.collect():
        want = library.encode_ordinary(row.text)
        packed = hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id] == (row.doc_id, len(want), packed, hashlib.sha256(row.text.encode()).hexdigest())


def test_nulls_extra_columns_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(common, "TOGETHER", 10)
    content = bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = [(1, None, "x", "d"), (None, "", None, "d"), (1, "héllo  wörld ", "y", None), (1, "héllo  wörld ", "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    coded = bpe.encode(docs, content, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "ids", "decoded", "_ids"]
    out = bpe.decode(coded, content, "_ids")
    assert out.columns == ["doc_id", "ids", "decoded", "_ids", "_decoded"]
    at_once = bpe.encode(docs, content, public_tokenizers.PATTERN, decoded_column="decoded")
    assert at_once.columns == out.columns and at_once.collect() == out.collect()
    assert [(r.doc_id, r.ids, bytes(r._decoded).decode()) for r in out.collect()] == [(i, x, t or "") for i, t, x, _ in rows]
    assert bpe.decode(bpe.encode(docs.limit(0), content, public_tokenizers.PATTERN), content, "_ids").count() == 0
