"""The permutation, and shards against the stream that they were cut from."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from listmill.llm import bpe, queries
from listmill.llm import training_order as order

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    p = order.Permutation(size, 99)
    slots = p.slots(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert p.sequences(slots).tolist() == list(range(size))
    if size > 100:
        assert slots.tolist() != order.Permutation(size, 100).slots(np.arange(size)).tolist()
        assert abs(np.corrcoef(np.arange(size), slots)[0, 1]) < 0.1


def test_large_permutation():
    p = order.Permutation(10**13 + 7, 3)
    some = np.arange(10**13 - 1000, 10**13)
    slots = p.slots(some)
    assert p.sequences(slots).tolist() == some.tolist() and 0 <= slots.min() and slots.max() < p.size


def stream(rows, end):
    return b"".join((r or b"") + end for r in rows)


def check(got, layout, data, end, key):
    """Every slot holds the sequence that the permutation names."""
    n = -(-len(data) // layout.stride)
    data += end * ((n * layout.stride - len(data)) // len(end))
    want = {}
    for sequence, slot in enumerate(order.Permutation(n, key).slots(np.arange(n)).tolist()):
        want[slot] = (sequence, data[sequence * layout.stride : (sequence + 1) * layout.stride])
    assert {r.slot: (r.sequence, bytes(r.data)) for r in got} == want
    assert all(r.crc32 == zlib.crc32(r.data) and r.first_byte == (r.slot % layout.per_shard) * layout.stride for r in got)
    assert sum(r.n_tokens for r in got) == layout.tokens


@pytest.mark.parametrize("length", [7, 64, 5000])
def test_shards_hold_the_stream(spark, tmp_path, length):
    rows = [None, b"", b"\1\0" * 3, b"\2\0" * 9000, b"\3\0" * 65, None, b"\3\0" * 65]
    path = str(tmp_path / "in")
    spark.createDataFrame([(r, 1) for r in rows], "ids binary, slot int").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    manifest, layout = order.materialise(docs, str(tmp_path / "out"), 5, length=length, shard_bytes=4000)
    got = order.read_shards(manifest, layout).collect()
    check(got, layout, stream(rows, b"\xff\xff"), b"\xff\xff", 5)
    later = order.read_shards(manifest, layout, first_slot=3).collect()
    assert sorted(later) == sorted(r for r in got if r.slot >= 3)
    empty, nothing = order.materialise(docs.limit(0), str(tmp_path / "none"), 5)
    assert nothing.sequences == 0 and order.read_shards(empty, nothing).count() == 0


def test_many_partitions_make_one_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(500).selectExpr("encode(concat(id, ':', repeat('x', cast(id % 40 as int))), 'UTF-8') ids").repartition(6).write.parquet(path)
    docs = spark.read.parquet(path)
    manifest, layout = order.materialise(docs, str(tmp_path / "out"), 8, width=1, end=b"\xff", length=100, shard_bytes=2000)
    assert manifest.count() == layout.shards > 3
    got = order.read_shards(manifest, layout).collect()
    whole = b"".join(bytes(r.data) for r in sorted(got, key=lambda r: r.sequence)).rstrip(b"\xff").split(b"\xff")
    assert sorted(whole) == sorted(bytes(r.ids) for r in docs.collect())


def test_query_on_documents(spark):
    rows = queries.op1_training_order(spark, FOLDER).collect()
    texts = [r.text.encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    data = stream(texts, b"\xff")
    n = -(-len(data) // 2048)
    data += b"\xff" * (n * 2048 - len(data))
    want = {s: zlib.crc32(data[i * 2048 : (i + 1) * 2048]) for i, s in enumerate(order.Permutation(n, queries.ORDER_KEY).slots(np.arange(n)).tolist())}
    assert {r.slot: r.crc32 for r in rows} == want


def test_token_order_on_documents(spark):
    """The slots hold ids of the vocabulary, as the tiktoken library gives them."""
    names = [q for q in entry.queries() if q.startswith("op1_")]
    assert names[0] == "op1_token_order"
    rows = entry.queries()[names[0]](spark, FOLDER).collect()
    ranks = bpe.rank_of_tokens(bpe.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    data = stream([np.array(library.encode_ordinary(t), "<u2").tobytes() for t in texts], b"\xff\xff")
    n = -(-len(data) // 4096)
    assert sum(r.n_tokens for r in rows) == len(data) // 2
    data += b"\xff" * (n * 4096 - len(data))
    want = {s: zlib.crc32(data[i * 4096 : (i + 1) * 4096]) for i, s in enumerate(order.Permutation(n, queries.ORDER_KEY).slots(np.arange(n)).tolist())}
    assert {r.slot: r.crc32 for r in rows} == want


def test_ids_that_do_not_fit_are_refused(spark):
    docs = spark.createDataFrame([("a",)], "text string")
    ranks = b"YQ== 65535"
    with pytest.raises(ValueError):
        order.token_order(docs, 1, ranks, ".")
    with pytest.raises(ValueError):
        bpe.encode(docs, b"YQ== 65536", ".", width=2)
