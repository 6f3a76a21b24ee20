"""Byte shards against a plain running sum."""

import random
import zlib

import pytest

from listmill.llm import sharding


def plain(rows, shards):
    """rows of (id, text) in input order."""
    sized = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows]
    sized.sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[2], r[1]))
    total, at, out, slots = sum(s for _, s, _ in sized), 0, [], {}
    for i, size, crc in sized:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i, size, crc, shard, slots[shard], at))
        at += size
    return out


def got(df):
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.first_byte) for r in df.collect()), key=lambda r: r[-1])


@pytest.mark.parametrize("seed,shards", [(1, 40), (2, 1), (3, 7)])
def test_against_running_sum(spark, seed, shards):
    rng = random.Random(seed)
    rows = [(rng.choice([None, rng.randrange(300), 5]), rng.choice([None, "", "ä" * rng.randrange(400), "same text"])) for _ in range(500)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, size int")
    found = sharding.byte_shards(docs.repartition(5), shards)
    assert got(found) == plain(rows, shards)
    assert {(r.law, r.grown_shard) for r in found.collect()} == {("bytes", None)}


def test_shares_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.byte_shards(docs).collect()
    sizes = [0] * 40
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)


def test_empty_few_and_very_long(spark):
    schema = "doc_id long, text string"
    assert sharding.byte_shards(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "x" * 3_000_000), (2, None)]
    assert got(sharding.byte_shards(spark.createDataFrame(rows, schema))) == plain(rows, 40)
