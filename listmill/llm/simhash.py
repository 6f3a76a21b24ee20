"""SimHash near duplicates: fingerprints meet at the anchor points of a covering code.

A fingerprint has 64 bits. Two that differ in at most three bits differ in at most one bit in their
upper or in their lower 32 bits. In each half the anchors are the words of the perfect Hamming code
of length 31 (covering radius 1): a half lies within distance 1 of exactly one anchor, its home.
Every fingerprint is sent to all anchors within distance 1 + 1 of the half, at most 16; two halves
that differ in one bit then meet at the home of either. What meets is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.engine import cut
from listmill.llm.common import fresh, partitions, parts
from listmill.operators.components import components

WORDS, SEED, MAX_BITS = 3, 42, 3
#: Members of an anchor that one task compares; larger anchors are taken apart by the other half's quarters.
COMPARED = 20_000
#: Shingles that are hashed together.
STEP = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a text: a bit is 1 if more than half of the shingles' hashes have it.

    Words are what is between space and \\t to \\r; A-Z are lower-cased. A text of fewer words is one
    shingle, a null text or one without words has fingerprint 0.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.append(0, ends[:-1] + 1)[:count].tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    set_bits = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, count, STEP):
        values = [hashed(joined[a:b], SEED) for a, b in zip(starts[at : at + STEP], ends[at : at + STEP])]
        bits = np.unpackbits(np.array(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_column: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with the text replaced by ``fp``, the fingerprint as a signed long."""
    rest = [c for c in docs.columns if c != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, len(rest)):
                fps = np.array([fingerprint(t, words) for t in part.column(len(rest)).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(fps)], names=[*rest, "fp"])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("fp", T.LongType())])
    return docs.select(*rest, text_column).mapInArrow(run, schema)


def _half(fp: Column, lower: int, size: int) -> Column:
    """``size`` bits from bit ``lower`` on, as a long."""
    return F.shiftrightunsigned(fp, lower).bitwiseAND(F.lit((1 << size) - 1))


def _syndrome(half: Column, checks: int) -> Column:
    """The exclusive or of the numbers (from 1) of the bits that are set: 0 for a word of the code."""
    out = F.lit(0)
    length = (1 << checks) - 1
    for b in range(checks):
        mask = sum(1 << (i - 1) for i in range(1, length + 1) if i >> b & 1)
        odd = F.bit_count(half.bitwiseAND(F.lit(mask))) % 2
        out = out + odd * (1 << b)
    return out.cast("int")


def anchors(half: Column, checks: int) -> Column:
    """The words of the Hamming code of length 2**checks - 1 within distance 2, the home first.

    With syndrome s, flipping bits i and j gives a word of the code if i xor j = s; bit number 0
    stands for none, so the pair (s, 0) is the home. A word of the code has only itself that near.
    """
    s = _syndrome(half, checks)
    one = F.lit(1).cast("bigint")

    def flip(i: Column) -> Column:
        return F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftleft", one, i - 1))

    firsts = F.array(*(F.lit(i) for i in range(1 << checks)))
    pairs = F.filter(firsts, lambda i: i < i.bitwiseXOR(s))  # i = 0 gives the home
    near = F.transform(pairs, lambda i: half.bitwiseXOR(flip(i)).bitwiseXOR(flip(i.bitwiseXOR(s))))
    return F.when(s == 0, F.array(half)).otherwise(near)


def _at_anchors(points: DataFrame, lower: int, size: int, checks: int, name: str) -> DataFrame:
    """A row per anchor of the ``size`` bits from ``lower`` on; the bits beyond the code's length aren't used."""
    half = _half(F.col("fp"), lower, (1 << checks) - 1)
    exploded = points.select("*", F.posexplode(anchors(half, checks)).alias("_rank", name))
    return exploded.withColumn("home", F.col("home") & (F.col("_rank") == 0)).drop("_rank")


def _links(run: np.ndarray, home: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links that connect the members of one anchor as all their links would, fewer than members.

    Only pairs with one member at home are compared: of two that differ by one bit in the half, each
    meets the other at its own home.
    """
    label = np.arange(len(run))
    for i in np.flatnonzero(home).tolist():
        near = np.flatnonzero(np.bitwise_count(run ^ run[i]) <= max_bits)
        labels = label[near]
        own = label[i]
        if (labels == own).all():
            continue
        others, first = np.unique(labels, return_index=True)
        for other, at in zip(others.tolist(), first.tolist()):
            if other != own:
                yield i, int(near[at])
        label[np.isin(label, others)] = own


def _compare(members: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Links (a, b) among the members of each key. Rows come sorted by key, a run at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            data = [np.asarray(batch.column(i)) for i in range(len(keys) + 2)]
            if rest is not None:
                data = [np.concatenate([a, b]) for a, b in zip(rest, data)]
            if len(data[0]) == 0:
                continue
            new = np.zeros(len(data[0]), bool)
            for key in data[: len(keys)]:
                new[1:] |= key[1:] != key[:-1]
            starts = np.append(0, np.flatnonzero(new))
            rest = [x[starts[-1] :] for x in data]
            yield from found(data, starts)
        if rest is not None:
            yield from found(rest, np.array([0, len(rest[0])]))

    def found(data: list[np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for i in np.flatnonzero(np.diff(starts) > 1).tolist():
            part = slice(starts[i], starts[i + 1])
            fps, home = data[-2][part].view(np.uint64), data[-1][part].astype(bool)
            for x, y in _links(fps, home, max_bits):
                a.append(fps[x])
                b.append(fps[y])
        if a:
            arrays = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return (
        members.select(*keys, "fp", "home")
        .repartition(partitions(members.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "a bigint, b bigint")
    )


def near_links(points: DataFrame, max_bits: int = MAX_BITS, compared: int = COMPARED) -> DataFrame:
    """Links (a, b) that connect the distinct ``fp`` of ``points`` as all pairs of at most ``max_bits`` bits would.

    An anchor with more than ``compared`` members is not compared at once: its members get a second
    anchor in each quarter of the other half (three bits there leave one quarter with at most one)
    by the code of length 15, and the compound keys are compared; no pair is lost by that.
    """
    if max_bits > 3:
        raise ValueError("two halves cover three differing bits")
    out = []
    base = points.select("fp", F.lit(True).alias("home"))
    for lower in (0, 32):
        members = cut(_at_anchors(base, lower, 32, 5, "anchor"))
        hot = cut(members.groupBy("anchor").count().where(F.col("count") > compared).select("anchor"))
        if hot.isEmpty():
            out.append(_compare(members, ["anchor"], max_bits))
            continue
        out.append(_compare(members.join(hot, "anchor", "left_anti"), ["anchor"], max_bits))
        many = members.join(hot, "anchor", "left_semi")
        for quarter in (32 - lower, 48 - lower):
            out.append(_compare(_at_anchors(many, quarter, 16, 4, "anchor2"), ["anchor", "anchor2"], max_bits))
    links = out[0]
    for x in out[1:]:
        links = links.unionByName(x)
    return links.distinct()


def near_groups(fps: DataFrame, max_bits: int = MAX_BITS, compared: int = COMPARED) -> DataFrame:
    """``fps`` (doc_id, fp, any others) with component_id and root, the component's least fingerprint.

    Rows with one fingerprint are one class; classes link at ``max_bits`` or fewer differing bits.
    component_id is the smallest doc_id that is reachable, itself included; null only where no
    reachable row has an id. Repeated rows stay, empty tables give no rows.
    """
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(classes, max_bits, compared))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = cut(rooted.join(ids, "root").select("fp", "root", "component_id"))
    return fps.join(labels, "fp")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    fps = cut(fingerprints(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_groups(fps).select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group, in the columns of ``docs``: the one with the group's smallest id.

    Of several rows of the group with that id one stays; the same id in another group doesn't count
    here. A row without an id stays only where no row of its group has one; there one row stays. An
    empty table gives no rows. Rows are known by id and text: equal texts are in one group.
    """
    key = fresh(docs, "kept_key")
    named = F.coalesce(F.concat(F.lit("id "), F.col(id_column).cast("string")), F.lit("none"))
    keyed = docs.withColumn(key, F.concat(named, F.lit(" "), F.sha1(F.coalesce(F.col(text_column), F.lit("")))))
    fps = cut(fingerprints(keyed.select(F.col(id_column).alias("doc_id"), F.col(key).alias("key"), F.col(text_column).alias("text"))))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"]
    kept = near_groups(fps).groupBy("root").agg(first.alias(key)).select(key)
    return keyed.join(cut(kept), key, "left_semi").dropDuplicates([key]).select(*docs.columns)
