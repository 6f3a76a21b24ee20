"""Name similarity: exact candidate generation by shared pieces, then verification.

Similarity is 200 * LCS / (len a + len b) over token-sorted names, so only insertions and
deletions count. Two names of lengths l <= m reach ``threshold`` only when at most
``(1 - threshold) * (l + m)`` characters are inserted or deleted. The shorter name is cut into
more pieces than that and keeps the rarest of them, so at least one survives unchanged in the
longer one, at a place that the edits before and behind it allow. The longer name asks once for
what stands at each of its places, whatever the shorter one's length. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from listmill.engine import cut
from listmill.functions.names import sorted_tokens


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_similarity(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / total if total else 0.0


@F.pandas_udf(DoubleType())
def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Similarity of two token-sorted names, 0 to 100; two empty names give 0."""
    for left, right in batches:
        yield pd.Series(
            [indel_similarity(a or "", b or "") for a, b in zip(left, right, strict=True)],
            dtype="float64",
        )


def token_sort_similarity(a: Column, b: Column) -> Column:
    return similarity(sorted_tokens(a), sorted_tokens(b))


def _edits(length: str, percent: int) -> str:
    """The most characters that may differ between a name of ``length`` and one no shorter."""
    return f"cast(floor({length} * {200 - 2 * percent} / {percent}) as int)"


def _width(length: str, percent: int) -> str:
    """Width of the pieces of a shorter name: as many fit as can differ, and one more."""
    return f"cast(floor({length} / ({_edits(length, percent)} + 1)) as int)"


def rare_pieces(names: DataFrame, percent: int) -> DataFrame:
    """(short, bucket, flag, len, piece, at): the pieces of ``names`` of which one is unchanged in
    every longer similar name.

    A name falls into more pieces than characters may differ. Only so many that one must survive
    are kept, and those are the ones that fewest names have. Names are short, so a name's pieces
    are ranked in its own row.
    """
    pieces = names.withColumn("width", F.expr(_width("len", percent))).select(
        F.col("name").alias("short"), "bucket", "flag", "len",
        F.explode(F.expr("transform(sequence(0, len div width - 1), i -> struct(substring(name, cast(i * width + 1 as int), width) as piece, i * width as at))")).alias("p"),
    ).select("short", "bucket", "flag", "len", "p.*")
    known = pieces.groupBy("piece").agg(F.count("*").alias("names"))
    rare = pieces.join(known, "piece").groupBy("short", "bucket", "flag", "len").agg(
        F.array_sort(F.collect_list(F.struct("names", "at", "piece"))).alias("ranked")
    )
    kept = F.expr(f"slice(ranked, 1, {_edits('len', percent)} + 1)")
    return rare.select("short", "bucket", "flag", "len", F.inline(kept)).drop("names")


def asked_pieces(names: DataFrame, percent: int) -> DataFrame:
    """(long, bucket, flag, len, piece, at): every place of ``names`` where a piece of a shorter
    similar name may stand, once per width that such a name can have: two or three at most."""
    widths = f"""array_distinct(transform(sequence(cast(ceil(len * {percent} / {200 - percent}.0) as int), len), l -> {_width("l", percent)}))"""
    probes = f"""flatten(transform({widths}, w ->
        transform(sequence(0, greatest(len - w, 0)), i -> struct(substring(name, i + 1, w) as piece, cast(i as bigint) as at))))"""
    return names.select(F.col("name").alias("long"), "bucket", "flag", "len", F.inline(F.expr(probes)))


def similar_names(
    names: DataFrame, percent: int, bucket: str = "bucket", flag: str = "flag"
) -> DataFrame:
    """Pairs of different names (name_a < name_b) with similarity >= ``percent``.

    ``names`` has distinct (name, bucket, flag) rows, names token-sorted and not empty. Pairs
    are looked for within a bucket and its next one, and only where at least one side is
    flagged: callers flag the names their matching rule can use at all.
    """
    base = cut(
        names.where(F.col("name") != "")
        .groupBy("name", F.col(bucket).alias("bucket"))
        .agg(F.max(flag).alias("flag"))
        .withColumn("len", F.length("name"))
    )
    s, l = rare_pieces(base, percent).alias("s"), asked_pieces(base, percent)  # noqa: E741
    l = l.withColumn("bucket", F.explode(F.expr("array(bucket - 1, bucket, bucket + 1)"))).alias("l")  # noqa: E741
    # a piece may move by the characters that differ before it, the rest of the name by those behind it
    moved, longer = F.col("l.at") - F.col("s.at"), F.col("l.len") - F.col("s.len")
    most = F.floor((100 - percent) * (F.col("l.len") + F.col("s.len")) / 100)
    # flagged short names meet every long name, others only flagged long names
    found = (
        s.join(l, ["bucket", "piece"])
        .where((longer >= 0) & (F.abs(moved) + F.abs(longer - moved) <= most))
        .where((F.col("s.flag") | F.col("l.flag")) & (F.col("short") != F.col("long")))
        .select(F.least("short", "long").alias("name_a"), F.greatest("short", "long").alias("name_b"))
        .distinct()
    )
    return found.where(similarity("name_a", "name_b") >= percent)
