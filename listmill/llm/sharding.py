"""Contiguous shards of equal bytes: global prefix sums from per-partition totals, cut at equal targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listmill.engine import cut
from listmill.llm.common import partitions

#: Bytes that a row takes besides its text.
ROW_BYTES = 16


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def byte_shards(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law ``bytes``, shard, slot, grown_shard (null), first_byte.

    Rows are ordered by id, then checksum, size and place in the input, so repeated ids and repeated
    rows have a fixed order; null ids come first. ``first_byte`` is the sum of the sizes before a
    row; the row goes to the shard whose equal share of all bytes holds the row's middle, so shards
    are contiguous and differ by one row's size at most. ``slot`` counts within the shard from 0.
    A null or empty text has the size of an empty row and the checksum 0. An empty table gives no
    rows. Columns other than the two named ones are not looked at.

    Only ids, sizes and checksums are shuffled, never texts. Rows of one id are split by the later
    order columns, so a frequent id spreads over many ranges. What is broadcast has one row per
    partition or per shard.
    """
    spark = docs.sparkSession
    text = F.col(text_column)
    small = cut(
        docs.select(
            F.col(id_column).alias("doc_id"),
            text_size(text).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    order = ["doc_id", "text_crc32", "size", "place"]
    ranged = cut(small.repartitionByRange(partitions(spark), *order).withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy(*order)
    placed = (
        ranged.join(F.broadcast(bases), "range")
        .withColumn("first_byte", F.col("bytes_before") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("position", F.col("rows_before") + F.row_number().over(inside) - 1)
        .withColumn(
            "shard",
            F.least(F.expr(f"((2 * first_byte + size) * {shards}) div (2 * total)"), F.lit(shards - 1)).cast("int"),
        )
        .select("doc_id", "size", "text_crc32", "shard", "first_byte", "position")
    )
    placed = cut(placed)
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first_position"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first_position")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "first_byte",
    )
