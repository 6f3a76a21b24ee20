"""Date-band neighbours of a key, without listing the pairs.

A row and its neighbours within ``days`` days share a (key, day) hub once each row has been
offered to the days around it. Rows are first reduced to one value per (key, day), so a key that
holds a third of all rows costs a handful of rows per day, and no pair is ever produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listmill.engine import cut
from listmill.fixed_values import MAX_DATE_GAP_DAYS


def days_around(day: Column, days: int = MAX_DATE_GAP_DAYS) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(-days), F.lit(days)), lambda d: F.date_add(day, d)))


def earliest_near(
    rows: DataFrame, key: list[str], day: str, value: str, days: int = MAX_DATE_GAP_DAYS
) -> DataFrame:
    """The smallest ``value`` within ``days`` days of each (key, day) of ``rows``' hubs."""
    per_day = rows.groupBy(*key, day).agg(F.min(value).alias(value))
    return (
        per_day.select(*key, days_around(F.col(day), days).alias(day), value)
        .groupBy(*key, day)
        .agg(F.min(value).alias(value))
    )


def first_other_near(
    rows: DataFrame, key: list[str], day: str, ident: str, days: int = MAX_DATE_GAP_DAYS
) -> DataFrame:
    """Each row with the smallest ``ident`` of another row of its key within ``days`` days
    (``first_near``, null without one) and how many such rows there are (``n_near``)."""
    per_day = rows.groupBy(*key, day).agg(F.min(ident).alias("lo"), F.count("*").alias("n"))
    rest = (
        rows.join(per_day.select(*key, day, "lo"), [*key, day])
        .where(F.col(ident) != F.col("lo"))
        .groupBy(*key, day)
        .agg(F.min(ident).alias("second"))
    )
    two = per_day.join(rest, [*key, day], "left").withColumn("_least", F.array_compact(F.array("lo", "second")))
    # one row per day of a key: the window holds 2 * days + 1 of them at most
    around = W.partitionBy(*key).orderBy(F.unix_date(F.col(day).cast("date"))).rangeBetween(-days, days)
    least = F.array_sort(F.flatten(F.collect_list("_least").over(around)))
    hub = two.select(
        *key, day, F.sum("n").over(around).alias("n"), F.get(least, 0).alias("first"), F.get(least, 1).alias("next")
    )
    return rows.join(hub, [*key, day], "left").select(
        *rows.columns,
        F.when(F.col("first") != F.col(ident), F.col("first")).otherwise(F.col("next")).alias("first_near"),
        (F.col("n") - 1).alias("n_near"),
    )


def in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``_part``: all rows in ``order`` fall into ranges of about equal size, numbered in
    that order. A crowded key spreads over several ranges. The table is stored, as ranges are drawn
    from a sample and must not be drawn again."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))


def with_previous(rows: DataFrame, order: list[str], more: list[str], name: str) -> DataFrame:
    """``rows`` with the struct ``name``: the columns ``order`` and ``more`` of the row before in
    ``order``, which ends in something unique. Null for the very first row.

    Each range is sorted by itself, and the last row of a range is carried over to the next one: one
    row per range.
    """
    ranged = in_ranges(rows, order)
    whole = F.struct(*order, *more)
    last = ranged.groupBy("_part").agg(F.max(whole).alias("_last"))
    carried = last.select("_part", F.lag("_last").over(W.orderBy("_part")).alias("_carried"))
    inside = F.lag(whole).over(W.partitionBy("_part").orderBy(*order))
    return (
        ranged.withColumn("_inside", inside)
        .join(carried, "_part")
        .select(*rows.columns, F.coalesce("_inside", "_carried").alias(name))
    )


def exact_rank(rows: DataFrame, key: list[str], ident: str) -> DataFrame:
    """row_number() of ``ident`` within ``key`` as ``rank``, for keys of any size.

    Ranks are counted inside ranges of all rows and shifted by the key's rows in the ranges before,
    one row per key and range.
    """
    ranged = in_ranges(rows, [*key, ident])
    sizes = ranged.groupBy(*key, "_part").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(*key, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part", *key).orderBy(ident))
    return (
        ranged.withColumn("_in", inside)
        .join(before, [*key, "_part"])
        .withColumn("rank", F.col("_before") + F.col("_in"))
        .drop("_part", "_in", "_before")
    )
