"""Exchange-rate snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "base string, rates map<string,double>, date string, fetched_at string, _bad string"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Dated snapshot files; unreadable or incomplete ones drop out."""
    raw = (
        spark.read.schema(SNAPSHOT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("multiLine", True)
        .json(path)
    )
    whole = F.map_contains_key("rates", F.lit("USD")) & F.map_contains_key("rates", F.lit("PHP"))
    return raw.where("_bad is null and rates is not null").where(whole).drop("_bad")


def latest_rates(snapshots: DataFrame) -> DataFrame:
    """(rates): the latest good snapshot's map, one row; no row when there is none."""
    return (
        snapshots.groupBy()
        .agg(F.max_by("rates", "fetched_at").alias("rates"))
        .where("rates is not null")
    )


def with_rates(df: DataFrame, latest: DataFrame) -> DataFrame:
    """``df`` with the ``rates`` map on every row; null when there are no rates.

    ``latest`` is one row by construction (a global aggregate), so it is read as a scalar.
    """
    found = latest.agg(F.first("rates").alias("rates"))
    return df.withColumn("rates", found.scalar())
