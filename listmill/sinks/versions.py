"""Versioned tables: parts by key hash, and one small list of parts per version.

A table is a folder with ``data`` (parts) and ``versions`` (lists). A version's list names, for each
key-hash bucket that has rows, the folder that holds them; a new version writes the buckets that
changed and names the old folders of the others. Lists are numbered and never overwritten: readers
take the highest one whose write was finished, so a writer that dies at any point leaves the version
before in force.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Key-hash buckets of a new table; a table keeps the number it was made with.
BUCKETS = 64


class Version:
    """A finished version: its number, its buckets' folders, the schema and the number of buckets."""

    def __init__(self, number: int, parts: dict[int, str], schema: T.StructType, buckets: int):
        self.number, self.parts, self.schema, self.buckets = number, parts, schema, buckets


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _finished(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions whose list was written to its end (the writer's success mark is there)."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/versions/*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [f.getPath().getParent().getName() for f in found]
    return sorted(int(n) for n in names if re.fullmatch(r"\d+", n))


def current(spark: SparkSession, root: str) -> Version | None:
    """The highest finished version; None where none was ever finished. A list that lacks parts is refused."""
    numbers = _finished(spark, root)
    if not numbers:
        return None
    lines = [json.loads(r.value) for r in spark.read.text(f"{root}/versions/{numbers[-1]:012d}").collect()]
    head = next((x for x in lines if "schema" in x), None)
    if head is None:
        raise RuntimeError(f"{root}: the list of version {numbers[-1]} has no head")
    parts = {x["bucket"]: x["folder"] for x in lines if "bucket" in x}
    if len(parts) != head["parts"]:
        raise RuntimeError(f"{root}: version {numbers[-1]} names {len(parts)} of {head['parts']} parts")
    return Version(numbers[-1], parts, T.StructType.fromJson(head["schema"]), head["buckets"])


def read(spark: SparkSession, root: str, only: list[int] | None = None) -> DataFrame | None:
    """The table as it stands, or the given buckets of it; None where there is none."""
    version = current(spark, root)
    return None if version is None else _rows(spark, root, version, only)


def _rows(spark: SparkSession, root: str, version: Version, only: list[int] | None = None) -> DataFrame:
    folders = [f"{root}/{folder}" for bucket, folder in sorted(version.parts.items()) if only is None or bucket in only]
    return spark.read.schema(version.schema).parquet(*folders) if folders else spark.createDataFrame([], version.schema)


def replace_buckets(rows: DataFrame, root: str, keys: list[str], touched: list[int], before: Version | None, buckets: int = BUCKETS) -> None:
    """Writes a version in which the touched buckets hold ``rows`` and the others what they held.

    All keys of ``rows`` must fall into touched buckets. The list is written last.
    """
    spark = rows.sparkSession
    buckets = before.buckets if before else buckets
    folder = f"data/{uuid.uuid4().hex}"
    marked = rows.withColumn("_bucket", bucket_of(keys, buckets))
    marked.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{folder}")
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}/_bucket=*")
    written = [f.getPath().getName() for f in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []]
    parts = {b: f for b, f in (before.parts if before else {}).items() if b not in set(touched)}
    parts |= {int(name.partition("=")[2]): f"{folder}/{name}" for name in written}
    schema = json.loads(rows.schema.json())
    lines = [{"schema": schema, "buckets": buckets, "parts": len(parts)}] + [{"bucket": b, "folder": f} for b, f in parts.items()]
    _finish(spark, root, before.number + 1 if before else 1, lines)


def _finish(spark: SparkSession, root: str, number: int, lines: list[dict]) -> None:
    """Writes a version's list; one that was begun under this number and never finished is written over."""
    if number in _finished(spark, root):
        raise RuntimeError(f"{root}: another writer finished version {number}")
    listed = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    listed.coalesce(1).write.mode("overwrite").text(f"{root}/versions/{number:012d}")
