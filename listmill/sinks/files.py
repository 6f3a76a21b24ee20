"""Writing: flat export, snapshots, versioned sync, verified copy, normalised dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, TimestampNTZType, TimestampType

from listmill.operators.incremental import sync_actions
from listmill.operators.privacy import leaks, scrub_table
from listmill.sinks import versions


def write_export(rows: DataFrame, path: str) -> None:
    """CSV with a header; list columns as text are already flat in export rows."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_or_null(column: Column) -> Column:
    """Nested values as JSON text; a missing value stays SQL null, never JSON "null"."""
    return F.when(column.isNotNull(), F.to_json(column, {"ignoreNullFields": "false"}))


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, timestamps without fraction and offset."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            c = json_or_null(c)
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def write_dump(df: DataFrame, path: str, key: list[str], details: DataFrame, empty: bool = False) -> None:
    """A scrubbed, compressed dump of a table; ``empty`` writes its header only."""
    rows = df.where(F.lit(False)) if empty else scrub_table(df, key, details)
    flat_columns(rows).write.mode("overwrite").option("header", True).option(
        "compression", "gzip"
    ).csv(path)


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The versioned table at ``root``; None before the first write."""
    return versions.read(spark, root)


def sync_table(wanted: DataFrame, root: str, key: str = "id") -> dict[str, int]:
    """Makes the table at ``root`` hold exactly ``wanted``; returns rows written and deleted.

    Only the key-hash buckets with a changed row are written again; readers see the old or the new
    version. When nothing changed nothing is written.
    """
    spark = wanted.sparkSession
    before = versions.current(spark, root)
    buckets = before.buckets if before else versions.BUCKETS
    target = spark.createDataFrame([], wanted.schema) if before is None else versions.read(spark, root)
    actions = sync_actions(target, wanted, key).where("action <> 'keep'")
    changes = actions.groupBy(versions.bucket_of([key], buckets).alias("bucket"), "action").agg(F.count("*").alias("n")).collect()
    result = {"written": sum(r.n for r in changes if r.action != "delete"), "deleted": sum(r.n for r in changes if r.action == "delete")}
    if changes or before is None:
        touched = sorted({r.bucket for r in changes})
        rows = wanted.where(versions.bucket_of([key], buckets).isin(touched))
        versions.replace_buckets(rows, root, [key], touched, before)
    return result


def copy_verified(tables: dict[str, DataFrame], keys: dict[str, list[str]], root: str, details: DataFrame) -> dict[str, int]:
    """Writes scrubbed copies, reads them back and compares: a missing row or a remaining
    account detail raises."""
    counts = {}
    for name, df in tables.items():
        path = f"{root}/{name}"
        scrub_table(df, keys[name], details).write.mode("overwrite").parquet(path)
        back = df.sparkSession.read.parquet(path)
        counts[name], expected = back.count(), df.count()
        if counts[name] != expected:
            raise RuntimeError(f"{name}: {counts[name]} rows written, {expected} expected")
        left = leaks(back, keys[name], details).limit(1).count()
        if left:
            raise RuntimeError(f"{name}: account details remain in the copy")
    return counts


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
