"""Listings arriving as files, folded into the listing table batch by batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listmill.operators.incremental import upsert_late
from listmill.sinks import versions


def listing_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """New files under ``path`` as a stream of sightings, also late and repeated ones: the upsert takes them."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


#: The counts of a micro-batch, and of all up to it.
COUNTED = ["seen", "new", "updated", "in_window"]
COUNTERS = "batch bigint, " + ", ".join(f"{c} bigint, all_{c} bigint" for c in COUNTED)


def counters(spark: SparkSession, path: str) -> DataFrame:
    """One row per counted micro-batch: what it brought, and the running counts after it."""
    return spark.read.schema(COUNTERS).option("recursiveFileLookup", True).parquet(f"{path}/of")


def record_counts(path: str, batch_id: int, batch: DataFrame, known: DataFrame, keys: list[str], in_window: Column) -> None:
    """Writes a micro-batch's row of counters; a batch that has one keeps it.

    ``seen`` are its rows, ``new`` its different keys that ``known`` lacks, ``updated`` the rest. Rows
    are summed up per key before they meet ``known``, and the counts are taken as observed metrics of
    the last step of that one pass, whose tasks count once however often they are tried.
    The row is written before the batch is folded: a batch that is delivered again after a crash finds
    either no finished row and the table as it was, or its row.
    """
    spark = batch.sparkSession
    folder = f"{path}/of/batch-{batch_id:012d}"
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return
    per_key = batch.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(in_window).alias("_in"))
    held = known.select(*(F.col(k).alias(f"_of_{k}") for k in keys)).distinct().withColumn("_known", F.lit(True))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    observed = Observation()
    metered = per_key.join(held, same, "left").observe(
        observed, F.sum("_n").alias("seen"), F.count_if(F.col("_known").isNull()).alias("new"), F.sum("_in").alias("in_window")
    )
    metered.select("_n").write.format("noop").mode("overwrite").save()
    own = {c: observed.get[c] or 0 for c in ("seen", "new", "in_window")}
    own["updated"] = own["seen"] - own["new"]
    last = None
    if batch_id:
        last = counters(spark, path).where(F.col("batch") < batch_id).orderBy(F.desc("batch")).first()
    row = {"batch": batch_id} | own | {f"all_{c}": own[c] + (last[f"all_{c}"] if last else 0) for c in COUNTED}
    spark.createDataFrame([row], COUNTERS).coalesce(1).write.mode("overwrite").parquet(folder)


def fold_into(spark: SparkSession, root: str, keys: list[str], seen: str, counts: str | None = None, in_window: Column | None = None):
    """A batch handler that upserts into a versioned table: the key-hash buckets that the batch meets
    are read, folded and written as a new version. A batch that is delivered again changes nothing,
    and files may come in any order. With a folder ``counts``, each batch adds a row of counters."""

    window = F.lit(True) if in_window is None else in_window

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = versions.current(session, root)
        buckets = before.buckets if before else versions.BUCKETS
        touched = [r.bucket for r in batch.select(versions.bucket_of(keys, buckets).alias("bucket")).distinct().collect()]
        if not touched and before:
            if counts:
                record_counts(counts, batch_id, batch, batch.select(*keys), keys, window)
            return
        if before is None:
            old = (
                session.createDataFrame([], batch.drop(seen).schema)
                .withColumn("first_seen_at", F.lit(None).cast(dict(batch.dtypes)[seen]))
                .withColumn("last_seen_at", F.lit(None).cast(dict(batch.dtypes)[seen]))
            )
        else:
            old = versions.read(session, root, touched)
        if counts:
            record_counts(counts, batch_id, batch, old, keys, window)
        versions.replace_buckets(upsert_late(old, batch, keys, seen), root, keys, touched, before)

    return handle


def run_available(
    stream: DataFrame, root: str, checkpoint: str, keys: list[str], seen: str = "seen_at", counts: str | None = None, in_window: Column | None = None
) -> None:
    """Folds everything that has arrived, then stops. ``counts`` names a folder for running counters."""
    query = (
        stream.writeStream.foreachBatch(fold_into(stream.sparkSession, root, keys, seen, counts, in_window))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def sighting_counts(batch: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """(outcome, n): new and updated sightings of a batch."""
    seen = known.select(*keys, F.lit(True).alias("_known")).distinct()
    outcome = F.when(F.col("_known"), "updated").otherwise("new")
    return batch.join(seen, keys, "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
