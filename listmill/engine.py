"""Session and lineage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "listmill", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for stored intermediate results.

    It is the one the cluster names in ``spark.checkpoint.dir``. A local session without the
    setting gets a private folder; a cluster session without it is refused, because a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="listmill-scratch-")
        sc.setCheckpointDir(folder)
    return folder


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Whether a query's shuffle files go when it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame) -> str:
    """The path of ``df`` as a table. Its shuffle files go once it is written: what follows reads the table."""
    path = f"{scratch_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` stored as a table in the scratch folder and read back.

    Forgets the lineage, so a lost executor costs a re-read only. A written table, unlike a
    checkpoint, also brings the real size: join estimates do not pile up over rounds, and the
    planner can choose broadcasts by what is there.
    """
    return df.sparkSession.read.schema(df.schema).parquet(_stored(df))


def cut_all(parts: list[DataFrame]) -> DataFrame:
    """The rows of all ``parts``, which have the same columns, as one stored table. Each part is
    planned and written by itself: the driver holds the plan of one at a time."""
    paths = [_stored(part) for part in parts]
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(*paths)


def load(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df
