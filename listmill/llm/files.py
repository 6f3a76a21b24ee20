"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from listmill.engine import scratch_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that the session names."""
    return f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds a folder and the folder's path in it (local, hdfs, s3, gs)."""
    return fs.FileSystem.from_uri(folder)
