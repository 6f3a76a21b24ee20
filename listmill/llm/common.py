"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.engine import partitions  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Bytes of a batch's texts that are worked on together; a longer text comes by itself.
TOGETHER = 2 << 20


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(texts: pa.Array, together: int | None = None) -> Iterator[tuple[int, int]]:
    """Begins and ends of slices of texts that hold about ``together`` bytes (TOGETHER if not given), or one row."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths, dtype=np.int64) // (together or TOGETHER)
    starts = np.append(0, np.flatnonzero(np.diff(group)) + 1)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(lengths)]):
        if b > a:
            yield a, b


def parts(batch: pa.RecordBatch, column: int, together: int | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose column holds about ``together`` bytes (TOGETHER if not given), or one row."""
    for a, b in slices(batch.column(column), together):
        yield batch.slice(a, b - a)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned crc32 of a text's UTF-8 bytes (polynomial 0xEDB88320).

    Needs ``crc_table`` as a column in scope, see CRC_TABLE_SQL.
    """
    return f"""xor(list_reduce(
        list_prepend(4294967295::bigint,
            list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)),
        lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::bigint)"""


CRC_TABLE_SQL = """list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end))"""
