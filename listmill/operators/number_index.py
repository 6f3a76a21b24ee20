"""The numbers of texts as rows, so that amounts find their places by an equi join.

A text is read once, where it lies; what travels are its numbers, each with a bounded piece of the
text around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill import fixed_values as fv

#: Characters kept on either side of a number.
CONTEXT = 70
#: No double has more digits before its point, so longer numbers match no amount.
_MOST_DIGITS = 309
_ROWS_AT_ONCE = 10_000
_TEXTS_AT_ONCE = 64

_FIRST = re.compile(r"(?<![\d.,])[0-9]+")
_GROUP = re.compile(fv.THOUSANDS_GAP.rstrip("?") + r"((?:[0-9]{3})+)(?![0-9])")
_NO_CENTS = re.compile(r"(?:[.,]0{1,2}|,-)?(?!\d|[.,]\d|\n\d)")
_CENTS = re.compile(r"[.,]([0-9]{2})(?!\d)")
#: What may go on with a number, as cents or as its next group.
_GOES_ON = frozenset(".,'- \u00a0\u202f")


def canonical(amount: Column) -> Column:
    """How the index spells an amount: digits alone for whole ones, else with two decimals."""
    nearest = F.bround(amount)
    whole = F.abs(amount - nearest) < 1e-9
    return F.when(whole, F.format_string("%.0f", nearest)).otherwise(F.format_string("%.2f", amount))


def readings(text: str) -> Iterator[tuple[str, int, int]]:
    """(number, start, end) of every way to read a number, from left to right.

    Groups of three digits may stand apart, so "1 250" is 1, 1250 and 250. A whole number may end in
    zero cents, is not part of a longer one and does not go on from the line before. Places of one
    number do not overlap.
    """
    free: dict[str, int] = {}
    for first in _FIRST.finditer(text):
        start, end = first.span()
        digits = first[0]
        goes_on = start > 1 and text[start - 1] == "\n" and text[start - 2].isdecimal()
        while len(digits) <= _MOST_DIGITS:
            after = text[end : end + 1]
            beyond = text[end + 1 : end + 2] if after == "\n" else after
            if after not in _GOES_ON and not beyond.isdecimal():
                # nothing goes on with the number: most end like this
                if not goes_on and start >= free.get(digits, 0):
                    free[digits] = end
                    yield digits, start, end
                break
            found = []
            if not goes_on and (tail := _NO_CENTS.match(text, end)):
                found.append((digits, tail.end()))
            if cents := _CENTS.match(text, end):
                found.append((f"{digits}.{cents[1]}", cents.end()))
            for number, upto in found:
                if start >= free.get(number, 0):
                    free[number] = upto
                    yield number, start, upto
            group = _GROUP.match(text, end)
            if not group:
                break
            digits, end = digits + group[1], group.end()


def number_index(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, number, start, left, hit, right): a row per reading of a number in the key's text.

    ``left`` and ``right`` are up to CONTEXT characters beside it. Null texts have no rows.
    """
    schema = T.StructType([
        texts.schema[key], T.StructField("number", T.StringType()), T.StructField("start", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("left", "hit", "right")),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = schema.names, [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            keys, columns = batch.column(0), [[] for _ in names]
            at, numbers, starts, lefts, hits, rights = columns

            def flushed(keys=keys, columns=columns) -> pa.RecordBatch:
                out = [keys.take(pa.array(columns[0])), *map(pa.array, columns[1:], types)]
                for column in columns:
                    column.clear()
                return pa.RecordBatch.from_arrays(out, names=names)

            for first in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                for i, body in enumerate(batch.column(1).slice(first, _TEXTS_AT_ONCE).to_pylist(), first):
                    for number, start, end in readings(body):
                        at.append(i)
                        numbers.append(number)
                        starts.append(start)
                        lefts.append(body[max(0, start - CONTEXT) : start])
                        hits.append(body[start:end])
                        rights.append(body[end : end + CONTEXT])
                        if len(at) == _ROWS_AT_ONCE:
                            yield flushed()
            if at:
                yield flushed()

    body = F.replace(F.col(text), F.lit("\u00a0"), F.lit(" "))
    return texts.where(F.col(text).isNotNull()).select(key, body.alias("text")).mapInArrow(run, schema)
