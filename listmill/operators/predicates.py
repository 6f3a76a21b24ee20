"""Filters: windows, optional ranges, three-valued flags, work selections."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.places import any_of

MAX_ROWS = 5000


def in_window(day: Column, start: dt.date, end: dt.date) -> Column:
    """Inside the window, both ends included; no date is outside, not unknown."""
    return F.coalesce(day.between(F.lit(start), F.lit(end)), F.lit(False))


def undated_or_in_window(day: Column, start: dt.date, end: dt.date) -> Column:
    return day.isNull() | day.between(F.lit(start), F.lit(end))


@dataclass(frozen=True)
class DateRange:
    """Optional bounds (included) on two date columns, and whether the second has a value."""

    starts_from: dt.date | None = None
    starts_to: dt.date | None = None
    other_from: dt.date | None = None
    other_to: dt.date | None = None
    has_other: bool | None = None

    def conditions(self, start: Column, other: Column) -> Column:
        out = F.lit(True)
        bounds = [
            (start, self.starts_from, self.starts_to),
            (other, self.other_from, self.other_to),
        ]
        for column, low, high in bounds:
            if low is not None:
                out = out & (column >= F.lit(low))
            if high is not None:
                out = out & (column <= F.lit(high))
        if self.has_other is not None:
            out = out & (other.isNotNull() if self.has_other else other.isNull())
        return out


def matches_text(query: str, *columns: Column) -> Column:
    """Case-insensitive substring in any of the columns; % and _ are plain characters."""
    escaped = query.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return any_of([F.coalesce(c.ilike(f"%{escaped}%"), F.lit(False)) for c in columns])


def is_exactly(column: Column, value: bool | None) -> Column:
    """A three-valued flag test; no value asks nothing."""
    return F.lit(True) if value is None else column.eqNullSafe(F.lit(value))


def paged(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    if not 0 <= limit <= MAX_ROWS:
        raise ValueError(f"limit must be 0 .. {MAX_ROWS}")
    return df.orderBy(*order).offset(offset).limit(limit)


def pending(df: DataFrame) -> DataFrame:
    """Listings to place: in the window, not off topic (undecided ones stay), not linked yet."""
    return df.where(
        F.col("in_window").eqNullSafe(F.lit(True))
        & ~F.col("is_topic").eqNullSafe(F.lit(False))
        & F.col("entity_id").isNull()
    )


def to_read(retry_without_fees: bool) -> Column:
    """Entities to read: never read or failed; optionally those read that ended without fees."""
    wanted = F.col("status").isin("collected", "enrich_failed")
    if retry_without_fees:
        wanted = wanted | (
            (F.col("status") == "needs_review")
            & F.col("fee_min").isNull()
            & F.col("review_note").isin(fv.NOTE_NOT_PUBLISHED, fv.NOTE_FEES_NOT_FOUND)
        )
    return wanted


def to_validate(entities: DataFrame, fees: DataFrame) -> DataFrame:
    """Entities with fees, and those whose note says that fees are missing."""
    owners = fees.select(F.col("entity_id").alias("id"), F.lit(True).alias("_has")).distinct()
    note = F.coalesce("review_note", F.lit(""))
    return (
        entities.join(owners, "id", "left")
        .where(F.col("_has") | note.startswith("fees not") | note.startswith(fv.NOTE_MISSED))
        .drop("_has")
    )


def needing_details(entities: DataFrame, listings: DataFrame, source: str) -> DataFrame:
    """Entities without a homepage that have a listing of ``source``."""
    owners = listings.where(F.col("source") == source).select(F.col("entity_id").alias("id"))
    return entities.where("homepage is null").join(owners, "id", "left_semi")


def unreadable() -> Column:
    return F.col("review_note").eqNullSafe(F.lit(fv.NOTE_UNREADABLE))


def reading_work(
    entities: DataFrame, retry_without_fees: bool = False, ids: list[int] | None = None, limit: int | None = None
) -> DataFrame:
    """Entities to read, the earliest first: those named, or those whose state asks for it."""
    chosen = F.col("id").isin(ids) if ids is not None else to_read(retry_without_fees)
    ordered = entities.where(chosen).orderBy(F.col("start_date").asc_nulls_last(), "id")
    return ordered if limit is None else ordered.limit(limit)


def details_work(entities: DataFrame, listings: DataFrame, source: str, limit: int | None = None) -> DataFrame:
    """Entities whose details ``source`` can fill in, the earliest first."""
    ordered = needing_details(entities, listings, source).orderBy(F.col("start_date").asc_nulls_last(), "id")
    return ordered if limit is None else ordered.limit(limit)


def latest_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """The runs that began last, newest first."""
    return paged(runs, [F.col("started_at").desc_nulls_last(), F.col("id").desc()], limit)
