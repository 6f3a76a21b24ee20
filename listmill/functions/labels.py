"""Status and label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv


def fee_status(status: Column, note: Column) -> Column:
    """The plain-language label for where an entity's fees stand."""
    n = F.coalesce(note, F.lit(""))
    return (
        F.when(status == "enriched", "Fees found")
        .when(status == "collected", "Not read yet")
        .when(
            n.startswith(fv.NOTE_NOT_PUBLISHED) | n.startswith(fv.NOTE_FEES_NOT_FOUND),
            "No fees posted yet",
        )
        .when(n.startswith(fv.NOTE_MISSED), "Fees on the site, not read yet")
        .when(n.startswith(fv.NOTE_UNVERIFIED.rstrip(": ")), "Fees unverified")
        .when(n.startswith("no homepage"), "Website unreadable")
        .when(n.contains("don't match listing"), "Check the edition")
        .otherwise("Not read yet")
    )


def is_counted(check_status: Column) -> Column:
    """Fees that count: verified, or not checked yet."""
    return check_status.isNull() | (check_status == "verified")


def summary_note(counted: Column, missing: Column, odd: Column) -> Column:
    """"1 of 9 fees not found on the page; 2 of 9 fees implausible", null when all is well."""
    said = lambda n, what: F.when(
        n > 0,
        F.concat(n.cast("string"), F.lit(" of "), counted.cast("string"), F.lit(what)),
    )
    return F.nullif(
        F.concat_ws(
            "; ", said(missing, " fees not found on the page"), said(odd, " fees implausible")
        ),
        F.lit(""),
    )


def read_status(
    any_verified: Column, n_fees: Column, fees_published: Column, note: Column, mention: Column
) -> Column:
    """struct<status, review_note> after a page was read.

    ``note`` is the check summary, ``mention`` a price the extraction missed (or null).
    """
    missed = F.concat(
        F.lit(fv.NOTE_MISSED + ', e.g. "'), F.substring(mention, 1, 160), F.lit('"')
    )
    reason = (
        F.when(mention.isNotNull(), missed)
        .when(n_fees > 0, F.concat(F.lit(fv.NOTE_UNVERIFIED), F.coalesce(note, F.lit("see the fee checks"))))
        .when(F.coalesce(fees_published, F.lit(False)), fv.NOTE_FEES_NOT_FOUND)
        .otherwise(fv.NOTE_NOT_PUBLISHED)
    )
    return F.struct(
        F.when(any_verified, "enriched").otherwise("needs_review").alias("status"),
        F.when(any_verified, note).otherwise(reason).alias("review_note"),
    )


def history_label(history: Column) -> Column:
    return F.when(
        history.isNotNull(),
        F.when(history["has_history"], "has history").otherwise("no history found"),
    )


def history_years(history: Column) -> Column:
    return F.coalesce(
        F.transform(history["editions"], lambda e: e["year"]), F.array().cast("array<int>")
    )
