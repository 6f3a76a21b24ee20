"""What kind of fee a row is, from its category, tier and notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import has


def classify(category: Column, tier: Column, notes: Column) -> Column:
    """struct<who, student, member, mode, period, local>.

    Plain column expressions: rows are classified where they are read, no shuffle to find
    the distinct texts first.
    """
    cat = F.coalesce(category, F.lit(""))
    tr = F.coalesce(tier, F.lit(""))
    text = F.concat(cat, F.lit(" "), tr, F.lit(" "), F.coalesce(notes, F.lit("")))

    who = (
        F.when(has(cat, fv.KIND_EXTRA) & ~has(cat, "registration"), "extra")
        .when(has(cat, fv.KIND_ATTENDEE) & ~has(cat, fv.KIND_PRESENTS), "attendee")
        .otherwise("author")
    )
    member = F.when(
        has(text, fv.KIND_NON_MEMBER) | has(text, fv.KIND_NON_SOCIETY), F.lit(False)
    ).when(has(text, fv.KIND_MEMBER), F.lit(True))
    virtual, onsite = has(text, fv.KIND_VIRTUAL), has(text, fv.KIND_ONSITE)
    mode = F.when(virtual & ~onsite, "virtual").when(onsite & ~virtual, "onsite")
    # the tier speaks first; the whole text only when there is no tier
    said = F.when(tr == "", text).otherwise(tr)
    period = (
        F.when(F.lower(F.trim(tr)).isin("onsite", "on-site"), "late")
        .when(has(said, fv.KIND_EARLY), "early")
        .when(has(said, fv.KIND_LATE), "late")
        .when(has(text, fv.KIND_REGULAR), "regular")
    )
    local = F.when(has(cat, fv.KIND_LOCAL), F.lit(True)).when(
        has(cat, fv.KIND_FOREIGN), F.lit(False)
    )
    return F.struct(
        who.alias("who"),
        has(cat, fv.KIND_STUDENT).alias("student"),
        member.alias("member"),
        mode.alias("mode"),
        period.alias("period"),
        local.alias("local"),
    )


def _points(value: Column, table: dict) -> Column:
    out = F.lit(table[None])
    for key, points in table.items():
        if key is not None:
            out = F.when(value == F.lit(key), points).otherwise(out)
    return out


def standard_score(kind: Column) -> Column:
    """Closeness to "regular, non-member, international author, in person"; null = unfit."""
    fits = (
        (kind["who"] == "author") & ~kind["student"] & ~F.coalesce(kind["local"], F.lit(False))
    )
    points = (
        _points(kind["member"], fv.SCORE_MEMBER)
        + _points(kind["mode"], fv.SCORE_MODE)
        + _points(kind["period"], fv.SCORE_PERIOD)
        + F.when(~F.coalesce(kind["local"], F.lit(True)), 1).otherwise(0)
    )
    return F.when(fits, points)


def student_rank(kind: Column, usd: Column) -> Column:
    """struct<not author, usd> to take the minimum of; null when the row cannot stand."""
    fits = (
        kind["student"]
        & (kind["who"] != "extra")
        & ~F.coalesce(kind["local"], F.lit(False))
        & usd.isNotNull()
    )
    return F.when(fits, F.struct((kind["who"] != "author").alias("not_author"), usd.alias("usd")))
