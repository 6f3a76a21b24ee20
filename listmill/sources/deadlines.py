"""Dated label lines ("Submission deadline: 1 May 2026") as typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.dates import last_round, parse_date
from listmill.functions.regex import present

FIELDS = [
    "abstract_deadline", "paper_deadline", "notification_date", "camera_ready_deadline",
    "registration_deadline",
]
_LABEL_LIMIT = 60


def label_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, label, value) of the lines that have a colon."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    at = F.instr("line", ":")
    return lines.where(at > 0).select(
        key,
        "line_no",
        F.lower(F.trim(F.expr("left(line, instr(line, ':') - 1)"))).alias("label"),
        F.trim(F.expr("substring(line, instr(line, ':') + 1)")).alias("value"),
    )


def _pivoted(df: DataFrame, key: str, pick) -> DataFrame:
    """One column per deadline field. The field list is fixed, so one aggregation does it."""
    return df.groupBy(key).agg(
        *[
            pick("value_date", F.when(F.col("field") == f, F.col("line_no"))).alias(f)
            for f in FIELDS
        ]
    )


def by_exact_label(lines: DataFrame, key: str, source: str) -> DataFrame:
    """Known labels only; a later line of the same field wins."""
    field = F.create_map(*[F.lit(x) for pair in fv.LABELS[source].items() for x in pair])
    return _pivoted(_dated(lines, key, F.try_element_at(field, F.col("label"))), key, F.max_by)


def _dated(lines: DataFrame, key: str, field: Column) -> DataFrame:
    """(key, line_no, field, value_date) of the lines that have both; each date is parsed once."""
    known = lines.withColumn("field", field).where("field is not null")
    return known.select(key, "line_no", "field", present(parse_date(F.col("value"))).alias("value_date"))


def rule_field(label: Column) -> Column:
    """The field of the first rule whose word the label contains."""
    out = None
    for word, field in fv.LABEL_RULES:
        hit = label.contains(word)
        out = F.when(hit, field) if out is None else out.when(hit, field)
    return out


def by_rules(lines: DataFrame, key: str) -> DataFrame:
    """Rules on the label's words; the first line of a field wins."""
    short = lines.where(
        (F.length("label") <= _LABEL_LIMIT) & ~F.col("label").startswith("conference date")
    )
    return _pivoted(_dated(short, key, rule_field(F.col("label"))), key, F.min_by)


def key_dates(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rule-based deadlines; a multi-round paper deadline fills in when no line gives one."""
    ruled = by_rules(label_lines(df, key, text), key)
    rounds = df.select(key, last_round(F.col(text)).alias("round_date"))
    return rounds.join(ruled, key, "left").select(
        key,
        *[
            F.coalesce("paper_deadline", "round_date").alias(f) if f == "paper_deadline" else f
            for f in FIELDS
        ],
    )
