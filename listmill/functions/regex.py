"""Regex helpers shared by the text rules.

Patterns are written once in ``fixed_values``. ``(?U)`` makes Java's classes and word
boundaries Unicode-aware, which the fixed patterns expect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_CASE = "(?iU)"
CASED = "(?U)"


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def present(value: Column) -> Column:
    """A generator: rows whose ``value`` is null vanish. A filter on a computed column would compute
    the column twice, once below it and once above."""
    return F.explode(F.array_compact(F.array(value)))


def has(text: Column, pattern: str) -> Column:
    """Whether a pattern occurs, in any case. Patterns without classes and boundaries do not need
    the dearer Unicode classes."""
    return text.rlike((ANY_CASE if "\\" in pattern else "(?iu)") + pattern)


def first_match(text: Column, pattern: str, group: int = 0, flags: str = ANY_CASE) -> Column:
    """The first match (or group), null when there is none."""
    return F.nullif(F.regexp_extract(text, flags + pattern, group), F.lit(""))


def squash(text: Column) -> Column:
    """Trimmed text with every run of white space as one blank."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def snippet_of(text: Column, pattern: str, radius: int, flags: str = ANY_CASE) -> Column:
    """White-space-collapsed surroundings of the first match, null when there is none."""
    lead = F.regexp_extract(text, f"{flags}(?s)^(.*?)(?:{pattern})", 1)
    hit = F.regexp_extract(text, flags + f"(?:{pattern})", 0)
    start = F.greatest(F.length(lead) - radius, F.lit(0))
    size = F.length(lead) - start + F.length(hit) + radius
    return F.when(text.rlike(flags + f"(?:{pattern})"), squash(F.substring(text, start + 1, size)))
