"""Dates as sources write them. Formats beyond the listed shapes give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.money import literal_map
from listmill.functions.regex import bind, squash

_DAY = r"(\d{1,2})"
_SUFFIXED_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_YEAR = r"(\d{4})"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
_CLOCK = r"(?:,?\s+(?:at\s+)?\d{1,2}:\d{2}.*)?"

# a single date: pattern, then which group holds year, month word or number, day
_WORD_SHAPES = [
    (rf"{_WEEKDAY}{fv.MONTH_WORD}\s+{_SUFFIXED_DAY},?\s+{_YEAR}{_CLOCK}", 3, 1, 2),
    (rf"{_WEEKDAY}{_SUFFIXED_DAY}(?:\s+of)?[\s-]+{fv.MONTH_WORD},?[\s-]+{_YEAR}{_CLOCK}", 3, 2, 1),
    (rf"{_YEAR}[\s-]+{fv.MONTH_WORD}[\s-]+{_SUFFIXED_DAY}", 1, 2, 3),
]
_NUMBER_SHAPES = [
    (rf"{_DAY}/{_DAY}/{_YEAR}{_CLOCK}", 3, 1, 2),
    (rf"{_YEAR}/{_DAY}/{_DAY}{_CLOCK}", 1, 2, 3),
]

# ranges: pattern, then (year, month, day) groups of the start and of the end
_M, _D, _S = fv.MONTH_WORD, _DAY, fv.DATE_DASH
_RANGES = [
    (rf"{_M}\s+{_D}{_S}{_M}\s+{_D},?\s+{_YEAR}", (5, 1, 2), (5, 3, 4)),
    (rf"{_D}\s+{_M}{_S}{_D}\s+{_M},?\s+{_YEAR}", (5, 2, 1), (5, 4, 3)),
    (rf"{_M}\s+{_D}{_S}{_D},?\s+{_YEAR}", (4, 1, 2), (4, 1, 3)),
    (rf"{_D}{_S}{_D}\s+{_M},?\s+{_YEAR}", (4, 3, 1), (4, 3, 2)),
]


def month_number(word: Column) -> Column:
    """1..12 from the first three letters, null for any other word."""
    return F.try_element_at(literal_map(fv.MONTHS), F.substring(F.lower(word), 1, 3))


def build_date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day)
    return text.try_cast("date")


def no_date(text: Column) -> Column:
    return (text == "") | F.upper(text).isin(fv.NO_DATE)


def _word_date(text: Column, pattern: str, y: int, m: int, d: int, shift: int = 0) -> Column:
    g = lambda i: F.regexp_extract(text, pattern, i)
    year = g(y) if shift == 0 else (g(y).try_cast("int") + shift).cast("string")
    return build_date(year, month_number(g(m)), g(d))


def parse_date(raw: Column) -> Column:
    """One date. Bracketed text (an original, pre-extension deadline) is ignored."""
    return bind(squash(F.regexp_replace(raw, r"\(.*?\)", "")), _one_date)


def _one_date(text: Column) -> Column:
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10).try_cast("date"))
    choices = [iso]
    for shape, y, m, d in _WORD_SHAPES:
        anchored = f"(?i)^{shape}$"
        parts = F.split(F.regexp_replace(text, anchored, f"${y}|${m}|${d}"), r"\|")
        named = bind(parts, lambda p: build_date(F.get(p, 0), month_number(F.get(p, 1)), F.get(p, 2)))
        choices.append(F.when(text.rlike(anchored), named))
    for shape, y, m, d in _NUMBER_SHAPES:
        anchored = f"(?i)^{shape}$"
        g = lambda i, p=anchored: F.regexp_extract(text, p, i)
        choices.append(F.when(text.rlike(anchored), build_date(g(y), g(m), g(d))))
    return F.when(~no_date(text), F.coalesce(*choices))


def parse_date_range(raw: Column) -> Column:
    """struct<start, end>. The first of the range shapes that occurs decides."""
    return bind(squash(raw), _date_span)


def _date_span(text: Column) -> Column:
    span = lambda s, e: F.struct(s.alias("start"), e.alias("end"))
    nothing = F.lit(None).cast("date")
    out = F.when(text.isNull() | no_date(text), span(nothing, nothing))
    for i, (pattern, start_at, end_at) in enumerate(_RANGES):
        start, end = _word_date(text, pattern, *start_at), _word_date(text, pattern, *end_at)
        if i == 0:  # "Dec 30 - Jan 2, 2027" starts in the year before
            start = F.when(end < start, _word_date(text, pattern, *start_at, shift=-1)).otherwise(
                start
            )
        out = out.when(text.rlike(pattern), span(start, end))
    parts = F.split(text, r"\s+(?:-|–|—|to)\s+", 2)
    left, right = parse_date(F.get(parts, F.lit(0))), parse_date(F.get(parts, F.lit(1)))
    single = parse_date(text)
    return out.when(
        (F.size(parts) == 2) & F.coalesce(left, right).isNotNull(),
        span(left, F.coalesce(right, left)),
    ).otherwise(span(single, single))


def sane_end(start: Column, end: Column) -> Column:
    """An end that can be true: last year's year is replaced by the start's, others dropped."""
    moved = F.concat(F.year(start).cast("string"), F.date_format(end, "-MM-dd")).try_cast("date")
    return F.when(start.isNull() | end.isNull() | (end >= start), end).when(
        moved.between(start, F.date_add(start, fv.SANE_END_DAYS)), moved
    )


def monday(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def epoch_ms_or_text(key: Column, text: Column) -> Column:
    """A cell's date: its millisecond sort key when it has one, else its text."""
    stamped = F.when(
        key.rlike(r"^\d{1,15}$"), F.timestamp_millis(key.try_cast("bigint")).cast("date")
    )
    return F.coalesce(stamped, parse_date(text))


def row_date(text: Column, month: Column, year: Column) -> Column:
    """"Oct 05" under a month and year header."""
    shape = r"^([A-Za-z]{3})[a-z]*\.?\s+(\d{1,2})"
    word = F.regexp_extract(F.trim(text), shape, 1)
    number = F.coalesce(month_number(word), month, F.lit(1))
    return F.when(
        F.trim(text).rlike(shape) & year.isNotNull(),
        build_date(year, number, F.regexp_extract(F.trim(text), shape, 2)),
    )


def old_edition_note(listed: Column, extracted: Column) -> Column:
    """A note when the page's start is too far from the listed one; null when it fits."""
    from listmill.fixed_values import EDITION_TOLERANCE_DAYS

    return F.when(
        F.abs(F.datediff(extracted, listed)) > EDITION_TOLERANCE_DAYS,
        F.concat(
            F.lit("homepage dates "),
            extracted.cast("string"),
            F.lit(" don't match listing "),
            listed.cast("string"),
            F.lit(" (old edition?)"),
        ),
    )


def last_round(text: Column) -> Column:
    """"(first round) ... (second round)" deadlines: the latest of them."""
    body = F.regexp_extract(squash(text), f"(?is){fv.ROUNDS}", 1)
    dates = F.regexp_extract_all(body, F.lit(f"(?i){fv.ROUND_DATE}"), F.lit(1))
    return F.array_max(F.transform(dates, parse_date))
