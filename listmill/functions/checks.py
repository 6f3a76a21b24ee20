"""Can an amount be a fee, is it really in the text it was read from, and which prices were missed?"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.money import rough_usd
from listmill.functions.regex import ANY_CASE, squash

_RADIUS = 70
_MARK_RADIUS = 30
_DATE_RADIUS = 12


def _marks(currency: Column) -> Column:
    table = F.create_map(
        *[
            x
            for code, marks in fv.CURRENCY_MARKS.items()
            for x in (F.lit(code), F.array(*[F.lit(m) for m in marks]))
        ]
    )
    return F.coalesce(F.try_element_at(table, currency), F.array(F.lower(currency)))


def result(status: str, note: Column, evidence: Column | None = None) -> Column:
    """struct<status, note, evidence>."""
    nothing = F.lit(None).cast("string")
    return F.struct(
        F.lit(status).alias("status"),
        note.alias("note"),
        (nothing if evidence is None else evidence).alias("evidence"),
    )


def implausible(amount: Column, currency: Column) -> Column:
    """The verdict on an amount that no text could save; null where the text decides."""
    usd = rough_usd(amount, currency)
    return (
        F.when(amount <= 0, result("implausible", F.lit(fv.NOTE_ZERO)))
        .when(F.coalesce(currency, F.lit("")) == "", result("implausible", F.lit(fv.NOTE_NO_CURRENCY)))
        .when(usd < fv.MIN_USD, result("implausible", _about(usd, 2, "low")))
        .when(usd > fv.MAX_USD, result("implausible", _about(usd, 0, "high")))
    )


def _about(usd: Column, decimals: int, side: str) -> Column:
    return F.concat(
        F.lit("about US$"),
        F.format_number(usd, decimals),
        F.lit(f", too {side} for a registration fee"),
    )


def _around(radius: int) -> Column:
    """The hit of an index row with ``radius`` characters on either side."""
    return F.concat(F.right("left", F.lit(radius)), "hit", F.left("right", F.lit(radius)))


def is_near(currency: Column) -> Column:
    """Whether an index row has a mark of the currency beside it."""
    return F.exists(_marks(currency), lambda m: F.lower(_around(_MARK_RADIUS)).contains(m))


def is_date_part(number: Column) -> Column:
    """Whether an index row's number can be a year and stands beside the name of a month or the like."""
    year_like = (F.length(number) == 4) & number.between("1990", "2040")
    return year_like & _around(_DATE_RADIUS).rlike(ANY_CASE + fv.DATE_NEAR_NUMBER)


def grounded(first: Column, near: Column, only_dates: Column) -> Column:
    """The verdict from the places of an amount: the first one and the first one beside its currency
    (structs of left, hit and right; null when there is none)."""
    best = F.coalesce(near, first)
    evidence = squash(F.concat(best["left"], best["hit"], best["right"]))
    return (
        F.when(first.isNull(), result("not_found", F.lit(fv.NOTE_NOT_FOUND)))
        .when(only_dates, result("implausible", F.lit(fv.NOTE_DATE), evidence))
        .otherwise(result("verified", F.when(near.isNull(), fv.NOTE_NO_MARK), evidence))
    )


_PRICE, _FEE_WORDS, _NOT_A_FEE = (re.compile(p, re.IGNORECASE) for p in (fv.PRICE, fv.FEE_WORDS, fv.NOT_A_FEE))


def _priced_places(body: str) -> Iterator[tuple[int, int]]:
    """Where a price stands that may be a fee; a line is judged once, whatever its prices."""
    line_end, allowed, said = -1, False, False
    for price in _PRICE.finditer(body):
        start, end = price.span()
        if start > line_end:
            line_start, line_end = body.rfind("\n", 0, start) + 1, body.find("\n", end)
            line_end = len(body) if line_end < 0 else line_end
            line = body[line_start:line_end]
            allowed, said = not _NOT_A_FEE.search(line), bool(_FEE_WORDS.search(line))
        if allowed and (said or _FEE_WORDS.search(body[max(0, start - 160) : end + 60])):
            yield start, end


def _snippets(body: str, most: int | None) -> list[str]:
    """One sweep from left to right. Starts and ends of the snippets never fall, so one lies inside
    another only where both are cut off at the same end of the text."""
    found: dict[str, None] = {}
    last_start, last_end = -1, -1
    for start, end in _priced_places(body):
        start, end = max(0, start - _RADIUS), min(len(body), end + _RADIUS)
        snippet = " ".join(body[start:end].split())
        if most is None:
            if start != last_start and end != last_end:
                found[snippet] = None
            last_start, last_end = start, end
        elif not any(snippet in f or f in snippet for f in found):
            found[snippet] = None
            if len(found) == most:
                break
    return list(found)


def fee_mentions(text: Column, most: int | None = None) -> Column:
    """Snippets where the text shows a price next to fee words, in order.

    A snippet whose place lies inside another's is left out, and one whose words were seen before.
    With ``most``, the first so many, none of which lies inside another's words. The work is linear
    in the text; a null text has none.
    """

    @F.pandas_udf("array<string>")
    def mentions(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _snippets(t.replace("\u00a0", " "), most) if t else [])

    return mentions(text)
