"""Can an event be attended online? Decided from text, fees and listed formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import has, snippet_of

_RADIUS = 80
# an explicit rule counts only when "or online" does not follow it
_IN_PERSON_RULE = f"(?>{fv.ATTEND_NEGATIVE})(?!{fv.ATTEND_OR_ONLINE})"


def _evidence(source: str, says: Column, text: Column) -> Column:
    return F.struct(F.lit(source).alias("source"), says.alias("says"), text.alias("text"))


def decide(text: Column, virtual_fee: Column, formats: Column) -> Column:
    """struct<mode, evidence>; null when nothing says either way.

    ``virtual_fee`` is the label of the first fee for virtual attendance (or null),
    ``formats`` the listed formats in alphabetical order.
    """
    body = F.coalesce(text, F.lit(""))
    formats = F.coalesce(formats, F.array().cast("array<string>"))
    neg, full, pos = (
        has(body, p) for p in (_IN_PERSON_RULE, fv.ATTEND_FULLY_ONLINE, fv.ATTEND_POSITIVE)
    )
    paid = virtual_fee.isNotNull()
    listed = lambda f: F.array_contains(formats, f)
    mode = (
        F.when(neg, fv.IN_PERSON)
        .when(full | (listed("virtual") & ~paid & ~pos), fv.ONLINE_ONLY)
        .when(paid | pos | listed("hybrid") | listed("virtual"), fv.ONLINE_OPTION)
        .when(listed("inperson"), fv.IN_PERSON)
    )
    page = lambda says, p: _evidence("page", F.lit(says), snippet_of(body, p, _RADIUS))
    heard = F.concat(
        F.array(F.when(paid, _evidence("fee", F.lit("online"), virtual_fee))),
        F.transform(
            formats,
            lambda f: _evidence("ieee", f, F.concat(F.lit("IEEE lists the format as "), f)),
        ),
        F.array(
            F.when(full, page("online only", fv.ATTEND_FULLY_ONLINE)),
            F.when(pos, page("online", fv.ATTEND_POSITIVE)),
        ),
    )
    evidence = F.when(neg, F.array(page("in person", _IN_PERSON_RULE))).otherwise(
        F.slice(F.array_compact(heard), 1, 4)
    )
    return F.when(mode.isNotNull(), F.struct(mode.alias("mode"), evidence.alias("evidence")))
