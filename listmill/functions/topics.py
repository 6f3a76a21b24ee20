"""Topic verdict from keywords."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill.functions.regex import ANY_CASE, bind, blank_to_null


def _hit(text: Column, low: Column, pattern: str) -> Column:
    """Whether a keyword occurs. Most keywords are plain substrings once a trailing ``\\w*``
    (which also matches nothing) is dropped, so they need no regular expression; the others
    run theirs only on texts that hold the keyword's longest plain part."""
    plain = re.sub(r"\\w\*$", "", pattern)
    if re.fullmatch(r"[a-z ]+", plain):
        return low.contains(plain)
    core = max(re.findall(r"[a-z]+", re.sub(r"\\[bw]\*?|\(.*?\)", " ", pattern)), key=len)
    return low.contains(core) & text.rlike(ANY_CASE + pattern)


def keyword_hits(text: Column, patterns: list[str]) -> Column:
    """The keywords that occur, in alphabetical order."""
    both = F.struct(text.alias("text"), F.lower(text).alias("low"))
    return bind(
        both,
        lambda t: F.array_compact(
            F.array(*[F.when(_hit(t["text"], t["low"], p), F.lit(p)) for p in sorted(patterns)])
        ),
    )


def verdict(positive: Column, negative: Column) -> Column:
    """struct<is_topic, reason> from the two keyword arrays; null verdict = undecided."""
    np, nn = F.size(positive), F.size(negative)
    yes, no = np > nn, (nn > 0) & (np == 0)
    four = lambda a: F.array_join(F.slice(a, 1, 4), ", ")
    return F.struct(
        F.when(yes, F.lit(True)).when(no, F.lit(False)).alias("is_topic"),
        F.when(yes, F.concat(F.lit("keywords: "), four(positive)))
        .when(no, F.concat(F.lit("non-CS keywords: "), four(negative)))
        .otherwise(
            F.concat(
                F.lit("ambiguous (pos="), np.cast("string"), F.lit(", neg="), nn.cast("string"), F.lit(")")
            )
        )
        .alias("reason"),
    )


def topic_text(acronym: Column, name: Column, categories: Column, description: Column) -> Column:
    """What the verdict reads of a listing: the non-empty parts, whole."""
    return F.concat_ws(
        " ",
        blank_to_null(acronym),
        blank_to_null(name),
        blank_to_null(F.array_join(categories, " ")),
        blank_to_null(description),
    )
