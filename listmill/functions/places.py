"""Places: splitting a location, canonical countries and continents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv

UNKNOWN = "Unknown"


def split_location(raw: Column) -> Column:
    """struct<city, country>: first and last comma part that has a Latin letter."""
    parts = F.filter(
        F.transform(F.split(raw, ","), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")),
        lambda p: p.rlike("[A-Za-z]"),
    )
    first, last = F.get(parts, F.lit(0)), F.try_element_at(parts, F.lit(-1))
    usable = (F.size(parts) > 0) & ~F.upper(first).isin(fv.NO_DATE)
    city = F.when(
        (F.size(parts) == 1) & F.lower(first).isin("online", "virtual", "hybrid"), F.initcap(first)
    ).otherwise(first)
    return F.struct(
        F.when(usable, city).alias("city"),
        F.when(usable & (F.size(parts) > 1), last).alias("country"),
    )


def _names(text: str) -> list[str]:
    return [" ".join(n.split()) for n in text.replace("\n", " ").split(", ")]


def country_rows() -> list[tuple[str, str, str]]:
    """(spelling key, canonical country, continent) for every known spelling."""
    continent = {n.strip(): c for c, text in fv.COUNTRIES.items() for n in _names(text)}
    spelled = {name.lower(): name for name in continent}
    spelled.update({s.strip(): "United States" for s in _names(fv.UNITED_STATES_SPELLINGS)})
    for name, spellings in fv.COUNTRY_SPELLINGS.items():
        spelled.update(dict.fromkeys(spellings, name))
    return sorted((k, n, continent[n]) for k, n in spelled.items())


def country_key(raw: Column) -> Column:
    trimmed = F.regexp_replace(F.trim(raw), r"^[.,;]+|[.,;]+$", "")
    return F.lower(F.trim(F.regexp_replace(trimmed, r"(?U)\s+", " ")))


def with_country(
    df: DataFrame, column: str, canonical: str = "canonical_country", continent: str = "continent"
) -> DataFrame:
    """Adds the canonical country and its continent by a join with the fixed spelling table.

    The table is built from ``fixed_values`` (a few hundred rows whatever the data holds), so
    it is always safe to broadcast. Unknown spellings pass through and have no continent.
    """
    spark = df.sparkSession
    dim = spark.createDataFrame(country_rows(), "_key string, _canonical string, _continent string")
    joined = df.withColumn("_key", country_key(F.col(column))).join(
        F.broadcast(dim), "_key", "left"
    )
    known = F.col("_key").isNotNull() & (F.col("_key") != "")
    return joined.select(
        *df.columns,
        F.when(known, F.coalesce("_canonical", F.trim(F.col(column)))).alias(canonical),
        F.col("_continent").alias(continent),
    )


def checked_continents(names: list[str] | tuple[str, ...]) -> list[str]:
    """The given continents in their proper spelling; a name that is none is refused."""
    proper = {c.lower(): c for c in [*fv.CONTINENTS, UNKNOWN]}
    wrong = [n for n in names if n.lower() not in proper]
    if wrong:
        raise ValueError(f"unknown continent {wrong}; use one of {sorted(proper.values())}")
    return [proper[n.lower()] for n in names]


def in_scope(continent: Column, names: list[str] | tuple[str, ...]) -> Column:
    return F.coalesce(continent, F.lit(UNKNOWN)).isin(checked_continents(names))


def places_conflict(a: Column, b: Column) -> Column:
    """Both places known and different."""
    ka, kb = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (a, b))
    return (ka != "") & (kb != "") & (ka != kb)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))
