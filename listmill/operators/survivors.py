"""From linked listings to one row per entity, and folding duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.dates import sane_end
from listmill.operators.fees import fee_range
from listmill.functions.labels import is_counted
from listmill.operators.placement import priority

PROVENANCE = "map<string, struct<source:string, url:string>>"


def present(value: Column, dtype: str) -> Column:
    """Not null and, for texts, not empty."""
    return value.isNotNull() & (value != "") if dtype == "string" else value.isNotNull()


def filled(value: Column, dtype: str) -> Column:
    return F.nullif(value, F.lit("")) if dtype == "string" else value


def best_values(listings: DataFrame, entity: str, fields: list[str]) -> DataFrame:
    """Per entity and field the value of the highest-priority listing that has one, as
    struct<value, source, url>; ties go to the lower listing id. One aggregation."""
    types = dict(listings.dtypes)
    ranked = listings.withColumn("_rank", F.struct(priority(F.col("source")), F.col("id")))
    picks = [
        F.min_by(
            F.struct(F.col(f).alias("value"), "source", "url"),
            F.when(present(F.col(f), types[f]), F.col("_rank")),
        ).alias(f)
        for f in fields
    ]
    return ranked.groupBy(entity).agg(*picks)


def apply_listings(entities: DataFrame, listings: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Entities with every field taken from their listings, provenance alongside.

    Values read from the homepage stay, and so does a value no listing has any more.
    """
    fields = fields or fv.MERGE_FIELDS
    best = best_values(listings.where("entity_id is not null"), "entity_id", fields)
    best = best.select(F.col("entity_id").alias("id"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = entities.join(best, "id", "left")
    sources = F.coalesce("field_sources", F.create_map().cast(PROVENANCE))

    def taken(f):
        at = F.try_element_at(sources, F.lit(f))
        return F.col(f"_{f}.value").isNotNull() & ~F.coalesce(at["source"] == "homepage", F.lit(False))

    news = F.array_compact(
        F.array(
            *[
                F.when(
                    taken(f), F.struct(F.lit(f).alias("f"), F.struct(f"_{f}.source", f"_{f}.url").alias("v"))
                )
                for f in fields
            ]
        )
    )
    changed = F.transform(news, lambda n: n["f"])
    provenance = F.map_concat(
        F.map_filter(sources, lambda k, v: ~F.array_contains(changed, k)), F.map_from_entries(news)
    )
    out = joined.select(
        *[
            F.when(taken(c), F.col(f"_{c}.value")).otherwise(F.col(c)).alias(c)
            if c in fields
            else provenance.cast(PROVENANCE).alias(c)
            if c == "field_sources"
            else F.col(c)
            for c in entities.columns
        ]
    )
    if {"start_date", "end_date"} <= set(fields):
        out = out.withColumn("end_date", sane_end(F.col("start_date"), F.col("end_date")))
    return out


def homepage_fields(sources: Column) -> Column:
    return F.coalesce(
        F.size(F.map_filter(sources, lambda k, v: v["source"] == "homepage")), F.lit(0)
    )


def keep_and_drop(pairs: DataFrame, entities: DataFrame, listings: DataFrame) -> DataFrame:
    """(keep, drop) of duplicate pairs: the one with fees, then more homepage fields, then more
    listings, then the lower id stays."""
    counts = listings.groupBy(F.col("entity_id").alias("id")).agg(F.count("*").alias("n"))
    weight = F.struct(
        F.col("fee_min").isNotNull().alias("fees"),
        homepage_fields(F.col("field_sources")).alias("home"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (-F.col("id")).alias("low"),
    )
    weights = entities.join(counts, "id", "left").select("id", weight.alias("w"))
    a = weights.select(F.col("id").alias("a"), F.col("w").alias("wa"))
    b = weights.select(F.col("id").alias("b"), F.col("w").alias("wb"))
    first = F.col("wa") >= F.col("wb")
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .select(
            F.when(first, F.col("a")).otherwise(F.col("b")).alias("keep"),
            F.when(first, F.col("b")).otherwise(F.col("a")).alias("drop"),
        )
    )


def fold(
    entities: DataFrame, listings: DataFrame, fees: DataFrame, chosen: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Folds each ``drop`` into its ``keep``: missing fields, listings, and fees when the keeper
    has none that count. Returns the new entities, listings and fees."""
    types = dict(entities.dtypes)
    fields = [f for f in [*fv.MERGE_FIELDS, "registration_url"] if f in types]
    gone = entities.join(chosen.select(F.col("drop").alias("id")), "id", "left_semi")
    donor = gone.join(chosen, gone["id"] == chosen["drop"]).select(
        F.col("keep").alias("id"), *[F.col(c).alias(f"_{c}") for c in entities.columns if c != "id"]
    )
    stay = entities.join(chosen.select(F.col("drop").alias("id")), "id", "left_anti")
    joined = stay.join(donor, "id", "left")
    sources = F.coalesce("field_sources", F.create_map().cast(PROVENANCE))
    theirs = F.coalesce("_field_sources", F.create_map().cast(PROVENANCE))
    lacking = F.array_compact(
        F.array(
            *[
                F.when(
                    ~present(F.col(f), types[f]) & present(F.col(f"_{f}"), types[f]), F.lit(f)
                )
                for f in fields
            ]
        )
    )
    given = F.map_filter(theirs, lambda k, v: F.array_contains(lacking, k))
    provenance = F.map_concat(
        F.map_filter(sources, lambda k, v: ~F.map_contains_key(given, k)), given
    )
    moves = F.col("fee_min").isNull() & F.col("_fee_min").isNotNull()
    new = {f: F.coalesce(filled(F.col(f), types[f]), F.col(f"_{f}"), F.col(f)) for f in fields}
    new["field_sources"] = provenance
    new["enriched_at"] = F.greatest("enriched_at", "_enriched_at")
    for f in ("status", "review_note", "fee_min", "fee_max", "currency"):
        new[f] = F.when(moves, F.col(f"_{f}")).otherwise(F.col(f))
    folded = joined.select(*[new.get(c, F.col(c)).alias(c) for c in entities.columns])

    moved = chosen.select(F.col("drop").alias("entity_id"), F.col("keep").alias("_keep"))
    relinked = listings.join(moved, "entity_id", "left").select(
        *[
            F.coalesce("_keep", "entity_id").alias(c) if c == "entity_id" else F.col(c)
            for c in listings.columns
        ]
    )
    takers = joined.where(moves).select(F.col("id").alias("_keep"), F.lit(True).alias("_takes"))
    fees_moved = (
        fees.join(moved, "entity_id", "left")
        .join(takers, "_keep", "left")
        .where("_keep is null or _takes")
        .select(
            *[
                F.coalesce("_keep", "entity_id").alias(c) if c == "entity_id" else F.col(c)
                for c in fees.columns
            ]
        )
    )
    return folded, relinked, fees_moved


def refresh_ranges(entities: DataFrame, fees: DataFrame) -> DataFrame:
    """Entities with fee_min, fee_max and currency recomputed from the fees that count. There is a range
    for each entity with fees, so they are never broadcast."""
    ranges = fee_range(fees.where(is_counted(F.col("check_status"))), "entity_id")
    ranges = ranges.withColumnRenamed("entity_id", "id").hint("merge")
    return entities.drop("fee_min", "fee_max", "currency").join(ranges, "id", "left").select(
        *entities.columns
    )
