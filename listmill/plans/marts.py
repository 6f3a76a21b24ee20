"""Derived values, publishing, export, search and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.config import EngineConfig
from listmill.engine import cut
from listmill.functions.dates import monday
from listmill.functions.labels import fee_status, history_label, history_years, is_counted
from listmill.functions.money import converted_by_map, headline_text
from listmill.functions.places import UNKNOWN, in_scope, with_country
from listmill.functions.urls import organizer_flag, without_person
from listmill.operators.fees import headlines, with_kinds
from listmill.operators.predicates import DateRange, is_exactly, matches_text, paged, undated_or_in_window
from listmill.operators.privacy import account_details, scrub_table
from listmill.sources.rates import with_rates

HEADLINE = ["amount", "currency", "category", "tier", "amount_usd", "amount_php"]


def source_name(source: Column) -> Column:
    out = source
    for code, name in fv.SOURCE_NAMES.items():
        out = F.when(source == code, name).otherwise(out)
    return out


def valued_fees(fees: DataFrame, rates: DataFrame) -> DataFrame:
    """Fees with their kind and both conversions."""
    value = lambda to: converted_by_map(F.col("amount"), F.col("currency"), F.col("rates"), to)
    valued = with_rates(fees, rates).withColumns({"amount_usd": value("USD"), "amount_php": value("PHP")})
    return with_kinds(valued.drop("rates"))


def with_derived(entities: DataFrame, fees: DataFrame, listings: DataFrame, rates: DataFrame) -> DataFrame:
    """Entities with every value that is worked out on read: continent, flag, attendance and
    history labels, converted ranges, headline fees, sources.

    Children are aggregated before the join, so nothing fans out.
    """
    valued = valued_fees(fees, rates).where(is_counted(F.col("check_status")))
    heads = headlines(valued, "entity_id", F.col("kind"), F.col("amount_usd"), "id", HEADLINE)
    sources = listings.where("entity_id is not null").groupBy("entity_id").agg(
        F.array_sort(F.collect_set("source")).alias("sources")
    )
    money = lambda side, to: converted_by_map(
        F.col(f"fee_{side}"), F.col("currency"), F.col("rates"), to
    ).alias(f"fee_{side}_{to.lower()}")
    base = with_rates(with_country(entities, "country"), rates)
    return (
        base.join(heads.withColumnRenamed("entity_id", "id"), "id", "left")
        .join(sources.withColumnRenamed("entity_id", "id"), "id", "left")
        .select(
            *entities.columns,
            "continent",
            organizer_flag(F.col("homepage")).alias("organizer_flag"),
            F.col("attendance.mode").alias("online"),
            history_label(F.col("history")).alias("history_label"),
            history_years(F.col("history")).alias("history_years"),
            money("min", "USD"), money("max", "USD"), money("min", "PHP"), money("max", "PHP"),
            F.col("standard").alias("standard_fee"),
            F.col("student").alias("student_fee"),
            F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
        )
    )


def _weeks(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """(week): every Monday week of the window."""
    days = F.sequence(monday(F.lit(config.window_start)), F.lit(config.window_end), F.expr("interval 7 days"))
    return spark.range(1).select(F.explode(days).alias("week"))


def week_totals(entities: DataFrame, config: EngineConfig, start: str, flagged: Column) -> DataFrame:
    """(week, total) for every Monday week of the window, empty ones too; flagged entities left out."""
    rows = entities.where(~flagged & F.col(start).isNotNull()).groupBy(monday(F.col(start)).alias("week")).agg(F.count("*").alias("total"))
    return _weeks(entities.sparkSession, config).join(rows, "week", "left").select("week", F.coalesce("total", F.lit(0)).alias("total"))


def week_amounts(entities: DataFrame, config: EngineConfig, id: str, start: str, usd: str, php: str, flagged: Column) -> DataFrame:
    """(week, start, id, usd, php): the amounts behind ``week_summary``, a row each, so that a week may hold
    any number of them; nothing is shuffled. Entities with neither amount are left out."""
    first, last = F.to_date(monday(F.lit(config.window_start))), F.date_add(F.to_date(monday(F.lit(config.window_end))), 6)
    inside = F.col(start).between(first, last) & ~flagged & (F.col(usd).isNotNull() | F.col(php).isNotNull())
    return entities.where(inside).select(
        monday(F.col(start)).alias("week"), F.col(start).alias("start"), F.col(id).alias("id"),
        F.bround(usd).cast("bigint").alias("usd"), F.bround(php).cast("bigint").alias("php"),
    )


def week_summary(
    entities: DataFrame, config: EngineConfig, id: str, start: str, usd: str, php: str, flagged: Column
) -> DataFrame:
    """(week, total, fees_usd, fees_php) for every Monday week of the window, empty ones too;
    fees rounded, in order of start and id, flagged entities left out."""
    rows = entities.where(~flagged & F.col(start).isNotNull()).select(
        monday(F.col(start)).alias("week"),
        F.struct(F.col(start).alias("s"), F.col(id).alias("i"), F.bround(usd).cast("bigint").alias("usd"),
                 F.bround(php).cast("bigint").alias("php")).alias("r"),
    )
    listed = rows.groupBy("week").agg(
        F.count("*").alias("total"), F.array_sort(F.collect_list("r")).alias("rows")
    )
    amounts = lambda f: F.filter(
        F.transform(F.coalesce("rows", F.array().cast("array<struct<s:date,i:bigint,usd:bigint,php:bigint>>")),
                    lambda r: r[f]), lambda v: v.isNotNull()
    )
    return _weeks(entities.sparkSession, config).join(listed, "week", "left").select(
        "week",
        F.coalesce("total", F.lit(0)).alias("total"),
        amounts("usd").alias("fees_usd"),
        amounts("php").alias("fees_php"),
    )


def published_entities(derived: DataFrame, listings: DataFrame, config: EngineConfig) -> DataFrame:
    """The public columns of entities in scope that start inside the window (or undated)."""
    link = F.struct(
        source_name(F.col("source")).alias("source"),
        F.when(F.col("source") != "edas", F.col("url")).alias("url"),
    )
    links = (
        listings.where("entity_id is not null and (source = 'edas' or coalesce(url, '') <> '')")
        .groupBy(F.col("entity_id").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("n"), link.alias("l")))).alias("ls"))
        .select("id", F.transform("ls", lambda x: x["l"]).alias("source_links"))
    )
    kept = derived.where(
        in_scope(F.col("continent"), config.public_continents)
        & undated_or_in_window(F.col("start_date"), config.window_start, config.window_end)
    ).join(links, "id", "left")
    return kept.select(
        "id", "acronym", "name", "start_date", "end_date", "city", "country",
        F.coalesce("continent", F.lit(UNKNOWN)).alias("continent"),
        "description", "abstract_deadline", "paper_deadline", "notification_date",
        "camera_ready_deadline", "registration_deadline", "homepage",
        without_person(F.col("registration_url")).alias("registration_url"),
        "fee_min", "fee_max", "currency", "fee_min_usd", "fee_max_usd", "fee_min_php", "fee_max_php",
        "standard_fee", "student_fee",
        F.col("standard_fee.amount_usd").alias("standard_fee_usd"),
        fee_status(F.col("status"), F.col("review_note")).alias("fee_status"),
        "online",
        F.when(
            F.col("attendance").isNotNull(),
            F.struct("attendance.mode", "attendance.evidence"),
        ).alias("attendance"),
        "history_label", "history_years",
        F.when(
            F.col("history").isNotNull(),
            F.struct("history.has_history", "history.editions", "history.publishers", "history.note"),
        ).alias("history"),
        "organizer_flag",
        F.array_sort(F.array_distinct(F.transform("sources", source_name))).alias("sources"),
        F.coalesce("source_links", F.array().cast("array<struct<source:string,url:string>>")).alias("source_links"),
    )


def published_fees(fees: DataFrame, shown: DataFrame, rates: DataFrame) -> DataFrame:
    """The public columns of counted fees of shown entities."""
    valued = valued_fees(fees.where(is_counted(F.col("check_status"))), rates)
    return valued.join(shown.select(F.col("id").alias("entity_id")), "entity_id", "left_semi").select(
        "id", "entity_id", "category", "tier", "amount", "currency", "amount_usd", "amount_php",
        "notes", source_name(F.col("source")).alias("source"),
        without_person(F.col("source_url")).alias("source_url"), "kind",
    )


def publish(
    entities: DataFrame, fees: DataFrame, listings: DataFrame, rates: DataFrame, config: EngineConfig
) -> dict[str, DataFrame]:
    """{"entities", "fees", "meta", "weeks"}: scrubbed marts. Metadata counts leave flagged
    organizers out."""
    derived = with_derived(entities, fees, listings, rates)
    shown = cut(published_entities(derived, listings, config))
    shown_fees = cut(published_fees(fees, shown, rates))
    edas = listings.where("source = 'edas' and extra is not null").select(
        F.explode(F.map_values(F.from_json("extra", "map<string,string>"))).alias("text")
    )
    details = cut(account_details(edas, "text"))
    flagged = F.col("organizer_flag").isNotNull()
    meta = shown.agg(
        F.count_if(~flagged).alias("entities"),
        F.count_if(F.col("fee_min").isNotNull() & ~flagged).alias("entities_with_fees"),
        F.count_if(flagged).alias("entities_flagged"),
    ).withColumns(
        {
            "window_start": F.lit(config.window_start),
            "window_end": F.lit(config.window_end),
            "continents": F.array(*[F.lit(c) for c in config.public_continents]),
        }
    )
    main = shown.withColumns(
        {
            "_usd": F.when(F.col("standard_fee").isNotNull(), F.col("standard_fee.amount_usd")).otherwise(F.col("fee_min_usd")),
            "_php": F.when(F.col("standard_fee").isNotNull(), F.col("standard_fee.amount_php")).otherwise(F.col("fee_min_php")),
        }
    )
    weeks = week_summary(main, config, "id", "start_date", "_usd", "_php", flagged)
    return {
        "entities": cut(scrub_table(shown, ["id"], details)),
        "fees": cut(scrub_table(shown_fees, ["id"], details)),
        "meta": meta,
        "weeks": weeks,
    }


def export_rows(
    entities: DataFrame, fees: DataFrame, listings: DataFrame, rates: DataFrame,
    continents: list[str] | None = None, source: str | None = None, dates: DateRange | None = None,
) -> DataFrame:
    """One flat row per entity in the fixed column order, by start date and acronym."""
    derived = with_derived(entities, fees, listings, rates)
    if continents is not None:
        derived = derived.where(in_scope(F.col("continent"), continents))
    if source is not None:
        owners = listings.where(F.col("source") == source).select(F.col("entity_id").alias("id"))
        derived = derived.join(owners, "id", "left_semi")
    if dates is not None:
        derived = derived.where(dates.conditions(F.col("start_date"), F.col("abstract_deadline")))
    fee = F.struct(
        "category", "tier", "amount", "currency", "amount_usd", "amount_php",
        F.col("check_status").alias("check"),
    )
    breakdown = (
        valued_fees(fees, rates)
        .groupBy(F.col("entity_id").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("n"), fee.alias("f")))).alias("fs"))
        .select("id", F.transform("fs", lambda x: x["f"]).alias("all_fees"))
    )
    places = (
        listings.where("entity_id is not null")
        .groupBy(F.col("entity_id").alias("id"))
        .agg(
            F.array_join(
                F.array_sort(F.collect_set(F.concat("source", F.lit(":"), F.coalesce("url", F.lit("None"))))), ", "
            ).alias("places")
        )
    )
    joined = derived.join(breakdown, "id", "left").join(places, "id", "left")
    text = lambda c: F.when(
        F.col(c).isNotNull(),
        headline_text(F.col(f"{c}.amount"), F.col(f"{c}.currency"), F.col(f"{c}.category")),
    )
    special = {
        "standard_fee": text("standard_fee"),
        "student_fee": text("student_fee"),
        **{
            f"{c}_{to}": F.col(f"{c}.amount_{to}")
            for c in ("standard_fee", "student_fee")
            for to in ("usd", "php")
        },
        "history_years": F.array_join(F.transform("history_years", lambda y: y.cast("string")), ", "),
        "fee_breakdown": F.to_json(
            F.coalesce("all_fees", F.array().cast(dict(breakdown.dtypes)["all_fees"])),
            {"ignoreNullFields": "false"},
        ),
        "sources": F.coalesce("places", F.lit("")),
        "field_sources": F.coalesce(F.to_json("field_sources"), F.lit("{}")),
    }
    return joined.orderBy(F.col("start_date").asc_nulls_first(), F.col("acronym").asc_nulls_first()).select(
        *[special.get(c, F.col(c)).alias(c) for c in fv.EXPORT_COLUMNS]
    )


def search_entities(
    entities: DataFrame, listings: DataFrame, *, status: str | None = None, has_fees: bool | None = None,
    continent: str | None = None, source: str | None = None, dates: DateRange | None = None,
    limit: int = 100, offset: int = 0, drop: tuple[str, ...] = (),
) -> DataFrame:
    """Filtered entities in order of start and id. The continent filter runs before the limit."""
    out = entities
    if dates is not None:
        out = out.where(dates.conditions(F.col("start_date"), F.col("abstract_deadline")))
    if status is not None:
        out = out.where(F.col("status") == status)
    if has_fees is not None:
        out = out.where(F.col("fee_min").isNotNull() == F.lit(has_fees))
    if source is not None:
        owners = listings.where(F.col("source") == source).select(F.col("entity_id").alias("id"))
        out = out.join(owners, "id", "left_semi")
    if continent is not None:
        out = with_country(out, "country").where(in_scope(F.col("continent"), [continent])).select(*entities.columns)
    order = [F.col("start_date").asc_nulls_first(), F.col("id")]
    return paged(out, order, limit, offset).drop(*drop)


def search_listings(
    listings: DataFrame, *, source: str | None = None, in_window: bool | None = None,
    is_topic: bool | None = None, q: str | None = None, limit: int = 50, offset: int = 0,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    out = listings.where(is_exactly(F.col("in_window"), in_window) & is_exactly(F.col("is_topic"), is_topic))
    if source is not None:
        out = out.where(F.col("source") == source)
    if q:
        out = out.where(matches_text(q, F.col("name"), F.col("acronym")))
    return paged(out, [F.col("start_date").asc_nulls_first(), F.col("id")], limit, offset).drop(*drop)


def nested(entities: DataFrame, fees: DataFrame, listings: DataFrame, ident: int | None = None) -> DataFrame:
    """Entities with their fees and listings as arrays in id order; optionally one of them."""
    if ident is not None:
        entities, fees, listings = (
            entities.where(F.col("id") == ident),
            fees.where(F.col("entity_id") == ident),
            listings.where(F.col("entity_id") == ident),
        )
    out = entities
    for name, child in (("fees", fees), ("listings", listings)):
        rest = [c for c in child.columns if c not in ("entity_id", "id")]
        rows = child.where("entity_id is not null").groupBy(F.col("entity_id").alias("_e")).agg(
            F.array_sort(F.collect_list(F.struct("id", F.struct(*rest).alias("row")))).alias(name)
        )
        out = out.join(rows, F.col("id") == F.col("_e"), "left").drop("_e")
    return out


def summary(entities: DataFrame, listings: DataFrame, config: EngineConfig) -> DataFrame:
    """(section, item, n): every count of the overview in one table.

    Each table is read once. Entities are counted by status, country and whether they have a fee,
    listings by source and entity; those rows are all that the sections are summed from.
    """
    one = lambda section, item, n: F.struct(
        F.lit(section).alias("section"), item.cast("string").alias("item"), n.cast("bigint").alias("n")
    )
    n = F.col("n")
    # n if the condition holds, 0 else: a count of nothing is a row as well
    those = lambda condition, count: F.when(condition, count).otherwise(0)

    counted = entities.groupBy("status", "country", F.col("fee_min").isNotNull().alias("has_fee")).agg(F.count("*").alias("n"))
    placed = with_country(counted, "country").withColumn("continent", F.coalesce("continent", F.lit(UNKNOWN)))
    in_area = F.col("continent").isin(*config.scope_continents)
    of_entities = F.array(
        one("entities_by_status", F.col("status"), n),
        one("entities_by_continent", F.col("continent"), n),
        one("scope", F.lit("entities"), those(in_area, n)),
        one("scope", F.lit("entities_with_fees"), those(in_area & F.col("has_fee"), n)),
        one("entities_with_fees", F.lit("all"), those(F.col("has_fee"), n)),
    )
    linked = listings.groupBy("source", "entity_id").agg(
        F.count("*").alias("n"),
        F.count_if("in_window").alias("inside"),
        F.count_if(F.col("in_window") & F.col("is_topic")).alias("on_topic"),
    )
    of_listings = F.array_compact(F.array(
        one("listings_by_source", F.col("source"), n),
        F.when(F.col("entity_id").isNotNull(), one("entities_by_source", F.col("source"), F.lit(1))),
        one("listings", F.lit("in_window"), F.col("inside")),
        one("listings", F.lit("in_window_topic"), F.col("on_topic")),
    ))
    always = entities.sparkSession.createDataFrame(
        [("scope", "entities", 0), ("scope", "entities_with_fees", 0), ("entities_with_fees", "all", 0), ("listings", "in_window", 0), ("listings", "in_window_topic", 0)],
        "section string, item string, n bigint",
    )
    rows = always.unionByName(placed.select(F.inline(of_entities))).unionByName(linked.select(F.inline(of_listings)))
    return rows.groupBy("section", "item").agg(F.sum("n").alias("n"))
