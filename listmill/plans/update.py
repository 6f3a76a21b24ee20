"""The whole chain over stored tables, one step after the other."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.config import EngineConfig
from listmill.engine import cut
from listmill.functions.places import in_scope, with_country
from listmill.functions.urls import organizer_flag
from listmill.operators.history import editions, history_records
from listmill.operators.incremental import upsert
from listmill.plans import consolidate, marts, reading
from listmill.sources.extractors import listing_id


@dataclass
class Tables:
    entities: DataFrame
    listings: DataFrame
    fees: DataFrame
    rates: DataFrame


def collect(tables: Tables, incoming: DataFrame) -> Tables:
    """Folds newly extracted rows into the listings. ``incoming`` has seen_at."""
    old = tables.listings
    state = ["id", "in_window", "is_topic", "topic_reason", "entity_id"]
    known = old.select("source", "source_id", *state)
    fresh = incoming.drop(*state, "first_seen_at", "last_seen_at")
    merged = upsert(old.drop(*state), fresh, ["source", "source_id"])
    joined = merged.join(known, ["source", "source_id"], "left").withColumn(
        "id", F.coalesce("id", listing_id(F.col("source"), F.col("source_id")))
    )
    return Tables(tables.entities, cut(joined.select(*old.columns)), tables.fees, tables.rates)


def consolidate_tables(tables: Tables, config: EngineConfig, answers: DataFrame | None = None) -> Tables:
    listings = cut(consolidate.filter_listings(tables.listings, config, answers))
    entities, listings, fees = consolidate.merge_listings(tables.entities, listings, tables.fees)
    entities, listings, fees = cut(entities), cut(listings), cut(fees)
    entities, listings, fees, _ = consolidate.dedupe(entities, listings, fees)
    return Tables(cut(entities), cut(listings), cut(fees), tables.rates)


def read_tables(tables: Tables, reads: DataFrame) -> Tables:
    entities, fees = reading.apply_reads(tables.entities, tables.fees, tables.listings, reads)
    return Tables(cut(entities), tables.listings, cut(fees), tables.rates)


def check_history(
    entities: DataFrame, items: DataFrame, continent: str | None = "Asia", only_unchecked: bool = False
) -> DataFrame:
    """Entities with their publication history. Flagged organizers are not checked: their names
    copy real series, so their record is emptied."""
    scoped = with_country(entities, "country")
    chosen = F.lit(True) if continent is None else in_scope(F.col("continent"), [continent])
    if only_unchecked:
        chosen = chosen & F.col("history").isNull()
    flagged = organizer_flag(F.col("homepage")).isNotNull()
    work = scoped.where(chosen & ~flagged).select("id", "name", "acronym", "start_date")
    asked = work.join(items.select("id").distinct(), "id", "left_semi")
    records = history_records(asked, editions(asked, items)).select("id", F.col("history").alias("_new"))
    return (
        scoped.withColumn("_empty", chosen & flagged)
        .join(records, "id", "left")
        .withColumn(
            "history",
            F.when(~F.coalesce("_empty", F.lit(False)), F.coalesce("_new", "history")),
        )
        .select(*entities.columns)
    )


@dataclass
class Outcome:
    """How an optional step ended."""

    step: str
    status: str  # done | failed
    error: str | None = None


def run_update(
    tables: Tables, config: EngineConfig, incoming: DataFrame | None = None,
    reads: DataFrame | None = None, items: DataFrame | None = None, outcomes: list[Outcome] | None = None,
) -> tuple[Tables, dict[str, DataFrame]]:
    """Collect, filter, merge, dedupe, apply reads, history, publish. Steps without input are
    left out.

    Collecting, reading and history stand for themselves: one that fails leaves the tables as they were
    and a record in ``outcomes``, and the chain goes on. A failure in the other steps ends it.
    """
    outcomes = [] if outcomes is None else outcomes

    def optional(step: str, work: Callable[[], Tables]) -> Tables:
        try:
            result = work()
        except Exception as e:  # the record says what happened
            outcomes.append(Outcome(step, "failed", f"{type(e).__name__}: {e}"))
            return tables
        outcomes.append(Outcome(step, "done"))
        return result

    if incoming is not None:
        tables = optional("collect", lambda: collect(tables, incoming))
    tables = consolidate_tables(tables, config)
    if reads is not None:
        tables = optional("read", lambda: read_tables(tables, reads))
    if items is not None:
        checked = lambda: cut(check_history(tables.entities, items, continent=None))
        tables = optional("history", lambda: Tables(checked(), tables.listings, tables.fees, tables.rates))
    site = marts.publish(tables.entities, tables.fees, tables.listings, tables.rates, config)
    return tables, site
