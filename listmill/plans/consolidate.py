"""Filter, merge and dedupe: from listings to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.config import EngineConfig
from listmill.engine import cut
from listmill.functions.dates import sane_end
from listmill.functions.regex import bind, present
from listmill.functions.topics import keyword_hits, topic_text, verdict
from listmill.operators.duplicates import duplicate_pairs
from listmill.operators.fees import check_fees
from listmill.operators.placement import place
from listmill.operators.predicates import in_window, pending
from listmill.operators.survivors import apply_listings, fold, keep_and_drop, refresh_ranges
from listmill.schemas import ENTITIES, EXTRACTED_FEES
from listmill.sources.readers import Reader, topics


def judge_topics(df: DataFrame, text: str, answers: DataFrame | None = None, key: str = "id") -> DataFrame:
    """``df`` with ``topic`` struct<is_topic, reason>. ``answers`` (key, is_topic, reason) is a
    second opinion used only where the keywords leave the verdict open."""
    judged = df.withColumn(
        "topic",
        bind(
            F.struct(
                keyword_hits(F.col(text), fv.TOPIC_POSITIVE).alias("pos"),
                keyword_hits(F.col(text), fv.TOPIC_NEGATIVE).alias("neg"),
            ),
            lambda h: verdict(h["pos"], h["neg"]),
        ),
    )
    if answers is None:
        return judged
    second = answers.select(
        key,
        F.struct(
            F.col("is_topic"),
            F.concat(F.lit("llm: "), F.col("reason")).alias("reason"),
        ).alias("_second"),
    )
    open_ = F.col("topic.is_topic").isNull() & F.col("_second").isNotNull()
    return (
        judged.join(second, key, "left")
        .withColumn("topic", F.when(open_, F.col("_second")).otherwise(F.col("topic")))
        .drop("_second")
    )


def _texted(listings: DataFrame) -> DataFrame:
    return listings.withColumn("_text", topic_text(F.col("acronym"), F.col("name"), F.col("categories"), F.col("description")))


def second_opinions(listings: DataFrame, config: EngineConfig, read: str | Reader) -> tuple[DataFrame, DataFrame]:
    """A reader's verdicts as ``filter_listings`` takes them, and its rejects. Only listings inside the
    window whose keywords leave the verdict open are sent to the reader."""
    inside = _texted(listings.where(in_window(F.col("start_date"), config.window_start, config.window_end)))
    open_ = judge_topics(inside, "_text").where("topic.is_topic is null")
    return topics(open_.select("id", F.col("_text").alias("text"), "url"), read, "id")


def filter_listings(listings: DataFrame, config: EngineConfig, answers: DataFrame | None = None) -> DataFrame:
    """Listings with in_window and, inside the window, is_topic and topic_reason."""
    judged = judge_topics(_texted(listings), "_text", answers)
    inside = in_window(F.col("start_date"), config.window_start, config.window_end)
    return judged.select(
        *[
            inside.alias(c)
            if c == "in_window"
            else F.when(inside, F.col("topic.is_topic")).otherwise(F.col(c)).alias(c)
            if c == "is_topic"
            else F.when(inside, F.col("topic.reason")).otherwise(F.col(c)).alias(c)
            if c == "topic_reason"
            else F.col(c)
            for c in listings.columns
        ]
    )


def filter_counts(listings: DataFrame) -> DataFrame:
    """(outcome, n) of a filtered listing table."""
    window = F.when(F.col("in_window"), "in_window").otherwise("out_of_window")
    topic = (
        F.when(F.col("is_topic"), "cs").when(~F.col("is_topic"), "not_cs").otherwise("ambiguous")
    )
    outcomes = F.array_compact(F.array(window, F.when(F.col("in_window"), topic)))
    return listings.select(F.explode(outcomes).alias("outcome")).groupBy("outcome").agg(
        F.count("*").alias("n")
    )


def _extra(path: str) -> Column:
    return F.get_json_object("extra", f"$.{path}")


def given_fees(listings: DataFrame) -> DataFrame:
    """(id, entity_id, source, url, extra, fees) of the listings that bring fees. The JSON is read by a
    generator: a filter on the fees would read it a second time."""
    fees = present(F.from_json(_extra("fees"), EXTRACTED_FEES))
    mine = listings.where("entity_id is not null")
    return mine.select("id", "entity_id", "source", "url", "extra", fees.alias("fees")).where(F.size("fees") > 0)


def source_fees(listings: DataFrame) -> DataFrame:
    """Fees that came with listings (their JSON ``extra``), checked against the page text that
    came along; of two listings of one source in one entity the later one counts."""
    last = given_fees(listings).groupBy("entity_id", "source").agg(
        F.max_by(F.struct("id", "url", "fees", "extra"), "id").alias("l")
    )
    rows = cut(
        last.select("entity_id", "source", "l.*").select(
            "entity_id", "source", F.col("id").alias("listing_id"), "url", "fees",
            _extra("register_page_text").alias("text"), _extra("register_self_url").alias("page_url"),
        )
    )
    # a fee is checked against its own listing's text, and not at all without one
    texted = F.when(F.col("text") != "", F.lit(True)).alias("_checked")
    fees = rows.select(
        "entity_id", "source", "listing_id", "url", "page_url", texted, F.posexplode("fees").alias("pos", "f")
    ).select("entity_id", "source", "listing_id", "url", "page_url", "_checked", "pos", "f.*")
    texts = rows.select("listing_id", F.coalesce("text", F.lit("")).alias("text"))
    checked = check_fees(fees, texts, "listing_id", "pos")
    return checked.where(F.col("_checked").isNull() | (F.col("check.status") != "duplicate")).select(
        F.xxhash64("entity_id", "source", "pos").alias("id"),
        "entity_id",
        "category",
        "tier",
        "amount",
        "currency",
        "notes",
        "source",
        F.coalesce("page_url", "url").alias("source_url"),
        F.when(F.col("_checked"), F.col("check.status")).alias("check_status"),
        F.when(F.col("_checked"), F.col("check.note")).alias("check_note"),
        F.when(F.col("_checked"), F.col("check.evidence")).alias("evidence"),
    )


def replace_source_fees(listings: DataFrame, fees: DataFrame) -> DataFrame:
    """``fees`` where all fees of a source in an entity are those that came with its listing, if any did.
    What was given grows with the listings, so it is never broadcast."""
    given = cut(source_fees(listings))
    replaced = given.select("entity_id", "source").distinct().hint("merge")
    kept = fees.join(replaced, ["entity_id", "source"], "left_anti")
    return kept.unionByName(given)


def merge_listings(
    entities: DataFrame, listings: DataFrame, fees: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Places pending listings, then recomputes every entity from its listings and fees.

    A new entity's id is the id of the listing that founded it, so a rerun on the same input
    gives the same ids.
    """
    spark = entities.sparkSession
    homes = place(entities, pending(listings))
    taken = entities.select(F.col("id").alias("founder_id"), F.lit(True).alias("_taken"))
    fresh = F.when(
        F.col("_taken"), F.raise_error(F.lit("a founding listing's id is already an entity's id"))
    ).otherwise(F.col("founder_id"))
    homes = homes.join(taken, "founder_id", "left").select(
        "id", F.coalesce("entity_id", fresh).alias("_home"), F.col("founder_id").isNotNull().alias("_new")
    )
    homes = cut(homes)
    linked = cut(
        listings.join(homes, "id", "left").select(
            *[
                F.coalesce("entity_id", "_home").alias(c) if c == "entity_id" else F.col(c)
                for c in listings.columns
            ]
        )
    )
    founded = homes.where("_new").select(F.col("_home").alias("id")).distinct()
    blank = spark.createDataFrame([], ENTITIES)
    everyone = entities.unionByName(
        blank.unionByName(founded.withColumn("status", F.lit("collected")), allowMissingColumns=True)
    )
    filled = apply_listings(everyone, linked)
    all_fees = replace_source_fees(linked, fees)
    return refresh_ranges(filled, all_fees), linked, all_fees


def find_duplicates(entities: DataFrame, listings: DataFrame) -> DataFrame:
    """(keep, drop) pairs of one pass, without changing anything."""
    return keep_and_drop(duplicate_pairs(entities), entities, listings)


def dedupe(
    entities: DataFrame, listings: DataFrame, fees: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One pass: repairs end dates, pairs duplicates, folds them. Also returns the pairs."""
    repaired = entities.withColumn("end_date", sane_end(F.col("start_date"), F.col("end_date")))
    pairs = cut(find_duplicates(repaired, listings))
    folded, relinked, moved = fold(repaired, listings, fees, pairs)
    folded = cut(folded)
    keepers = pairs.select(F.col("keep").alias("id"))
    touched = refresh_ranges(folded.join(keepers, "id", "left_semi"), moved)
    others = folded.join(keepers, "id", "left_anti")
    return others.unionByName(touched), relinked, moved, pairs
