"""Placing listings: each joins the first entity it matches or founds a new one.

The rule is sequential: listings come in order, an entity founded by one can be joined by the
next. The same result is reached in rounds. A listing is a founder once no undecided listing
before it could match it; whoever is next to a founder is a member. Rounds work on one row per
(key, name, day), and equal acronyms meet in (key, day) hubs, so identical or same-acronym
listings cost no pairs however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.engine import cut
from listmill.functions.names import acronym_key, core_name, sorted_tokens
from listmill.functions.places import places_conflict
from listmill.operators.neighbours import days_around, earliest_near
from listmill.operators.similarity import similar_names

_ID_LIMIT = 1 << 58
_HUB = ["key", "day"]
_NODE = ["key", "name", "day"]


def priority(source):
    out = F.lit(len(fv.SOURCE_PRIORITY))
    for rank, name in enumerate(fv.SOURCE_PRIORITY):
        out = F.when(source == name, rank).otherwise(out)
    return out


def _features(df: DataFrame) -> DataFrame:
    """id, key, name, day, country: what the rules look at. Empty texts stand for "none"."""
    return df.select(
        "id",
        F.coalesce(acronym_key(F.col("acronym")), F.lit("")).alias("key"),
        sorted_tokens(core_name(F.col("name"))).alias("name"),
        F.col("start_date").alias("day"),
        F.lower(F.trim(F.coalesce("country", F.lit("")))).alias("country"),
    )


def _bucket(day):
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / (fv.MAX_DATE_GAP_DAYS + 1))


def _close_names(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """left and right rows (prefixed a_, b_) with equal or similar names, close days and not
    two acronyms."""
    both = pairs.select("name_a", "name_b").unionByName(
        pairs.select(F.col("name_b").alias("name_a"), F.col("name_a").alias("name_b"))
    )
    a = left.where("name <> ''")
    near = a.join(both, a["name"] == both["name_a"]).select(
        *a.columns, F.col("name_b").alias("other")
    ).unionByName(a.select("*", F.col("name").alias("other")))
    offered = near.select(
        *[F.col(c).alias(f"a_{c}") for c in a.columns], "other", days_around(F.col("day")).alias("near_day")
    )
    b = right.where("name <> ''").select(*[F.col(c).alias(f"b_{c}") for c in right.columns])
    return offered.join(
        b, (F.col("other") == F.col("b_name")) & (F.col("near_day") == F.col("b_day"))
    ).where("a_key = '' or b_key = ''")


def place(entities: DataFrame, listings: DataFrame, threshold: int = fv.PLACEMENT_SIMILARITY) -> DataFrame:
    """(id, entity_id, founder_id) per listing.

    ``entities``: id, acronym, name, start_date, country. ``listings``: those and ``source``.
    ``entity_id`` is the existing entity joined, else null; ``founder_id`` is the id of the
    listing that founds the new entity, else null. Entities founded in the same run carry no
    country yet, so places can only conflict with existing ones.
    """
    known = _features(entities).where("day is not null").withColumn("pos", F.col("id"))
    ranked = listings.select("id", priority(F.col("source")).alias("rank"))
    new = (
        _features(listings)
        .join(ranked, "id")
        .withColumn(
            "pos",
            F.when(
                (F.col("id") >= 0) & (F.col("id") < _ID_LIMIT),
                (F.col("rank") + 1) * F.lit(_ID_LIMIT) + F.col("id"),
            ).otherwise(F.raise_error(F.lit("listing ids must be in 0 .. 2^58"))),
        )
        .drop("rank")
    )
    new = cut(new)

    # --- similar names, only where one side has no acronym
    names = (
        known.select("name", "day", "key")
        .unionByName(new.select("name", "day", "key"))
        .where("name <> '' and day is not null")
        .select("name", _bucket(F.col("day")).alias("bucket"), (F.col("key") == "").alias("flag"))
        .distinct()
    )
    pairs = cut(similar_names(names, threshold))

    # --- existing entities come first in the order, so they are asked first
    by_key = earliest_near(known.where("key <> ''"), ["key"], "day", "pos")
    kinds = new.groupBy(*_NODE, "country").agg(F.min("pos").alias("pos"))
    old = known.groupBy(*_NODE, "country").agg(F.min("pos").alias("pos"))
    by_name = (
        _close_names(kinds, old, pairs)
        .where(~places_conflict(F.col("a_country"), F.col("b_country")))
        .groupBy(*[F.col(f"a_{c}").alias(c) for c in [*_NODE, "country"]])
        .agg(F.min("b_pos").alias("old_by_name"))
    )
    kinds = cut(
        kinds.join(by_key.withColumnRenamed("pos", "old_by_key"), _HUB, "left").join(
            by_name, [*_NODE, "country"], "left"
        )
    )

    # --- rounds among the rest
    nodes = (
        kinds.where("old_by_key is null and old_by_name is null and day is not null")
        .where("key <> '' or name <> ''")
        .groupBy(*_NODE)
        .agg(F.min("pos").alias("pos"))
    )
    edges = cut(
        _close_names(nodes, nodes, pairs)
        .where("a_pos <> b_pos")
        .select(F.col("a_pos").alias("pos"), F.col("b_pos").alias("other"))
    )
    founders = founding_rounds(cut(nodes), edges)

    # --- every listing joins the earliest entity by acronym, else by name, if it was there first
    everyone = known.select("key", "day", "pos").unionByName(founders.select("key", "day", "pos"))
    near_key = earliest_near(everyone.where("key <> ''"), ["key"], "day", "pos")
    near_name = (
        _close_names(
            kinds.select(*_NODE).distinct(), founders.select(*_NODE, "pos"), pairs
        )
        .groupBy(*[F.col(f"a_{c}").alias(c) for c in _NODE])
        .agg(F.min("b_pos").alias("new_by_name"))
    )
    homes = (
        kinds.select(*_NODE, "country", "old_by_name")
        .join(near_key.withColumnRenamed("pos", "by_key"), _HUB, "left")
        .join(near_name, _NODE, "left")
        .withColumn("by_name", F.coalesce("old_by_name", "new_by_name"))
    )
    joined = new.join(
        homes.select(*_NODE, "country", "by_key", "by_name"), [*_NODE, "country"], "left"
    )
    home = F.when(F.col("by_key") <= F.col("pos"), F.col("by_key")).when(
        F.col("by_name") <= F.col("pos"), F.col("by_name")
    ).otherwise(F.col("pos"))
    return joined.withColumn("home", home).select(
        "id",
        F.when(F.col("home") < _ID_LIMIT, F.col("home")).alias("entity_id"),
        F.when(F.col("home") >= _ID_LIMIT, F.col("home") % _ID_LIMIT).alias("founder_id"),
    )


def founding_rounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes (key, name, day, pos) that found an entity, given name edges (pos, other).

    Equal non-empty keys within the date gap are neighbours too, through their hubs. Every round
    decides at least the earliest undecided node of each neighbourhood, so it ends by itself.
    """
    undecided, founders = nodes, None
    while not undecided.isEmpty():
        hub = earliest_near(undecided.where("key <> ''"), ["key"], "day", "pos")
        live = edges.join(undecided.select(F.col("pos").alias("other")), "other")
        by_edge = live.groupBy("pos").agg(F.min("other").alias("edge_min"))
        judged = cut(
            undecided.join(hub.withColumnRenamed("pos", "hub_min"), _HUB, "left")
            .join(by_edge, "pos", "left")
            .withColumn(
                "founds",
                (F.coalesce("hub_min", "pos") >= F.col("pos"))
                & (F.coalesce("edge_min", "pos") >= F.col("pos")),
            )
            .drop("hub_min", "edge_min")
        )
        fresh = judged.where("founds").drop("founds")
        founders = fresh if founders is None else founders.unionByName(fresh)
        near = fresh.where("key <> ''").select("key", days_around(F.col("day")).alias("day")).distinct()
        touched = edges.join(fresh.select(F.col("pos").alias("other")), "other").select("pos").distinct()
        undecided = cut(
            judged.where("not founds")
            .drop("founds")
            .join(near, _HUB, "left_anti")
            .join(touched, "pos", "left_anti")
        )
    return nodes if founders is None else founders
