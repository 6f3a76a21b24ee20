"""Earlier editions of an event among published proceedings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.names import (
    acronym_key, core_name, edition_number, name_acronym, name_words, word_overlap,
)
from listmill.operators.similarity import token_sort_similarity


def editions(entities: DataFrame, items: DataFrame, entity: str = "id") -> DataFrame:
    """(entity, year, name, publisher, doi, answer, pos) of items that are earlier editions.

    ``entities``: entity, name, acronym, start_date. ``items``: entity, answer (0 first, 1 second
    query), pos, names, year, publisher, doi. Items meet entities by the entity they were asked
    for; cheap rules run before the similarity, which is the only Python step.
    """
    conf = entities.select(
        entity,
        F.year("start_date").alias("this_year"),
        acronym_key(F.col("acronym")).alias("key"),
        core_name(F.col("name")).alias("core"),
        name_words(F.col("name")).alias("words"),
        edition_number(F.col("name")).alias("edition"),
    ).where("edition is null or edition <> 1")
    asked = (
        items.where("year is not null and year <> 0")
        .join(conf, entity)
        .where("year < this_year")
        .select("*", F.posexplode("names").alias("name_pos", "candidate"))
        .withColumn("their_key", name_acronym(F.col("candidate")))
    )
    both = F.col("key").isNotNull() & F.col("their_key").isNotNull()
    by_key = (
        both
        & (F.col("key") == F.col("their_key"))
        & (word_overlap(F.col("words"), name_words(F.col("candidate"))) >= fv.ACRONYM_WORDS_MIN)
    )
    by_name = ~both & (F.size("words") >= 3)
    likely = asked.withColumn(
        "needed", F.when(by_key, fv.ACRONYM_NAME_MIN).when(by_name, fv.NAME_ONLY_MIN)
    ).where("needed is not null")
    matching = likely.where(
        token_sort_similarity(F.col("core"), core_name(F.col("candidate"))) >= F.col("needed")
    )
    first = matching.groupBy(
        entity, "answer", "pos", "year", "publisher", "doi", "edition"
    ).agg(F.min_by("candidate", "name_pos").alias("name"))
    earlier = edition_number(F.col("name"))
    fits = first.where(
        F.col("edition").isNull() | earlier.isNull() | (earlier < F.col("edition"))
    )
    return first_per_year(fits, entity)


def first_per_year(found: DataFrame, entity: str) -> DataFrame:
    """One edition per entity and year: the first answer wins, then the first item."""
    return (
        found.groupBy(entity, "year")
        .agg(
            F.min_by(F.struct("name", "publisher", "doi", "answer", "pos"), F.struct("answer", "pos")).alias("e")
        )
        .select(entity, "year", "e.*")
    )


def history_records(entities: DataFrame, found: DataFrame, entity: str = "id") -> DataFrame:
    """(entity, history): newest editions first, whether they make a recent history, a note
    when they are too old. Entities without editions get an empty record."""
    # cut to the newest before the shuffle and again behind it; an entity's list is never longer
    fields = ["year", "name", "publisher", "doi"]
    newest = W.partitionBy(entity).orderBy(*[F.col(c).desc_nulls_last() for c in fields])
    top = found.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= fv.MAX_EDITIONS)
    listed = top.groupBy(entity).agg(F.sort_array(F.collect_list(F.struct(*fields)), asc=False).alias("editions"))
    empty = F.array().cast("array<struct<year:int,name:string,publisher:string,doi:string>>")
    joined = entities.join(listed, entity, "left").withColumn(
        "editions", F.coalesce("editions", empty)
    )
    newest = F.get(F.col("editions"), F.lit(0))["year"]
    recent = F.coalesce(newest >= F.year("start_date") - fv.RECENT_YEARS, F.lit(False))
    note = F.when(
        newest.isNotNull() & ~recent,
        F.concat(
            F.lit("only editions up to "),
            newest.cast("string"),
            F.lit(" were found: probably another series with the same name"),
        ),
    )
    publishers = F.array_sort(
        F.array_distinct(
            F.filter(
                F.transform("editions", lambda e: e["publisher"]),
                lambda p: p.isNotNull() & (p != ""),
            )
        )
    )
    return joined.select(
        entity,
        F.struct(
            recent.alias("has_history"),
            note.alias("note"),
            F.col("editions"),
            publishers.alias("publishers"),
        ).alias("history"),
    )
