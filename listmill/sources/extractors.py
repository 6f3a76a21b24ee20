"""Batch extractors by source name: landed rows or pages -> listing columns.

An extractor is a function ``DataFrame -> DataFrame`` whose output has some of the listing
columns; the registry adds the source name and unions them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listmill.functions.dates import epoch_ms_or_text, parse_date, parse_date_range, row_date
from listmill.functions.names import clean_acronym, split_trailing_acronym, without_year_suffix
from listmill.functions.places import split_location
from listmill.functions.regex import blank_to_null, squash
from listmill.functions.urls import absolute, query_id
from listmill.operators.incremental import first_by_list
from listmill.operators.lines import after_marker, carry_forward
from listmill.sources.answers import search_listings
from listmill.sources.html import page_rows
from listmill.schemas import LISTINGS

Extractor = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Extractor] = {}


def extractor(source: str) -> Callable[[Extractor], Extractor]:
    def register(fn: Extractor) -> Extractor:
        REGISTRY[source] = fn
        return fn

    return register


def extract(source: str, pages: DataFrame, limit: int | None = None) -> DataFrame:
    """One source's rows; ``limit`` gives a preview."""
    if source not in REGISTRY:
        raise KeyError(f"unknown source {source!r}; known: {sorted(REGISTRY)}")
    rows = REGISTRY[source](pages).withColumn("source", F.lit(source))
    return rows if limit is None else rows.limit(limit)


def extract_all(pages_by_source: dict[str, DataFrame]) -> DataFrame:
    """All sources' rows with the full listing schema. Ids come from (source, source_id)."""
    spark = next(iter(pages_by_source.values())).sparkSession
    out = spark.createDataFrame([], LISTINGS)
    for source, pages in pages_by_source.items():
        rows = extract(source, pages)
        keep = [c for c in rows.columns if c in out.columns]
        rows = rows.select(*keep).withColumn("id", listing_id(F.col("source"), F.col("source_id")))
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def listing_id(source: Column, source_id: Column) -> Column:
    """A deterministic id: 57 bits of the SHA-256 of source and source id, as placement takes them.

    Among a hundred million listings two share an id with a chance below one in twenty.
    """
    digest = F.sha2(F.to_json(F.struct(source.alias("source"), source_id.alias("id"))), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").bitwiseAND(F.lit((1 << 57) - 1))


@extractor("ieee")
def search_results(bodies: DataFrame) -> DataFrame:
    """``bodies``: body (a search response as JSON)."""
    return search_listings(bodies).drop("total")


def _place(where: Column) -> tuple[Column, Column]:
    split = split_location(where)
    return split["city"], split["country"]


@extractor("wikicfp")
def category_pages(pages: DataFrame) -> DataFrame:
    """``pages``: page_id, base, category, list_no, html. Two table rows per event: link and name,
    then when, where and deadline. Rows after an "Expired" marker are flagged; undated rows and
    repeats on later lists drop out."""
    rows = page_rows(pages)
    flagged = after_marker(
        rows, "page_id", "row_no", F.col("text") == "Expired CFPs", "expired"
    )
    order = W.partitionBy("page_id").orderBy("row_no")
    paired = flagged.withColumn("detail", F.lead("cells").over(order)).where(
        F.col("href").contains("eventid=") & (F.size("cells") >= 2) & (F.size("detail") >= 3)
    )
    when, where, due = (F.get(F.col("detail"), F.lit(i)) for i in range(3))
    title = squash(F.get(F.col("cells"), F.lit(0)))
    span = parse_date_range(when)
    city, country = _place(where)
    listed = paired.join(pages.select("page_id", "base", "category", "list_no"), "page_id").select(
        F.regexp_extract("href", r"[?&]eventid=([^&#]*)", 1).alias("source_id"),
        absolute(F.col("href"), F.col("base")).alias("url"),
        without_year_suffix(title).alias("acronym"),
        squash(F.get(F.col("cells"), F.lit(1))).alias("name"),
        span["start"].alias("start_date"),
        span["end"].alias("end_date"),
        F.when(F.upper(where) != "N/A", where).alias("location_raw"),
        city.alias("city"),
        country.alias("country"),
        parse_date(due).alias("paper_deadline"),
        F.array("category").alias("categories"),
        F.to_json(F.struct(title.alias("wikicfp_title"))).alias("extra"),
        "expired",
        (F.upper(when) == "N/A").alias("undated"),
        "list_no",
        "row_no",
    )
    return first_by_list(listed, "source_id", "list_no", "row_no").where("not undated")


@extractor("easychair")
def area_pages(rows: DataFrame) -> DataFrame:
    """``rows``: list_no, row_no, href, title, name, place, due_key, due, start_key, start, topics,
    base - one per table row, with the cells' date sort keys."""
    start = epoch_ms_or_text(F.col("start_key"), F.col("start"))
    city, country = _place(F.col("where"))
    listed = rows.withColumn("where", blank_to_null(squash(F.col("place")))).select(
        F.substring_index("href", "/", -1).alias("source_id"),
        absolute(F.col("href"), F.col("base")).alias("url"),
        clean_acronym(squash(F.col("title"))).alias("acronym"),
        F.coalesce(blank_to_null(squash(F.col("name"))), squash(F.col("title"))).alias("name"),
        start.alias("start_date"),
        F.col("where").alias("location_raw"),
        city.alias("city"),
        country.alias("country"),
        epoch_ms_or_text(F.col("due_key"), F.col("due")).alias("paper_deadline"),
        F.filter("topics", lambda t: t != "").alias("categories"),
        F.to_json(F.struct(squash(F.col("title")).alias("easychair_title"))).alias("extra"),
        "list_no",
        "row_no",
    )
    return first_by_list(listed, "source_id", "list_no", "row_no").where("start_date is not null")


@extractor("edas")
def register_rows(rows: DataFrame) -> DataFrame:
    """``rows``: row_no, conf_href, acronym, name, home_href, where_when (lines), register_href,
    base - one per row of the registration list."""
    lines = F.filter(F.transform(F.split("where_when", "\n"), lambda s: F.trim(s)), lambda s: s != "")
    page, register = absolute(F.col("conf_href"), F.col("base")), absolute(F.col("register_href"), F.col("base"))
    raw = squash(F.col("acronym"))
    place = F.get(F.col("lines"), F.lit(0))
    span = parse_date_range(F.when(F.size("lines") > 1, F.try_element_at("lines", F.lit(-1))))
    city, country = _place(place)
    return (
        rows.withColumn("lines", lines)
        .where(raw != "")
        .select(
            F.coalesce(query_id(page), query_id(register), raw).alias("source_id"),
            page.alias("url"),
            F.coalesce(blank_to_null(F.trim(F.regexp_replace(raw, r"\s*20\d{2}", ""))), raw).alias("acronym"),
            squash(F.col("name")).alias("name"),
            span["start"].alias("start_date"),
            span["end"].alias("end_date"),
            place.alias("location_raw"),
            city.alias("city"),
            country.alias("country"),
            F.col("home_href").alias("homepage"),
            F.to_json(F.struct(raw.alias("edas_title"), register.alias("register_self_url"))).alias("extra"),
        )
    )


@extractor("conferenceindex")
def month_cards(rows: DataFrame) -> DataFrame:
    """``rows``: page_id, list_no, row_no, header ("October, 2026" on header rows, else null),
    href, title, day_text, place, base. A header holds for the rows after it."""
    carried = carry_forward(rows, "page_id", "row_no", "header", "under")
    month = F.regexp_extract("under", r"([A-Za-z]+),\s*(\d{4})", 1)
    year = F.regexp_extract("under", r"([A-Za-z]+),\s*(\d{4})", 2).try_cast("int")
    from listmill.functions.dates import month_number

    where = blank_to_null(squash(F.regexp_replace(F.trim("place"), "^-+", "")))
    named = split_trailing_acronym(F.col("title"))
    city, country = _place(where)
    listed = carried.where(F.col("href").rlike("/event/[^/?#]+$")).select(
        F.substring_index("href", "/", -1).alias("source_id"),
        absolute(F.col("href"), F.col("base")).alias("url"),
        named["name"].alias("name"),
        named["acronym"].alias("acronym"),
        row_date(F.col("day_text"), month_number(month), year).alias("start_date"),
        where.alias("location_raw"),
        city.alias("city"),
        country.alias("country"),
        F.to_json(F.struct(squash(F.col("title")).alias("conferenceindex_title"))).alias("extra"),
        "list_no",
        "row_no",
    )
    return first_by_list(listed, "source_id", "list_no", "row_no")


def newest_start(rows: DataFrame, page: str) -> DataFrame:
    """(page, horizon): the latest start on each list page, what tells that a list is past the
    window."""
    return rows.groupBy(page).agg(F.max("start_date").alias("horizon"))
