"""Sitemaps, and which of their pages are worth reading."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the site's host, paths it closes to crawlers, the shape of a page name
HOST = "www.computer.org"
CLOSED_PATHS = ["/api/", "/_next/", "/search", "/wp-json/", "/private/", "/admin/"]
SLUG = r"^(?:cfp-[a-z0-9-]+|[a-z0-9-]+-cfp|[a-z0-9-]*[a-z]-?20\d{2}(?:-20\d{2})?)$"


def read_sitemap(spark: SparkSession, path: str, row: str = "url") -> DataFrame:
    """(loc, lastmod) of a sitemap file, or of an index file with ``row="sitemap"``."""
    return (
        spark.read.format("xml")
        .option("rowTag", row)
        .schema("loc string, lastmod string")
        .load(path)
        .select(
            F.trim("loc").alias("loc"),
            F.substring(F.trim("lastmod"), 1, 10).try_cast("date").alias("lastmod"),
        )
        .where("loc <> ''")
    )


def is_allowed(url: Column, host: str = HOST) -> Column:
    path = F.regexp_extract(url, r"^https://[^/?#]*(/[^?#]*)?", 1)
    open_path = F.lit(True)
    for closed in CLOSED_PATHS:
        open_path = open_path & ~path.startswith(closed)
    at_host = F.regexp_extract(url, r"^https://([^/?#]*)", 1) == host
    return at_host & ~url.contains("?") & open_path


def page_slug(url: Column, folder: str = "/conferences") -> Column:
    path = F.regexp_replace(F.regexp_extract(url, r"^https://[^/?#]*(/[^?#]*)?", 1), "/+$", "")
    slug = F.substring_index(path, "/", -1)
    return F.when(
        (F.concat(F.lit(folder), F.lit("/"), slug) == path) & slug.rlike(SLUG), slug
    )


def in_years(
    text: Column, lastmod: Column, start: dt.date, end: dt.date, max_age_days: int
) -> Column:
    """Years written in ``text`` overlap the window; without any, the page is recent enough."""
    years = F.transform(
        F.regexp_extract_all(text, F.lit(r"20\d{2}"), F.lit(0)), lambda y: y.cast("int")
    )
    overlap = (F.array_min(years) <= end.year) & (F.array_max(years) >= start.year)
    recent = lastmod.isNull() | (lastmod >= F.lit(start - dt.timedelta(days=max_age_days)))
    return F.when(F.size(years) > 0, overlap).otherwise(recent)


def select_pages(
    entries: DataFrame, start: dt.date, end: dt.date, max_age_days: int, host: str = HOST
) -> DataFrame:
    """The addresses worth a request for a date window, each once."""
    slug = page_slug(F.col("loc"))
    return (
        entries.where(is_allowed(F.col("loc"), host) & slug.isNotNull())
        .where(in_years(slug, F.col("lastmod"), start, end, max_age_days))
        .select(F.regexp_replace("loc", "/+$", "").alias("url"))
        .distinct()
    )
