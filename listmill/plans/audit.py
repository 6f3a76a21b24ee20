"""The audit: one row per check with its failures and up to four examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listmill.config import EngineConfig
from listmill.engine import cut, cut_all
from listmill.fixed_values import MAX_DATE_GAP_DAYS
from listmill.functions.labels import is_counted
from listmill.functions.money import converted_by_map
from listmill.functions.names import acronym_key
from listmill.functions.places import in_scope, with_country
from listmill.functions.urls import is_web_address, organizer_flag
from listmill.operators.fees import fee_range
from listmill.operators.neighbours import with_previous
from listmill.operators.privacy import leaks
from listmill.sources.rates import with_rates

EXAMPLES = 4
# fixed values: check name -> must be zero
CHECKS = {
    "ends before it starts": True,
    "starts outside the window": False,
    "no start date": True,
    "lasts more than 3 weeks": False,
    "submission deadline after the start": False,
    "paper deadline before 2025": False,
    "counted fee with zero or negative amount": True,
    "counted fee without a currency": True,
    "counted fee outside US$3-6,000": False,
    "the same fee twice": False,
    "fee range disagrees with the counted fees": True,
    "enriched with no counted fee": True,
    "not published but has counted fees": True,
    "never read": True,
    "likely duplicates": False,
    "homepage that isn't a web address": True,
    "listing not merged": True,
    "account details published": True,
    "person id in a published link": True,
    "published outside the window": True,
    "published without a fee status": True,
    "headline fee not among its fees": True,
    "published fee not convertible": False,
    "weeks don't add up": True,
}


def failing(df: DataFrame, checks: dict[str, Column], order: Column, label: Column) -> DataFrame:
    """(check, ord, example): one row per failed check and row; all checks in one scan."""
    marks = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]))
    return df.select(
        F.explode(marks).alias("check"), order.cast("string").alias("ord"), label.alias("example")
    )


def report(failures: DataFrame, checks: dict[str, bool] = CHECKS) -> DataFrame:
    """(check, must_be_zero, failures, examples, verdict) for every check, failed or not.

    Counts and examples are aggregates: a task hands on one count and the first few examples per
    check and salt (the planner cuts groups to their first rows before the shuffle), a second step
    takes the first few of all salts.
    """
    spark = failures.sparkSession
    counts = failures.groupBy("check").agg(F.count("*").alias("n"))
    first = first_few(failures.select("check", "ord", "example"), "check", ["ord", "example"], EXAMPLES)
    few = first.groupBy("check").agg(F.array_sort(F.collect_list(F.struct("ord", "example"))).alias("few"))
    names = spark.createDataFrame(list(checks.items()), "check string, must_be_zero boolean")
    n = F.coalesce("n", F.lit(0))
    return names.join(counts, "check", "left").join(few, "check", "left").select(
        "check",
        "must_be_zero",
        n.alias("failures"),
        F.coalesce(F.transform("few", lambda x: x["example"]), F.array().cast("array<string>")).alias("examples"),
        F.when(n == 0, "ok").when(F.col("must_be_zero"), "FAIL").otherwise("note").alias("verdict"),
    )


def first_few(df: DataFrame, group: str, order: list[str], n: int, salt: int = 64) -> DataFrame:
    """The first ``n`` rows per group, in two steps: per salted part, then per group. A group of
    any size is split over the salts first, so no task sorts all of it."""
    part = F.pmod(F.xxhash64(*order), F.lit(salt))
    salted = df.withColumn("_part", part)
    within = W.partitionBy(group, "_part").orderBy(*order)
    small = salted.withColumn("_n", F.row_number().over(within)).where(F.col("_n") <= n)
    whole = W.partitionBy(group).orderBy(*order)
    return (
        small.withColumn("_n", F.row_number().over(whole)).where(F.col("_n") <= n).drop("_n", "_part")
    )


def audit(
    entities: DataFrame, fees: DataFrame, listings: DataFrame, rates: DataFrame,
    site: dict[str, DataFrame], details: DataFrame, config: EngineConfig, everything: bool = False,
) -> DataFrame:
    """All checks over the stored tables and the published ``site`` marts.

    Failures are stored check by check, so that the driver never plans all checks at once. What has a
    row for each entity or fee is never broadcast: a few columns of a wide stored table look far
    smaller to the planner than they are.
    """
    c = with_country(entities, "country")
    if not everything:
        c = c.where(in_scope(F.col("continent"), config.public_continents))
    label = F.concat(F.lit("#"), F.col("id").cast("string"), F.lit(" "), F.coalesce("acronym", F.left("name", F.lit(40))))
    outside = F.col("start_date").isNotNull() & ~F.col("start_date").between(config.window_start, config.window_end)
    after = lambda f: F.coalesce(F.col(f) > F.col("start_date"), F.lit(False))

    counted = with_rates(fees.where(is_counted(F.col("check_status"))), rates).withColumn(
        "usd", converted_by_map(F.col("amount"), F.col("currency"), F.col("rates"), "USD")
    )
    c, counted = cut(c), cut(counted.select("id", "entity_id", "category", "tier", "amount", "currency", "usd"))
    owned = cut(counted.join(c.select(F.col("id").alias("entity_id")).hint("merge"), "entity_id", "left_semi"))
    has = counted.select(F.col("entity_id").alias("id"), F.lit(True).alias("has_counted")).distinct()
    ranges = fee_range(counted, "entity_id").select(
        F.col("entity_id").alias("id"), F.struct("fee_min", "fee_max", "currency").alias("want")
    )
    none = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (("fee_min", "double"), ("fee_max", "double"), ("currency", "string"))])
    state = cut(c.join(has.hint("merge"), "id", "left").join(ranges.hint("merge"), "id", "left"))
    no_fee = F.col("has_counted").isNull()
    parts = [failing(
        state,
        {
            "ends before it starts": F.col("end_date") < F.col("start_date"),
            "starts outside the window": outside,
            "no start date": F.col("start_date").isNull(),
            "lasts more than 3 weeks": F.datediff("end_date", "start_date") > 21,
            "paper deadline before 2025": F.year("paper_deadline") < 2025,
            "fee range disagrees with the counted fees": ~F.struct("fee_min", "fee_max", "currency").eqNullSafe(F.coalesce("want", none)),
            "enriched with no counted fee": (F.col("status") == "enriched") & no_fee,
            "not published but has counted fees": F.col("review_note").startswith("fees not published") & ~no_fee,
            "never read": (F.col("status") == "collected") & organizer_flag(F.col("homepage")).isNull(),
            "homepage that isn't a web address": (F.col("homepage") != "") & ~is_web_address(F.col("homepage")),
        },
        F.col("id"),
        label,
    )]
    for field in ("abstract_deadline", "paper_deadline"):
        parts.append(
            failing(c, {"submission deadline after the start": after(field)}, F.col("id"), F.concat(label, F.lit(f" {field}")))
        )
    fee_label = F.concat_ws(" ", F.concat(F.lit("#"), F.col("entity_id").cast("string")), "category", F.col("amount").cast("string"), "currency")
    parts.append(
        failing(
            owned,
            {
                "counted fee with zero or negative amount": F.col("amount").isNull() | (F.col("amount") <= 0),
                "counted fee without a currency": F.coalesce("currency", F.lit("")) == "",
                "counted fee outside US$3-6,000": ~F.col("usd").between(3, 6000),
            },
            F.col("id"),
            fee_label,
        )
    )
    repeats = owned.groupBy("entity_id", "category", "tier", "amount", "currency").agg(
        F.count("*").alias("n")
    ).where("n > 1")
    parts.append(
        repeats.select(
            F.lit("the same fee twice").alias("check"), F.col("entity_id").cast("string").alias("ord"), fee_label.alias("example")
        )
    )
    near = likely_duplicates(c.withColumn("key", acronym_key(F.col("acronym"))))
    parts.append(
        near.select(F.lit("likely duplicates").alias("check"), F.col("id").cast("string").alias("ord"), label.alias("example"))
    )
    left = listings.where("in_window and is_topic and entity_id is null")
    parts.append(
        failing(left, {"listing not merged": F.lit(True)}, F.col("id"), F.concat_ws(" ", "source", "source_id"))
    )
    shown, shown_fees = site["entities"], site["fees"]
    ident = F.concat(F.lit("#"), F.col("id").cast("string"))
    for df in (shown, shown_fees):
        parts.append(
            leaks(df, ["id"], details).select(
                F.lit("account details published").alias("check"), F.col("id").cast("string").alias("ord"), F.col("value").alias("example")
            )
        )
        parts.append(
            failing(
                df,
                {"person id in a published link": F.to_json(F.struct("*")).rlike(r'edas\.info[^"]*[?&]p=\d+')},
                F.col("id"),
                ident,
            )
        )
    prices = shown_fees.select(F.col("entity_id").alias("id"), "amount", "currency", F.lit(True).alias("listed")).distinct()
    std = shown.where("standard_fee is not null").select(
        "id", F.col("standard_fee.amount").alias("amount"), F.col("standard_fee.currency").alias("currency")
    )
    missing = std.join(prices.hint("merge"), ["id", "amount", "currency"], "left_anti")
    parts.append(
        failing(missing, {"headline fee not among its fees": F.lit(True)}, F.col("id"), ident)
    )
    parts.append(
        failing(
            shown,
            {
                "published outside the window": outside,
                "published without a fee status": F.coalesce("fee_status", F.lit("")) == "",
            },
            F.col("id"),
            ident,
        )
    )
    parts.append(
        failing(
            shown_fees,
            {"published fee not convertible": F.col("currency").isNotNull() & F.col("amount_usd").isNull()},
            F.col("id"),
            ident,
        )
    )
    visible = shown.agg(
        F.count_if(F.col("organizer_flag").isNull() & F.col("start_date").isNotNull() & ~outside).alias("visible")
    )
    weeks = site["weeks"].agg(F.coalesce(F.sum("total"), F.lit(0)).alias("weeks"))
    totals = weeks.withColumn("visible", visible.scalar())
    parts.append(
        failing(
            totals,
            {"weeks don't add up": F.col("weeks") != F.col("visible")},
            F.lit(0),
            F.concat_ws(" vs ", F.col("weeks").cast("string"), F.col("visible").cast("string")),
        )
    )
    return report(cut_all(parts))


def likely_duplicates(rows: DataFrame) -> DataFrame:
    """Neighbours in date order (then by id) inside (key, continent): at most 7 days apart, same
    country. All rows are sorted in ranges, so a crowded key is never sorted in one task."""
    own = ["key", "continent"]
    placed = rows.where("key is not null and start_date is not null").withColumns(
        {"continent": F.coalesce("continent", F.lit("?")), "_place": F.lower(F.coalesce("country", F.lit("")))}
    )
    before = with_previous(placed, [*own, "start_date", "id"], ["_place"], "_prev")
    same = [F.col(f"_prev.{c}") == F.col(c) for c in [*own, "_place"]]
    close = F.datediff("start_date", "_prev.start_date") <= MAX_DATE_GAP_DAYS
    return before.where(same[0] & same[1] & same[2] & close).drop("_place", "_prev")
