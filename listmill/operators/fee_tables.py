"""Fee rows from page tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.money import currency_in, parse_money, tier_of
from listmill.functions.regex import blank_to_null, has, present

_TABLE_HEAD = 300
_LONG_CELL = 30
_TEXT_LIMIT = 255


def money_columns(header: Column) -> Column:
    """Positions of the price columns; null when the headers say nothing either way."""
    price = lambda h: has(h, fv.MONEY_HEADER)
    other = lambda h: has(h, fv.NOT_FEE_HEADER)
    labels = F.slice(header, 2, F.greatest(F.size(header) - 1, F.lit(0)))
    marked = F.transform(header, lambda h, i: F.when((i > 0) & price(h) & ~other(h), i))
    return F.when(F.exists(labels, lambda h: price(h) | other(h)), F.array_compact(marked))


def fees_from_tables(tables: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, fee_no, category, tier, amount, currency, notes) from ``html.page_tables`` rows.

    A table is one input row, so header and cells meet without a join or a shuffle.
    """
    filled = F.filter(F.col("rows"), lambda r: F.exists(r, lambda c: c != ""))
    header = F.get(F.col("filled"), F.lit(0))
    notes_at = F.filter(
        F.transform("header", lambda h, i: F.when(has(h, fv.NOTES_HEADER), i)),
        lambda i: i.isNotNull(),
    )
    lines = (
        tables.withColumn("filled", filled)
        .where(F.size("filled") >= 2)
        .withColumn("header", header)
        .withColumn("price_cols", money_columns(F.col("header")))
        .withColumn("notes_at", F.get(notes_at, F.lit(0)))
        .withColumn(
            "table_currency",
            F.coalesce(
                currency_in(F.array_join("header", " ")),
                currency_in(F.substring("table_text", 1, _TABLE_HEAD)),
            ),
        )
        .select(key, "table_no", "header", "price_cols", "notes_at", "table_currency", F.posexplode("filled").alias("line_no", "cells"))
        .where("line_no > 0")
    )
    label = F.get(F.col("cells"), F.lit(0))
    is_price = currency_in(F.col("label")).isNotNull() & parse_money(F.col("label"))["amount"].isNotNull()
    cells = (
        lines.withColumn("label", label)
        .where((F.col("label") != "") & ~is_price)
        .select("*", F.posexplode("cells").alias("col_no", "cell"))
        .where("col_no > 0")
        .where(F.col("price_cols").isNull() | F.array_contains("price_cols", F.col("col_no")))
        .where(F.col("cell").rlike(r"\d"))
        .where((F.length("cell") <= _LONG_CELL) | currency_in(F.col("cell")).isNotNull())
    )
    column = F.coalesce(F.get(F.col("header"), F.col("col_no")), F.lit(""))
    noted = F.when(
        F.col("notes_at") > 0,
        blank_to_null(F.substring(F.get(F.col("cells"), F.col("notes_at")), 1, _TEXT_LIMIT)),
    )
    return (
        cells.select("*", present(parse_money(F.col("cell"))).alias("price"))
        .withColumn("column", column)
        .withColumn(
            "currency",
            F.coalesce("price.currency", currency_in(F.col("column")), F.col("table_currency")),
        )
        .where("price.amount > 0 and currency is not null")
        .select(
            key,
            F.struct("table_no", "line_no", "col_no").alias("fee_no"),
            F.substring("label", 1, _TEXT_LIMIT).alias("category"),
            F.coalesce(tier_of(F.col("column")), tier_of(F.col("label"))).alias("tier"),
            F.col("price.amount").alias("amount"),
            "currency",
            F.coalesce(noted, blank_to_null(F.col("column"))).alias("notes"),
        )
    )
