"""Lines of long texts: what to keep within a budget, carried headers, fair shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import ANY_CASE


def numbered_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def kept_lines(lines: DataFrame, key: str, useful: Column) -> DataFrame:
    """``lines`` with ``keep``: section headers; useful lines with one line either side; and
    whole runs of table lines, with the two lines before them, when any of those is useful."""
    by_line = W.partitionBy(key).orderBy("line_no")
    around = by_line.rowsBetween(-1, 1)
    table = F.col("line").contains("|")
    marked = lines.withColumns(
        {"table": table, "useful": useful, "head": ~table & F.col("line").startswith("### ")}
    ).withColumn("run", F.count_if(~F.col("table")).over(by_line))
    starts = F.col("table") & ~F.coalesce(F.lag("table").over(by_line), F.lit(False))
    title = F.coalesce(F.max("useful").over(by_line.rowsBetween(-2, -1)), F.lit(False))
    seen = marked.withColumns({"starts": starts, "told": starts & title})
    in_run = W.partitionBy(key, "run", "table")
    good = F.col("table") & F.max(F.col("useful") | F.col("told")).over(in_run)
    runs = seen.withColumn("good", good)
    begins = F.col("good") & F.col("starts")
    leads = F.coalesce(F.max(begins).over(by_line.rowsBetween(1, 2)), F.lit(False))
    plain = ~F.col("table") & ~F.col("head") & F.col("useful")
    keep = F.col("good") | F.col("head") | leads | F.max(plain).over(around)
    return runs.select(*lines.columns, keep.alias("keep"))


def condense(df: DataFrame, key: str, text: str, limit: int, out: str = "condensed") -> DataFrame:
    """(key, out): texts of at most ``limit`` characters: the start, then the kept lines while
    they fit. Short texts stay as they are and are never taken apart."""
    long = df.where(F.length(text) > limit)
    head = F.left(F.col(text), F.lit(limit // 8))
    budget = limit - limit // 8
    marked = kept_lines(
        numbered_lines(long, key, text), key, F.col("line").rlike(ANY_CASE + fv.USEFUL_LINE)
    ).where("keep")
    size = F.sum(F.length("line") + 1).over(
        W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    )
    fitting = marked.withColumn("size", size).where(F.col("size") <= budget)
    body = fitting.groupBy(key).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]
            ),
            "\n",
        ).alias("body")
    )
    cut = long.select(key, head.alias("head")).join(body, key, "left").select(
        key, F.concat_ws("\n", "head", "body").alias(out)
    )
    short = df.where(F.length(text) <= limit).select(key, F.col(text).alias(out))
    return short.unionByName(cut)


def carry_forward(
    rows: DataFrame, page: str, position: str, header: str, out: str, width: int = 1 << 16
) -> DataFrame:
    """The latest non-null ``header`` at or before each row of its page.

    Positions are cut into ranges: headers are carried inside a range, and from range to range
    with one row per range, so no task sorts a whole page whatever its length.
    """
    cells = rows.withColumn("_cell", F.floor(F.col(position) / width))
    ends = cells.groupBy(page, "_cell").agg(
        F.max_by(header, F.when(F.col(header).isNotNull(), F.col(position))).alias("_last")
    )
    earlier = W.partitionBy(page).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    before = ends.select(page, "_cell", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    upto = W.partitionBy(page, "_cell").orderBy(position).rowsBetween(W.unboundedPreceding, 0)
    return (
        cells.withColumn(out, F.last(header, ignorenulls=True).over(upto))
        .join(before, [page, "_cell"])
        .select(*rows.columns, F.coalesce(out, "_before").alias(out))
    )


def after_marker(rows: DataFrame, page: str, position: str, marker: Column, out: str) -> DataFrame:
    """Whether a marker row came before this row on its page (the marker rows drop out): the
    first marker's position is aggregated and joined back."""
    marked = rows.withColumn("_marker", F.coalesce(marker, F.lit(False)))
    first = marked.where("_marker").groupBy(page).agg(F.min(position).alias("_first"))
    return (
        marked.where("not _marker")
        .join(first, page, "left")
        .select(*rows.columns, F.coalesce(F.col(position) > F.col("_first"), F.lit(False)).alias(out))
    )


def fair_shares(sections: DataFrame, entity: str, order: str, section: str, total: int, out: str = "text") -> DataFrame:
    """(entity, out): an entity's sections in order, each cut to an equal share of ``total``.

    Sections are counted first and cut where they lie; only what is left of them is brought
    together, so an entity's row holds ``total`` characters and its separators, however much it has.
    """
    share = sections.groupBy(entity).agg(F.count("*").alias("_n")).withColumn("_share", F.floor(F.lit(total) / F.col("_n")).cast("int"))
    cut_down = sections.join(share, entity).select(
        entity, "_n", F.when(F.col("_share") > 0, F.struct(F.col(order).alias("o"), F.left(section, F.col("_share")).alias("s"))).alias("part")
    )
    parts = F.array_sort(F.collect_list("part"))  # nulls, of shares without a character, are not collected
    joined = F.array_join(F.transform("parts", lambda p: p["s"]), "\n\n")
    gaps = F.repeat(F.lit("\n\n"), F.col("n").cast("int") - 1)
    return cut_down.groupBy(entity).agg(parts.alias("parts"), F.first("_n").alias("n")).select(
        entity, F.when(F.size("parts") == 0, gaps).otherwise(joined).alias(out)
    )
