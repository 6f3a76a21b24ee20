"""Quality rules with thresholds that adapt to each language and source.

The thresholds come from mergeable quantile sketches: for each language, source and measure, counts
of integer values in buckets whose width grows with the value (exact below 64, within 1/32 above).
Sketches merge by adding counts, in any order and with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.engine import cut
from listmill.llm.common import fresh, parts

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Words of the windows that are looked up for repeats.
WINDOW = 8
#: The fixed part of the verdict.
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30
#: Rows that a sketch needs; smaller groups take their language's sketch, then that of all rows.
LEAST_ROWS = 100
#: How many quartile distances beyond the outer quartiles a value may lie.
REACH = 3
#: Measure: its numerator, denominator and scale, whether low values fail as well, and the least
#: distance from the quartile that is allowed, in the scale's units.
MEASURES = {
    "symbols": ("n_symbols", "word_chars", 1000, False, 50),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, False, 400),
    "repeat_words": ("n_repeat_words", "n_words", 1000, False, 300),
    "word_length": ("word_chars", "n_words", 100, True, 200),
}
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_FEATURE_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in FEATURES])
_SPACES = " \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    values, at, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    if len(values) == n:
        return 0
    suspects = np.flatnonzero(counts[at] > 1)
    seen: dict[tuple[bytes, ...], int] = {}
    for i in suspects.tolist():  # equal hashes are held against the words
        key = tuple(words[i : i + window])
        seen[key] = seen.get(key, 0) + 1
    repeats = [i for i in suspects.tolist() if seen[tuple(words[i : i + window])] > 1]
    border = np.zeros(len(words) + 1, np.int64)
    np.add.at(border, repeats, 1)
    np.add.at(border, np.array(repeats, np.int64) + window, -1)
    return int((np.cumsum(border) > 0).sum())


def features(text: str | None) -> tuple[int, ...]:
    """The counts in the order of FEATURES; all 0 for a null or empty text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def with_features(df: DataFrame, name: str, text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with a struct column of the FEATURES of each whole text, without the text if so asked."""
    rest = [c for c in df.columns if c != text_column]
    kept = [*rest, text_column] if keep_text else rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, len(rest)):
                rows = np.array([features(t) for t in part.column(len(rest)).to_pylist()], np.int64).reshape(-1, len(FEATURES))
                found = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(FEATURES))], names=FEATURES)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], found], names=[*kept, name])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, _FEATURE_TYPE)])
    return df.select(*rest, text_column).mapInArrow(run, schema).select(*(c for c in df.columns if c in kept), name)


def base_failed(f: str) -> Column:
    """The fixed rules on a column of features."""
    words = F.col(f"{f}.n_words")
    return (words < LEAST_WORDS) | (100 * F.col(f"{f}.n_repeat_words") > MOST_REPEATED_PERCENT * words)


def measure(f: str, name: str) -> Column:
    top, below, scale, _, _ = MEASURES[name]
    return F.expr(f"coalesce({scale} * {f}.{top} div nullif({f}.{below}, 0), 0)")


def bucket_of(value: Column) -> Column:
    """A bucket's number: it keeps the six leading bits of a value and how many follow them."""
    more = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return more * 64 + F.call_function("shiftright", value, more)


def bucket_start(bucket: Column) -> Column:
    return F.call_function("shiftleft", bucket % 64, F.floor(bucket / 64).cast("int"))


def sketch(rows: DataFrame, f: str, groups: list[str]) -> DataFrame:
    """Counts by group, measure and bucket over the rows that the fixed rules keep.

    A group has some hundred rows at most, and rows are counted before the shuffle, so a frequent
    language or source costs no more than a rare one.
    """
    values = F.array(*(F.struct(F.lit(m).alias("measure"), bucket_of(measure(f, m)).alias("bucket")) for m in MEASURES))
    return (
        rows.where(~base_failed(f))
        .select(*groups, F.explode(values).alias("v"))
        .groupBy(*groups, F.col("v.measure").alias("measure"), F.col("v.bucket").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merge(counts: DataFrame, groups: list[str]) -> DataFrame:
    return counts.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def bounds(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: ``rows`` and a map from measure to the least and greatest value allowed."""
    sums = Window.partitionBy(*groups, "measure")
    ranked = counts.withColumn("upto", F.sum("n").over(sums.orderBy("bucket"))).withColumn("rows", F.sum("n").over(sums))

    def quartile(k: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= k * F.col("rows"), bucket_start(F.col("bucket"))))

    quartiles = ranked.groupBy(*groups, "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.first("rows").alias("rows"))
    slack = F.create_map(*(x for m, v in MEASURES.items() for x in (F.lit(m), F.lit(v[4]).cast("bigint"))))[F.col("measure")]
    reach = F.greatest(slack, REACH * (F.col("q3") - F.col("q1")))
    limits = F.struct((F.col("q1") - reach).alias("least"), (F.col("q3") + reach).alias("most"))
    return (
        quartiles.withColumn("limits", limits)
        .groupBy(*groups)
        .agg(F.max("rows").alias("rows"), F.map_from_entries(F.collect_list(F.struct("measure", "limits"))).alias("limits"))
    )


def thresholds(counts: DataFrame, language: str, source: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """language, source, limits and ``level``, which says whose sketch they come from.

    One row for each pair that has rows the fixed rules keep; null is a value like any other.
    """
    own = bounds(counts, [language, source]).withColumnRenamed("limits", "own_limits").withColumnRenamed("rows", "own_rows")
    by_language = bounds(merge(counts, [language]), [language]).select(
        F.col(language).alias("_language"), F.col("limits").alias("language_limits"), F.col("rows").alias("language_rows")
    )
    everything = bounds(merge(counts.withColumn("_all", F.lit(1)), ["_all"]), ["_all"]).first()
    # limits of all rows: a few numbers
    all_limits = F.create_map(
        *(
            x
            for m, limit in (everything["limits"] if everything else {}).items()
            for x in (F.lit(m), F.struct(F.lit(limit["least"]).alias("least"), F.lit(limit["most"]).alias("most")))
        )
    )
    joined = own.join(by_language, F.col(language).eqNullSafe(F.col("_language")))
    is_own, is_language = F.col("own_rows") >= least_rows, F.col("language_rows") >= least_rows
    limits = F.when(is_own, F.col("own_limits")).when(is_language, F.col("language_limits"))
    return joined.select(
        language,
        source,
        (limits.otherwise(all_limits) if everything else limits).alias("limits"),
        F.when(is_own, "source").when(is_language, "language").otherwise("all").alias("level"),
    )


def judged(rows: DataFrame, f: str, limits: DataFrame, language: str, source: str, verdict: str) -> DataFrame:
    """``rows`` with the column ``verdict``: true where the fixed rules and all limits hold.

    Limits have one row per language and source; the planner sees their real size and broadcasts
    them only if small, else frequent pairs can be split.
    """
    right = limits.select(F.col(language).alias("_language"), F.col(source).alias("_source"), F.col("limits").alias("_limits"))
    on = F.col(language).eqNullSafe(F.col("_language")) & F.col(source).eqNullSafe(F.col("_source"))
    fits = ~base_failed(f)
    for name, (_, _, _, low, _) in MEASURES.items():
        value, limit = measure(f, name), F.col("_limits")[name]
        fits = fits & (value <= limit["most"])
        if low:
            fits = fits & (value >= limit["least"])
    # a row that the fixed rules fail may have no limits: false and null is false
    return rows.join(right, on, "left").withColumn(verdict, fits).drop("_language", "_source", "_limits")


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    source_column: str = "source",
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """One row per document: doc_id, the features, base_failed and kept.

    A null or empty text has all counts 0 and fails. Null languages and sources form groups of
    their own. Repeated rows are judged alike, each in its row; an empty table gives no rows; other
    columns are not looked at. Texts are read once and never shuffled.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(language_column).alias("lang"), F.col(source_column).alias("source"), F.col(text_column).alias("text")
    )
    counted = cut(with_features(rows, "f", keep_text=False))
    limits = cut(thresholds(cut(sketch(counted, "f", ["lang", "source"])), "lang", "source", least_rows))
    return judged(counted, "f", limits, "lang", "source", "kept").select("doc_id", "f.*", base_failed("f").alias("base_failed"), "kept")


def keep_good(
    docs: DataFrame, text_column: str = "text", language_column: str = "lang", source_column: str = "source", least_rows: int = LEAST_ROWS
) -> DataFrame:
    """The rows of ``docs`` that are kept, in its columns. Texts are read twice and not shuffled,
    unless the table of limits is too large to broadcast."""
    f, verdict = fresh(docs, "quality_features"), fresh(docs, "quality_verdict")
    counted = with_features(docs.select(*dict.fromkeys([language_column, source_column, text_column])), f, text_column, keep_text=False)
    limits = cut(thresholds(cut(sketch(counted, f, [language_column, source_column])), language_column, source_column, least_rows))
    return judged(with_features(docs, f, text_column), f, limits, language_column, source_column, verdict).where(F.col(verdict)).select(*docs.columns)


def _measure_sql(name: str) -> str:
    top, below, scale, _, _ = MEASURES[name]
    return f"coalesce({scale} * {top} // nullif({below}, 0), 0)"


def _quality_sql() -> str:
    """The same rows in DuckDB SQL."""
    values = " union all ".join(f"select lang, source, '{m}' as measure, {_measure_sql(m)} as value from featured where not base_failed" for m in MEASURES)
    slack = "case measure " + " ".join(f"when '{m}' then {v[4]}" for m, v in MEASURES.items()) + " end"

    def limits(name: str, groups: str) -> str:
        by = f"{groups}, measure" if groups else "measure"
        out = f"{groups}, " if groups else ""
        return f"""
{name}_ranked as (
    select {out}measure, bucket, sum(n) as n, sum(sum(n)) over (partition by {by} order by bucket) as upto, sum(sum(n)) over (partition by {by}) as total
    from counted group by {by}, bucket),
{name}_quartiles as (
    select {out}measure, any_value(total) as total,
        min(case when 4 * upto >= total then start end) as q1, min(case when 4 * upto >= 3 * total then start end) as q3
    from (select *, (bucket % 64) << (bucket // 64)::int as start from {name}_ranked) group by {by}),
{name}_limits as (
    select {out}measure, total, q1 - greatest({slack}, {REACH} * (q3 - q1)) as least, q3 + greatest({slack}, {REACH} * (q3 - q1)) as most
    from {name}_quartiles)"""

    checks = " and ".join(
        f"{_measure_sql(m)} <= max(case when measure = '{m}' then most end)"
        + (f" and {_measure_sql(m)} >= max(case when measure = '{m}' then least end)" if v[3] else "")
        for m, v in MEASURES.items()
    )
    return f"""
with d as (select row_number() over () as row_id, doc_id, lang, source, coalesce(text, '') as t from documents),
w as (
    select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as words,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
    from d),
windows as (
    select row_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') as win
    from (select row_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from w where len(words) >= {WINDOW})),
twice as (select row_id, i from (select *, count(*) over (partition by row_id, win) as n from windows) where n > 1),
repeated as (
    select row_id, count(distinct p) as n_repeat_words from (select row_id, unnest(range(i, i + {WINDOW})) as p from twice) group by row_id),
featured as (
    select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words as base_failed
    from (
        select w.row_id, doc_id, lang, source, len(words)::bigint as n_words,
            coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
            coalesce(n_repeat_words, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines
        from w left join repeated on w.row_id = repeated.row_id)),
measured as ({values}),
counted as (
    select lang, source, measure, greatest(length(bin(value)) - 6, 0) * 64 + (value >> greatest(length(bin(value)) - 6, 0)::int) as bucket, count(*) as n
    from measured group by all),
{limits("own", "lang, source")},
{limits("lang", "lang")},
{limits("every", "")},
chosen as (
    select o.lang, o.source, o.measure,
        case when o.total >= {LEAST_ROWS} then o.least when l.total >= {LEAST_ROWS} then l.least else e.least end as least,
        case when o.total >= {LEAST_ROWS} then o.most when l.total >= {LEAST_ROWS} then l.most else e.most end as most
    from own_limits o
    join lang_limits l on o.lang is not distinct from l.lang and o.measure = l.measure
    join every_limits e on o.measure = e.measure),
verdicts as (
    select row_id, {checks} as fits
    from featured f join chosen c on f.lang is not distinct from c.lang and f.source is not distinct from c.source
    group by row_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, not base_failed and coalesce(fits, false) as kept
from featured left join verdicts on featured.row_id = verdicts.row_id"""


QUALITY_SQL = _quality_sql()
