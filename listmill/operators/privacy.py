"""Taking account details out of every text.

Details (person ids, e-mail addresses) are collected from one source's texts. Their number is
not bounded, so they are never turned into one big pattern or sent to the driver: each row is
asked which details it holds by an equi join on the tokens it contains, and only those few are
replaced in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from listmill import fixed_values as fv

# matches begin where a stretch begins, so that a long stretch without "@" is read once
EMAIL = r"(?<![^()\s<>\[\],;\"])[^()\s<>\[\],;\"]+@[^()\s<>\[\],;\"]+"
_AROUND = r"(?<![^)\s@])([^)\s@]++)@(?=([^)\s]+))"


def account_details(texts: DataFrame, text: str) -> DataFrame:
    """(kind, value): the distinct ids and e-mails in the account headers of ``texts``."""
    pattern = F.lit(fv.ACCOUNT_HEADER)
    ids = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(1)),
        lambda v: F.struct(F.lit("id").alias("kind"), v.alias("value")),
    )
    mails = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(2)),
        lambda v: F.struct(F.lit("email").alias("kind"), v.alias("value")),
    )
    return (
        texts.where(F.col(text).contains(fv.ACCOUNT_MARK))
        .select(F.explode(F.concat(ids, mails)).alias("d"))
        .select("d.*")
        .distinct()
    )


def emails_in(texts: DataFrame, text: str) -> DataFrame:
    """(kind, value): every distinct e-mail address in ``texts``."""
    return (
        texts.where(F.col(text).contains("@"))
        .select(F.explode(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))).alias("value"))
        .select(F.lit("email").alias("kind"), "value")
        .distinct()
    )


def _lengths(details: DataFrame) -> Column:
    """The lengths that occur among the values, as one array: a scalar subquery, at most one entry
    per possible length however many details there are."""
    return details.agg(F.collect_set(F.length("value")).alias("n")).scalar()


def _shapes(details: DataFrame) -> Column:
    """The lengths before and behind the first "@" that occur among the addresses, as one array."""
    local = F.length(F.substring_index("value", "@", 1))
    shape = F.struct(local.alias("local"), (F.length("value") - local - 1).alias("rest"))
    return details.where("kind = 'email'").agg(F.collect_set(shape).alias("n")).scalar()


def details_held(rows: DataFrame, key: list[str], text: Column, details: DataFrame) -> DataFrame:
    """(key, held): the details that occur in each row's text, longest first.

    A text is asked for its whole digit runs and, around each "@", for the stretches that are as
    long as some address is. These are looked up whole: addresses that share the part before the
    "@" are different keys, and texts do not travel.
    """
    asked = (
        rows.select(*key, text.alias("_text"))
        .where(F.col("_text").rlike(r"\d|@"))
        .withColumn("_shapes", _shapes(details))
    )
    around = F.lit(_AROUND)
    sides = F.arrays_zip(
        F.regexp_extract_all("_text", around, F.lit(1)).alias("before"), F.regexp_extract_all("_text", around, F.lit(2)).alias("behind")
    )

    def stretches(side: Column) -> Column:
        fitting = F.filter("_shapes", lambda s: (s["local"] <= F.length(side["before"])) & (s["rest"] <= F.length(side["behind"])))
        return F.transform(
            fitting, lambda s: F.concat(F.right(side["before"], s["local"]), F.lit("@"), F.left(side["behind"], s["rest"]))
        )

    digits = F.array_distinct(F.regexp_extract_all("_text", F.lit(r"\d+"), F.lit(0)))
    none = F.array().cast("array<string>")
    addresses = F.when(F.col("_text").contains("@"), F.array_distinct(F.flatten(F.transform(sides, stretches)))).otherwise(none)
    tagged = lambda values, kind: F.transform(
        values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    )
    tokens = asked.select(*key, F.explode(F.concat(tagged(digits, "id"), tagged(addresses, "email"))).alias("t"))
    real = tokens.select(*key, "t.*").join(details.select("kind", "value"), ["kind", "value"])
    one = F.struct((-F.length("value")).alias("n"), "value", "kind")
    return real.groupBy(*key).agg(F.array_sort(F.collect_set(one)).alias("held"))


def scrubbed(text: Column, held: Column) -> Column:
    """The text without footers, the given details and, in marked texts, IP addresses."""
    no_details = F.coalesce(
        held, F.array().cast("array<struct<n:int,value:string,kind:string>>")
    )
    bare = F.when(
        text.contains(fv.FOOTER_MARK),
        F.regexp_replace(text, fv.ACCOUNT_FOOTER, "[user details removed]"),
    ).otherwise(text)
    clean = F.aggregate(
        no_details,
        bare,
        lambda t, d: F.when(
            d["kind"] == "email", F.replace(t, d["value"], F.lit("[account email]"))
        ).otherwise(
            F.regexp_replace(t, F.concat(F.lit(r"(?<!\d)"), d["value"], F.lit(r"(?!\d)")), F.lit("0"))
        ),
    )
    return F.when(
        clean.contains(fv.ACCOUNT_MARK), F.regexp_replace(clean, "(?U)" + fv.IP_ADDRESS, "[ip]")
    ).otherwise(clean)


def _deep(value: Column, dtype: DataType, held: Column) -> Column:
    """``value`` with every text inside it scrubbed; other types stay untouched."""
    if isinstance(dtype, StringType):
        return scrubbed(value, held)
    if isinstance(dtype, ArrayType) and _has_text(dtype):
        return F.transform(value, lambda v: _deep(v, dtype.elementType, held))
    if isinstance(dtype, MapType) and _has_text(dtype.valueType):
        return F.transform_values(value, lambda k, v: _deep(v, dtype.valueType, held))
    if isinstance(dtype, StructType) and _has_text(dtype):
        inner = F.struct(
            *[_deep(value[f.name], f.dataType, held).alias(f.name) for f in dtype.fields]
        )
        return F.when(value.isNotNull(), inner)
    return value


def _has_text(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _has_text(dtype.elementType)
    if isinstance(dtype, MapType):
        return _has_text(dtype.valueType)
    if isinstance(dtype, StructType):
        return any(_has_text(f.dataType) for f in dtype.fields)
    return isinstance(dtype, StringType)


def scrub_table(df: DataFrame, key: list[str], details: DataFrame) -> DataFrame:
    """Every text of every column, nested ones included, without account details."""
    texts = [f.name for f in df.schema.fields if _has_text(f.dataType) and f.name not in key]
    whole = F.to_json(F.struct(*texts))
    held = details_held(df, key, whole, details)
    joined = df.join(held, key, "left")
    return joined.select(
        *[
            _deep(F.col(f.name), f.dataType, F.col("held")).alias(f.name)
            if f.name in texts
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def leaks(df: DataFrame, key: list[str], details: DataFrame) -> DataFrame:
    """(key, value): details still present anywhere in a row's texts; must be empty.

    Stricter than scrubbing: an id counts even inside a longer number. Only runs of the lengths
    that occur among the details are cut out and joined.
    """
    texts = [f.name for f in df.schema.fields if _has_text(f.dataType) and f.name not in key]
    whole = df.select(*key, F.to_json(F.struct(*texts)).alias("_text"))
    mails = details_held(whole, key, F.col("_text"), details.where("kind = 'email'")).select(
        *key, F.explode("held.value").alias("value")
    )
    ids = details.where("kind = 'id'")
    cut = F.expr(
        """flatten(transform(filter(_n, n -> n <= length(run)),
             n -> transform(sequence(1, length(run) - n + 1), i -> substring(run, i, n))))"""
    )
    runs = whole.withColumn("_n", _lengths(ids)).select(
        *key, "_n", F.explode(F.regexp_extract_all("_text", F.lit(r"\d+"), F.lit(0))).alias("run")
    )
    found = runs.select(*key, F.explode(F.array_distinct(cut)).alias("value")).join(
        ids.select("value"), "value"
    )
    return mails.unionByName(found.select(*key, "value")).distinct()
