"""The supplied tables in the roles the operators expect."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.config import EngineConfig
from listmill.engine import load
from listmill.fixed_values import FEE_WORDS, NOT_A_FEE, PRICE

CONFIG = EngineConfig(window_start=dt.date(1997, 1, 1), window_end=dt.date(1997, 12, 31))
RATES = {"USD": 1.0, "EUR": 0.83, "GBP": 0.77, "PHP": 56.31}
# the order of an order's lines; rows equal in all of it are the same row
LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
SQL_LINE_ORDER = ", ".join(LINE_ORDER)
SQL_ISO = "case l_returnflag when 'A' then 'USD' when 'N' then 'EUR' else 'GBP' end"
SQL_CATEGORY = "case l_returnflag when 'A' then 'Non-IEEE Member' when 'N' then 'IEEE Member' else 'Student Author' end"
SQL_TIER = "case l_linestatus when 'F' then 'regular' else 'early' end"
SQL_RATE = "case l_returnflag when 'A' then 1.0::double when 'N' then 0.83::double else 0.77::double end"


def sql_cents(value: str) -> str:
    """Half-even rounding of a double's shortest decimal form, as Spark rounds it."""
    return f"round_even(cast(cast({value} as varchar) as decimal(38, 14)), 2)::double"


def case(column: str, pairs: dict[str, str], other: str | None = None) -> Column:
    out = F.lit(other)
    for key, value in pairs.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(RATES,)], "rates map<string,double>")


def orders(spark: SparkSession, d: str) -> DataFrame:
    """Entities: id, customer, status, start_date."""
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )


def fees(spark: SparkSession, d: str) -> DataFrame:
    """Fees: one per line, with the order column ``id`` (a struct)."""
    return load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("entity_id"),
        F.struct(*LINE_ORDER).alias("id"),
        case("l_returnflag", {"A": "Non-IEEE Member", "N": "IEEE Member"}, "Student Author").alias("category"),
        case("l_linestatus", {"F": "regular"}, "early").alias("tier"),
        F.lit(None).cast("string").alias("notes"),
        F.col("l_extendedprice").alias("amount"),
        case("l_returnflag", {"A": "US$", "N": "EURO"}, "GBP").alias("currency"),
        case("l_linestatus", {"F": "verified"}).alias("check_status"),
        "l_returnflag",
        "l_quantity",
    )



def table(spark: SparkSession, schema: str, rows: DataFrame) -> DataFrame:
    """``rows`` in the columns of a stored table; columns they lack are null."""
    return spark.createDataFrame([], schema).unionByName(rows, allowMissingColumns=True)


def sql_mentions(source: str) -> str:
    """CTEs that end in ``mentions`` (id, i, snippet): the missed prices of ``source`` (id, t), in order."""
    price, words, other = (f"(?i){p}".replace("'", "''") for p in (PRICE, FEE_WORDS, NOT_A_FEE))
    before = lambda a, n: f"coalesce(list_sum(list_transform({a}[1:{n}], lambda x: length(x))), 0)"
    return f"""
priced as (
    select id, replace(t, chr(160), ' ') as t, regexp_extract_all(replace(t, chr(160), ' '), '{price}') as hits,
        string_split_regex(replace(t, chr(160), ' '), '{price}') as gaps
    from {source} where regexp_matches(replace(t, chr(160), ' '), '{price}')),
places as (
    select id, t, i, ({before("gaps", "i")} + {before("hits", "i - 1")})::bigint as a, length(hits[i]) as n
    from (select *, unnest(range(1, len(hits) + 1)) as i from priced)),
price_lines as (
    select *, regexp_extract(substr(t, 1, a), '[^\\n]*$') || substr(t, a + 1, n) || regexp_extract(substr(t, a + n + 1), '^[^\\n]*') as line
    from places),
fee_places as (
    select id, t, i, greatest(a - 70, 0) as lo, least(a + n + 70, length(t)) as hi from price_lines
    where not regexp_matches(line, '{other}') and (regexp_matches(line, '{words}')
        or regexp_matches(substr(t, greatest(a - 160, 0) + 1, a + n + 60 - greatest(a - 160, 0)), '{words}'))),
apart as (
    select * from fee_places
    qualify lo is distinct from lag(lo) over (partition by id order by i) and hi is distinct from lag(hi) over (partition by id order by i)),
mentions as (
    select id, min(i) as i, snippet
    from (select id, i, trim(regexp_replace(substr(t, lo + 1, hi - lo), '\\s+', ' ', 'g')) as snippet from apart) group by id, snippet)"""
