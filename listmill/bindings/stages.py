"""The stages themselves over orders and lines in the roles of entities, listings and fees."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.bindings.registry import query
from listmill.bindings.tables import CONFIG, LINE_ORDER, SQL_LINE_ORDER, case, rates, sql_mentions, table
from listmill.engine import cut, load
from listmill.functions.labels import is_counted
from listmill.functions.places import UNKNOWN
from listmill.operators import history, predicates
from listmill.operators.fees import fee_range
from listmill.operators.survivors import refresh_ranges
from listmill.plans import audit as qa
from listmill.plans import consolidate, marts, reading
from listmill.schemas import ENTITIES, FEES, LISTINGS
from listmill.sources import answers

# ---------------------------------------------------------------- fees of listings

#: Whole amounts up to 6,600, as a page shows them.
_AMOUNT = "round(l_extendedprice / 1600) * 100"
_LISTED = f"""
with lines as (select l_orderkey as e, l_linestatus as source, l_returnflag as r, {_AMOUNT} as a from lineitem),
shown as (select distinct e, source, a from lines where r <> 'R'),
given as (
    select e, source, a, e % 3 = 0 as later, row_number() over (partition by e, source, a) as rep from lines),
judged as (
    select g.e, g.source, case when later then a + 1 else a end as a, case when later or (e, source) not in (select e, source from shown) then null when rep > 1 then 'duplicate'
        when a <= 0 or a > 6000 then 'implausible' when shown.a is null then 'not_found' else 'verified' end as status
    from given g left join shown using (e, source, a)),
replaced as (
    select * from judged where status is distinct from 'duplicate'
    union all select o_orderkey, 'homepage', 77.0, 'verified' from orders
    union all select o_orderkey, 'F', 55.0, 'verified' from orders where o_orderkey not in (select e from given where source = 'F'))"""


def _listed_fees(spark, d):
    """Listings that bring fees: one per order and line status, with the page's text; each third order has a
    later one of the same source, with other amounts and no text."""
    lines = load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("entity_id"), F.col("l_linestatus").alias("source"), "l_returnflag", F.expr(_AMOUNT).alias("amount")
    )
    nothing = F.lit(None).cast("string")

    def fee(amount):
        return F.struct(F.lit("Author").alias("category"), nothing.alias("tier"), amount.alias("amount"), F.lit("USD").alias("currency"), nothing.alias("notes"))

    shown = F.concat(F.lit("Author fee USD "), F.format_number("amount", 0))
    given = lines.groupBy("entity_id", "source").agg(
        F.sort_array(F.collect_list(fee(F.col("amount")))).alias("fees"),
        F.sort_array(F.collect_list(fee(F.col("amount") + 1))).alias("later"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("l_returnflag") != "R", shown))), "\n").alias("text"),
    )
    number = F.col("entity_id") * 10 + case("source", {"F": "1"}, "2").cast("bigint")
    first = F.struct(number.alias("id"), F.to_json(F.struct("fees", F.col("text").alias("register_page_text"))).alias("extra"))
    later = F.when(F.col("entity_id") % 3 == 0, F.struct((number + 5).alias("id"), F.to_json(F.struct(F.col("later").alias("fees"))).alias("extra")))
    listed = given.select("entity_id", "source", F.explode(F.array_compact(F.array(first, later))).alias("l"))
    return table(spark, LISTINGS, listed.select("entity_id", "source", "l.*"))


@query(_LISTED + """
select e as id, source, coalesce(status, 'unchecked') as status, count(*) as n, sum(a) as total, min(lo) as fee_min, max(hi) as fee_max
from replaced left join (select e as i, min(a) as lo, max(a) as hi from replaced where status is null or status = 'verified' group by 1) on i = e
group by all""")
def source_fee_copy(spark, d):
    """Fees that came with listings take the place of what their source had in the entity; ranges follow."""
    stored = load(spark, d, "orders", "o_orderkey").select(
        F.explode(F.array(
            F.struct((F.col("o_orderkey") * 10).alias("id"), F.col("o_orderkey").alias("entity_id"), F.lit("homepage").alias("source"), F.lit(77.0).alias("amount")),
            F.struct((F.col("o_orderkey") * 10 + 1).alias("id"), F.col("o_orderkey").alias("entity_id"), F.lit("F").alias("source"), F.lit(55.0).alias("amount")),
        )).alias("f")
    ).select("f.*", F.lit("USD").alias("currency"), F.lit("verified").alias("check_status"))
    fees = consolidate.replace_source_fees(_listed_fees(spark, d), table(spark, FEES, stored))
    entities = table(spark, ENTITIES, load(spark, d, "orders", "o_orderkey").select(F.col("o_orderkey").alias("id")))
    ranged = refresh_ranges(entities, fees).select("id", "fee_min", "fee_max")
    status = F.coalesce("check_status", F.lit("unchecked")).alias("status")
    per = fees.groupBy(F.col("entity_id").alias("id"), "source", status).agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    return per.join(ranged.hint("merge"), "id")


# ---------------------------------------------------------------- stored fees, checked again

_STORED = f"""
with lines as (select l_orderkey as e, l_linestatus as c, l_returnflag as r, {_AMOUNT} as a from lineitem),
texts as (select e as id, string_agg(distinct 'Author fee USD ' || format('{{:,}}', a::bigint), chr(10) order by 'Author fee USD ' || format('{{:,}}', a::bigint)) as t
    from lines where r <> 'R' group by 1),
shown as (select distinct e, a from lines where r <> 'R'),
fees as (select *, row_number() over (partition by e, c, a order by r) as rep from lines where e % 7 <> 0),
judged as (
    select f.e, c, f.a, case when t.id is null then 'stored' when rep > 1 then 'duplicate' when f.a <= 0 or f.a > 6000 then 'implausible'
        when s.a is null then 'not_found' else 'verified' end as status
    from fees f left join texts t on t.id = f.e left join shown s on s.e = f.e and s.a = f.a),
kept as (select * from judged where status <> 'duplicate'),
counts as (
    select e, count(*) as n, count(*) filter (status = 'not_found') as missing, count(*) filter (status = 'implausible') as odd,
        bool_or(status = 'verified') as good, min(a) filter (status = 'verified') as lo, max(a) filter (status = 'verified') as hi
    from kept group by e),
{sql_mentions("texts")},
first_mention as (select id, arg_min(snippet, i) as snippet from mentions group by id),
notes as (
    select o_orderkey as id, case o_orderstatus when 'F' then 'enriched' when 'O' then 'needs_review' else 'collected' end as status, t is not null as read,
        coalesce(n, 0) as n, coalesce(good, false) as good, lo, hi,
        nullif(concat_ws('; ', case when missing > 0 then missing || ' of ' || n || ' fees not found on the page' end,
            case when odd > 0 then odd || ' of ' || n || ' fees implausible' end), '') as said,
        case when snippet is not null then '{fv.NOTE_MISSED}, e.g. "' || substr(snippet, 1, 160) || '"' end as missed
    from orders left join texts on texts.id = o_orderkey left join counts on e = o_orderkey left join first_mention m on m.id = o_orderkey)"""


@query(_STORED + f"""
select id, case when read and n > 0 and status in ('enriched', 'needs_review') then case when good then 'enriched' else 'needs_review' end
    when read and n = 0 and missed is not null then 'needs_review' else status end as status,
  case when read and n > 0 and status in ('enriched', 'needs_review')
      then case when good then said else coalesce(missed, '{fv.NOTE_UNVERIFIED}' || coalesce(said, 'see the fee checks')) end
    when read and n = 0 then coalesce(missed, '{fv.NOTE_NOT_PUBLISHED}') else '{fv.NOTE_MISSED}' end as note,
  case when read then lo end as fee_min, case when read then hi end as fee_max
from notes""")
def revalidated_fees(spark, d):
    """Stored fees against their page's text once more: repeats go, statuses, notes and ranges follow; orders
    without fees are asked for prices that were missed."""
    # numbered lines and texts are read several times: stored once, they are sorted and gathered once
    lines = cut(load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("entity_id"), F.col("l_linestatus").alias("category"), "l_returnflag", F.expr(_AMOUNT).alias("amount"),
        (F.col("l_orderkey") * 1000 + F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))).alias("number"),
    ))
    shown = F.concat(F.lit("Author fee USD "), F.format_number("amount", 0))
    texts = cut(lines.where("l_returnflag <> 'R'").groupBy("entity_id").agg(F.array_join(F.sort_array(F.collect_set(shown)), "\n").alias("text")))
    fees = table(spark, FEES, lines.where("entity_id % 7 <> 0").select(
        F.col("number").alias("id"), "entity_id", "category", "amount", F.lit("USD").alias("currency"), F.lit("homepage").alias("source"), F.lit("not_found").alias("check_status")
    ))
    entities = table(spark, ENTITIES, load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), case("o_orderstatus", {"F": "enriched", "O": "needs_review"}, "collected").alias("status"), F.lit(fv.NOTE_MISSED).alias("review_note")
    ))
    done, _ = reading.revalidate(entities, fees, texts)
    return done.select("id", "status", F.col("review_note").alias("note"), "fee_min", "fee_max")


# ---------------------------------------------------------------- overview

_COUNTRY = "case o_orderkey % 5 when 0 then 'Japan' when 1 then 'Italy' when 2 then 'japan' when 3 then 'Atlantis' end"
_CONTINENT = f"case o_orderkey % 5 when 0 then 'Asia' when 1 then 'Europe' when 2 then 'Asia' else '{UNKNOWN}' end"


def _overview(spark, d):
    """Orders as entities, of which those above a price have a fee; events as listings of users."""
    entities = table(spark, ENTITIES, load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.expr(_COUNTRY).alias("country"),
        F.when(F.col("o_totalprice") > 1e5, F.col("o_totalprice")).alias("fee_min"),
    ))
    listings = table(spark, LISTINGS, load(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.when(F.col("value") > 1, F.col("user_id")).alias("entity_id"),
        (F.col("value") > 50).alias("in_window"), F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 3 == 1).alias("is_topic"),
    ))
    return marts.summary(entities, listings, CONFIG)


@query(f"""
with e as (select o_orderstatus as status, {_CONTINENT} as continent, o_totalprice > 1e5 as fee from orders),
l as (select event_type, case when value > 1 then user_id end as entity, value > 50 as inside, event_id % 3 = 1 as topic from events)
select 'entities_by_status' as section, status as item, count(*)::bigint as n from e group by 2
union all select 'entities_by_continent', continent, count(*) from e group by 2
union all select 'scope', 'entities', count(*) from e where continent = 'Asia'
union all select 'scope', 'entities_with_fees', count(*) from e where continent = 'Asia' and fee
union all select 'entities_with_fees', 'all', count(*) from e where fee
union all select 'listings_by_source', event_type, count(*) from l group by 2
union all select 'entities_by_source', event_type, count(distinct entity) from l where entity is not null group by 2
union all select 'listings', 'in_window', count(*) from l where inside
union all select 'listings', 'in_window_topic', count(*) from l where inside and topic""")
def summary_counts(spark, d):
    """All counts of the overview, each table read once."""
    return _overview(spark, d)


def _section(spark, d, section, name):
    return _overview(spark, d).where(F.col("section") == section).select(F.col("item").alias(name), "n")


@query("select event_type as source, count(*) as n from events group by event_type")
def listings_by_source(spark, d):
    return _section(spark, d, "listings_by_source", "source")


@query("select event_type as source, count(distinct user_id) as n from events where value > 1 group by event_type")
def entities_by_source_distinct(spark, d):
    return _section(spark, d, "entities_by_source", "source")


@query("select o_orderstatus as status, count(*) as n from orders group by 1")
def entities_by_status(spark, d):
    return _section(spark, d, "entities_by_status", "status")


# ---------------------------------------------------------------- audit

_LETTERS = "translate(cast(o_custkey as varchar), '0123456789', 'ABCDEFGHIJ')"
_STATE = f"""
numbered as (select *, row_number() over (partition by l_orderkey order by {SQL_LINE_ORDER}) as rn from lineitem),
f as (
    select l_orderkey as e, l_orderkey * 1000 + rn as id, l_returnflag as cat, l_linestatus as tier, case when l_quantity = 1 then 0.0 else round(l_extendedprice / 16) end as a,
        case when l_quantity <> 2 then 'USD' end as cur, l_quantity = 3 as unpriced
    from numbered where l_linestatus = 'O' or l_returnflag <> 'R'),
per as (select e, cur, count(*) as n, min(a) as lo, max(a) as hi, min(id) as first from f group by e, cur),
best as (select * from per qualify row_number() over (partition by e order by n desc, first) = 1),
o as (
    select o_orderkey as id, 'K' || {_LETTERS} as acronym, case when o_orderkey % 50 > 0 then o_orderdate::date end as s, o_orderdate::date as d, o_orderkey % 40 - 1 as days,
        o_orderstatus as st, lo, hi, cur, best.e is not null as has, {_COUNTRY} as country, {_CONTINENT} as continent, o_totalprice
    from orders left join best on best.e = o_orderkey),
l as (select id, '#' || id || ' ' || acronym as label, * exclude (id) from o),
shown as (select * from l where id % 3 > 0)"""
_OUT = "(s is not null and not s between date '1997-01-01' and date '1997-12-31')"
_FEE_LABEL = "concat_ws(' ', '#' || e, cat, a::varchar, cur)"
#: Check: the failures as (ord, example).
_FAILURES = {
    "ends before it starts": "select id, label from l where s is not null and days < 0",
    "starts outside the window": f"select id, label from l where {_OUT}",
    "no start date": "select id, label from l where s is null",
    "lasts more than 3 weeks": "select id, label from l where s is not null and days > 21",
    "submission deadline after the start": "select id, label || ' paper_deadline' from l where s is not null and id % 45 = 1 union all select id, label || ' abstract_deadline' from l where s is not null and id % 60 = 2",
    "paper deadline before 2025": "select id, label from l",
    "counted fee with zero or negative amount": f"select id, {_FEE_LABEL} from f where a <= 0",
    "counted fee without a currency": f"select id, {_FEE_LABEL} from f where cur is null",
    "counted fee outside US$3-6,000": f"select id, {_FEE_LABEL} from f where cur is not null and not a between 3 and 6000",
    "the same fee twice": f"select e, {_FEE_LABEL} from f group by e, cat, tier, a, cur having count(*) > 1",
    "fee range disagrees with the counted fees": "select id, label from l where id % 11 = 0",
    "enriched with no counted fee": "select id, label from l where st = 'F' and not has",
    "not published but has counted fees": "select id, label from l where st = 'P' and has",
    "never read": "select id, label from l where st = 'O' and id % 9 <> 2",
    "likely duplicates": "select id, label from (select *, lag(s) over w as ps, lag(coalesce(country, '')) over w as pc from l where s is not null window w as (partition by acronym, continent order by s, id)) where s - ps <= 7 and lower(pc) = lower(coalesce(country, ''))",
    "homepage that isn't a web address": "select id, label from l where id % 9 = 1",
    "listing not merged": "select event_id, event_type || ' ' || user_id from events where event_id % 100 = 0 and value > 50",
    "account details published": "select id, 'p' || (id % 7) || '@x.org' from shown where id % 97 = 5",
    "person id in a published link": "select id, '#' || id from shown where id % 89 = 7",
    "published outside the window": f"select id, '#' || id from shown where {_OUT}",
    "published without a fee status": "select id, '#' || id from shown where id % 83 = 8",
    "headline fee not among its fees": "select id, '#' || id from shown where has and cur is not null and id % 79 = 10",
    "published fee not convertible": "select f.id, '#' || f.id from f where unpriced and cur is not null and e % 3 > 0",
    "weeks don't add up": f"select 0, (n + 1)::bigint || ' vs ' || n from (select count(*) as n from shown where s is not null and not {_OUT})",
}


@query(f"""
with {_STATE},
failures as ({' union all '.join(f'''select '{c.replace("'", "''")}' as c, ord::varchar as ord, ex from ({q}) as x(ord, ex)''' for c, q in _FAILURES.items())}),
names as (select unnest([{', '.join("{'c': '" + c.replace("'", "''") + f"', 'must': {str(m).lower()}}}" for c, m in qa.CHECKS.items())}], recursive := true)),
few as (select *, row_number() over (partition by c order by ord, ex) as rn from failures)
select names.c as "check", must as must_be_zero, count(few.c) as failures, coalesce(string_agg(ex, '; ' order by ord, ex) filter (rn <= 4), '') as examples,
  case when count(few.c) = 0 then 'ok' when must then 'FAIL' else 'note' end as verdict
from names left join few on few.c = names.c group by 1, 2""")
def audit_all_checks(spark, d):
    """Every check of the audit over orders, lines and events with planted faults."""
    line = load(spark, d, "lineitem").withColumn("rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)))
    fees = cut(table(spark, FEES, line.select(
        (F.col("l_orderkey") * 1000 + F.col("rn")).alias("id"), F.col("l_orderkey").alias("entity_id"), F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("tier"),
        F.when(F.col("l_quantity") == 1, 0.0).otherwise(F.round(F.col("l_extendedprice") / 16)).alias("amount"), F.when(F.col("l_quantity") != 2, "USD").alias("currency"),
        F.when(F.col("l_linestatus") != "O", F.when(F.col("l_returnflag") == "R", "not_found").otherwise("verified")).alias("check_status"),
        F.when(F.col("l_quantity") == 3, "unpriced").alias("notes"),
    )))
    o = load(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date")).withColumn("acronym", F.concat(F.lit("K"), F.expr(_LETTERS.replace("varchar", "string"))))
    key = F.col("o_orderkey")
    start = F.when(key % 50 > 0, F.col("day"))
    ranges = fee_range(fees.where(is_counted(F.col("check_status"))), "entity_id")
    best = ranges.select(F.col("entity_id").alias("o_orderkey"), "fee_min", "fee_max", "currency").hint("merge")
    entities = cut(table(spark, ENTITIES, o.join(best, "o_orderkey", "left").select(
        key.alias("id"), "acronym", start.alias("start_date"), F.date_add("day", (key % 40 - 1).cast("int")).alias("end_date"), F.expr(_COUNTRY).alias("country"),
        F.when(key % 45 == 1, F.date_add("day", 1)).otherwise(F.date_sub("day", 30)).alias("paper_deadline"), F.when(key % 60 == 2, F.date_add("day", 1)).alias("abstract_deadline"),
        case("o_orderstatus", {"F": "enriched", "O": "collected"}, "needs_review").alias("status"), F.when(F.col("o_orderstatus") == "P", fv.NOTE_NOT_PUBLISHED).alias("review_note"),
        F.when(key % 9 == 1, "ftp//x").when(key % 9 == 2, f"https://{next(iter(fv.FLAGGED_HOSTS))}/a").otherwise("https://h.org/").alias("homepage"),
        F.when(key % 11 == 0, F.coalesce("fee_min", F.lit(0.0)) + 1).otherwise(F.col("fee_min")).alias("fee_min"), "fee_max", "currency",
    )))
    listings = table(spark, LISTINGS, load(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("source_id"),
        F.when(F.col("event_id") % 100 > 0, F.col("user_id")).alias("entity_id"), F.lit(True).alias("in_window"), (F.col("value") > 50).alias("is_topic"),
    ))
    shown = cut(o.where("o_orderkey % 3 > 0").join(best, "o_orderkey", "left").select(
        key.alias("id"), start.alias("start_date"), F.when(key % 83 != 8, "Fees found").alias("fee_status"), F.lit(None).cast("string").alias("organizer_flag"),
        F.when(key % 97 == 5, F.concat(F.lit("mail p"), (key % 7).cast("string"), F.lit("@x.org"))).alias("description"),
        F.when(key % 89 == 7, "https://edas.info/r.php?c=1&p=5").alias("registration_url"),
        F.when(F.col("currency").isNotNull(), F.struct((F.col("fee_max") + F.when(key % 79 == 10, 0.5).otherwise(0)).alias("amount"), "currency")).alias("standard_fee"),
    ))
    counted = fees.where(is_counted(F.col("check_status")) & (F.col("entity_id") % 3 > 0))
    shown_fees = counted.select("id", "entity_id", "amount", "currency", F.when(F.col("notes").isNull(), F.col("amount")).alias("amount_usd"))
    inside = F.col("start_date").between(CONFIG.window_start, CONFIG.window_end)
    weeks = shown.agg((F.count_if(inside) + 1).alias("total"))
    details = load(spark, d, "supplier", "s_suppkey").where("s_suppkey < 7").select(F.lit("email").alias("kind"), F.concat(F.lit("p"), F.col("s_suppkey").cast("string"), F.lit("@x.org")).alias("value"))
    out = qa.audit(entities, fees, listings, rates(spark), {"entities": shown, "fees": shown_fees, "weeks": weeks}, details, CONFIG, everything=True)
    return out.withColumn("examples", F.array_join("examples", "; "))


# ---------------------------------------------------------------- reads of pages

@query(_STORED + f"""
select id, case when not fresh then status when n = 0 or good then 'enriched' else 'needs_review' end as status,
  case when not fresh then 'before' when n = 0 then null when good then said else coalesce(missed, '{fv.NOTE_UNVERIFIED}' || coalesce(said, 'see the fee checks')) end as note,
  case when fresh and n > 0 then lo else 77.0 end as fee_min, case when fresh and n > 0 then hi else 77.0 end as fee_max
from (select *, read and id % 5 > 0 as fresh from notes)""")
def applied_reads(spark, d):
    """Answers about pages, applied: their fees replace the stored ones of the page and are checked against its
    text; a text that was read before changes nothing."""
    lines = load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("entity_id"), F.col("l_linestatus").alias("category"), "l_returnflag", F.expr(_AMOUNT).alias("amount")
    )
    shown = F.concat(F.lit("Author fee USD "), F.format_number("amount", 0))
    nothing = F.lit(None).cast("string")
    fee = F.struct("category", nothing.alias("tier"), "amount", F.lit("us$").alias("currency"), nothing.alias("notes"))
    pages = lines.groupBy("entity_id").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("l_returnflag") != "R", shown))), "\n").alias("text"),
        F.sort_array(F.collect_list(F.when(F.col("entity_id") % 7 != 0, fee))).alias("fees"),
    ).where("text <> ''")
    said = F.to_json(F.struct(F.lit(True).alias("fees_published"), "fees"))
    reads = pages.select(
        "entity_id", "text", F.sha2("text", 256).alias("fingerprint"), (F.col("entity_id") % 5 == 0).alias("unchanged"),
        nothing.alias("note"), F.lit("2026-09-01").cast("timestamp").alias("read_at"), said.alias("answer"),
    )
    reads = answers.extracted_records(reads)[0].drop("answer")
    order = load(spark, d, "orders")
    entities = table(spark, ENTITIES, order.select(
        F.col("o_orderkey").alias("id"), case("o_orderstatus", {"F": "enriched", "O": "needs_review"}, "collected").alias("status"), F.lit("before").alias("review_note"),
        F.lit(77.0).alias("fee_min"), F.lit(77.0).alias("fee_max"), F.lit("USD").alias("currency"),
    ))
    stored = table(spark, FEES, order.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("entity_id"), F.lit(77.0).alias("amount"), F.lit("USD").alias("currency"),
        F.lit("homepage").alias("source"), F.lit("verified").alias("check_status"),
    ))
    done, _ = reading.apply_reads(entities, stored, table(spark, LISTINGS, spark.createDataFrame([], "id bigint")), reads)
    return done.select("id", "status", F.col("review_note").alias("note"), "fee_min", "fee_max")


# ---------------------------------------------------------------- searches and nested rows

@query(f"""
select o_orderkey as id, o_orderstatus as status, cast(cast(o_orderdate as date) as varchar) as start_date from orders
where cast(o_orderdate as date) between date '1996-01-01' and date '1998-12-31' and o_orderstatus = 'F' and {_CONTINENT} = 'Asia' and o_totalprice > 1e5
  and exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'N')
order by cast(o_orderdate as date), o_orderkey limit 100 offset 20""")
def search_entities(spark, d):
    """Status, fee, source, continent and date filters run before the page is cut."""
    entities = table(spark, ENTITIES, load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("start_date"),
        F.expr(_COUNTRY).alias("country"), F.when(F.col("o_totalprice") > 1e5, F.col("o_totalprice")).alias("fee_min"),
    ))
    listings = table(spark, LISTINGS, load(spark, d, "lineitem").select(F.col("l_orderkey").alias("entity_id"), F.col("l_returnflag").alias("source")))
    span = predicates.DateRange(starts_from=dt.date(1996, 1, 1), starts_to=dt.date(1998, 12, 31))
    found = marts.search_entities(entities, listings, status="F", has_fees=True, continent="asia", source="N", dates=span, limit=100, offset=20)
    return found.select("id", "status", F.col("start_date").cast("string").alias("start_date"))


@query("select p_partkey as id, p_name as name from part where p_name ilike '%RING%' or p_brand ilike '%RING%' order by p_partkey limit 50")
def search_substring(spark, d):
    listings = table(spark, LISTINGS, load(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("acronym")
    ))
    return marts.search_listings(listings, q="RING").select("id", "name")


@query("""
select c_custkey as id, coalesce(ids, '') as children, coalesce(n, 0) as n_listings from customer
left join (select o_custkey, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as ids from orders group by 1) o on c_custkey = o_custkey
left join (select user_id, count(*) as n from events group by 1) e on user_id = c_custkey""")
def nested_children(spark, d):
    """Customers with their orders as fees and their events as listings."""
    entities = table(spark, ENTITIES, load(spark, d, "customer").select(F.col("c_custkey").alias("id")))
    fees = table(spark, FEES, load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("entity_id")))
    listings = table(spark, LISTINGS, load(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("entity_id")))
    ids = F.array_join(F.transform("fees", lambda f: f["id"].cast("string")), ",")
    n = F.coalesce(F.size("listings"), F.lit(0))
    return marts.nested(entities, fees, listings).select("id", F.coalesce(ids, F.lit("")).alias("children"), F.greatest(n, F.lit(0)).cast("bigint").alias("n_listings"))


# ---------------------------------------------------------------- earlier editions

_SERIES = "concat('Quantum Garden ', translate(cast(o_custkey as string), '0123456789', 'ABCDEFGHIJ'), ' Walks')"


@query("""
with items as (
    select o_custkey as id, 1970 + o_orderkey % 29 as year, o_orderkey % 2 as answer, o_orderkey as pos, 'P' || o_orderkey % 3 as publisher
    from orders where o_orderkey % 5 > 0 and not (o_custkey % 2 = 0 and o_orderkey % 5 = 1)),
one as (select * from items qualify row_number() over (partition by id, year order by answer, pos) = 1),
top as (select * from one qualify row_number() over (partition by id order by year desc) <= 12),
listed as (
    select id, max(year) as newest, string_agg(year::varchar, ',' order by year desc) as years, string_agg(distinct publisher, ',' order by publisher) as publishers
    from top group by id)
select c_custkey as id, coalesce(years, '') as years, coalesce(publishers, '') as publishers, coalesce(newest >= 1996, false) as has_history,
  case when newest < 1996 then 'only editions up to ' || newest || ' were found: probably another series with the same name' end as note
from customer left join listed on listed.id = c_custkey""")
def edition_history(spark, d):
    """Items that answer for a customer's series, by acronym or by name; the newest twelve years count."""
    series = F.expr(_SERIES)
    entities = load(spark, d, "customer").select(F.col("c_custkey").alias("id")).withColumn("o_custkey", F.col("id")).select(
        "id", series.alias("name"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("K"), F.expr(_LETTERS.replace("varchar", "string")))).alias("acronym"), F.lit("2000-05-01").cast("date").alias("start_date")
    )
    key = F.col("o_orderkey")
    own = F.concat(series, F.lit(" (K"), F.expr(_LETTERS.replace("varchar", "string")), F.lit(")"))
    named = F.when(key % 5 == 0, "Entirely different matters").when((F.col("o_custkey") % 2 == 0) & (key % 5 == 1), F.concat(series, F.lit(" (OTHER)"))).otherwise(own)
    items = load(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), (key % 2).cast("int").alias("answer"), key.cast("int").alias("pos"), F.array(F.lit("Proceedings of nothing"), named).alias("names"),
        (1970 + key % 29).cast("int").alias("year"), F.concat(F.lit("P"), (key % 3).cast("string")).alias("publisher"), key.cast("string").alias("doi"),
    )
    records = history.history_records(entities, history.editions(entities, items)).select("id", "history.*")
    years = F.array_join(F.transform("editions", lambda e: e["year"].cast("string")), ",")
    return records.select("id", years.alias("years"), F.array_join("publishers", ",").alias("publishers"), "has_history", "note")
