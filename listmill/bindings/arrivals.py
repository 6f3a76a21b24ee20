"""What arrives from outside: JSON answers whose shapes drift, made from the rows of given tables, and counted streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from listmill.bindings.registry import query
from listmill.engine import cut, load, scratch_folder
from listmill.sources import answers, readers


def _result(number: str, quoted: bool = False) -> str:
    """SQL for one search result of an order, as JSON text."""
    mark = "'\"'" if quoted else "''"
    about = """case when o_orderkey % 8 = 4 then '["a"," b ",""]' else '"a; ;b "' end"""
    place = """case when o_orderkey % 8 = 3 then '"Hall  of C' || cast(o_custkey % 10 as string) || '"'
        else '{"city":" C' || cast(o_custkey % 10 as string) || '","region":null,"country":"' || o_orderstatus || '"}' end"""
    return f"""'{{"eventId":' || {mark} || cast({number} as string) || {mark} || ',"eventTitle":"Meeting  on ' || o_orderpriority || ' (E' || cast(o_orderkey % 1000 + 10 as string)
        || ')","startDate":"' || date_format(o_orderdate, 'yyyy-MM-dd') || '","isvirtual":' || case when o_custkey % 3 = 0 then '"Y"' when o_custkey % 3 = 1 then 'true' else 'null' end
        || ',"location":' || {place} || ',"about":' || {about} || '}}'"""


_FIRST, _SECOND = "o_orderkey * 10", "o_orderkey * 10 + 1"
_SEARCH_BODY = f"""case o_orderkey % 8
    when 0 then '{{"entity":{{"totalResults":2,"results":[' || {_result(_FIRST)} || ','
    when 1 then '{{"entity":{{"totalResults":1,"results":' || {_result(_FIRST)} || '}}}}'
    when 2 then '{{"entity":{{"totalResults":"2","results":[' || {_result(_FIRST, True)} || ',' || {_result(_SECOND, True)} || ']}}}}'
    when 5 then case when o_orderkey % 16 = 5 then '{{"entity":"try again later"}}' else '{{"entity":{{"results":7}}}}' end
    when 6 then '{{"entity":{{"results":["gone",' || {_result(_SECOND)} || ',{{"eventTitle":"no id"}},null]}}}}'
    when 7 then case when o_orderkey % 16 = 7 then '{{"entity":null,"extra":1}}' else '{{"entity":{{"totalResults":0,"results":null}}}}' end
    else '{{"entity":{{"totalResults":2,"results":[' || {_result(_FIRST)} || ',' || {_result(_SECOND)} || ']}}}}' end"""


def _search_bodies(spark, d):
    """A response for each order; by its key's last bits broken, of one result, quoted, of plain places, of lists, without rows."""
    return cut(load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_SEARCH_BODY).alias("body")))


@query("""
select o_orderkey as id, case o_orderkey % 8 when 1 then 1 when 6 then 0 else 2 end as total, (o_orderkey * 10 + i)::varchar as source_id,
  'Meeting on ' || o_orderpriority || ' (E' || (o_orderkey % 1000 + 10) || ')' as name, 'E' || (o_orderkey % 1000 + 10) as acronym, o_orderdate::date as start_date,
  case when o_orderkey % 8 = 3 then 'Hall of C' || o_custkey % 10 else 'C' || o_custkey % 10 || ', ' || o_orderstatus end as location_raw,
  case when o_orderkey % 8 <> 3 then 'C' || o_custkey % 10 end as city, case when o_orderkey % 8 <> 3 then o_orderstatus end as country,
  'a|b' as categories, o_custkey % 3 < 2 as virtual
from orders, unnest([0, 1]) u(i)
where o_orderkey % 8 not in (0, 5, 7) and (i = 0 or o_orderkey % 8 <> 1) and (i = 1 or o_orderkey % 8 <> 6)""")
def search_answers(spark, d):
    """Listings of search responses, whatever shape the responses have."""
    rows = answers.search_listings(_search_bodies(spark, d), keep=["id"])
    return rows.select(
        "id", "total", "source_id", "name", "acronym", "start_date", "location_raw", "city", "country",
        F.array_join("categories", "|").alias("categories"), F.get_json_object("extra", "$.virtual").cast("boolean").alias("virtual"),
    )


@query("""
select o_orderkey as id, case o_orderkey % 8 when 0 then 'broken' when 5 then 'shape' else 'result' end as reason, case when o_orderkey % 8 = 6 then 3 else 1 end as n
from orders where o_orderkey % 8 in (0, 5, 6)""")
def search_rejects(spark, d):
    """Responses, and results of responses, that could not be read, by reason."""
    return answers.search_rejects(_search_bodies(spark, d), keep=["id"]).groupBy("id", "reason").agg(F.count("*").alias("n"))


_DETAIL_BODY = """case p_partkey % 6
    when 0 then 'no answer: ' || p_name
    when 1 then '{"entity":{"eventDetail":["' || p_name || '"]}}'
    else '{"entity":{"eventDetail":{"eventId":' || case when p_partkey % 6 = 2 then '"' || cast(p_partkey as string) || '"' else cast(p_partkey as string) end
      || ',"url":' || case when p_partkey % 4 = 0 then '"//p' || cast(p_partkey as string) || '.org/"' when p_partkey % 4 = 1 then '" https://p.org/x"' when p_partkey % 4 = 2 then '"no site"' else 'null' end
      || ',"scope":" ' || p_name || '  and   more ","venues":' || case when p_partkey % 6 = 3 then '[" Hall 1","","Hall ' || cast(p_size as string) || '"]' else '"Hall 1, ,Hall ' || cast(p_size as string) || '"' end
      || ',"eventContact":"  ","keywords":' || case when p_partkey % 6 = 4 then '["' || p_type || '"]' when p_partkey % 6 = 5 then 'null' else '"' || p_type || ', ' || p_brand || '"' end
      || ',"callForPapers":"' || p_brand || '"}}}' end"""


@query("""
with p as (select *, p_partkey % 6 > 1 as ok from part)
select p_partkey as id, case when ok then p_partkey end as event_id,
  case when ok then case p_partkey % 4 when 0 then 'https://p' || p_partkey || '.org/' when 1 then 'https://p.org/x' end end as homepage,
  case when ok then p_name || ' and more' end as description, case when ok then 'Hall 1, Hall ' || p_size end as venue, null::varchar as contact,
  case p_partkey % 6 when 2 then p_type || '|' || p_brand when 3 then p_type || '|' || p_brand when 4 then p_type else '' end as keywords,
  case when ok then p_brand end as call_for_papers, case p_partkey % 6 when 0 then 'broken' when 1 then 'shape' end as rejected
from p""")
def detail_answers(spark, d):
    """What detail responses add to a listing, and why a response adds nothing."""
    bodies = cut(load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr(_DETAIL_BODY).alias("body")))
    return answers.details(bodies, keep=["id"]).withColumn("keywords", F.array_join("keywords", "|"))


_INDEX_BODY = """case o_orderkey % 7
    when 0 then '[]'
    when 1 then '{"message":{"items":[{"title":"x"}'
    else '{"message":{"items":[{"DOI":"10.1/' || cast(o_orderkey as string) || '","container-title":' || case when o_orderkey % 7 = 2 then '"Proc. ' || o_orderpriority || '"' else '["Proc. ' || o_orderpriority || '",""]' end
      || ',"title":["Volume ' || cast(o_custkey as string) || '"],"type":"' || case when o_custkey % 2 = 0 then 'book' else 'article' end
      || '","published":{"date-parts":' || case when o_orderkey % 7 = 3 then '["' || date_format(o_orderdate, 'yyyy') || '"]' when o_orderkey % 7 = 4 then 'null' else '[[' || date_format(o_orderdate, 'yyyy') || ',5]]' end
      || '},"event":' || case when o_custkey % 3 = 0 then '{"name":"Event ' || o_orderstatus || '"}' else 'null' end || ',"publisher":"P' || cast(o_custkey % 5 as string) || '"},'
      || case when o_orderkey % 7 = 5 then '"withdrawn"' else '{"publisher":3}' end || ']}}' end"""


def _index_bodies(spark, d):
    return cut(load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_INDEX_BODY).alias("body")))


@query("""
select o_orderkey as id, 0 as pos, concat_ws('|', case when o_custkey % 3 = 0 then 'Event ' || o_orderstatus end, 'Proc. ' || o_orderpriority, case when o_custkey % 2 = 0 then 'Volume ' || o_custkey end) as names,
  case when o_orderkey % 7 <> 4 then year(o_orderdate) end as year, 'P' || o_custkey % 5 as publisher, '10.1/' || o_orderkey as doi
from orders where o_orderkey % 7 > 1
union all select o_orderkey, 1, '', null, '3', null from orders where o_orderkey % 7 in (2, 3, 4, 6)""")
def index_answers(spark, d):
    """Candidate volumes of bibliographic answers, with the names that may be an event's."""
    return answers.published_items(_index_bodies(spark, d), "id").withColumn("names", F.array_join("names", "|"))


@query("select o_orderkey as id, case o_orderkey % 7 when 0 then 'shape' when 1 then 'broken' else 'result' end as reason from orders where o_orderkey % 7 in (0, 1, 5)")
def index_rejects(spark, d):
    return answers.item_rejects(_index_bodies(spark, d), "id")


_EXTRACTED_BODY = """case l_orderkey % 9
    when 0 then '{"name":"' || l_returnflag || '", "fees":'
    when 1 then '"I could not find any fee."'
    else '{"name":"E' || cast(l_orderkey as string) || '","acronym":null,"fees_published":' || case when l_orderkey % 9 = 2 then '"yes, all"' when l_linestatus = 'F' then '"true"' else 'false' end
      || ',"fees":' || case l_orderkey % 9
        when 3 then '{"category":"' || l_returnflag || '","amount":"' || cast(cast(l_quantity as int) as string) || '.5","currency":"USD"}'
        when 4 then '[{"category":"' || l_returnflag || '","amount":"free"}]'
        when 5 then '["' || l_returnflag || '"]'
        when 6 then 'null'
        else '[{"category":"' || l_returnflag || '","tier":"early","amount":' || cast(cast(l_quantity as int) as string) || ',"currency":"EUR","notes":7},{"category":"' || l_linestatus || '","amount":null}]' end
      || '}' end"""


@query("""
select l_orderkey as id, l_linenumber as line, case l_orderkey % 9 when 0 then 'broken' when 1 then 'shape' when 2 then 'result' when 4 then 'result' when 5 then 'result' end as rejected,
  case when l_orderkey % 9 in (3, 6, 7, 8) then 'E' || l_orderkey end as name, case when l_orderkey % 9 in (3, 6, 7, 8) then l_linestatus = 'F' end as published,
  case l_orderkey % 9 when 3 then 1 when 7 then 2 when 8 then 2 end as n,
  case l_orderkey % 9 when 3 then l_returnflag || ':' || l_quantity::int || '.5:USD' when 7 then l_returnflag || ':' || l_quantity::int || '.0:EUR' when 8 then l_returnflag || ':' || l_quantity::int || '.0:EUR' end as first
from lineitem""")
def extraction_answers(spark, d):
    """Extraction answers as typed records; bad ones stand beside them with a reason."""
    lines = load(spark, d, "lineitem")
    bodies = cut(lines.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.expr(_EXTRACTED_BODY).alias("answer")))
    fees, fee = F.col("extracted.fees"), F.get("extracted.fees", F.lit(0))
    return answers.records(bodies).select(
        "id", "line", "rejected", F.col("extracted.name").alias("name"), F.col("extracted.fees_published").alias("published"),
        F.when(fees.isNotNull(), F.size(fees)).alias("n"), (F.concat(fee["category"], F.lit(":"), fee["amount"].cast("string"), F.lit(":"), fee["currency"])).alias("first"),
    )


@query("""
with t as (select l_orderkey * 10 + l_linenumber as id, l_orderkey as e, bool_and(l_returnflag = 'R') as open from lineitem group by 1, 2)
select id, case when open then 'unanswered' when e % 9 = 0 then 'broken' when e % 9 = 1 then 'shape' when e % 9 in (2, 4, 5) then 'result' end as rejected,
  case when not open and e % 9 in (3, 6, 7, 8) then 'E' || e end as name from t""")
def reader_records(spark, d):
    """Records by a reader whose answers were landed before: none for returned lines, two for some, and some for lines nobody asks about."""
    lines = cut(load(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.expr(_EXTRACTED_BODY).alias("answer"), "l_returnflag"))
    given = lines.where("l_returnflag <> 'R'").select("id", "answer")
    landed = given.unionByName(given.where("id % 3 = 0")).unionByName(given.select(-F.col("id"), "answer").toDF("id", "answer"))
    read = readers.all_records(lines.select("id", F.col("l_returnflag").alias("text")), readers.stored(landed, "id"), "id")
    return read.select("id", "rejected", F.col("extracted.name").alias("name"))


#: Files of events in one micro-batch.
FILES_PER_BATCH = 64


@query("""
select count(*) as seen, count(distinct user_id) as new, count(*) - count(distinct user_id) as updated, count(*) filter (ts < timestamp '2024-01-15') as in_window,
  count(distinct user_id) as kept
from events""")
def stream_counters(spark, d):
    """Running counters of the events arriving as a stream, beside a recount of the table they were folded into."""
    from listmill.sinks.files import read_current
    from listmill.streaming.ingest import COUNTED, counters, listing_stream, run_available

    root = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}"
    stream = listing_stream(spark, f"{d}/events.parquet*", load(spark, d, "events").schema, FILES_PER_BATCH)
    rows = stream.select("user_id", F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("seen_at"))
    window = F.col("seen_at") < F.lit("2024-01-15").cast("timestamp")
    run_available(rows, f"{root}/table", f"{root}/state", ["user_id"], counts=f"{root}/counts", in_window=window)
    last = counters(spark, f"{root}/counts").agg(*(F.max_by(f"all_{c}", "batch").alias(c) for c in COUNTED))
    kept = read_current(spark, f"{root}/table").count()
    return last.withColumn("kept", F.lit(kept))
