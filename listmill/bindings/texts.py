"""Text, page and name rules over documents, pages, parts and conversations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.bindings.registry import query
from listmill.bindings.tables import CONFIG, LINE_ORDER, SQL_LINE_ORDER, case, orders, sql_mentions
from listmill.engine import cut, load
from listmill.functions import checks, dates, names, places, urls
from listmill.functions.attendance import decide
from listmill.functions.money import currency_in, normalize_currency, tier_of
from listmill.operators import lines, privacy
from listmill.operators.duplicates import duplicate_pairs
from listmill.operators.fee_tables import fees_from_tables
from listmill.operators.placement import place
from listmill.plans.audit import first_few
from listmill.plans.consolidate import judge_topics
from listmill.sources import deadlines, html, readers, sitemaps

# ---------------------------------------------------------------- names


@query("select p_partkey as id, upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) as \"key\", p_name || ' ' || lower(p_type) as core from part")
def acronym_and_core_name(spark, d):
    """Society words, ordinals, years and boilerplate put around a part's name come off again."""
    acronym = F.concat(F.lit("2026 19th IEEE "), F.col("p_brand"), F.lit(" 2027"))
    name = F.concat(F.lit("The 5th International Conference on "), F.col("p_name"), F.lit(" and "), F.col("p_type"), F.lit(" (XY 2026)"))
    return load(spark, d, "part").select(
        F.col("p_partkey").alias("id"), names.acronym_key(acronym).alias("key"), names.core_name(name).alias("core")
    )


@query("""
with w as (select p_partkey as id, p_brand, list_distinct(list_filter(string_split(lower(p_name || ' ' || p_type), ' '), lambda x: len(x) > 2)) as a from part),
f as (select p_brand, arg_min(a, id) as b from w group by 1)
select id, len(list_intersect(a, b))::double / greatest(len(list_distinct(a || b)), 1) as overlap from w join f using (p_brand)""")
def word_jaccard(spark, d):
    """Shared words of a part's name and that of the first part of its brand."""
    words = names.name_words(F.concat_ws(" ", "p_name", "p_type"))
    rows = load(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand", words.alias("a"))
    first = rows.groupBy("p_brand").agg(F.min_by("a", "id").alias("b"))
    return rows.join(first, "p_brand").select("id", names.word_overlap(F.col("a"), F.col("b")).alias("overlap"))


@query("select p_partkey as id, p_size as edition from part")
def edition_ordinals(spark, d):
    """Digits with a suffix, or a word for the first ten."""
    n = F.col("p_size")
    words = F.get(F.array(*[F.lit(w) for w in fv.WORD_ORDINALS]), (n - 1).cast("int"))
    text = F.concat_ws(" ", F.coalesce(words, F.concat(n.cast("string"), F.lit("th"))), "p_name")
    return load(spark, d, "part").select(F.col("p_partkey").alias("id"), names.edition_number(text).alias("edition"))


@query("select p_partkey as id, p_name as name, upper(replace(p_brand, '#', '-')) as acronym, p_type as call, p_name as place, p_brand as clean from part")
def title_cleaning(spark, d):
    df = load(spark, d, "part")
    acr = F.upper(F.replace("p_brand", F.lit("#"), F.lit("-")))
    split = names.split_trailing_acronym(F.concat(F.col("p_name"), F.lit("  ("), acr, F.lit(")")))
    return df.select(
        F.col("p_partkey").alias("id"), split["name"].alias("name"), split["acronym"].alias("acronym"),
        names.call_title(F.concat(F.lit("Call for Papers: IEEE "), F.col("p_type"), F.lit(" 2026"))).alias("call"),
        names.place_and_dates(F.concat(F.col("p_name"), F.lit(", November 11-12, 2026")))["place"].alias("place"),
        names.clean_acronym(F.concat(F.lit("3rd "), F.col("p_brand"), F.lit(" 2026"))).alias("clean"),
    )


def _part_events(spark, d):
    return load(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_type").isin("PROMO", "SMALL", "LARGE"), F.col("p_brand")).alias("acronym"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"),
        F.date_add(F.lit(dt.date(2026, 10, 1)), F.col("p_size")).alias("start_date"),
        case("p_type", {"PROMO": "Japan", "SMALL": "China", "ECONOMY": "Japan"}).alias("country"),
    )


def _similar_sql(percent: int) -> str:
    """Names and the pairs of them that are similar enough: the longest common subsequence is counted in
    the bits of a number, a character of the other name at a time."""
    return f"""
alike as (
    select a, b from (
        select x.name as a, y.name as b, length(x.name) as n, length(y.name) as m,
            list_reduce(list_prepend((1::hugeint << length(x.name)) - 1, list_transform(string_split(y.name, ''),
                lambda c: coalesce(list_sum(list_transform(range(1, length(x.name) + 1), lambda i: case when x.name[i] = c then 1::hugeint << (i - 1) else 0::hugeint end)), 0)::hugeint)),
                lambda kept, mask: ((kept + (kept & mask)) | (kept - (kept & mask))) & ((1::hugeint << length(x.name)) - 1)) as kept
        from (select distinct name from e) x, (select distinct name from e) y)
    where 200 * (n - bit_count(kept)) >= {percent} * (n + m))"""


_EVENTS = """
parts as (
    select p_partkey as id, case when p_type in ('PROMO', 'SMALL', 'LARGE') then upper(replace(p_brand, '#', '')) else '' end as key,
        array_to_string(list_sort(string_split(lower(p_name || ' ' || p_type), ' ')), ' ') as name, p_size as day,
        case p_type when 'PROMO' then 'japan' when 'SMALL' then 'china' when 'ECONOMY' then 'japan' else '' end as country,
        p_type = 'STANDARD' as known from part)"""

_LEADERS = f"""
with recursive {_EVENTS}, e as (select * from parts),{_similar_sql(fv.PLACEMENT_SIMILARITY)},
old as (select * from parts where known and country = ''),
l as (
    select *, row_number() over (order by case country when 'china' then {fv.SOURCE_PRIORITY.index("edas")} when 'japan' then {fv.SOURCE_PRIORITY.index("ieee")} else {fv.SOURCE_PRIORITY.index("wikicfp")} end, id) as rn
    from parts where not (known and country = '')),
by_key as (select l.rn, min(o.id) as home from l join old o on l.key <> '' and l.key = o.key and abs(l.day - o.day) <= 7 group by 1),
by_name as (
    select l.rn, min(o.id) as home from l join old o on abs(l.day - o.day) <= 7 and (l.key = '' or o.key = '' or l.key = o.key)
        and (l.country = '' or o.country = '' or l.country = o.country) join alike on a = l.name and b = o.name group by 1),
new_key as (select l.rn, list(f.rn order by f.rn) as before from l join l f on f.rn < l.rn and l.key <> '' and l.key = f.key and abs(l.day - f.day) <= 7 group by 1),
new_name as (
    select l.rn, list(f.rn order by f.rn) as before from l join l f on f.rn < l.rn and abs(l.day - f.day) <= 7 and (l.key = '' or f.key = '' or l.key = f.key)
        join alike on a = l.name and b = f.name group by 1),
asked as (
    select l.rn, l.id, by_key.home as old_key, by_name.home as old_name, coalesce(new_key.before, []) as ks, coalesce(new_name.before, []) as ns
    from l left join by_key using (rn) left join by_name using (rn) left join new_key using (rn) left join new_name using (rn)),
step as (
    select 0::bigint as rn, []::bigint[] as founders, null::bigint as entity, null::bigint as founder
    union all
    select rn, case when entity is null and founder = rn then list_append(founders, rn) else founders end, entity, founder
    from (
        select rn, founders, case when old_key is not null then old_key when by_k is null then old_name end as entity,
            case when old_key is not null then null when by_k is not null then by_k when old_name is not null then null else coalesce(by_n, rn) end as founder
        from (
            select q.*, s.founders, list_filter(q.ks, lambda x: list_contains(s.founders, x))[1] as by_k, list_filter(q.ns, lambda x: list_contains(s.founders, x))[1] as by_n
            from step s join asked q on q.rn = s.rn + 1)))
select asked.id, entity as entity_id, f.id as founder_id from step join asked using (rn) left join asked f on f.rn = step.founder"""

_PAIRS = f"""
with recursive {_EVENTS}, e as (select * from parts),{_similar_sql(fv.DUPLICATE_SIMILARITY)},
r as (select *, row_number() over (order by day, id) as rn from parts),
same as (
    select x.rn, y.rn as other from r x join r y on y.rn > x.rn and y.day - x.day <= 7 and (x.country = '' or y.country = '' or x.country = y.country)
    left join alike on a = x.name and b = y.name
    where (x.key <> '' and x.key = y.key) or (a is not null and (x.key = '' or y.key = '' or starts_with(x.key, y.key) or starts_with(y.key, x.key)))),
asked as (select rn, id, coalesce(others, []) as others from r left join (select rn, list(other order by other) as others from same group by 1) using (rn)),
step as (
    select 0::bigint as rn, []::bigint[] as used, null::bigint as mate
    union all
    select rn, case when mate is null then used else list_concat(used, [rn, mate]) end, mate
    from (
        select q.rn, s.used, case when not list_contains(s.used, q.rn) then list_filter(q.others, lambda x: not list_contains(s.used, x))[1] end as mate
        from step s join asked q on q.rn = s.rn + 1))
select x.id as a, y.id as b from step join asked x using (rn) join asked y on y.rn = step.mate"""


@query(_LEADERS)
def resolve_leaders(spark, d):
    """Parts as listings of several sources, placed onto the promoted ones as known entities."""
    rows = _part_events(spark, d).withColumn("source", case("country", {"Japan": "ieee", "China": "edas"}, "wikicfp"))
    known = rows.where("name like '%STANDARD' and country is null").drop("source")
    return place(known, rows.where("not (name like '%STANDARD' and country is null)"))


@query(_PAIRS)
def resolve_pairs(spark, d):
    return duplicate_pairs(_part_events(spark, d))


# ---------------------------------------------------------------- dates, places, money


@query("select o_orderkey as id, cast(cast(o_orderdate as date) as varchar) as day, cast(cast(o_orderdate as date) as varchar) as first, cast(cast(o_orderdate as date) + 2 as varchar) as last from orders")
def date_parse(spark, d):
    """Dates written in the shapes sources use, read back."""
    day, last = F.col("start_date"), F.date_add("start_date", 2)
    short, long = F.date_format(day, "MMM d, yyyy"), F.date_format(day, "d MMMM yyyy")
    single = (
        F.when(F.col("status") == "F", F.concat(short, F.lit(" (Jan 1, 1990)")))
        .when(F.col("status") == "O", long)
        .otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm"))
    )
    one_month = F.concat(F.date_format(day, "MMMM d"), F.lit("-"), F.date_format(last, "d, yyyy"))
    two_ends = F.concat(F.date_format(day, "d MMM"), F.lit(" - "), F.date_format(last, "d MMM yyyy"))
    whole = F.concat(short, F.lit(" - "), F.date_format(last, "MMM d, yyyy"))
    span = F.when(F.month(day) == F.month(last), one_month).when(F.year(day) == F.year(last), two_ends).otherwise(whole)
    r = dates.parse_date_range(F.col("span"))
    return orders(spark, d).select("id", single.alias("single"), span.alias("span")).select(
        "id", dates.parse_date(F.col("single")).cast("string").alias("day"), r["start"].cast("string").alias("first"), r["end"].cast("string").alias("last")
    )


@query("""
select id, cast(case when e >= s then e when try_cast(year(s) || strftime(e, '-%m-%d') as date) between s and s + 31 then try_cast(year(s) || strftime(e, '-%m-%d') as date) end as varchar) as sane,
  abs(date_diff('day', s, e)) > 45 as old_edition from (select o_orderkey as id, cast(o_orderdate as date) as s, cast(l_shipdate as date) - 365 as e from orders join lineitem on l_orderkey = o_orderkey)""")
def sane_end_date(spark, d):
    line = load(spark, d, "lineitem", "l_orderkey", "l_shipdate").select(
        F.col("l_orderkey").alias("id"), F.date_sub(F.col("l_shipdate").cast("date"), 365).alias("e")
    )
    return orders(spark, d).join(line, "id").select(
        "id", dates.sane_end(F.col("start_date"), F.col("e")).cast("string").alias("sane"),
        dates.old_edition_note(F.col("start_date"), F.col("e")).isNotNull().alias("old_edition"),
    )


@query("select event_id as id, cast(cast(ts as date) as varchar) as day from events")
def epoch_cells(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return load(spark, d, "events").select(
        F.col("event_id").alias("id"), dates.epoch_ms_or_text(ms, F.lit("TBA")).cast("string").alias("day")
    )


@query("select c_custkey as id, c_mktsegment as city, n_name as country, r_name as region_key from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey")
def location_split(spark, d):
    placed = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    split = places.split_location(F.concat_ws(" , ", "c_mktsegment", F.lit("〒 12"), "r_name", "n_name"))
    return placed.select(
        F.col("c_custkey").alias("id"), split["city"].alias("city"), split["country"].alias("country"),
        F.upper(places.country_key(F.concat(F.lit(" "), F.col("r_name"), F.lit(".,")))).alias("region_key"),
    )


@query("""
select canonical_country, coalesce(continent, 'Unknown') as continent, count(*) as n from (
select case c_mktsegment when 'BUILDING' then 'United States' when 'MACHINERY' then 'China' when 'FURNITURE' then 'Vietnam' when 'HOUSEHOLD' then 'Turkey' else c_mktsegment end as canonical_country,
  case c_mktsegment when 'BUILDING' then 'North America' when 'MACHINERY' then 'Asia' when 'FURNITURE' then 'Asia' when 'HOUSEHOLD' then 'Asia' end as continent from customer) group by 1, 2""")
def country_spellings(spark, d):
    spelled = case("c_mktsegment", {"BUILDING": "U.S.A.", "MACHINERY": "China.", "FURNITURE": "Viet  Nam", "HOUSEHOLD": "Türkiye"})
    df = load(spark, d, "customer").select(F.coalesce(spelled, F.col("c_mktsegment")).alias("country"))
    return places.with_country(df, "country").groupBy("canonical_country", F.coalesce("continent", F.lit("Unknown")).alias("continent")).agg(
        F.count("*").alias("n")
    )


@query("select l_returnflag as flag, case l_returnflag when 'A' then 'USD' when 'N' then 'EUR' else 'IDR' end as code, case l_returnflag when 'A' then 'USD' when 'R' then 'IDR' end as hint, case l_linestatus when 'F' then 'early' else 'onsite' end as tier, count(*) as n from lineitem group by all")
def currency_and_tier(spark, d):
    spelled = case("l_returnflag", {"A": " us$ ", "N": "Euros"}, "Rp")
    header = case("l_returnflag", {"A": "Fee ABC US$", "N": "Fee"}, "Biaya Rp")
    tier = case("l_linestatus", {"F": "Early or late"}, "On-Site desk")
    return load(spark, d, "lineitem").groupBy(
        F.col("l_returnflag").alias("flag"), normalize_currency(spelled).alias("code"), currency_in(header).alias("hint"), tier_of(tier).alias("tier")
    ).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- topics and documents


def _word(w):
    return rf"(^|[^\p{{L}}\p{{N}}_]){w}($|[^\p{{L}}\p{{N}}_])"


def _sql_hit(pattern: str) -> str:
    p = pattern.replace(r"\w*", "")
    if p.startswith(r"\b"):
        return f"regexp_matches(low, '{_word(p[2:-2])}')"
    if "(?!" in p:
        return "regexp_matches(replace(low, 'educational technology', ''), 'education')"
    return f"regexp_matches(low, '{p}')"


def _sql_hits(patterns: list[str]) -> str:
    return "list_filter([" + ", ".join(f"case when {_sql_hit(p)} then '{p}' end" for p in sorted(patterns)) + "], lambda x: x is not null)"


_TOPIC_TEXT = "text || ' ' || case lang when 'en' then 'AI data network' when 'fr' then 'nursing' else 'education data' end"


@query(f"""
with t as (select doc_id as id, lower({_TOPIC_TEXT}) as low from documents),
h as (select id, {_sql_hits(fv.TOPIC_POSITIVE)} as p, {_sql_hits(fv.TOPIC_NEGATIVE)} as n from t)
select id, case when len(p) > len(n) then 'yes' when len(n) > 0 and len(p) = 0 then 'no' else 'open' end as verdict,
 case when len(p) > len(n) then 'keywords: ' || array_to_string(p[1:4], ', ') when len(n) > 0 and len(p) = 0 then 'non-CS keywords: ' || array_to_string(n[1:4], ', ')
 else 'ambiguous (pos=' || len(p) || ', neg=' || len(n) || ')' end as reason from h""")
def topic_verdict(spark, d):
    """Keywords over whole texts."""
    tail = case("lang", {"en": "AI data network", "fr": "nursing"}, "education data")
    docs = load(spark, d, "documents", "doc_id", "text", "lang").select(F.col("doc_id").alias("id"), F.concat_ws(" ", "text", tail).alias("body"))
    t = F.col("topic.is_topic")
    return judge_topics(docs, "body").select(
        "id", F.when(t, "yes").when(~t, "no").otherwise("open").alias("verdict"), F.col("topic.reason").alias("reason")
    )


@query(f"""
with t as (select doc_id as id, lower({_TOPIC_TEXT}) as low from documents),
h as (select id, len({_sql_hits(fv.TOPIC_POSITIVE)}) as p, len({_sql_hits(fv.TOPIC_NEGATIVE)}) as n from t)
select id, case when p > n then true when n > 0 and p = 0 then false end as is_topic, case when p <= n and (n = 0 or p > 0) then 'unanswered' end as rejected from h""")
def reader_topics(spark, d):
    """Verdicts by a reader that is known by name, and the texts it leaves without one."""
    tail = case("lang", {"en": "AI data network", "fr": "nursing"}, "education data")
    docs = load(spark, d, "documents", "doc_id", "text", "lang").select(F.col("doc_id").alias("id"), F.concat_ws(" ", "text", tail).alias("text"))
    good, bad = readers.topics(docs, "keywords", "id")
    return good.drop("reason").unionByName(bad, allowMissingColumns=True)


_LIMIT = 2000
_USEFUL_SQL = "fee|registration|register|early[- ]?bird|price|cost|usd|us\\$|nt\\$|\\$|eur|€|£|¥|₹|৳|₱|₩|฿|rmb|cny|idr|inr|jpy|krw|myr|thb|sgd|php|twd|bdt|pkr|" + _word("rm") + "|" + _word("rp") + "|deadline|submission|abstract|notification|camera|important dates|venue|location|held|20\\d\\d"


@query(f"""
with docs as (select doc_id as id, text from documents), long as (select * from docs where length(text) > {_LIMIT}),
l as (select id, unnest(range(len(string_split(text, chr(10))))) as i, unnest(string_split(text, chr(10))) as line from long),
m as (select *, contains(line, '|') as tab, regexp_matches(lower(line), '{_USEFUL_SQL}') as useful, not contains(line, '|') and starts_with(line, '### ') as head from l),
r as (select *, count(*) filter (not tab) over (partition by id order by i) as run,
  tab and not coalesce(lag(tab) over (partition by id order by i), false) as starts,
  coalesce(bool_or(useful) over (partition by id order by i rows between 2 preceding and 1 preceding), false) as titled from m),
g as (select *, tab and bool_or(useful or (starts and titled)) over (partition by id, run, tab) as good from r),
k as (select *, good or head or coalesce(bool_or(good and starts) over (partition by id order by i rows between 1 following and 2 following), false)
  or bool_or(not tab and not head and useful) over (partition by id order by i rows between 1 preceding and 1 following) as keep from g),
f as (select *, sum(length(line) + 1) over (partition by id order by i) as size from k where keep),
b as (select id, string_agg(line, chr(10) order by i) as body from f where size <= {_LIMIT - _LIMIT // 8} group by id)
select id, text as condensed from docs where length(text) <= {_LIMIT}
union all select long.id, left(text, {_LIMIT // 8}) || coalesce(chr(10) || body, '') from long left join b on b.id = long.id""")
def condense_lines(spark, d):
    docs = load(spark, d, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")
    return lines.condense(docs, "id", "text", _LIMIT)


@query("select conv_id as id, string_agg(left(role || ': ' || text, (1000 // n)::int), chr(10) || chr(10) order by turn) as text from (select *, count(*) over (partition by conv_id) as n from conversations) group by 1")
def fair_shares(spark, d):
    rows = load(spark, d, "conversations").select(F.col("conv_id").alias("id"), "turn", F.concat_ws(": ", "role", "text").alias("s"))
    return lines.fair_shares(rows, "id", "turn", "s", 1000)


@query("select conv_id, turn, role, max(turn) filter (role = 'user') over (partition by conv_id order by turn) as asked_at from conversations")
def forward_fill_sections(spark, d):
    rows = load(spark, d, "conversations", "conv_id", "turn", "role").withColumn("h", F.when(F.col("role") == "user", F.col("turn")))
    return lines.carry_forward(rows, "conv_id", "turn", "h", "asked_at").drop("h")


@query("""
select conv_id, turn, after from (select *, bool_or(role = 'assistant') over (partition by conv_id order by turn) as after from conversations) where role <> 'assistant'""")
def after_marker_rows(spark, d):
    rows = load(spark, d, "conversations", "conv_id", "turn", "role")
    return lines.after_marker(rows, "conv_id", "turn", F.col("role") == "assistant", "after").select("conv_id", "turn", "after")


@query("select doc_id as id, length(text) >= 300 as readable from documents")
def readable_texts(spark, d):
    return load(spark, d, "documents", "doc_id", "text").select(F.col("doc_id").alias("id"), html.readable(F.col("text")).alias("readable"))


@query("""
select o_orderkey as id, cast(max(cast(l_shipdate as date)) as varchar) as paper, cast(min(cast(l_shipdate as date)) as varchar) as notification
from orders join lineitem on l_orderkey = o_orderkey group by 1""")
def deadline_labels(spark, d):
    """Label lines written from an order's ship dates: later exact labels win, first rule lines win."""
    line = load(spark, d, "lineitem", "l_orderkey", "l_shipdate").select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").cast("date").alias("day")).distinct()
    dated = F.transform(F.array_sort(F.collect_set("day")), lambda x: F.date_format(x, "d MMMM yyyy"))
    texts = line.groupBy("id").agg(
        F.array_join(
            F.concat(
                F.transform(dated, lambda s: F.concat(F.lit("Submission Deadline: "), s)),
                F.transform(dated, lambda s: F.concat(F.lit("Author notification due: "), s)),
            ),
            "\n",
        ).alias("text")
    )
    split = deadlines.label_lines(texts, "id", "text")
    exact = deadlines.by_exact_label(split, "id", "easychair").select("id", F.col("paper_deadline").cast("string").alias("paper"))
    ruled = deadlines.by_rules(split, "id").select("id", F.col("notification_date").cast("string").alias("notification"))
    return exact.join(ruled, "id")


@query("""
select doc_id as id, case when lang = 'fr' then 'in person only' when lang = 'en' then 'online option' when lang = 'de' then 'online only' when n_chars > 2000 then 'online option' end as mode from documents""")
def attendance_mode(spark, d):
    """Votes of a sentence put in front of each text, a fee, and a listed format."""
    said = case("lang", {
        "fr": "No online presentation will be allowed. ", "en": "Authors may choose online presentation. ", "de": "The workshop will be held online. ",
    }, "")
    docs = load(spark, d, "documents", "doc_id", "text", "lang", "n_chars")
    formats = F.when((F.col("n_chars") > 2000) & ~F.col("lang").isin("fr", "en", "de"), F.array(F.lit("hybrid")))
    return docs.select(F.col("doc_id").alias("id"), decide(F.concat(said, "text"), F.lit(None).cast("string"), formats)["mode"].alias("mode"))


@query(f"""
with {sql_mentions("(select doc_id as id, text as t from documents)")},
counted as (select id, count(*) as n, string_agg(snippet, '|' order by i) as said from mentions group by id)
select doc_id as id, coalesce(n, 0)::int as mentions, sha256(coalesce(said, '')) as said from documents left join counted on id = doc_id""")
def missed_prices(spark, d):
    """Prices next to fee words in whole texts."""
    docs = load(spark, d, "documents", "doc_id", "text").withColumn("found", checks.fee_mentions(F.col("text")))
    return docs.select(F.col("doc_id").alias("id"), F.size("found").alias("mentions"), F.sha2(F.array_join("found", "|"), 256).alias("said"))


# ---------------------------------------------------------------- privacy

_MAIL = r"[^()\s<>\[\],;\"]+@[^()\s<>\[\],;\"]+"


@query(rf"""
with needles as (select distinct unnest(regexp_extract_all(text, '{_MAIL}')) as v from documents where contains(text, '@')),
pairs as (select doc_id, list(v order by -length(v), v) as vs from documents join needles on contains(text, v) group by doc_id),
marked as (select d.doc_id as id, case lang when 'en' then 'EDAS ' || text else text end as t, coalesce(vs, []) as vs from documents d left join pairs p on p.doc_id = d.doc_id),
clean as (select id, list_reduce(list_prepend(t, vs), lambda a, v: replace(a, v, '[account email]')) as t from marked)
select id, sha256(case when contains(t, 'EDAS') then regexp_replace(t, '\b\d{{1,3}}(\.\d{{1,3}}){{3}}\b', '[ip]', 'g') else t end) as clean from clean""")
def scrub_accounts(spark, d):
    """Every address found in the documents is taken out of all of them, IP addresses out of
    marked ones; the result is compared by its digest."""
    docs = load(spark, d, "documents", "doc_id", "text", "lang")
    needles = cut(privacy.emails_in(docs, "text"))
    marked = docs.select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") == "en", F.concat(F.lit("EDAS "), "text")).otherwise(F.col("text")).alias("text")
    )
    return privacy.scrub_table(marked, ["id"], needles).select("id", F.sha2("text", 256).alias("clean"))


@query(rf"""
with needles as (select distinct unnest(regexp_extract_all(text, '{_MAIL}')) as v from documents where contains(text, '@')),
pairs as (select doc_id, list(v order by -length(v), v) as vs from documents join needles on contains(text, v) group by doc_id),
clean as (select d.doc_id as id, list_reduce(list_prepend(text, coalesce(vs, [])), lambda a, v: replace(a, v, '[account email]')) as t from documents d left join pairs p on p.doc_id = d.doc_id)
select id, sha256(t) as listed, sha256(t) as mapped, sha256(t) as inner_text, length(t) > 0 as counted from clean""")
def nested_scrub(spark, d):
    """Addresses are taken out of texts in lists, maps and structs alike; what is no text stays."""
    docs = load(spark, d, "documents", "doc_id", "text").withColumn("id", F.col("doc_id"))
    needles = cut(privacy.emails_in(docs.select("text"), "text"))
    text = F.col("text")
    inner = F.struct(F.array(F.struct(text, F.length(text).alias("n"))).alias("list"), F.create_map(F.lit("body"), text).alias("map"), text.alias("own"))
    clean = privacy.scrub_table(docs.select("id", inner.alias("nested")), ["id"], needles)
    digest = lambda c: F.sha2(c, 256)
    return clean.select(
        "id", digest(F.col("nested.list")[0]["text"]).alias("listed"), digest(F.col("nested.map")["body"]).alias("mapped"),
        digest(F.col("nested.own")).alias("inner_text"), (F.col("nested.list")[0]["n"] > 0).alias("counted"),
    )


@query(rf"""
with needles as (select distinct unnest(regexp_extract_all(text, '{_MAIL}')) as v from documents where contains(text, '@'))
select doc_id as id, v as "value" from documents join needles on contains(text, v)""")
def leak_scan(spark, d):
    docs = load(spark, d, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")
    return privacy.leaks(docs, ["id"], cut(privacy.emails_in(docs, "text")))


# ---------------------------------------------------------------- pages

def _sql_unescaped(text: str) -> str:
    for name, character in {"lt": "<", "gt": ">", "quot": '"', "apos": "''", "#39": "''", "copy": "\u00a9", "middot": "\u00b7", "amp": "&"}.items():
        text = f"replace({text}, '&{name};', '{character}')"
    return text


_ANCHORS = f"""
with a as (select page_id, url as base, regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 1) as hs,
  regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 2) as ts from pages),
raw as (select page_id, base, unnest(range(len(hs))) as pos, unnest(hs) as h, unnest(ts) as t from a),
l as (select page_id, base, pos, {_sql_unescaped("h")} as href, trim({_sql_unescaped("t")}) as text from raw),
u as (select *, case when starts_with(href, '/') then regexp_extract(base, '^([a-z]+://[^/?#]*)', 1) || href else href end as url from l)"""


@query(f"select page_id, nullif(trim({_sql_unescaped("regexp_extract(html, '<title>([^<]*)</title>', 1)")}), '') as title from pages")
def page_titles(spark, d):
    return load(spark, d, "pages", "page_id", "html").select("page_id", html.title_of(F.col("html")).alias("title"))


@query(_ANCHORS + " select page_id, pos, url, text from u qualify row_number() over (partition by page_id, url order by pos) = 1")
def page_anchors(spark, d):
    """Links by pattern, absolute, the first of equal ones."""
    rows = load(spark, d, "pages").select("page_id", "url", F.posexplode(html.anchors(F.col("html"))).alias("pos", "a"))
    found = rows.select("page_id", "pos", urls.absolute(F.col("a.href"), F.col("url")).alias("link"), F.col("a.text").alias("text"))
    first = found.where("link is not null").groupBy("page_id", "link").agg(F.min(F.struct("pos", "text")).alias("f"))
    return first.select("page_id", "f.pos", F.col("link").alias("url"), "f.text")


@query(_ANCHORS + " select page_id, pos, url, text from u qualify row_number() over (partition by page_id, url order by pos) = 1")
def page_links(spark, d):
    """The same links by the page reader."""
    return html.page_links(load(spark, d, "pages"))


@query()
def html_text(spark, d):
    return html.html_text(load(spark, d, "pages", "page_id", "html"))


@query()
def list_rows(spark, d):
    return html.page_rows(load(spark, d, "pages", "page_id", "html"))


@query(f"""
with s as (select l_orderkey as page_id, case l_returnflag when 'A' then 6 when 'N' then 3 else 1 end + case l_linestatus when 'F' then 12 else 0 end as score,
  row_number() over (partition by l_orderkey order by case l_returnflag when 'A' then 6 when 'N' then 3 else 1 end + case l_linestatus when 'F' then 12 else 0 end desc,
  {SQL_LINE_ORDER}) as rank, l_partkey as link from lineitem)
select page_id, score, link from s where rank <= 7""")
def link_scores(spark, d):
    """The best links of a page, page order on ties; an order's lines stand for its links."""
    line = load(spark, d, "lineitem")
    path = case("l_returnflag", {"A": "registration", "N": "dates"}, "about")
    home = F.lit("https://www.event.example.com/")
    score = urls.link_score(case("l_linestatus", {"F": "Fees"}, "x"), F.concat(F.lit("https://event.example.com/"), path), home)
    links = line.select(F.col("l_orderkey").alias("page_id"), score.alias("score"), (-score).alias("down"), *LINE_ORDER)
    best = first_few(links.where("score > 0"), "page_id", ["down", *LINE_ORDER], CONFIG.max_pages_per_site - 1, 8)
    return best.select("page_id", "score", F.col("l_partkey").alias("link"))


@query(r"""
with q as (select page_id, regexp_extract(url, '^([^?#]*)', 1) as b, string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&') as ps, regexp_extract(url, '(#.*)$', 1) as f from pages),
k as (select page_id, b, f, array_to_string(list_filter(ps, lambda x: contains(x, '=') and not starts_with(x, 'utm_')), '&') as s from q)
select page_id, b || case when s <> '' then '?' || s else '' end || f as url from k""")
def url_param_drop(spark, d):
    return load(spark, d, "pages", "page_id", "url").select("page_id", urls.without_tracking(F.col("url")).alias("url"))


@query(r"select page_id, nullif(regexp_extract(url || '&id=' || page_id, '[?&]id=([^&#]*)', 1), '') as qid, regexp_matches(url, '(?i)^https?://[^\s/$.?#].[^\s]*$') as is_address from pages where contains(url, '?')")
def url_query_ids(spark, d):
    p = load(spark, d, "pages", "page_id", "url").where(F.col("url").contains("?"))
    with_id = F.concat("url", F.lit("&id="), F.col("page_id").cast("string"))
    return p.select("page_id", urls.query_id(with_id).alias("qid"), urls.is_web_address(F.col("url")).alias("is_address"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"


@query(f"""
with known as (select distinct array_to_string(string_split({_HOST}, '.')[-3:], '.') as h from pages where contains(url, 'spam') or contains(url, 'pills'))
select page_id, min(h) as known, array_to_string(string_split({_HOST}, '.')[-2:], '.') as site from pages join known on {_HOST} = h or ends_with({_HOST}, '.' || h) group by page_id, url""")
def host_flags(spark, d):
    """Hosts equal to a known one or below it: suffixes and an equi join, no pattern per row."""
    p = load(spark, d, "pages", "page_id", "url").withColumn("host", urls.host(F.col("url")))
    known = p.where(F.col("url").contains("spam") | F.col("url").contains("pills")).select(
        F.array_join(F.slice(F.split("host", r"\."), F.greatest(-F.size(F.split("host", r"\.")), F.lit(-3)), 3), ".").alias("known")
    ).distinct()
    asked = p.select("page_id", "host", F.explode(urls.host_suffixes(F.col("host"))).alias("known"))
    return asked.join(known, "known").groupBy("page_id", "host").agg(F.min("known").alias("known")).select("page_id", "known", urls.site(F.col("host")).alias("site"))


@query(r"""select page_id, (contains(html, 'login.php') and contains(html, 'redirect(') and length(html) < 2000) or regexp_matches(html, '(?is)<input[^>]*\btype\s*=\s*["'']?password') as login from pages""")
def login_pages(spark, d):
    return load(spark, d, "pages", "page_id", "html").select("page_id", html.asks_login(F.col("html")).alias("login"))


@query("""
with e as (select 'https://www.computer.org/conferences/cfp-' || o_orderkey || '-' || case o_orderstatus when 'F' then cast(year(o_orderdate) + 4 as varchar) when 'O' then 'x' else 'x?y=1' end as loc,
  o_orderstatus as s, cast(o_orderdate as date) as m from orders),
y as (select *, list_transform(regexp_extract_all(loc, '20\\d\\d'), lambda x: cast(x as int)) as ys from e)
select distinct loc as url from y where s <> 'P' and case when len(ys) > 0 then list_min(ys) <= 2002 and list_max(ys) >= 2001 else m >= date '2001-01-01' - 365 end""")
def page_selection(spark, d):
    """Pages whose years overlap the window, or that have none and are recent; queries never."""
    year = (F.year("start_date") + 4).cast("string")
    tail = F.when(F.col("status") == "F", year).when(F.col("status") == "O", "x").otherwise("x?y=1")
    loc = F.concat(F.lit("https://www.computer.org/conferences/cfp-"), F.col("id").cast("string"), F.lit("-"), tail)
    entries = orders(spark, d).select(loc.alias("loc"), F.col("start_date").alias("lastmod"))
    return sitemaps.select_pages(entries, dt.date(2001, 1, 1), dt.date(2002, 12, 31), 365)


@query("""
select l_orderkey as id, l_partkey as part, case l_linestatus when 'F' then 'early' else 'late' end as tier, round_even(l_quantity * 10, 0) as amount, count(*) as n from lineitem group by all""")
def table_fees(spark, d):
    """Fee tables written as HTML from each order's lines and read back from the page."""
    line = load(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_linestatus", "l_quantity")
    price = F.concat(F.lit("<td>$"), F.format_string("%.0f", F.col("l_quantity") * 10), F.lit("</td>"))
    cells = F.when(F.col("l_linestatus") == "F", F.concat(price, F.lit("<td></td>"))).otherwise(F.concat(F.lit("<td></td>"), price))
    row = F.concat(F.lit("<tr><td>Part "), F.col("l_partkey").cast("string"), F.lit("</td>"), cells, F.lit("</tr>"))
    head = "<table><tr><th>Category</th><th>Early (USD)</th><th>Late (USD)</th></tr>"
    pages = line.groupBy(F.col("l_orderkey").alias("page_id")).agg(
        F.concat(F.lit(head), F.array_join(F.collect_list(row), ""), F.lit("</table>")).alias("html")
    )
    found = fees_from_tables(html.page_tables(pages))
    return found.groupBy(
        F.col("page_id").alias("id"), F.regexp_extract("category", r"\d+", 0).cast("bigint").alias("part"), "tier", "amount"
    ).agg(F.count("*").alias("n"))
