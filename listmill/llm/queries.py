"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.engine import load
from listmill.llm import (
    bpe,
    decontaminate,
    hmm_lm,
    language_id,
    periodic_runs,
    quality,
    secret_scan,
    sharding,
    simhash,
    training_order,
    url_filter,
    warc,
    whitening,
)
from listmill.llm.common import CRC_TABLE_SQL, ORACLES, QUERIES, crc32_sql, fold_of, query

__all__ = ["ORACLES", "QUERIES"]

#: The rules of the URL query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


#: The key of the training order's permutation.
ORDER_KEY = 20240607


@query()
def op1_token_order(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return training_order.token_order(load(spark, folder, "documents"), ORDER_KEY, ranks, public_tokenizers.PATTERN)


@query()
def op1_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """The same for ids of one byte: the texts' UTF-8 bytes."""
    return training_order.byte_order(load(spark, folder, "documents"), ORDER_KEY)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Ids of the texts and back, as digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ranks = bpe.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, decoded_column="decoded").select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_bitmap_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(load(spark, folder, "documents"))


@query(f"""
with t as (select {CRC_TABLE_SQL} as crc_table),
sized as (
    select doc_id, coalesce(strlen(text), 0) + 16 as size, {crc32_sql("coalesce(text, '')")} as text_crc32
    from documents, t),
summed as (
    select *, sum(size) over (order by doc_id nulls first, text_crc32, size rows unbounded preceding) - size as first_byte,
        sum(size) over () as total
    from sized),
placed as (select *, least(((2 * first_byte + size) * 40) // (2 * total), 39)::int as shard from summed)
select doc_id, size::bigint as size, text_crc32, 'bytes' as law, shard,
    row_number() over (partition by shard order by first_byte) - 1 as slot, null::int as grown_shard,
    first_byte::bigint as first_byte
from placed""")
def op5_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.byte_shards(load(spark, folder, "documents"))


@query("""
with parts as (
    select page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') as h,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
    from pages),
hosts as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
rules(rule_host, rule_path, verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best as (
    select host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
        max_by(verdict, length(rule_host || rule_path)) as verdict
    from (select distinct host, path from hosts)
    join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by host, path)
select page_id, hosts.host, hosts.path, rule, coalesce(verdict, 'allow') as verdict
from hosts left join best on hosts.host = best.host and hosts.path = best.path""")
def op8_bloom_cascade(spark: SparkSession, folder: str) -> DataFrame:
    listed = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"select * from values {listed} as rules(host, path, verdict)")
    return url_filter.judge_urls(load(spark, folder, "pages"), rules)


@query()
def op9_simhash_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents"))


@query("""
with sized as (
    select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes from pages),
grouped as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload) end as original from sized)
select page_id, payload_bytes, sha1(payload) as payload_digest,
    case when page_id < original then 'revisit' else 'response' end as record_type,
    case when page_id < original then original end as refers_to
from grouped""")
def op10_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(load(spark, folder, "pages"))


@query(quality.QUALITY_SQL)
def op3_adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(load(spark, folder, "documents"))


@query()
def op6_cgk_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query()
def op7_gru_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents", "doc_id", "text", "lang")
    rows = docs.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "text")
    return language_id.predict(rows, language_id.learn(docs)).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return hmm_lm.score_texts(load(spark, folder, "documents"))


def _secrets_sql() -> str:
    """Places of a kind's matches: what lies between them is counted up from the left."""
    assign = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    crc = crc32_sql("match[5:34]")
    base62 = " || ".join(f"substr('{secret_scan.BASE62.decode()}', 1 + ({crc} // {62**i} % 62)::int, 1)" for i in reversed(range(6)))
    folded = "xor((c & 33554431) << 5, v)"
    for i, step in enumerate(secret_scan.BECH32_STEPS):
        folded = f"xor({folded}, case when (c >> {25 + i}) & 1 = 1 then {step} else 0 end)"
    state = secret_scan.bech32_prefix(secret_scan.AGE_PREFIX.lower())
    age = f"""length(match) = 74 and regexp_matches(lower(match[17:]), '^[{secret_scan.BECH32.decode()}]+$')
        and list_reduce(list_prepend({state}::bigint, list_transform(string_split(lower(match[17:]), ''),
            lambda x: (strpos('{secret_scan.BECH32.decode()}', x) - 1)::bigint)), lambda c, v: {folded}) = 1"""
    value = "[A-Za-z0-9+/_.=-]+"
    before = f"""({assign})["'']?\x20*[:=]\x20*["'']?"""
    kinds = [
        ("assign", before + value, f"length(regexp_extract(match, '{before}({value})', 2)) >= {secret_scan.LEAST_VALUE}"),
        ("access", "AKIA[A-Z0-9]+", f"length(match) >= {secret_scan.LEAST_ACCESS}"),
        ("hex", f"[0-9a-f]{{{secret_scan.LEAST_HEX},}}", "true"),
        ("github", "gh[pousr]_[0-9A-Za-z]+", f"length(match) = 40 and match[35:] = {base62}"),
        ("npm", "npm_[0-9A-Za-z]+", f"length(match) = 40 and match[35:] = {base62}"),
        ("age", "AGE-SECRET-KEY-1[A-Z0-9]+", age),
    ]
    found = " union all ".join(
        f"""
    select row_id, {number} as number, '{kind}' as kind, start, start + length(match) as stop
    from (
        select row_id, crc_table, unnest(matches) as match, unnest(list_transform(range(1, len(matches) + 1),
            lambda i: list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0)))::bigint as start
        from (select row_id, crc_table, regexp_extract_all(t, '{pattern}') as matches, string_split_regex(t, '{pattern}') as gaps from d))
    where {holds}"""
        for number, (kind, pattern, holds) in enumerate(kinds)
    )
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' order by start, number)"
    return f"""
with d as (select row_number() over () as row_id, doc_id, coalesce(text, '') as t, {CRC_TABLE_SQL} as crc_table from documents),
found as ({found}),
counted as (
    select row_id, count(*) filter (number = 0) as n_assign, count(*) filter (number = 1) as n_access, count(*) filter (number = 2) as n_hex,
        {listed} filter (number < 3) as base, {listed} as spans
    from found group by row_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join counted on d.row_id = counted.row_id"""


@query(_secrets_sql())
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(load(spark, folder, "documents", "doc_id", "text"))

    def of_kind(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select("doc_id", *map(of_kind, secret_scan.BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` where each tenth document, by the checksum of its id, repeats its words from a place on."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.withColumn("_h", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n, g = "size(_words)", "(_h div 10)"
    a = f"cast({g} % {n} as int)"
    p = f"cast(1 + ({n} - {a}) div (3 + {g} % 8) as int)"
    repeated = f"slice(flatten(array_repeat(slice(_words, {a} + 1, {p}), cast(({n} - {a} - 1) div {p} + 1 as int))), 1, {n} - {a})"
    changed = F.expr(f"case when {n} > 0 then array_join(concat(slice(_words, 1, {a}), {repeated}), ' ') else text end")
    return rows.withColumn("text", changed).drop("_h", "_words")


@query("""
with d as (
    select row_number() over () as row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, h
    from (select *, CRC as h from documents, (select TABLE as crc_table))),
planted as (
    select row_id, doc_id, len(w) as n, case when h % 10 = 0 and len(w) > 0 then list_transform(range(len(w)),
        lambda i: case when i < a then w[i + 1] else w[(a + (i - a) % p + 1)::int] end) else w end as w
    from (
        select *, 1 + (len(w) - a) // (3 + g % 8) as p
        from (select *, h // 10 as g, case when len(w) > 0 then (h // 10) % len(w) else 0 end as a from d))),
equal as (
    select row_id, p, unnest(list_filter(range(1, n - p + 1), lambda i: w[i] = w[i + p])) as i
    from (select *, unnest(range(1, n // 4 + 1)) as p from planted)),
stretches as (
    select row_id, p, min(i) - 1 as start, count(*) + p as length
    from (select *, i - row_number() over (partition by row_id, p order by i) as island from equal)
    group by row_id, p, island having count(*) + p >= greatest(6, 4 * p)),
runs as (select row_id, start, length, min(p) as period from stretches group by all),
best as (
    select row_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed,
        first({'start': start, 'length': length, 'period': period} order by length::double / period desc, start, period) as top
    from runs group by row_id),
dropped as (
    select row_id, list(distinct i) as gone from (select row_id, unnest(range(start + period, start + length)) as i from runs) group by row_id),
kept as (
    select planted.row_id, list_filter(w, lambda x, i: gone is null or not list_contains(gone, i - 1)) as kept
    from planted left join dropped on planted.row_id = dropped.row_id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, top.start::bigint as start, top.length::bigint as length, top.period::bigint as period,
    (1000 * top.length // top.period)::bigint as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256,
    sha256(array_to_string(kept, ' ')) as collapsed_sha256
from planted left join best on planted.row_id = best.row_id join kept on planted.row_id = kept.row_id""".replace("CRC", crc32_sql("coalesce(doc_id::varchar, '')")).replace("TABLE", CRC_TABLE_SQL))
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(planted_periods(load(spark, folder, "documents", "doc_id", "text")))
    # the greatest length / period, compared without rounding; runs come by start and period
    best = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),
        (best, r) -> case when best is null or r.length * best.period > best.length * r.period then r else best end)""")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_incremental_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(load(spark, folder, "embeddings"))
