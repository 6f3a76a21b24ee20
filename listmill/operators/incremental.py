"""State carried from run to run, as joins between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def given(value: Column, dtype: str) -> Column:
    """The value when it says something; null, empty list and empty map say nothing."""
    if dtype.startswith(("array", "map")):
        return F.when(F.size(value) > 0, value)
    return value


def latest_given(incoming: DataFrame, keys: list[str], order: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: per field the last value that says something."""
    types = dict(incoming.dtypes)
    fields = [c for c in incoming.columns if c not in {*keys, order, *skip}]
    return incoming.groupBy(*keys).agg(
        *[
            F.max_by(F.col(c), F.when(given(F.col(c), types[c]).isNotNull(), F.col(order))).alias(c)
            for c in fields
        ],
        F.min(order).alias("_first"),
        F.max(order).alias("_last"),
    )


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: list[str], seen: str = "seen_at"
) -> DataFrame:
    """Insert or update by ``keys``; a thin sighting never wipes a filled field.

    ``incoming`` carries the sighting time ``seen``; the result has first_seen_at (kept) and
    last_seen_at (refreshed by every sighting). Works the same on a batch or a micro-batch.
    """
    news = latest_given(incoming, keys, seen)
    fields = [c for c in news.columns if c not in {*keys, "_first", "_last"}]
    old = existing.select(
        *keys,
        *[F.col(c).alias(f"_old_{c}") for c in fields],
        F.col("first_seen_at").alias("_old_first"),
        F.col("last_seen_at").alias("_old_last"),
    )
    types = dict(news.dtypes)
    return old.join(news, keys, "full_outer").select(
        *keys,
        *[F.coalesce(given(F.col(c), types[c]), F.col(f"_old_{c}"), F.col(c)).alias(c) for c in fields],
        F.coalesce("_old_first", "_first").alias("first_seen_at"),
        F.greatest("_old_last", "_last").alias("last_seen_at"),
    )


def upsert_late(existing: DataFrame, incoming: DataFrame, keys: list[str], seen: str = "seen_at") -> DataFrame:
    """``upsert`` for sightings that may arrive in any order: an older one fills what is empty but
    replaces no later value, and first_seen_at is the earliest sighting.

    The result also has ``given_at``, for each field the time of the sighting that gave its value; for
    a row of ``existing`` that lacks it, last_seen_at counts.
    """
    types = dict(incoming.dtypes)
    fields = [c for c in incoming.columns if c not in {*keys, seen}]
    at = {c: F.when(given(F.col(c), types[c]).isNotNull(), F.col(seen)) for c in fields}
    news = incoming.groupBy(*keys).agg(
        *[F.max_by(F.col(c), at[c]).alias(c) for c in fields],
        F.struct(*[F.max(at[c]).alias(c) for c in fields]).alias("_at"),
        F.min(seen).alias("_first"),
        F.max(seen).alias("_last"),
    )
    since = {c: F.when(given(F.col(c), types[c]).isNotNull(), F.col("last_seen_at")) for c in fields}
    if "given_at" in existing.columns:
        since = {c: F.coalesce(F.col("given_at")[c], since[c]) for c in fields}
    old = existing.select(
        *keys,
        *[F.col(c).alias(f"_old_{c}") for c in fields],
        F.struct(*[since[c].alias(c) for c in fields]).alias("_old_at"),
        F.col("first_seen_at").alias("_old_first"),
        F.col("last_seen_at").alias("_old_last"),
    )

    def value(c: str) -> Column:
        late = F.coalesce(F.col("_at")[c] < F.col("_old_at")[c], F.lit(False))
        return F.coalesce(F.when(~late, given(F.col(c), types[c])), F.col(f"_old_{c}"), F.col(c))

    return old.join(news, keys, "full_outer").select(
        *keys,
        *[value(c).alias(c) for c in fields],
        F.least("_old_first", "_first").alias("first_seen_at"),
        F.greatest("_old_last", "_last").alias("last_seen_at"),
        F.struct(*[F.greatest(F.col("_old_at")[c], F.col("_at")[c]).alias(c) for c in fields]).alias("given_at"),
    )


def sync_actions(target: DataFrame, wanted: DataFrame, key: str = "id") -> DataFrame:
    """(key, action, row): insert, update, delete or keep, so that ``target`` comes to hold
    exactly ``wanted``. A second run gives only keeps."""
    cols = [c for c in wanted.columns if c != key]
    row = lambda df, name: df.select(key, F.struct(*cols).alias(name))
    both = row(target, "old").join(row(wanted, "new"), key, "full_outer")
    action = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(F.col("old").eqNullSafe(F.col("new")), "keep")
        .otherwise("update")
    )
    return both.select(key, action.alias("action"), F.col("new").alias("row"))


def changed_texts(texts: DataFrame, known: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``texts`` with ``fingerprint`` and ``unchanged``: the same text as at the last read."""
    before = known.select(key, F.col("fingerprint").alias("_before"))
    marked = texts.withColumn("fingerprint", F.sha2(F.col(text), 256))
    return (
        marked.join(before, key, "left")
        .withColumn("unchanged", F.coalesce(F.col("fingerprint") == F.col("_before"), F.lit(False)))
        .drop("_before")
    )


def replace_origin(existing: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``existing`` whose origin (``keys``) has fresh rows give way to those."""
    origins = fresh.select(*keys).distinct()
    return existing.join(origins, keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def classify_requests(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """``requests`` (request_id, key, kind, source, params) with ``outcome`` and ``run_id``.

    A used key with the same request is a replay, with another request a conflict; a request
    equal to a running one is a replay of it; anything else is new.
    """
    same = lambda a, b: (
        F.col(f"{a}.kind").eqNullSafe(F.col(f"{b}.kind"))
        & F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
        & F.col(f"{a}.params").eqNullSafe(F.col(f"{b}.params"))
    )
    keyed = runs.where("idempotency_key is not null")
    by_key = requests.alias("q").join(
        keyed.alias("r"), F.col("q.key") == F.col("r.idempotency_key"), "left"
    ).select(
        "q.*", F.col("r.id").alias("key_run"), same("q", "r").alias("key_same")
    )
    running = runs.where("status = 'running'").groupBy("kind", "source", "params").agg(
        F.min("id").alias("running_id")
    )
    met = by_key.alias("q").join(running.alias("r"), same("q", "r"), "left")
    outcome = (
        F.when(F.col("key_run").isNotNull() & ~F.col("key_same"), "conflict")
        .when(F.col("key_run").isNotNull() | F.col("running_id").isNotNull(), "replay")
        .otherwise("new")
    )
    return met.select(
        "q.request_id",
        outcome.alias("outcome"),
        F.when(outcome != "conflict", F.coalesce("key_run", "running_id")).alias("run_id"),
    )


def fresh_pages(
    pages: DataFrame, now: Column, ttl_hours: int, override_hours: Column | None = None
) -> DataFrame:
    """The latest successful copy per address, when young enough. An override may raise the
    limit, never lower it."""
    limit = F.lit(ttl_hours) if override_hours is None else F.greatest(F.lit(ttl_hours), override_hours)
    others = [c for c in pages.columns if c != "url"]
    latest = (
        pages.where("status_code < 400")
        .groupBy("url")
        .agg(F.max_by(F.struct(*others), "fetched_at").alias("copy"))
        .select("url", "copy.*")
    )
    age = F.unix_timestamp(now) - F.unix_timestamp("fetched_at")
    return latest.where(age <= limit * 3600)


def is_due(last: Column, now: Column, max_age_seconds: int = 24 * 3600) -> Column:
    """Whether a snapshot is missing or older than a day."""
    return last.isNull() | (F.unix_timestamp(now) - F.unix_timestamp(last) > max_age_seconds)


def first_by_list(rows: DataFrame, key: str, list_order: str, position: str) -> DataFrame:
    """Rows of several lists appended, the first of each key kept."""
    others = [c for c in rows.columns if c != key]
    return (
        rows.groupBy(key)
        .agg(F.min_by(F.struct(*others), F.struct(list_order, position)).alias("r"))
        .select(key, "r.*")
    )
