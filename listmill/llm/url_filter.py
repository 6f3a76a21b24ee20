"""URL rules looked up in Bloom filter cascades: exact over the keys of the corpus, without a join.

Filters travel in the plan, so their size is bounded: keys fall into slices by their hash until each
slice's cascades fit, and the rows pass the slices one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill.engine import cut

#: Bits and hash functions per key of a level.
BITS_PER_KEY, HASHES = 10, 4
#: Least bits of a level, and bits that one row of the aggregate holds.
LEAST_BITS, BUCKET_BITS = 64, 32768
#: Bytes of all levels together that a plan may carry; larger lists take several passes.
FILTER_LIMIT = 32 << 20
#: The least limit: a slice of one listed key must fit.
LEAST_LIMIT = 16


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """The keys under which a rule for this URL can be listed, longest first, longer hosts first.

    A key is a host or parent domain followed by a prefix of the path; only prefixes as long as
    some rule's path are needed.
    """
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*(F.lit(n) for n in lengths)), lambda n: n <= F.length(path))
    keys = F.flatten(
        F.transform(
            domains,
            lambda d: F.transform(
                cuts,
                lambda n: F.struct(
                    (-F.length(d) - n).alias("a"), (-F.length(d)).alias("b"), F.concat(d, F.substring(path, F.lit(1), n)).alias("key")
                ),
            ),
        )
    )
    return F.transform(F.array_sort(keys), lambda k: k["key"])


@dataclass
class Level:
    bits: int
    data: bytes
    seed: int

    def holds(self, key: Column) -> Column:
        """Whether all bits of a key are set. The filter's bytes stand in the plan once."""
        places = F.array(*(_place(key, self.seed, i, self.bits) for i in range(HASHES)))

        def is_set(place: Column) -> Column:
            byte = F.substring(F.lit(self.data), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
            return F.call_function("bit_get", F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1

        return F.forall(places, is_set)


def _place(key: Column, seed: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed * HASHES + i)), F.lit(bits).cast("bigint"))


def bloom_level(keys: DataFrame, n: int, seed: int) -> Level:
    """A Bloom filter of the ``key`` column. Bits are set by a map-side combined aggregate; the
    driver receives one row per 32,768 bits, so its share is bounded by the filter's size."""
    bits = max(LEAST_BITS, n * BITS_PER_KEY)
    places = keys.select(F.explode(F.array(*(_place(F.col("key"), seed, i, bits) for i in range(HASHES)))).alias("place"))
    rows = (
        places.groupBy(F.floor(F.col("place") / BUCKET_BITS).alias("bucket"))
        .agg(F.bitmap_construct_agg((F.col("place") % BUCKET_BITS)).alias("bitmap"))
        .collect()
    )
    data = bytearray(-(-bits // BUCKET_BITS) * BUCKET_BITS // 8)
    for row in rows:
        at = row["bucket"] * BUCKET_BITS // 8
        data[at : at + len(row["bitmap"])] = row["bitmap"]
    return Level(bits, bytes(data[: -(-bits // 8)]), seed)


@dataclass
class Cascade:
    """Levels that alternate between listed keys and keys that the level before let through wrongly."""

    levels: list[Level]

    def member(self, key: Column) -> Column:
        verdict = F.lit(len(self.levels) % 2 == 1)
        for at in reversed(range(len(self.levels))):
            verdict = F.when(self.levels[at].holds(key), verdict).otherwise(F.lit(at % 2 == 1))
        return verdict

    @property
    def size(self) -> int:
        return sum(len(x.data) for x in self.levels)


def build_cascade(listed: DataFrame, universe: DataFrame, limit: int = FILTER_LIMIT) -> Cascade | None:
    """A cascade that answers exactly for every listed key and every key of ``universe``.

    Level 0 holds the listed keys; level 1 the universe's keys that pass level 0 without being
    listed; level 2 the listed keys that pass level 1; and so on until a level lets none through.
    Each level sees only what the one before let through, so the tables shrink about fortyfold a
    level. None if the filters would need more than ``limit`` bytes.
    """
    inside = cut(listed.select("key").where("key is not null").distinct())
    n = inside.count()
    if not n:
        return Cascade([])
    levels: list[Level] = []
    held, outside = inside, None
    while n:
        if sum(len(x.data) for x in levels) + n * BITS_PER_KEY // 8 > limit:
            return None
        levels.append(bloom_level(held, n, len(levels)))
        passes = levels[-1].holds(F.col("key"))
        if outside is None:
            wrong = universe.where(passes).distinct().join(inside, "key", "left_anti")
        else:
            wrong = outside.where(passes)
        held, outside = cut(wrong), held
        n = held.count()
    return Cascade(levels)


def slice_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(parts))


def sliced_cascades(
    listed: list[DataFrame], universe: DataFrame, limit: int, parts: int = 1, part: int = 0
) -> Iterator[tuple[int, int, list[Cascade]]]:
    """(parts, part, a cascade for each list over the keys of that slice): slices that together hold every key once.

    A slice whose cascades need more than ``limit`` bytes is halved by the next bit of the hash.
    """
    if parts > 1:
        own = lambda df: df.where(slice_of(F.col("key"), parts) == part)
    else:
        own = lambda df: df
    cascades = []
    for keys in listed:
        made = build_cascade(own(keys), own(universe), limit // len(listed))
        if made is None:
            break
        cascades.append(made)
    else:
        yield parts, part, cascades
        return
    if parts == 1:
        listed, universe = [cut(keys) for keys in listed], cut(universe.distinct())
    for half in (part, part + parts):
        yield from sliced_cascades(listed, universe, limit, 2 * parts, half)


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", limit: int = FILTER_LIMIT) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains
    where the path starts with the rule's; the longest host and path together win, then the longer
    host; a key that is listed with both verdicts blocks. A URL that no listed key fits is
    in no list, so it is allowed. A null URL, and one without ``://``, has an empty host and path
    and fits no rule with a path; empty tables give no rows, an empty rule table allows everything.
    Repeated rows are judged one by one. Only the id and the URL are read. ``limit`` bounds the bytes
    of filters in a plan: beyond it the rows pass slices of the keys one by one, still without a join.
    """
    rows = pages.select(
        F.col(id_column).alias("page_id"), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path")
    )
    listed = cut(rules.select(F.concat("host", "path").alias("key"), "path", "verdict").where("key is not null").distinct())
    lengths = sorted(r["n"] for r in listed.select(F.length("path").alias("n")).distinct().collect())  # no longer than the longest rule
    if not lengths:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = rows.select(F.explode(keys).alias("key"))
    blocking = listed.where("verdict = 'block'").select("key")
    allowing = listed.where("verdict = 'allow'").select("key").join(blocking, "key", "left_anti")
    hits = None
    for parts, part, (block, allow) in sliced_cascades([blocking, allowing], universe, max(limit, LEAST_LIMIT)):
        found = F.transform(keys, lambda k, i: F.struct(i.alias("rank"), k.alias("key"), block.member(k).alias("blocks")))
        if parts > 1:
            mine = F.filter(found, lambda x: (slice_of(x["key"], parts) == part) & (x["blocks"] | allow.member(x["key"])))
        else:
            mine = F.filter(found, lambda x: x["blocks"] | allow.member(x["key"]))
        first = F.get(mine, 0)
        if parts == 1:
            hits = rows.withColumn("hit", first)
        else:
            hits = cut(rows.withColumn("hit", first) if hits is None else hits.withColumn("hit", F.least("hit", first)))
    return hits.select(
        "page_id",
        "host",
        "path",
        F.col("hit.key").alias("rule"),
        F.when(F.col("hit.blocks"), "block").otherwise("allow").alias("verdict"),
    )
