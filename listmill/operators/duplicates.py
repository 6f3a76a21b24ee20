"""Pairing entities that are the same event, each in at most one pair per pass.

The rule: entities by start date and id, each not yet used takes the first unused one after it that
is the same event. Groups of one acronym (or one name) that nothing else touches, and whose places
all agree or fall apart cleanly, are paired by rank. All others are joined into components of linked
groups, which are cut where no row stands for more than the date gap; the rows of such a run are read
once in order as a sorted stream that keeps only those still waiting within the gap.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.engine import cut, partitions
from listmill.operators.components import components
from listmill.operators.neighbours import days_around, exact_rank
from listmill.operators.placement import _bucket, _features
from listmill.operators.similarity import similar_names

_KIND = ["key", "name", "day", "country"]


def _agree(a: str, b: str):
    """Places that do not conflict: equal, or one unknown."""
    return (F.col(a) == "") | (F.col(b) == "") | (F.col(a) == F.col(b))


def _prefix_linked(keys: DataFrame) -> DataFrame:
    """Pairs of different keys of which one begins with the other: (short, long)."""
    begun = keys.select(
        F.col("key").alias("long"),
        F.explode(F.expr("transform(sequence(1, length(key) - 1), n -> left(key, n))")).alias("short"),
    ).where("length(long) > 1")
    return begun.join(keys.withColumnRenamed("key", "short"), "short").select("short", "long")


def _name_edges(kinds: DataFrame, threshold: int) -> DataFrame:
    """Neighbouring kinds by the name rule: (kind, other), both directions.

    Keys must be missing on a side or one a proper prefix of the other; equal keys are the
    acronym rule's business.
    """
    keys = kinds.where("key <> ''").select("key").distinct()
    linked = cut(_prefix_linked(keys))
    chained = linked.select(F.col("short").alias("key")).unionByName(
        linked.select(F.col("long").alias("key"))
    ).distinct()
    usable = kinds.where("name <> ''").join(
        chained.withColumn("chained", F.lit(True)), "key", "left"
    )
    flagged = usable.withColumn("flag", (F.col("key") == "") | F.col("chained").isNotNull())
    names = flagged.select("name", _bucket(F.col("day")).alias("bucket"), "flag").distinct()
    pairs = cut(similar_names(names, threshold))
    both = pairs.unionByName(
        pairs.select(F.col("name_b").alias("name_a"), F.col("name_a").alias("name_b"))
    )
    a = flagged.select(*[F.col(c).alias(f"a_{c}") for c in ["kind", *_KIND]])
    b = flagged.select(*[F.col(c).alias(f"b_{c}") for c in ["kind", *_KIND]])
    near = a.join(both, F.col("a_name") == F.col("name_a")).select(
        *a.columns, F.col("name_b").alias("other")
    ).unionByName(a.select("*", F.col("a_name").alias("other")))
    offered = near.select("*", days_around(F.col("a_day")).alias("near_day"))
    met = offered.join(
        b, (F.col("other") == F.col("b_name")) & (F.col("near_day") == F.col("b_day"))
    ).where(_agree("a_country", "b_country"))
    compatible = (
        (F.col("a_key") == "")
        | (F.col("b_key") == "")
        | (F.col("a_key") != F.col("b_key"))
        & (F.col("a_key").startswith(F.col("b_key")) | F.col("b_key").startswith(F.col("a_key")))
    )
    return met.where(compatible).select(F.col("a_kind").alias("kind"), F.col("b_kind").alias("other"))


def duplicate_pairs(entities: DataFrame, threshold: int = fv.DUPLICATE_SIMILARITY) -> DataFrame:
    """(a, b): ids of the pairs found, ``a`` the earlier by start date and id.

    ``entities``: id, acronym, name, start_date, country. Ids are unique; those without a date pair
    with nothing.
    """
    # rows are few bytes and much work: tasks by their bytes would be too few
    rows = cut(_features(entities.where("start_date is not null").repartition(partitions(entities.sparkSession))))
    # a kind is known by the least id of its rows
    kinds = cut(rows.groupBy(*_KIND).agg(F.min("id").alias("kind")))
    edges = cut(_name_edges(kinds, threshold))
    group = F.when(F.col("key") != "", F.concat(F.lit("k:"), "key")).otherwise(F.concat(F.lit("n:"), "name"))
    kinds = kinds.where("key <> '' or name <> ''").withColumn("grp", group)
    ends = edges.join(kinds.select("kind", "grp"), "kind").join(
        kinds.select(F.col("kind").alias("other"), F.col("grp").alias("other_grp")), "other"
    )
    links = cut(ends.where("grp <> other_grp").select("grp", "other_grp").distinct())
    grouped = rows.join(kinds, _KIND)

    # --- groups nothing else touches, in one step
    places = kinds.groupBy("grp").agg(
        F.max((F.col("country") == "").cast("int")).alias("unknown"),
        F.min(F.nullif("country", F.lit(""))).alias("lo"),
        F.max(F.nullif("country", F.lit(""))).alias("hi"),
    )
    # without unknown places a group falls apart by place; with one place all of it agrees
    plain = places.where("unknown = 0 or lo is null or lo = hi").join(links.select("grp").distinct(), "grp", "left_anti")
    simple = cut(
        grouped.join(plain.select("grp", "unknown"), "grp").withColumn(
            "part", F.when(F.col("unknown") == 0, F.col("country")).otherwise("")
        )
    )
    by_rank = _pairs_by_rank(simple)

    # --- the others, component by component
    roots = components(links.select(F.col("grp").alias("a"), F.col("other_grp").alias("b")))
    others = cut(
        grouped.join(plain, "grp", "left_anti")
        .join(roots.withColumnRenamed("node", "grp"), "grp", "left")
        .select(F.coalesce("root", "grp").alias("part"), "day", "id", "kind", "key", "country")
    )
    return by_rank.unionByName(_pairs_by_walk(others, edges.where("kind <> other")))


def with_runs(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``run``: the number of their stretch of days within ``key`` that no gap above
    the allowed one cuts. Nothing pairs across runs. Windows see one row per day of a key."""
    by_day = W.partitionBy(*key).orderBy("day")
    gap = F.datediff("day", F.lag("day").over(by_day)) > fv.MAX_DATE_GAP_DAYS
    days = rows.select(*key, "day").distinct().withColumn("new_run", F.coalesce(gap.cast("int"), F.lit(1)))
    return rows.join(days.select(*key, "day", F.sum("new_run").over(by_day).alias("run")), [*key, "day"])


class _Waiting:
    """The rows of one run that have no partner yet, by kind and by (key, place), oldest first, and
    the similar kinds of the day's kinds."""

    def __init__(self) -> None:
        self.alike: dict[int, list[int]] = defaultdict(list)
        self.by_kind: dict[int, deque] = defaultdict(deque)
        self.by_place: dict[str, dict[str, deque]] = defaultdict(lambda: defaultdict(deque))
        self.gone: set[int] = set()

    def _head(self, line: deque | None, since) -> tuple | None:
        """The oldest row of a line that still waits; rows before ``since`` and used ones fall out."""
        while line and (line[0][0] < since or line[0][1] in self.gone):
            line.popleft()
        return line[0] if line else None

    def partner(self, row, since) -> tuple | None:
        lines = [self.by_kind.get(k) for k in (row.kind, *self.alike.get(row.kind, ()))]
        if row.key:
            places = self.by_place.get(row.key, {})
            lines += places.values() if not row.country else [places.get(row.country), places.get("")]
        found = min((h for h in (self._head(line, since) for line in lines) if h is not None), default=None)
        if found is not None:
            self.gone.add(found[1])
        return found

    def add(self, row) -> None:
        entry = (row.day, row.id)
        self.by_kind[row.kind].append(entry)
        if row.key:
            self.by_place[row.key][row.country].append(entry)

    def forget(self, since) -> None:
        """Drops lines and marks that can't matter any more."""
        self.by_kind = defaultdict(deque, {k: q for k, q in self.by_kind.items() if self._head(q, since)})
        for key, places in list(self.by_place.items()):
            for place, line in list(places.items()):
                if self._head(line, since) is None:
                    del places[place]
            if not places:
                del self.by_place[key]
        self.gone &= {entry[1] for q in self.by_kind.values() for entry in q}


def walk_units(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows and, before a day's rows, the links of its kinds (``other`` is not null), by part and
    run: a component falls into one unit of work per run of days."""
    placed = with_runs(rows, ["part"])
    # a kind has one day, so its links are needed on that day only
    days = placed.select("kind", "part", "run", "day").distinct()
    return placed.select("*", F.lit(None).cast("bigint").alias("other")).unionByName(
        links.join(days, "kind").select("part", "run", "day", "kind", "other"), allowMissingColumns=True
    )


def _pairs_by_walk(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs inside components. A node prefers earlier partners from either side, so asking each row
    for its earliest waiting partner gives the same pairs as letting each take its first later one.

    What a task holds is the rows that wait within a week and the links of one day."""
    gap = pd.Timedelta(days=fv.MAX_DATE_GAP_DAYS)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, day, forgotten, waiting = None, None, None, _Waiting()
        for batch in batches:
            pairs = []
            for row in batch.itertuples(index=False):
                since = (pd.Timestamp(row.day) - gap).date()
                if (row.part, row.run) != unit:
                    unit, forgotten, waiting = (row.part, row.run), row.day, _Waiting()
                elif forgotten < since:
                    forgotten = row.day
                    waiting.forget(since)
                if row.day != day:
                    day = row.day
                    waiting.alike.clear()
                if not pd.isna(row.other):
                    waiting.alike[row.kind].append(int(row.other))
                    continue
                mate = waiting.partner(row, since)
                if mate is None:
                    waiting.add(row)
                else:
                    pairs.append((mate[1], int(row.id)))
            yield pd.DataFrame(pairs, columns=["a", "b"])

    units = walk_units(rows, links).withColumn("at", F.col("other").isNull())
    return units.repartition("part", "run").sortWithinPartitions("part", "run", "day", "at", "id").mapInPandas(walk, "a bigint, b bigint")


def _pairs_by_rank(rows: DataFrame) -> DataFrame:
    """Pairs of neighbours in date order where every close pair of a group is the same event."""
    own = ["grp", "part"]
    days = with_runs(rows.groupBy(*own, "day").agg(F.count("*").alias("n")), own)
    before = W.partitionBy(*own, "run").orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    runs = days.select(*own, "day", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = (
        exact_rank(rows.select(*own, "day", "id"), [*own, "day"], "id")
        .join(runs, [*own, "day"])
        .withColumn("place", F.col("before") + F.col("rank") - 1)
        .withColumn("couple", F.floor(F.col("place") / 2))
    )
    return (
        ranked.groupBy(*own, "run", "couple")
        .agg(
            F.min_by("id", "place").alias("a"),
            F.max_by("id", "place").alias("b"),
            F.count("*").alias("n"),
        )
        .where("n = 2")
        .select("a", "b")
    )
