"""The round-based resolution must equal a plain sequential model."""

import datetime as dt
import random
import re

import pytest

from listmill import fixed_values as fv
from listmill.operators import duplicates
from listmill.operators.duplicates import duplicate_pairs
from listmill.operators.placement import place
from listmill.operators.similarity import asked_pieces, indel_similarity, rare_pieces, similar_names

ENTITY = "id long, acronym string, name string, start_date date, country string"
LISTING = ENTITY + ", source string"
DAY0 = dt.date(2026, 10, 1)


def key_of(acronym):
    s = acronym or ""
    for p in (fv.SOCIETY_WORDS, fv.ORDINAL_NUMBER):
        s = re.sub(p, " ", s, flags=re.I)
    return re.sub("[^A-Za-z0-9]", "", re.sub(fv.YEAR_MARK, " ", s)).upper()


def name_of(name):
    s = re.sub(r"\(.*?\)", " ", name or "")
    return " ".join(sorted(" ".join(re.sub(fv.BOILERPLATE, " ", s, flags=re.I).split()).lower().split()))


def similar(a, b, threshold):
    x, y = name_of(a), name_of(b)
    return bool(x and y) and indel_similarity(x, y) >= threshold


def near(a, b):
    return a is not None and b is not None and abs((a - b).days) <= 7


def sequential_placement(entities, listings):
    """[(listing id, ('old', id) | ('new', founder id))], one listing after the other."""
    placed = [("old", *e) for e in sorted(entities)]
    rank = {s: i for i, s in enumerate(fv.SOURCE_PRIORITY)}
    out = {}
    for ident, acronym, name, day, country, source in sorted(
        listings, key=lambda r: (rank.get(r[5], len(rank)), r[0])
    ):
        key, home = key_of(acronym), None
        for kind, eid, eacr, ename, eday, ecountry in placed:
            if key and key == key_of(eacr) and near(day, eday):
                home = (kind, eid)
                break
        if home is None:
            for kind, eid, eacr, ename, eday, ecountry in placed:
                other = key_of(eacr)
                if key and other and key != other:
                    continue
                here, there = (country or "").strip().lower(), (ecountry or "").strip().lower()
                if not near(day, eday) or (here and there and here != there):
                    continue
                if similar(name, ename, 90):
                    home = (kind, eid)
                    break
        if home is None:
            home = ("new", ident)
            placed.append(("new", ident, acronym, name, day, None))
        out[ident] = home
    return out


def sequential_pairs(entities):
    rows = sorted((e for e in entities if e[3]), key=lambda e: (e[3], e[0]))
    used, pairs = set(), set()
    for i, a in enumerate(rows):
        if a[0] in used:
            continue
        for b in rows[i + 1 :]:
            if (b[3] - a[3]).days > 7:
                break
            if b[0] in used:
                continue
            ca, cb = ((x[4] or "").strip().lower() for x in (a, b))
            if ca and cb and ca != cb:
                continue
            ka, kb = key_of(a[1]), key_of(b[1])
            linked = not ka or not kb or ka.startswith(kb) or kb.startswith(ka)
            if (ka and ka == kb) or (linked and similar(a[2], b[2], 92)):
                pairs.add((a[0], b[0]))
                used.update((a[0], b[0]))
                break
    return pairs


WORDS = "Machine Learning Robotics Vision Systems Networks Security Data Cloud Theory".split()


def random_rows(rng, n, first_id, dates, hot=False):
    rows = []
    for i in range(n):
        words = rng.sample(WORDS, rng.randint(1, 3))
        name = "International Conference on " + " ".join(words)
        if rng.random() < 0.4:  # a typo
            at = rng.randrange(len(name) - 12, len(name))
            name = name[:at] + rng.choice("abcxyz") + name[at + 1 :]
        acronym = rng.choice([None, None, "ICML", "ICMLX", "IEEE ICML 2026", "RV", "RVS", "CS"])
        if hot and rng.random() < 0.6:
            acronym, name = rng.choice([("HOT", name), (None, "Hot Topics in Everything")])
        country = rng.choice([None, "Japan", "japan ", "China"]) if not hot else rng.choice([None, "Japan"])
        day = DAY0 + dt.timedelta(days=rng.randrange(dates))
        rows.append((first_id + i, acronym, name, day, country))
    return rows


def test_a_long_name_asks_once_per_place(spark):
    name = "".join(random.Random(3).choices("abcdefghij klm", k=100)).strip().ljust(100, "x")
    base = spark.createDataFrame([(name, 0, True, 100), ("tiny name", 0, True, 9)], "name string, bucket int, flag boolean, len int")
    for percent in (90, 92):
        asked = {r.long: r["count"] for r in asked_pieces(base, percent).groupBy("long").count().collect()}
        kept = {r.short: r["count"] for r in rare_pieces(base, percent).groupBy("short").count().collect()}
        assert asked[name] <= 200 and kept[name] == 100 * (200 - 2 * percent) // percent + 1
        assert asked["tiny name"] <= 20 and kept["tiny name"] <= 3


def test_the_commonest_pieces_are_left_out(spark):
    names = [f"abc{f'{i:03d}' * 6}zz" for i in range(40)]  # 23 characters: seven pieces, of which six are kept
    base = spark.createDataFrame([(n, 0, True, len(n)) for n in names], "name string, bucket int, flag boolean, len int")
    kept = {r.piece for r in rare_pieces(base, 90).collect()}
    assert kept == {f"{i:03d}" for i in range(40)}


def test_similar_names_finds_every_pair(spark):
    rng = random.Random(5)
    base = ["advanced computing systems", "data mining theory", "vision", "ai", "robot learning control"]
    names = set()
    for _ in range(140):
        s = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(s))
            if rng.random() < 0.5:
                s.insert(at, rng.choice("abe "))
            elif len(s) > 1:
                del s[at]
        names.add("".join(s).strip())
    names = sorted(n for n in names if n)
    df = spark.createDataFrame([(n, 0, True) for n in names], "name string, bucket long, flag boolean")
    for percent in (90, 92):
        got = {(r.name_a, r.name_b) for r in similar_names(df, percent).collect()}
        want = {
            (a, b) for a in names for b in names if a < b and indel_similarity(a, b) >= percent
        }
        assert got == want


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, False)])
def test_placement_equals_sequential(spark, seed, hot):
    rng = random.Random(seed)
    entities = random_rows(rng, 12, 1, 40)
    listings = [
        (*r, rng.choice(["edas", "ieee", "wikicfp", "other"]))
        for r in random_rows(rng, 90, 1000, 40, hot)
    ]
    got = {
        r.id: ("old", r.entity_id) if r.entity_id is not None else ("new", r.founder_id)
        for r in place(
            spark.createDataFrame(entities, ENTITY), spark.createDataFrame(listings, LISTING)
        ).collect()
    }
    assert got == sequential_placement(entities, listings)


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (4, False), (5, True)])
def test_pairs_equal_sequential(spark, seed, hot):
    rng = random.Random(seed)
    entities = random_rows(rng, 90, 1, 60, hot)
    got = {(r.a, r.b) for r in duplicate_pairs(spark.createDataFrame(entities, ENTITY)).collect()}
    assert got == sequential_pairs(entities)


def test_stored_tables_do_not_grow_with_a_mixed_group(spark, monkeypatch):
    """One acronym with unknown and known places: a longer stream, not more steps."""
    from listmill.operators import components

    stored = []

    def counted(df, original=duplicates.cut):
        stored.append(1)
        return original(df)

    monkeypatch.setattr(duplicates, "cut", counted)
    monkeypatch.setattr(components, "cut", counted)
    steps = []
    for n in (20, 2000):
        rng = random.Random(n)
        rows = [(i, "MIX", None, DAY0 + dt.timedelta(days=rng.randrange(3)), rng.choice([None, "Peru", "Chad", "Fiji"])) for i in range(n)]
        stored.clear()
        got = {(r.a, r.b) for r in duplicate_pairs(spark.createDataFrame(rows, ENTITY)).collect()}
        steps.append(len(stored))
        if n == 20:
            assert got == sequential_pairs(rows)
        assert len({i for pair in got for i in pair}) == 2 * len(got) >= n - 4
    assert steps[0] == steps[1]


def test_names_of_one_small_file_are_read_by_many_tasks(spark, monkeypatch):
    tasks, cut = [], duplicates.cut
    monkeypatch.setattr(duplicates, "cut", lambda df: tasks.append(df.rdd.getNumPartitions()) or cut(df))
    rows = [(i, None, f"workshop {i % 3}", DAY0, None) for i in range(40)] + [(99, "ABC", "undated", None, None)]
    assert duplicate_pairs(spark.createDataFrame(rows, ENTITY).coalesce(1)).count() == 19
    assert tasks[0] == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_crowded_acronym_is_paired_in_one_step(spark):
    rows = [(i, "BUSY", f"name {i}", DAY0 + dt.timedelta(days=i % 3), "Japan") for i in range(400)]
    got = {(r.a, r.b) for r in duplicate_pairs(spark.createDataFrame(rows, ENTITY)).collect()}
    assert got == sequential_pairs(rows)
    assert len(got) == 200


def test_duplicates_by_acronym_and_by_begun_acronym(spark):
    d = dt.date(2031, 4, 2)
    rows = [
        (1, "QUX", "The 9th International Conference on Quiet Engines", DAY0, None),
        (2, "QUX", "2031 9th International Conference on Quiet Engines", DAY0, None),
        (3, "Q7Z", "2031 3rd International Conference on Glaciers", d, None),
        (4, "Ei/Scopus-Q7Z", "2031 IEEE 3rd International Conference on Glaciers", d, None),
        (5, "BARF", "The 2nd EU International Conference on Tidal Maps", d, None),
        (6, "BARFOLD", "2031 2nd EU International Conference on Tidal Maps", d, None),
        (7, "WOBBLE", "Paper Folding and Its Limits", DAY0, "Peru"),
        (8, "IEEE WOBBLE", "Weather Observation and Bridges", d, "Peru"),
        (9, "GLOOP", "Conference on Soup, Salt and Memory", d, "Peru"),
        (10, "MIRT", "Conference on Rail Timetables and Trust", d, "Peru"),
    ]
    got = {(r.a, r.b) for r in duplicate_pairs(spark.createDataFrame(rows, ENTITY)).collect()}
    assert got == {(1, 2), (3, 4), (5, 6)}


def test_one_component_is_one_unit_per_run_of_days(spark):
    """A third of all rows in one component over a year: work is cut where a week passes without a row."""
    rows = [("c", DAY0 + dt.timedelta(days=10 * (i % 36) + i % 3), i, i, "K", "") for i in range(720)]
    rows += [(f"p{i}", DAY0, 1000 + i, 1000 + i, "K", "") for i in range(1440)]
    df = spark.createDataFrame(rows, "part string, day date, id bigint, kind bigint, key string, country string")
    links = spark.createDataFrame([(0, 36), (1000, 1001)], "kind bigint, other bigint")
    units = duplicates.walk_units(df, links)
    assert units.where("part = 'c'").select("run").distinct().count() == 36
    assert {(r.kind, r.other, r.run) for r in units.where("other is not null").collect()} == {(0, 36, 1), (1000, 1001, 1)}
    assert units.where("other is null").count() == len(rows)
