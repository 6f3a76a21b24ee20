"""Incremental state, neighbours, privacy, history, sinks, stream."""

import datetime as dt
import json
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listmill.operators import incremental as inc
from listmill.operators import lines, neighbours, predicates
from listmill.bindings import relational  # noqa: F401
from listmill.bindings.registry import QUERIES
from listmill.engine import cut
from listmill.operators.fees import check_fees, check_summary, fee_range, headlines, mark_repeats, repeat_counts
from listmill.operators.history import editions, history_records
from listmill.operators.privacy import account_details, details_held, emails_in, leaks, scrub_table
from listmill.functions.fee_kinds import classify
from listmill.plans.audit import first_few, likely_duplicates
from listmill.sinks import files, versions
from listmill.sources import rates
from listmill.streaming import ingest

T = dt.datetime
SIGHT = "source string, source_id string, name string, tags array<string>, seen_at timestamp"


def test_upsert_never_wipes(spark):
    old = spark.createDataFrame(
        [("a", "1", "old", ["x"], T(2026, 1, 1), T(2026, 1, 1)), ("a", "2", "gone", [], T(2026, 1, 1), T(2026, 1, 1))],
        "source string, source_id string, name string, tags array<string>, first_seen_at timestamp, last_seen_at timestamp",
    )
    new = spark.createDataFrame(
        [("a", "1", None, [], T(2026, 2, 1)), ("a", "1", "newer", None, T(2026, 2, 2)), ("b", "1", None, None, T(2026, 2, 3))], SIGHT
    )
    got = {(r.source, r.source_id): r for r in inc.upsert(old, new, ["source", "source_id"]).collect()}
    r = got["a", "1"]
    assert (r.name, r.tags, r.first_seen_at, r.last_seen_at) == ("newer", ["x"], T(2026, 1, 1), T(2026, 2, 2))
    assert got["a", "2"].name == "gone" and got["b", "1"].first_seen_at == T(2026, 2, 3)


def test_sync_is_idempotent(spark, tmp_path):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0)], "id long, v string, w double")
    b = spark.createDataFrame([(2, "y", 1.0), (3, "z", None), (1, "x2", None)], "id long, v string, w double")
    root = str(tmp_path / "t")
    assert files.sync_table(a, root) == {"written": 2, "deleted": 0}
    assert files.sync_table(a, root) == {"written": 0, "deleted": 0}
    assert files.sync_table(b, root) == {"written": 2, "deleted": 0}
    assert files.sync_table(b.where("id <> 3"), root) == {"written": 0, "deleted": 1}
    assert sorted(r.id for r in files.read_current(spark, root).collect()) == [1, 2]


def test_requests(spark):
    runs = spark.createDataFrame(
        [(1, "collect", "a", "{}", "succeeded", "k1"), (2, "merge", None, "{}", "running", None)],
        "id long, kind string, source string, params string, status string, idempotency_key string",
    )
    asked = spark.createDataFrame(
        [(1, "k1", "collect", "a", "{}"), (2, "k1", "collect", "b", "{}"), (3, None, "merge", None, "{}"), (4, "k9", "filter", None, "{}")],
        "request_id long, key string, kind string, source string, params string",
    )
    got = {r.request_id: (r.outcome, r.run_id) for r in inc.classify_requests(asked, runs).collect()}
    assert got == {1: ("replay", 1), 2: ("conflict", None), 3: ("replay", 2), 4: ("new", None)}


def test_fresh_pages_override_only_raises(spark):
    now = F.lit("2026-01-10 00:00:00").cast("timestamp")
    pages = spark.createDataFrame(
        [("u", 200, T(2026, 1, 9), "new"), ("u", 200, T(2026, 1, 1), "old"), ("v", 200, T(2026, 1, 4), "v"), ("w", 500, T(2026, 1, 9), "w")],
        "url string, status_code int, fetched_at timestamp, html string",
    )
    names = lambda h: {(r.url, r.html) for r in inc.fresh_pages(pages, now, 72, F.lit(h)).collect()}
    assert names(1) == {("u", "new")} and names(24 * 7) == {("u", "new"), ("v", "v")}
    assert inc.fresh_pages(pages, now, 72).count() == 1


def test_rates(spark, tmp_path):
    good = {"base": "USD", "rates": {"USD": 1, "PHP": 56}, "date": "d", "fetched_at": "2026-01-01"}
    (tmp_path / "1.json").write_text(json.dumps(good))
    (tmp_path / "2.json").write_text('{"base": "USD", "rates": {"US')
    (tmp_path / "3.json").write_text(json.dumps({**good, "rates": {"USD": 1}, "fetched_at": "2026-02-01"}))
    latest = rates.latest_rates(rates.read_snapshots(spark, str(tmp_path)))
    assert latest.first().rates == {"USD": 1.0, "PHP": 56.0}
    assert rates.with_rates(spark.range(1), latest.where("false")).first().rates is None


def test_first_other_near_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), dt.date(2026, 1, 1) + dt.timedelta(days=rng.randrange(25))) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k string, day date")
    got = {r.id: (r.first_near, r.n_near) for r in neighbours.first_other_near(df, ["k"], "day", "id").collect()}
    for i, k, d in rows:
        near = [j for j, k2, d2 in rows if j != i and k == k2 and abs((d - d2).days) <= 7]
        assert got[i] == (min(near, default=None), len(near) if near else (got[i][1] or 0))


def test_exact_rank_and_first_few(spark):
    df = spark.range(1000).select((F.col("id") * 7).alias("id"), (F.col("id") % 3).alias("k"))
    got = neighbours.exact_rank(df, ["k"], "id").collect()
    by = {}
    for r in got:
        by.setdefault(r.k, []).append((r.rank, r.id))
    for rows in by.values():
        rows.sort()
        assert [n for n, _ in rows] == list(range(1, len(rows) + 1)) and [i for _, i in rows] == sorted(i for _, i in rows)
    few = first_few(df, "k", ["id"], 4).collect()
    assert sorted(r.id for r in few if r.k == 0) == [0, 21, 42, 63]


def test_the_row_before_is_carried_over_ranges(spark):
    rng = random.Random(6)
    rows = [(i, "hot" if i % 3 else rng.choice("ab"), rng.randrange(9), f"v{i}") for i in rng.sample(range(500), 500)]
    df = spark.createDataFrame(rows, "id long, k string, day int, v string")
    got = {r.id: r.prev and (r.prev.id, r.prev.v) for r in neighbours.with_previous(df, ["k", "day", "id"], ["v"], "prev").collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    assert got == {b[0]: a and (a[0], a[3]) for a, b in zip([None, *ordered], ordered)}
    assert neighbours.in_ranges(df, ["k", "day", "id"]).groupBy("_part").count().where("count < 60").count() == 0


FEE = "entity_id long, id long, category string, tier string, amount double, currency string, notes string, check_status string"


def fee(i, category, amount, tier=None, status="verified", entity=1, currency="USD"):
    return (entity, i, category, tier, float(amount), currency, None, status)


def head(spark, rows):
    df = spark.createDataFrame(rows, FEE).where("check_status = 'verified'")
    kind = classify(F.col("category"), F.col("tier"), F.col("notes"))
    r = headlines(df, "entity_id", kind, F.col("amount"), "id", ["amount"]).first()
    return (r.standard and r.standard.amount, r.student and r.student.amount) if r else (None, None)


def test_headlines(spark):
    rows = [
        fee(1, "IEEE Member", 400, "early"), fee(2, "Non-IEEE Member", 450, "early"), fee(3, "Non-IEEE Member", 550, "regular"),
        fee(4, "Student IEEE Member", 250, "early"), fee(5, "Student Non-IEEE Member", 300, "early"),
        fee(6, "Local Participants (Indian) Non-IEEE Member", 90, "regular"), fee(7, "Listener", 150), fee(8, "Extra Paper", 200),
        fee(9, "Non-IEEE Member", 9999, "regular", "implausible"),
    ]
    assert head(spark, rows) == (550.0, 250.0)
    assert head(spark, [fee(1, "Listener", 100), fee(2, "Banquet ticket", 60)]) == (None, None)
    rows = [fee(1, "Student Author", 250), fee(2, "Student Listener", 50), fee(3, "Regular Author", 500)]
    assert head(spark, rows)[1] == 250.0 and head(spark, rows[1:])[1] == 50.0


def test_range_ties_and_null_currency(spark):
    rows = [fee(1, "a", 5, currency="EUR"), fee(2, "b", 9), fee(3, "c", 7), fee(4, "d", 4, currency="EUR"), fee(5, "e", 3, entity=2, currency=None)]
    got = {r.entity_id: (r.fee_min, r.fee_max, r.currency) for r in fee_range(spark.createDataFrame(rows, FEE), "entity_id").collect()}
    assert got == {1: (4.0, 5.0, "EUR"), 2: (3.0, 3.0, None)}


def test_check_fees_and_summary(spark):
    rows = [fee(1, "Author", 955, "early"), fee(2, "author ", 955, "early"), fee(3, "Listener", 1234), fee(4, "X", 10, entity=2)]
    texts = spark.createDataFrame([(1, "Author early USD 955")], "entity_id long, text string")
    checked = check_fees(spark.createDataFrame(rows, FEE), texts, "entity_id")
    assert [r.check.status for r in checked.orderBy("id").collect()] == ["verified", "duplicate", "not_found", "not_found"]
    got = {r.entity_id: (r.n_fees, r.any_verified, r.check_note) for r in check_summary(checked, "entity_id").collect()}
    assert got == {1: (2, True, "1 of 2 fees not found on the page"), 2: (1, False, "1 of 1 fees not found on the page")}
    marks = mark_repeats(spark.createDataFrame(rows, FEE), [F.col("tier")], "id")
    assert [r.is_repeat for r in marks.orderBy("id").collect()] == [False, True, False, True]


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """Otherwise all shuffles of a long query lie on the disks until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs())

    def shuffled():
        return {p.name for f in folders for p in Path(f.getPath()).glob("*/shuffle_*")}

    asked, there = spark.conf.get(key), shuffled()
    out = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # they are removed in the background
        if left := shuffled() - there:
            time.sleep(0.1)
    assert not left and spark.conf.get(key) == asked
    assert sorted(r.k for r in out.collect()) == list(range(7))


def test_repeat_counts_need_no_order(spark):
    rows = [(1, "a", 2.0), (1, "a", 2.0), (1, None, 2.0), (1, None, 2.0), (1, None, 2.0), (1, "a", 3.0), (None, "a", 2.0)]
    got = repeat_counts(spark.createDataFrame(rows, "e bigint, tier string, amount double"), "e", [F.col("tier"), F.bround("amount", 2)])
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in got.collect()} == {(1, 3, 3), (None, 1, 0)}
    query = QUERIES["fee_duplicates"](spark, "/root/testdata/sf0.001")
    assert "Join" not in query._jdf.queryExecution().executedPlan().toString()


PERSON = "EDAS (2616716 - holder@example.org) page. Price 2616716.5 USD 300 from 10.0.0.1 [User 2616716 at 10.0.0.1 token]"


def test_scrub_and_leaks(spark):
    src = spark.createDataFrame([(PERSON,)], "text string")
    details = account_details(src, "text")
    assert {(r.kind, r.value) for r in details.collect()} == {("id", "2616716"), ("email", "holder@example.org")}
    df = spark.createDataFrame(
        [(1, PERSON, [("k", {"u": "x holder@example.org y", "n": "12616716"})], 2616716), (2, "plain 10.0.0.1", None, 5)],
        "id long, t string, nest array<struct<a:string, m:map<string,string>>>, n long",
    )
    assert leaks(df, ["id"], details).count() == 2
    out = {r.id: r for r in scrub_table(df, ["id"], details).collect()}
    assert out[1].t == "EDAS (0 - [account email]) page. Price 0.5 USD 300 from [ip] [user details removed]"
    assert out[1].nest[0].m == {"u": "x [account email] y", "n": "12616716"} and out[1].n == 2616716
    assert out[2].t == "plain 10.0.0.1" and out[2].nest is None
    assert [r.value for r in leaks(scrub_table(df, ["id"], details), ["id"], details).collect()] == ["2616716"]


def item(pos, name, year, answer=0, ident=1, publisher="P", doi="d"):
    return (ident, answer, pos, [name], year, publisher, doi)


def history(spark, name, acronym, items):
    ent = spark.createDataFrame([(1, name, acronym, dt.date(2026, 11, 1))], "id long, name string, acronym string, start_date date")
    its = spark.createDataFrame(items, "id long, answer int, pos int, names array<string>, year int, publisher string, doi string")
    return history_records(ent, editions(ent, its)).first().history


def test_history(spark):
    base = "International Conference on Telecommunication Systems Services and Applications"
    h = history(spark, f"The 20th {base}", "TSSA", [
        item(0, f"2024 18th {base} (TSSA)", 2024), item(1, f"2024 again {base} (TSSA)", 2024, publisher="Q"),
        item(2, f"2023 17th {base} (TSSA)", 2023), item(3, f"{base} (TSSA)", 2026), item(0, f"{base} (TSSA)", 2023, 1, publisher="R"),
    ])
    assert h.has_history and [e.year for e in h.editions] == [2024, 2023] and h.publishers == ["P"]
    assert not history(spark, f"1st {base}", "TSSA", [item(0, f"{base} (TSSA)", 2024)]).editions
    assert not history(spark, f"2nd {base}", "TSSA", [item(0, f"4th {base} (TSSA)", 2024)]).editions
    assert history(spark, f"5th {base}", "TSSA", [item(0, f"4th {base} (TSSA)", 2024)]).editions
    assert not history(spark, "Conference on Bioethics", "ICB", [item(0, "Conference on Biometrics (ICB)", 2024)]).editions
    old = history(spark, base, "TSSA", [item(0, f"{base} (TSSA)", 2013)])
    assert not old.has_history and old.editions and old.note.startswith("only editions up to 2013")
    lead = history(spark, "International Conference on Intelligent Manufacturing and Health", "ICIMH", [
        item(0, "ICIMH 2022: 2022 The 4th International Conference on Intelligent Manufacturing and Health", 2022)])
    assert lead.has_history


def test_lines(spark):
    df = spark.createDataFrame([(1, i, h, t) for i, (h, t) in enumerate([("A", "x"), (None, "y"), ("B", "z"), (None, "Expired"), (None, "w")])],
                               "page int, n int, h string, t string")
    got = [r.u for r in lines.carry_forward(df, "page", "n", "h", "u").orderBy("n").collect()]
    assert got == ["A", "A", "B", "B", "B"]
    got = {r.t: r.e for r in lines.after_marker(df, "page", "n", F.col("t") == "Expired", "e").collect()}
    assert got == {"x": False, "y": False, "z": False, "w": True}
    parts = spark.createDataFrame([(1, 2, "b" * 9), (1, 1, "a" * 9)], "e int, o int, s string")
    assert lines.fair_shares(parts, "e", "o", "s", 8).first().text == "aaaa\n\nbbbb"


def test_predicates(spark):
    df = spark.createDataFrame([(1, True, None, None), (2, True, False, None), (3, None, True, None), (4, True, True, 9)],
                               "id int, in_window boolean, is_topic boolean, entity_id long")
    assert [r.id for r in predicates.pending(df).collect()] == [1]
    s = spark.createDataFrame([("50% off",), ("500 off",)], "name string")
    assert s.where(predicates.matches_text("0%", F.col("name"))).count() == 1
    with pytest.raises(ValueError):
        predicates.paged(df, [F.col("id")], 5001)


def test_likely_duplicates(spark):
    rng = random.Random(1)
    rows = [(i * 40000, "K", "Asia", dt.date(2026, 1, 1) + dt.timedelta(days=rng.randrange(90)), rng.choice(["X", "x", "Y", None])) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, key string, continent string, start_date date, country string")
    got = {r.id for r in likely_duplicates(df).collect()}
    rows.sort(key=lambda r: (r[3], r[0]))
    want = {b[0] for a, b in zip(rows, rows[1:]) if (b[3] - a[3]).days <= 7 and (a[4] or "").lower() == (b[4] or "").lower()}
    assert got == want


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), str(rng.randrange(6)), rng.choice([None, "n1", "n2"]), [], T(2026, 1, 1) + dt.timedelta(hours=i)) for i in range(40)]
    for part in range(4):
        spark.createDataFrame(rows[part * 10 : part * 10 + 10] + rows[part * 10 : part * 10 + 2], SIGHT).coalesce(1).write.parquet(
            str(tmp_path / "in"), mode="append")
    stream = ingest.listing_stream(spark, str(tmp_path / "in"), SIGHT)
    keys = ["source", "source_id"]
    for _ in range(2):  # the second run finds nothing new
        ingest.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"), keys)
    empty = spark.createDataFrame([], "source string, source_id string, name string, tags array<string>, first_seen_at timestamp, last_seen_at timestamp")
    batch = inc.upsert(empty, spark.createDataFrame(rows, SIGHT), keys)
    cols = batch.columns
    key = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert key(files.read_current(spark, str(tmp_path / "out"))) == key(batch)
    known = batch.where("source = 'a'")
    counts = {r.outcome: r.n for r in ingest.sighting_counts(spark.createDataFrame(rows, SIGHT), known, keys).collect()}
    assert sum(counts.values()) == 40 and counts["updated"] == sum(r[0] == "a" for r in rows)


def test_old_files_and_sightings_of_one_time_reach_the_table(spark, tmp_path):
    """Runs that get an older file later end with the same table as one batch of all."""
    keys, t = ["source", "source_id"], T(2026, 3, 20)
    runs = [
        [("a", "1", "new", None, t), ("a", "1", None, ["x"], t), ("a", "2", None, [], t), ("a", "4", "n", [], t)],
        [("a", "1", "old", ["old"], T(2026, 1, 1)), ("a", "2", "fills", None, T(2026, 1, 2)), ("a", "3", "late", [], T(2026, 1, 3))],
        [("a", "2", "between", None, T(2026, 2, 1)), ("a", "4", None, ["y"], T(2026, 2, 1)), ("a", "2", "before", ["z"], T(2026, 1, 1))],
    ]
    for rows in runs:
        spark.createDataFrame(rows, SIGHT).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
        ingest.run_available(ingest.listing_stream(spark, str(tmp_path / "in"), SIGHT), str(tmp_path / "out"), str(tmp_path / "cp"), keys)
    got = files.read_current(spark, str(tmp_path / "out")).drop("given_at").collect()
    assert sorted(map(tuple, got)) == [
        ("a", "1", "new", ["x"], T(2026, 1, 1), t), ("a", "2", "between", ["z"], T(2026, 1, 1), t),
        ("a", "3", "late", None, T(2026, 1, 3), T(2026, 1, 3)), ("a", "4", "n", ["y"], T(2026, 2, 1), t),
    ]


def test_addresses_that_share_their_beginning_make_no_pairs(spark):
    """Every text holds one of 3,000 addresses of the same local part: as many hits as texts."""
    n = 3000
    details = spark.range(n).selectExpr("'email' kind", "concat('info@h', id, '.example.org') value")
    texts = spark.range(n).selectExpr("id", "concat('Write to info@h', id, '.example.org, or call ', id, '. <b>x@y</b>') text")
    held = details_held(texts, ["id"], F.col("text"), details).select("id", F.explode("held.value").alias("v")).collect()
    # an address that begins as another one does is in the text as well
    assert {r.v for r in held if r.id == 17} == {"info@h17.example.org"} and len(held) == n
    clean = scrub_table(texts.limit(50), ["id"], details)
    assert all(r.text.startswith("Write to [account email], or call") for r in clean.collect())


def test_nested_texts_are_scrubbed(spark):
    details = spark.createDataFrame([("email", "a@b.c"), ("id", "123456")], "kind string, value string")
    rows = spark.createDataFrame([(1, [("see xa@b.cd", {"k": "id 123456, 1123456"})])], "id long, l array<struct<t:string,m:map<string,string>>>")
    got = scrub_table(rows, ["id"], details).first().l[0]
    assert got.t == "see x[account email]d" and got.m == {"k": "id 0, 1123456"}


def ids_and_names(df):
    return sorted((r.id, r.name) for r in df.collect())


def test_a_writer_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    rows = [(i, f"n{i}") for i in range(40)]
    first = spark.createDataFrame(rows, "id long, name string")
    files.sync_table(first, root)
    changed = spark.createDataFrame([*rows[:-1], (39, "new")], "id long, name string")

    # dies after the data, before the list
    def died(*_):
        raise OSError("died")

    with monkeypatch.context() as m:
        m.setattr(versions, "_finish", died)
        with pytest.raises(OSError):
            files.sync_table(changed, root)
    assert ids_and_names(files.read_current(spark, root)) == sorted(rows)

    # dies in the middle of the list: no success mark
    (tmp_path / "t" / "versions" / "000000000002").mkdir()
    (tmp_path / "t" / "versions" / "000000000002" / "part-00000.txt").write_text('{"bucket": 1')
    assert ids_and_names(files.read_current(spark, root)) == sorted(rows)
    assert files.sync_table(changed, root) == {"written": 1, "deleted": 0}
    assert ids_and_names(files.read_current(spark, root)) == sorted([*rows[:-1], (39, "new")])


def test_only_changed_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(5000).selectExpr("id", "concat('n', id) name")
    files.sync_table(rows, root)
    before = versions.current(spark, root)
    files.sync_table(rows.where("id <> 7").union(spark.createDataFrame([(6000, "x")], "id long, name string")), root)
    after = versions.current(spark, root)
    moved = [b for b in range(after.buckets) if before.parts.get(b) != after.parts.get(b)]
    assert len(before.parts) == 64 and 1 <= len(moved) <= 2
    assert files.read_current(spark, root).count() == 5000


def test_an_emptied_table_stays_a_table(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a")], "id long, name string")
    files.sync_table(rows, root)
    assert files.sync_table(rows.limit(0), root) == {"written": 0, "deleted": 1}
    assert files.read_current(spark, root).columns == ["id", "name"] and files.read_current(spark, root).count() == 0


def test_dump_and_copy(spark, tmp_path):
    details = account_details(spark.createDataFrame([(PERSON,)], "text string"), "text")
    df = spark.createDataFrame([(1, PERSON, None, T(2026, 1, 1, 2, 3, 4, 5)), (2, "x", ["a"], None)], "id long, t string, l array<string>, at timestamp")
    files.write_dump(df, str(tmp_path / "dump"), ["id"], details)
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "dump")).orderBy("id").collect()
    assert back[0].at == "2026-01-01 02:03:04" and back[0].l is None and back[1].l is not None and "holder" not in back[0].t
    assert files.copy_verified({"t": df}, {"t": ["id"]}, str(tmp_path / "copy"), details) == {"t": 2}
    files.write_json(df, str(tmp_path / "json"))
    assert '"l":null' in spark.read.text(str(tmp_path / "json")).where("value like '%EDAS%'").first().value
    files.write_dump(df, str(tmp_path / "none"), ["id"], details, empty=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "none")).count() == 0


def test_counters_equal_a_recount(spark, tmp_path):
    """Batches of one file: each has its row, the last row is the count of all; a batch given again changes nothing."""
    rows = [(f"s{i % 3}", None if i % 5 == 0 else str(i % 5), "n", None, T(2026, 1, 1 + i % 20)) for i in range(60)]
    for part in range(3):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], SIGHT).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    keys, counts, window = ["source", "source_id"], str(tmp_path / "counts"), F.col("seen_at") < T(2026, 1, 10)
    stream = ingest.listing_stream(spark, str(tmp_path / "in"), SIGHT, files_per_batch=1)
    for _ in range(2):
        ingest.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"), keys, counts=counts, in_window=window)
    got = ingest.counters(spark, counts).orderBy("batch").collect()
    assert [r.batch for r in got] == [0, 1, 2] and all(r.seen == 20 and r.new + r.updated == 20 for r in got)
    assert got[0].new == len({r[:2] for r in rows[:20]})
    last = got[-1]
    assert (last.all_seen, last.all_new, last.all_in_window) == (60, len({r[:2] for r in rows}), sum(r[4] < T(2026, 1, 10) for r in rows))
    assert last.all_updated == sum(r.updated for r in got)
    batch = spark.createDataFrame(rows[:20], SIGHT)
    ingest.record_counts(counts, 2, batch, batch, keys, window)
    ingest.record_counts(counts, 3, batch.limit(0), batch, keys, window)
    again = ingest.counters(spark, counts).orderBy("batch").collect()
    assert again[:3] == got and (again[3].seen, again[3].new, again[3].all_seen) == (0, 0, 60)


def test_long_stretches_are_read_once(spark):
    """A stretch of half a million characters before and behind addresses; time grew with its square."""
    long = "x" * 500_000
    rows = spark.createDataFrame([(1, f"{long} a@b.org {long}"), (2, f"c@b.org, {long}@d.org")], "id int, t string")
    details = spark.createDataFrame([("email", "a@b.org"), ("email", f"{'x' * 9}@d.org")], "kind string, value string")
    began = time.time()
    held = details_held(rows, ["id"], F.col("t"), details).select("id", F.explode("held.value").alias("v")).collect()
    assert sorted(held) == [(1, "a@b.org"), (2, "xxxxxxxxx@d.org")]
    found = {r.value for r in emails_in(rows, "t").collect()}
    assert found == {"a@b.org", "c@b.org", f"{long}@d.org"}
    assert time.time() - began < 60
