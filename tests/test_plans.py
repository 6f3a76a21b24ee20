"""Whole stages over small tables."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from listmill.config import EngineConfig
from listmill.operators.incremental import replace_origin
from listmill.operators.privacy import account_details
from listmill.operators.survivors import refresh_ranges
from listmill.plans import audit, consolidate, marts, reading, update
from listmill.schemas import ENTITIES, FEES, LISTINGS

CONFIG = EngineConfig(today=dt.date(2026, 9, 1))
D = dt.date


def table(spark, schema, rows):
    """Rows given as dicts; columns left out are null."""
    empty = spark.createDataFrame([], schema)
    names = empty.columns
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], empty.schema)


def listing(i, source, **kw):
    base = dict(id=i, source=source, source_id=str(i), url=f"https://{source}.org/{i}", name=f"Name {i}", in_window=True, is_topic=True, start_date=D(2026, 11, 2))
    return {**base, **kw}


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame([({"USD": 1.0, "PHP": 56.0, "EUR": 0.8, "INR": 84.0},)], "rates map<string,double>")


def test_filter_stage(spark):
    rows = table(spark, LISTINGS, [
        listing(1, "ieee", name="Machine Learning Conference", in_window=None, is_topic=None),
        listing(2, "ieee", name="Poetry", is_topic=None), listing(3, "ieee", name="Nursing", start_date=None, is_topic=None),
        listing(4, "ieee", name="Nursing", is_topic=None),
    ])
    answers = spark.createDataFrame([(2, True, "said so"), (1, False, "ignored")], "id long, is_topic boolean, reason string")
    out = consolidate.filter_listings(rows, CONFIG, answers)
    got = {r.id: (r.in_window, r.is_topic, r.topic_reason) for r in out.collect()}
    assert got[1][:2] == (True, True) and got[2] == (True, True, "llm: said so")
    assert got[3] == (False, None, None) and got[4][:2] == (True, False)
    assert {r.outcome: r.n for r in consolidate.filter_counts(out).collect()} == {"in_window": 3, "out_of_window": 1, "cs": 2, "not_cs": 1}


def test_merge_stage(spark):
    extra = json.dumps({
        "fees": [{"category": "Author", "tier": "early", "amount": 955, "currency": "USD"}, {"category": "author", "tier": "early", "amount": 955, "currency": "USD"}, {"category": "X", "amount": 1234, "currency": "USD"}],
        "register_page_text": "Author early USD 955", "register_self_url": "https://edas.info/r?c=1&p=2",
    })
    rows = table(spark, LISTINGS, [
        listing(11, "wikicfp", acronym="TSSA", name="Telecom Systems", city="Baku", homepage="https://w.org"),
        listing(12, "edas", acronym="IEEE TSSA 2026", name="Telecom Systems Services", extra=extra, homepage=""),
        listing(13, "ieee", acronym=None, name="International Conference on Robot Hands", country="Japan", end_date=D(2025, 11, 4)),
        listing(14, "wikicfp", acronym="RH", name="Conference on Robot Hands", start_date=D(2026, 11, 3), description="desc"),
        listing(15, "wikicfp", acronym="OFF", is_topic=False), listing(16, "wikicfp", acronym="OPEN", is_topic=None),
    ])
    ents = table(spark, ENTITIES, [dict(id=1, acronym="OLD", name="Old", start_date=D(2026, 10, 5), status="collected", city="Here")])
    entities, linked, fees = consolidate.merge_listings(ents, rows, table(spark, FEES, []))
    link = {r.id: r.entity_id for r in linked.collect()}
    assert link == {11: 12, 12: 12, 13: 13, 14: 13, 15: None, 16: 16}
    got = {r.id: r for r in entities.collect()}
    assert set(got) == {1, 12, 13, 16}
    e = got[12]
    assert (e.name, e.city, e.homepage, e.status) == ("Telecom Systems Services", "Baku", "https://w.org", "collected")
    assert e.field_sources["city"].source == "wikicfp" and e.field_sources["name"].source == "edas"
    assert (e.fee_min, e.fee_max, e.currency) == (955.0, 955.0, "USD")
    assert got[13].end_date == D(2026, 11, 4) and got[13].description == "desc" and got[1].city == "Here"
    checks = sorted((r.amount, r.check_status, r.source_url) for r in fees.collect())
    assert checks == [(955.0, "verified", "https://edas.info/r?c=1&p=2"), (1234.0, "not_found", "https://edas.info/r?c=1&p=2")]


def test_homepage_values_stay(spark):
    ents = table(spark, ENTITIES, [dict(id=1, name="A", city="Site", start_date=D(2026, 11, 2), field_sources={"city": {"source": "homepage", "url": "u"}})])
    rows = table(spark, LISTINGS, [listing(5, "ieee", entity_id=1, city="Listed", country="Japan"), listing(6, "edas", entity_id=1, city="Other", country="")])
    entities, _, _ = consolidate.merge_listings(ents, rows, table(spark, FEES, []))
    r = entities.first()
    assert r.city == "Site" and r.country == "Japan" and r.field_sources["city"].source == "homepage" and r.name == "Name 6"


def test_fees_of_listings_are_read_once(spark):
    rows = [(1, 5, "x", '{"fees":[{"category":"Author","amount":9}],"register_page_text":"t"}'), (2, 5, "x", '{"fees":[]}'), (3, 5, "x", None), (4, None, "x", '{"fees":[{}]}')]
    given = consolidate.given_fees(spark.createDataFrame(rows, "id bigint, entity_id bigint, source string, extra string").withColumn("url", F.lit("u")))
    assert given._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert [(r.id, [f.amount for f in r.fees]) for r in given.collect()] == [(1, [9.0])]


def test_fees_of_listings_are_never_broadcast(spark):
    """However small the files look, what has a row for each fee or entity stays off the driver."""
    extra = json.dumps({"fees": [{"category": "Author", "amount": 300.0, "currency": "USD"}], "register_page_text": "Author USD 300"})
    rows = table(spark, LISTINGS, [listing(1, "ieee", entity_id=5, extra=extra)])
    old = table(spark, FEES, [dict(id=1, entity_id=5, source="ieee", amount=7.0, currency="USD", check_status="verified")])
    all_fees = consolidate.replace_source_fees(rows, old)
    ranged = refresh_ranges(table(spark, ENTITIES, [dict(id=5)]), all_fees)
    for df in (consolidate.source_fees(rows), all_fees, ranged):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert [(r.amount, r.check_status) for r in all_fees.collect()] == [(300.0, "verified")]
    assert [(r.id, r.fee_min) for r in ranged.collect()] == [(5, 300.0)]


def test_dedupe_keeps_the_better_one(spark):
    ents = table(spark, ENTITIES, [
        dict(id=1, acronym="TSSA", name="The 20th TSSA", start_date=D(2026, 10, 1), homepage="https://t.org", fee_min=350.0, fee_max=600.0, currency="USD",
             field_sources={"homepage": {"source": "homepage", "url": "x"}}, status="enriched"),
        dict(id=2, acronym="TSSA", name="2026 20th TSSA", start_date=D(2026, 10, 1), registration_url="https://reg", status="collected", enriched_at=dt.datetime(2026, 1, 1)),
        dict(id=3, acronym="ZZ", name="Other", start_date=D(2026, 10, 1)),
    ])
    fees = table(spark, FEES, [dict(id=1, entity_id=1, category="Author", source="homepage", amount=350.0, currency="USD", check_status="verified")])
    rows = table(spark, LISTINGS, [listing(1, "easychair", entity_id=1), listing(2, "ieee", entity_id=2)])
    assert [(r.keep, r["drop"]) for r in consolidate.find_duplicates(ents, rows).collect()] == [(1, 2)]
    entities, linked, kept, _ = consolidate.dedupe(ents, rows, fees)
    got = {r.id: r for r in entities.collect()}
    assert set(got) == {1, 3} and got[1].registration_url == "https://reg" and got[1].fee_min == 350.0 and got[1].fee_max == 350.0
    assert got[1].enriched_at == dt.datetime(2026, 1, 1) and {r.entity_id for r in linked.collect()} == {1}
    flipped = ents.withColumn("id", 10 - F.col("id"))  # now the one without fees has the lower id
    entities, linked, kept, _ = consolidate.dedupe(flipped, rows.withColumn("entity_id", 10 - F.col("entity_id")), fees.withColumn("entity_id", 10 - F.col("entity_id")))
    assert {r.id for r in entities.collect()} == {9, 7} and kept.first().entity_id == 9


def reads(spark, rows):
    from listmill.sources.answers import extracted_records

    schema = "entity_id long, text string, fingerprint string, unchanged boolean, note string, read_at timestamp, answer string"
    df = spark.createDataFrame(rows, schema)
    good, bad = extracted_records(df.where("answer is not null"))
    assert bad.isEmpty()
    return good.drop("answer").unionByName(df.where("answer is null").drop("answer"), allowMissingColumns=True)


NOW = dt.datetime(2026, 9, 1)


def test_apply_reads(spark):
    ents = table(spark, ENTITIES, [
        dict(id=i, name=f"E{i}", start_date=D(2026, 11, 2), homepage=f"https://e{i}.org", status="collected", read_fingerprint="f0") for i in range(1, 7)
    ])
    old = table(spark, FEES, [
        dict(id=1, entity_id=1, category="Old", source="homepage", amount=9.0, currency="USD"), dict(id=2, entity_id=1, category="Kept", source="edas", amount=20.0, currency="USD"),
        dict(id=3, entity_id=4, category="Stay", source="homepage", amount=50.0, currency="USD"),
    ])
    fee = lambda a, c="USD", cat="Author": dict(category=cat, amount=a, currency=c)
    ans = lambda **kw: json.dumps({"fees_published": True, "fees": [], **kw})
    df = reads(spark, [
        (1, "Author USD 400, virtual participation too", "f1", False, None, NOW, ans(start_date="2026-11-03", city="Baku", fees=[fee(400, "us$"), fee(400), fee(777)])),
        (2, "x", "f2", False, None, NOW, ans(start_date="2026-01-01", city="Far")),
        (3, "Registration fee: RM 1,200 for authors.", "f3", False, None, NOW, ans()),
        (4, "same", "f0", True, None, NOW, None),
        (5, None, None, False, "no homepage and no source page text", NOW, None),
        (6, "nothing", "f6", False, None, NOW, ans(fees_published=False, fees=[fee(5000000)])),
    ])
    entities, fees = reading.apply_reads(ents, old, table(spark, LISTINGS, [listing(1, "ieee", entity_id=3, extra='{"event_format":"Hybrid"}')]), df)
    got = {r.id: r for r in entities.collect()}
    a = got[1]
    assert (a.status, a.review_note, a.city, a.start_date) == ("enriched", "1 of 2 fees not found on the page", "Baku", D(2026, 11, 3))
    assert (a.fee_min, a.fee_max, a.read_fingerprint, a.attendance.mode) == (20.0, 400.0, "f1", "online option")
    assert a.field_sources["city"].url == "https://e1.org"
    assert got[2].status == "needs_review" and "don't match listing" in got[2].review_note and got[2].city is None and got[2].read_fingerprint == "f2"
    assert got[3].review_note.startswith('prices on the page were not extracted, e.g. "Registration fee') and got[3].attendance.mode == "online option"
    assert (got[4].status, got[4].enriched_at, got[4].read_fingerprint) == ("collected", NOW, "f0")
    assert got[5].review_note.startswith("no homepage") and got[5].read_fingerprint is None
    assert got[6].review_note == "fees found, but none could be verified: 1 of 1 fees implausible"
    assert sorted((r.entity_id, r.amount) for r in fees.collect()) == [(1, 20.0), (1, 400.0), (1, 777.0), (4, 50.0), (6, 5000000.0)]


def test_sections_and_routing(spark):
    ents = table(spark, ENTITIES, [dict(id=1, name="E", homepage="https://e.org", read_fingerprint=None)])
    rows = table(spark, LISTINGS, [listing(3, "edas", entity_id=1, extra='{"register_page_text":"reg"}'), listing(2, "wikicfp", entity_id=1, description="call")])
    linked = spark.createDataFrame([(1, 1, "u1", "best"), (1, 2, "u2", "second"), (1, 3, "u3", "cut")], "entity_id long, rank int, url string, text string")
    home = spark.createDataFrame([(1, "home")], "entity_id long, text string")
    text = reading.page_texts(reading.page_sections(ents, rows, linked, home, 3), 1000)
    assert text.first().text.split("\n\n") == [
        "### page u2\nsecond", "### page u1\nbest", "### wikicfp call for papers (https://wikicfp.org/2)\ncall",
        "### edas register_page_text (https://edas.org/3)\nreg", "### homepage https://e.org\nhome",
    ]
    routed = reading.route_reads(ents, text).first()
    assert not routed.unchanged and len(routed.fingerprint) == 64
    again = ents.withColumn("read_fingerprint", F.lit(routed.fingerprint))
    assert reading.route_reads(again, text).first().unchanged


def test_revalidate(spark):
    ents = table(spark, ENTITIES, [
        dict(id=1, name="A", status="enriched"), dict(id=2, name="B", status="needs_review", review_note='prices on the page were not extracted, e.g. "x"'),
        dict(id=3, name="C", status="needs_review", review_note="fees not published yet"), dict(id=4, name="D", status="enriched", fee_min=1.0),
    ])
    f = lambda i, a, c, e=1: dict(id=i, entity_id=e, category="Author", amount=a, currency=c, source="homepage")
    fees = table(spark, FEES, [f(1, 100.0, "RMB"), f(2, 100.0, "RMB"), f(3, 9.0, "USD"), f(4, 70.0, "USD", 4)])
    texts = spark.createDataFrame([(1, "Author RMB 100"), (2, "no prices"), (3, "Author fee: USD 250")], "entity_id long, text string")
    entities, out = reading.revalidate(ents, fees, texts)
    got = {r.id: r for r in entities.collect()}
    assert (got[1].status, got[1].fee_min, got[1].currency, got[1].review_note) == ("enriched", 100.0, "CNY", "1 of 2 fees not found on the page")
    assert got[2].review_note == "fees not published yet" and "USD 250" in got[3].review_note and got[4].fee_min == 1.0
    assert sorted((r.id, r.check_status) for r in out.collect() if r.entity_id == 1) == [(1, "verified"), (3, "not_found")]


def test_revalidation_broadcasts_nothing(spark, monkeypatch):
    ents = table(spark, ENTITIES, [dict(id=1, name="A", status="enriched"), dict(id=2, name="B", status="collected")])
    fees = table(spark, FEES, [dict(id=i, entity_id=1, category="Author", amount=300.0, currency="USD", source="homepage") for i in (1, 2)])
    texts = spark.createDataFrame([(1, "Author fee USD 300"), (2, "Author fee USD 200")], "entity_id bigint, text string")
    plans, cut = [], reading.cut
    monkeypatch.setattr(reading, "cut", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut(df))[1])
    done, kept = reading.revalidate(ents, fees, texts)
    assert len(plans) == 3 and "Broadcast" not in "".join([*plans, done._jdf.queryExecution().executedPlan().toString()])
    assert [(r.id, r.check_status) for r in kept.collect()] == [(1, "verified")]
    assert {r.id: (r.status, r.fee_min) for r in done.collect()} == {1: ("enriched", 300.0), 2: ("needs_review", None)}


def test_details(spark):
    ents = table(spark, ENTITIES, [dict(id=1, name="E", status="needs_review", review_note="no homepage and no source page text")])
    rows = table(spark, LISTINGS, [listing(1, "ieee", source_id="77", entity_id=1, extra='{"a":"1"}'), listing(2, "ieee", source_id="78", entity_id=1)])
    det = spark.createDataFrame([(77, "https://h.org", "scope", "venue", None, ["k"], None)],
                                "event_id long, homepage string, description string, venue string, contact string, keywords array<string>, call_for_papers string")
    entities, listings = reading.apply_details(ents, rows, det)
    r = entities.first()
    assert (r.homepage, r.status, r.review_note, r.field_sources["homepage"].source) == ("https://h.org", "collected", None, "ieee")
    first = listings.where("id = 1").first()
    assert first.homepage == "https://h.org" and json.loads(first.extra)["venue"] == "venue" and json.loads(first.extra)["a"] == "1"


@pytest.fixture(scope="module")
def small(spark, rates):
    person = "EDAS (2616716 - holder@example.org)"
    ents = table(spark, ENTITIES, [
        dict(id=1, acronym="AA", name="Alpha", start_date=D(2026, 11, 2), country="Japan", status="enriched", fee_min=80.0, fee_max=400.0, currency="EUR", homepage="https://a.org",
             description=f"from {person}", registration_url="https://edas.info/r.php?c=1&p=2616716",
             history={"has_history": True, "note": None, "editions": [{"year": 2024, "name": "n", "publisher": "p", "doi": "d"}], "publishers": ["p"]},
             attendance={"mode": "online option", "evidence": []}, field_sources={"name": {"source": "ieee", "url": "u"}}),
        dict(id=2, acronym="WW", name="Flagged", start_date=D(2026, 11, 3), country="Italy", status="collected", homepage="https://waset.org/x"),
        dict(id=3, acronym="OUT", name="Out", start_date=D(2028, 1, 1), end_date=D(2027, 1, 1), country="Japan", status="enriched"),
        dict(id=4, acronym="BR", name="Elsewhere", start_date=D(2026, 12, 1), country="Brazil", status="collected"),
    ])
    f = lambda i, cat, a, cur="EUR", st="verified", e=1: dict(id=i, entity_id=e, category=cat, amount=a, currency=cur, source="homepage", check_status=st)
    fees = table(spark, FEES, [f(1, "Author", 400.0), f(2, "Student", 80.0), f(3, "Author", 9.0, st="not_found"), f(4, "Author", 100.0, "XYZ")])
    rows = table(spark, LISTINGS, [listing(1, "edas", entity_id=1, extra=json.dumps({"page": person})), listing(2, "ieee", entity_id=1), listing(3, "wikicfp", entity_id=2), listing(4, "ieee")])
    return ents, fees, rows


def test_publish_and_audit(spark, small, rates):
    ents, fees, rows = small
    site = marts.publish(ents, fees, rows, rates, CONFIG)
    shown = {r.id: r for r in site["entities"].collect()}
    assert set(shown) == {1, 2}
    a = shown[1]
    assert (a.standard_fee.amount, a.standard_fee.amount_usd, a.student_fee.amount, a.fee_min_usd) == (400.0, 500.0, 80.0, 100.0)
    assert a.description == "from EDAS (0 - [account email])" and a.registration_url == "https://edas.info/r.php?c=1"
    assert a.sources == ["EDAS", "IEEE Conferences"] and [l.url for l in a.source_links] == [None, "https://ieee.org/2"]
    assert a.fee_status == "Fees found" and a.history_years == [2024] and shown[2].organizer_flag
    assert sorted(r.id for r in site["fees"].collect()) == [1, 2, 4]
    m = site["meta"].first()
    assert (m.entities, m.entities_with_fees, m.entities_flagged) == (1, 1, 1)
    weeks = site["weeks"].orderBy("week").collect()
    assert weeks[0].week == D(2026, 9, 28) and len(weeks) == 27 and sum(w.total for w in weeks) == 1
    assert [w.fees_usd for w in weeks if w.total] == [[500]]

    edas = rows.where("source = 'edas'").select(F.get_json_object("extra", "$.page").alias("t"))
    got = {r.check: r for r in audit.audit(ents, fees, rows, rates, site, account_details(edas, "t"), CONFIG).collect()}
    assert set(got) == set(audit.CHECKS)
    bad = {c: r.failures for c, r in got.items() if r.failures}
    assert bad == {
        "ends before it starts": 1, "starts outside the window": 1, "enriched with no counted fee": 1,
        "listing not merged": 1, "published fee not convertible": 1,
    }
    assert got["ends before it starts"].verdict == "FAIL" and got["starts outside the window"].verdict == "note"
    assert got["ends before it starts"].examples == ["#3 OUT"]


def test_audit_is_planned_check_by_check(spark, small, rates):
    ents, fees, rows = small
    site = marts.publish(ents, fees, rows, rates, CONFIG)
    details = account_details(rows.select(F.lit("").alias("t")), "t")
    plan = audit.audit(ents, fees, rows, rates, site, details, CONFIG)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "Union" not in plan


def test_audit_broadcasts_only_what_is_bounded(spark, small, rates, monkeypatch):
    """The fixed spellings, the account details and a row per range; never entities, fees or prices."""
    ents, fees, rows = small
    plans, cut, cut_all = [], audit.cut, audit.cut_all
    site = {name: cut(df) for name, df in marts.publish(ents, fees, rows, rates, CONFIG).items() if name in ("entities", "fees", "weeks")}
    details = account_details(rows.select(F.lit("").alias("t")), "t")
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(audit, "cut", lambda df: (planned(df), cut(df))[1])
    monkeypatch.setattr(audit, "cut_all", lambda parts: ([planned(part) for part in parts], cut_all(parts))[1])
    audit.audit(ents, fees, rows, rates, site, details, CONFIG)
    joins = [line for plan in plans for line in plan.splitlines() if re.search("Broadcast(Hash|NestedLoop)Join", line)]
    assert joins and all(re.search(r"Join \[(_key|kind|value|_part)#", line) for line in joins), joins


def test_export_search_summary(spark, small, rates):
    ents, fees, rows = small
    out = marts.export_rows(ents, fees, rows, rates, ["Asia"]).collect()
    assert [r.acronym for r in out] == ["AA", "OUT"]
    r = out[0]
    assert (r.standard_fee, r.student_fee_usd, r.history_years, r.online) == ("400 EUR (Author)", 100.0, "2024", "online option")
    assert json.loads(r.fee_breakdown)[0] == {"category": "Author", "tier": None, "amount": 400.0, "currency": "EUR", "amount_usd": 500.0, "amount_php": 28000.0, "check": "verified"}
    assert r.sources == "edas:https://edas.org/1, ieee:https://ieee.org/2" and json.loads(r.field_sources)["name"]["source"] == "ieee"
    assert [r.id for r in marts.search_entities(ents, rows, continent="asia", limit=1, offset=1).collect()] == [3]
    assert [r.id for r in marts.search_entities(ents, rows, has_fees=True, source="ieee").collect()] == [1]
    with pytest.raises(ValueError):
        marts.search_entities(ents, rows, continent="Asgard")
    assert [r.id for r in marts.search_listings(rows, q="name 2", drop=("description",)).collect()] == [2]
    one = marts.nested(ents, fees, rows, 1).first()
    assert [f.id for f in one.fees] == [1, 2, 3, 4] and [l.id for l in one.listings] == [1, 2]
    got = {(r.section, r.item): r.n for r in marts.summary(ents, rows, CONFIG).collect()}
    assert got["entities_by_continent", "Asia"] == 2 and got["scope", "entities_with_fees"] == 1
    assert got["entities_by_source", "ieee"] == 1 and got["listings", "in_window"] == 4 and got["entities_with_fees", "all"] == 1


def test_update_chain(spark, rates):
    incoming = table(spark, LISTINGS, [
        listing(None, "ieee", source_id="a", acronym="MLX", name="Machine Learning X", country="Japan", in_window=None),
        listing(None, "wikicfp", source_id="b", acronym="MLX'26", name="Machine Learning X", in_window=None),
        listing(None, "wikicfp", source_id="c", acronym="OLD", name="Robots", start_date=D(2020, 1, 1), in_window=None),
    ]).withColumn("seen_at", F.lit(NOW))
    empty = update.Tables(table(spark, ENTITIES, []), table(spark, LISTINGS, []), table(spark, FEES, []), rates)
    tables, site = update.run_update(empty, CONFIG, incoming)
    assert tables.listings.count() == 3 and tables.entities.count() == 1
    ident = tables.entities.first().id
    assert site["entities"].first().fee_status == "Not read yet"
    read = reads(spark, [(ident, "Author USD 300", "f", False, None, NOW, json.dumps({"fees_published": True, "fees": [{"category": "Author", "amount": 300, "currency": "USD"}]}))])
    items = spark.createDataFrame([(ident, 0, 0, ["Machine Learning X Symposium (MLX)"], 2025, "P", "d")], "id long, answer int, pos int, names array<string>, year int, publisher string, doi string")
    again, site = update.run_update(tables, CONFIG, incoming, read, items)
    assert again.listings.count() == 3 and again.entities.count() == 1 and again.entities.first().status == "enriched"
    assert site["entities"].first().standard_fee.amount_usd == 300.0 and site["entities"].first().history_label == "has history"


def test_a_failing_step_is_recorded_and_the_chain_goes_on(spark, rates):
    incoming = table(spark, LISTINGS, [
        listing(None, "ieee", source_id="a", acronym="MLX", name="Machine Learning X", country="Japan", in_window=None),
    ]).withColumn("seen_at", F.lit(NOW))
    empty = update.Tables(table(spark, ENTITIES, []), table(spark, LISTINGS, []), table(spark, FEES, []), rates)
    broken = spark.createDataFrame([(1,)], "nothing int")
    outcomes = []
    tables, site = update.run_update(empty, CONFIG, incoming, reads=broken, outcomes=outcomes)
    assert [(o.step, o.status) for o in outcomes] == [("collect", "done"), ("read", "failed")] and outcomes[1].error
    assert tables.entities.count() == 1 and site["entities"].count() == 1


def test_replace_origin(spark):
    old = spark.createDataFrame([(1, "homepage", 5), (1, "edas", 6), (2, "homepage", 7)], "e int, source string, v int")
    new = spark.createDataFrame([(1, "homepage", 8)], "e int, source string, v int")
    assert sorted(r.v for r in replace_origin(old, new, ["e", "source"]).collect()) == [6, 7, 8]


def test_search_substring_takes_parts_of_every_size(spark, tmp_path):
    from listmill.bindings.stages import search_substring

    rows = [(1, "Key Ring", "B", 1), (2, "bolt", "RINGS", 40), (3, "bolt", "B", 40)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    assert [r.id for r in search_substring(spark, str(tmp_path)).collect()] == [1, 2]
