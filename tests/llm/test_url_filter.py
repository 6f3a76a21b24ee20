"""URL verdicts against a plain rule search, and cascades against sets."""

import random

import pytest
from pyspark.sql import functions as F

from listmill.llm import queries, url_filter

RULES = queries.URL_RULES


def plain(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest[: min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))]
        path = rest[len(host) :]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def rules_of(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def check(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    found = url_filter.judge_urls(pages, rules_of(spark, rules), **options).collect()
    assert sorted(tuple(r) for r in found) == sorted((i, *plain(u, rules)) for i, u in enumerate(urls))


URLS = [
    None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "http://a.com/x", "http://example.com/en/1", "http://example.com/en", "https://www.example.com/en/",
    "http://m.WWW.example.com/en/x?y", "http://notexample.com/en/", "ftp://x.net/es/?a", "http://net/fr/", "http://x.net/de/", "http://x.net?/es/", "http://x.net#/es/",
    "a://b://c.com/", "http://É.com/ä", "http://example.com./en/", "http://..com/", "http://x.net/es/\nzwei", "http://a.com/" + "p" * 50_000, "http://" + "l." * 300 + "com/",
]


@pytest.mark.parametrize("limit", [url_filter.FILTER_LIMIT, 0])
def test_rules_of_the_query(spark, limit):
    """With hardly any room for filters, the rows pass slices of the keys."""
    check(spark, URLS * 2, [*RULES, *((f"h{i}.org", "/", "block") for i in range(9))], limit=limit)


def test_slices_hold_every_key_once_and_within_the_limit(spark):
    universe = spark.range(0, 2000).select(F.concat(F.lit("k"), "id").alias("key"))
    lists = [universe.where("hash(key) % 3 = 0"), universe.where("hash(key) % 3 = 1")]
    want = [{r.key for r in x.collect()} for x in lists]
    seen, slices = [set(), set()], 0
    for parts, part, cascades in url_filter.sliced_cascades(lists, universe.union(universe), 1000):
        slices += 1
        assert sum(c.size for c in cascades) <= 1000 and parts > 1
        own = universe.where(url_filter.slice_of(F.col("key"), parts) == part)
        for held, cascade in zip(seen, cascades):
            new = {r.key for r in own.where(cascade.member(F.col("key"))).collect()}
            assert not new & held
            held |= new
    assert seen == want and slices > 1


def test_many_rules_make_many_levels(spark):
    rng = random.Random(1)
    names = [f"h{i}" for i in range(60)]
    urls = [f"http://{rng.choice(names)}.{rng.choice(names)}.org/{rng.choice('abc')}/{rng.randrange(9)}" for _ in range(2000)]
    rules = list({(f"{rng.choice(names)}.org" if rng.random() < 0.5 else f"{rng.choice(names)}.{rng.choice(names)}.org", f"/{rng.choice('abc')}/" if rng.random() < 0.7 else "", rng.choice(["allow", "block"])) for _ in range(150)})
    check(spark, urls, rules)


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)  # many wrong passes, many levels
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(0, 3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    cascade = url_filter.build_cascade(listed, universe.union(universe))
    assert len(cascade.levels) > 3
    held = {r.key for r in universe.where(cascade.member(F.col("key"))).collect()}
    assert held == {f"k{i}" for i in range(0, 3000, 3)}


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.judge_urls(pages.limit(0), rules_of(spark, RULES)).count() == 0
    only = url_filter.judge_urls(pages, rules_of(spark, RULES).limit(0)).first()
    assert (only.rule, only.verdict, only.host, only.path) == (None, "allow", "a.com", "/")
    blocked = url_filter.judge_urls(pages, rules_of(spark, [("com", "/", "allow"), ("com", "/", "block")])).first()
    assert (blocked.rule, blocked.verdict) == ("com/", "block")
