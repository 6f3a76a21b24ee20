"""Readers of texts: what plugs in, and what becomes of its answers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from listmill.bindings import arrivals  # noqa: F401
from listmill.bindings.registry import QUERIES
from listmill.config import EngineConfig
from listmill.plans import consolidate
from listmill.schemas import LISTINGS
from listmill.sources import readers

TEXTS = "id string, text string, url string"


def _texts(spark, *ids):
    return spark.createDataFrame([(i, f"text {i}", None) for i in ids], TEXTS)


def _answers(spark, rows):
    return spark.createDataFrame([(k, v if v is None or isinstance(v, str) else json.dumps(v)) for k, v in rows], "key string, answer string")


def test_every_text_has_a_record_or_a_reason(spark):
    landed = _answers(spark, [
        ("a", {"name": "A", "fees": [{"category": "Author", "amount": 100, "currency": "USD"}]}),
        ("b", "not json"), ("c", {"name": "late"}), ("c", {"name": "early"}), ("d", None), ("z", {"name": "not asked"}),
    ])
    good, bad = readers.records(_texts(spark, "a", "b", "c", "d", "e", None), readers.stored(landed), "id")
    assert {(r["id"], r["extracted"]["name"]) for r in good.collect()} == {("a", "A"), ("c", "early")}
    assert {(r["id"], r["rejected"]) for r in bad.collect()} == {("b", "broken"), ("d", "unanswered"), ("e", "unanswered")}
    assert good.where("id = 'a'").first()["extracted"]["fees"][0]["amount"] == 100.0


def test_repeated_keys_and_no_texts(spark):
    landed = _answers(spark, [("a", {"name": "A"})])
    good, bad = readers.records(_texts(spark, "a", "a"), readers.stored(landed), "id")
    assert good.count() == 1 and bad.count() == 0
    good, bad = readers.records(_texts(spark, "a").limit(0), readers.stored(landed), "id")
    assert good.count() == bad.count() == 0


def test_a_reader_of_ones_own(spark):
    @readers.reader(readers.TOPICS, "by length")
    def by_length(texts):
        assert texts.columns == ["key", "text", "url", "hint"]
        said = F.struct((F.length("text") > 6).alias("is_topic"), F.lit("length").alias("reason"))
        return texts.select("key", F.to_json(said).alias("answer"))

    good, bad = readers.topics(_texts(spark, "a", "bbb"), "by length", "id")
    assert {tuple(r) for r in good.select("id", "is_topic", "reason").collect()} == {("a", False, "length"), ("bbb", True, "length")}
    assert bad.count() == 0


def test_topic_answers_of_the_wrong_kind(spark):
    landed = _answers(spark, [("a", {"is_topic": "maybe"}), ("b", {"reason": "no verdict"}), ("c", [1]), ("d", {"is_topic": True})])
    good, bad = readers.topics(_texts(spark, "a", "b", "c", "d"), readers.stored(landed), "id")
    assert [tuple(r) for r in good.select("id", "is_topic", "reason").collect()] == [("d", True, None)]
    assert {(r["id"], r["rejected"]) for r in bad.collect()} == {("a", "result"), ("b", "result"), ("c", "shape")}


def test_unknown_and_unfit_readers(spark):
    with pytest.raises(KeyError, match="keywords"):
        readers.topics(_texts(spark, "a"), "nobody", "id")
    with pytest.raises(ValueError, match="answer"):
        readers.topics(_texts(spark, "a"), lambda texts: texts.select("key"), "id")
    with pytest.raises(ValueError, match="records"):
        readers.reader("riddles", "x")


def test_only_open_listings_are_sent(spark):
    start = dt.date(2026, 10, 1)
    rows = [(1, "Machine Learning Symposium", start), (2, "Annual Meeting", start), (3, "Another Meeting", dt.date(2019, 1, 1))]
    named = spark.createDataFrame(rows, "id bigint, name string, start_date date")
    listings = spark.createDataFrame([], LISTINGS).unionByName(named, allowMissingColumns=True)
    config = EngineConfig(window_start=dt.date(2026, 1, 1), window_end=dt.date(2026, 12, 31))
    landed = _answers(spark, [("1", {"is_topic": False}), ("2", {"is_topic": True, "reason": "computing"}), ("3", {"is_topic": True})])
    typed = landed.withColumn("key", F.col("key").cast("bigint"))
    answers, bad = consolidate.second_opinions(listings, config, readers.stored(typed))
    assert [r["id"] for r in answers.collect()] == [2] and bad.count() == 0
    judged = {r["id"]: (r["is_topic"], r["topic_reason"]) for r in consolidate.filter_listings(listings, config, answers).collect()}
    assert judged[2] == (True, "llm: computing") and judged[1][0] is True


def _parses(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("VariantExpressionEvalUtils.parseJson")


def test_records_are_told_apart_in_one_pass(spark):
    landed = _answers(spark, [("a", {"name": "A"}), ("b", "not json"), ("d", {"fees": ["no fee"]}), ("e", {"fees": {"amount": "5"}})])
    read = readers.all_records(_texts(spark, "a", "b", "c", "d", "e"), readers.stored(landed), "id")
    assert _parses(read) == 1  # before it runs, a plan is shown once
    got = {r["id"]: (r["rejected"], r["extracted"] and (r["extracted"]["name"], r["extracted"]["fees"] and r["extracted"]["fees"][0]["amount"])) for r in read.collect()}
    assert got == {"a": (None, ("A", None)), "b": ("broken", None), "c": ("unanswered", None), "d": ("result", None), "e": (None, (None, 5.0))}
    assert _parses(QUERIES["reader_records"](spark, "/root/testdata/sf0.001")) == 1
