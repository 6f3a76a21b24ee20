"""Readers of texts: the place where an extraction service or a rule of one's own plugs in.

A reader is a function ``DataFrame -> DataFrame``. It gets the columns key, text, url and hint, one row
per text, and returns key and answer, a JSON body: a record of the event for ``RECORDS``, an object
with is_topic and reason for ``TOPICS``. How it gets there is its own affair; a service whose answers
were landed before the run is ``stored``. What comes back is held to the same rules for all readers:
texts without an answer and answers that cannot be read are rejected with a reason, never lost; of
several answers to one text the least in text order counts; answers to texts that were not asked
about are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed_values as fv
from listmill.functions.regex import present
from listmill.functions.topics import keyword_hits, verdict
from listmill.sources.answers import records as extractions
from listmill.sources.answers import topic_verdicts

Reader = Callable[[DataFrame], DataFrame]
#: What a reader may be asked for.
RECORDS, TOPICS = "records", "topics"
READERS: dict[tuple[str, str], Reader] = {}
#: Reason of a text that its reader has left without an answer.
UNANSWERED = "unanswered"


def reader(kind: str, name: str) -> Callable[[Reader], Reader]:
    """Make a reader known by name."""
    if kind not in (RECORDS, TOPICS):
        raise ValueError(f"unknown kind of reader {kind!r}; known: {[RECORDS, TOPICS]}")

    def register(fn: Reader) -> Reader:
        READERS[kind, name] = fn
        return fn

    return register


def stored(answers: DataFrame, key: str = "key", answer: str = "answer") -> Reader:
    """The reader whose answers stand in a table."""
    return lambda texts: answers.select(F.col(key).alias("key"), F.col(answer).alias("answer"))


def _chosen(kind: str, read: str | Reader) -> Reader:
    if not isinstance(read, str):
        return read
    if (kind, read) not in READERS:
        raise KeyError(f"unknown reader {read!r}; known: {sorted(n for k, n in READERS if k == kind)}")
    return READERS[kind, read]


def asked(texts: DataFrame, kind: str, read: str | Reader, key: str = "key") -> DataFrame:
    """(key, answer) for every text with a key; the answer is null where the reader gave none.

    Only keys and answers meet after the reader, the texts do not. A key that stands at several rows
    is asked about with each of them and gets one answer.
    """
    optional = [F.col(c) if c in texts.columns else F.lit(None).cast("string").alias(c) for c in ("url", "hint")]
    questions = texts.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), "text", *optional)
    given = _chosen(kind, read)(questions)
    missing = {"key", "answer"} - set(given.columns)
    if missing:
        raise ValueError(f"a reader returns key and answer; this one lacks {sorted(missing)}")
    least = given.groupBy("key").agg(F.min("answer").alias("answer"))
    return questions.select("key").distinct().join(least, "key", "left").withColumnRenamed("key", key)


def _unanswered() -> Column:
    return F.when(F.col("answer").isNull(), UNANSWERED).otherwise(F.col("rejected"))


def all_records(texts: DataFrame, read: str | Reader, key: str = "key") -> DataFrame:
    """(key, extracted, rejected): every text with its record, or with the reason why there is none. The
    answers are read once."""
    return extractions(asked(texts, RECORDS, read, key)).select(key, "extracted", _unanswered().alias("rejected"))


def records(texts: DataFrame, read: str | Reader, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(key, extracted) of the texts whose record could be read, (key, rejected) of all others."""
    read_ = all_records(texts, read, key)
    return read_.select(key, present(F.col("extracted")).alias("extracted")), read_.select(key, present(F.col("rejected")).alias("rejected"))


def topics(texts: DataFrame, read: str | Reader, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(key, is_topic, reason), as ``judge_topics`` takes them for second opinions, and (key, rejected)."""
    good, bad = topic_verdicts(asked(texts, TOPICS, read, key))
    return good.drop("answer"), bad.withColumn("rejected", _unanswered()).drop("answer")


@reader(TOPICS, "keywords")
def keyword_topics(texts: DataFrame) -> DataFrame:
    """The keyword rule as a reader: open verdicts stay unanswered."""
    found = verdict(keyword_hits(F.col("text"), fv.TOPIC_POSITIVE), keyword_hits(F.col("text"), fv.TOPIC_NEGATIVE))
    judged = texts.select("key", found.alias("v")).where("v.is_topic is not null")
    return judged.select("key", F.to_json("v").alias("answer"))
