"""Quality rules: counts against plain versions, sketches against sorted values, thresholds on small tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from listmill.llm import quality

FOLDER = "/root/testdata/sf0.001"


def plain_features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines))


def test_features_against_plain():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a b c d e f g h " * 3, "x\ny\nx\n\n \nx", "ä#*$%&|<> ü\x0b\x85\xa0z"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a ", "b ", "ab\n", "ä|", "\n", " ", "#x "]) for _ in range(rng.randint(0, 120))))
    for text in texts:
        assert quality.features(text) == plain_features(text), repr(text)


def test_features_of_a_very_long_text():
    words = [str(i) for i in range(200_000)]
    text = " ".join(words + words[:9])
    assert quality.features(text)[4] == 18


def test_buckets_are_in_order_and_near(spark):
    rows = spark.range(0, 20_000, 7).select("id", quality.bucket_of(F.col("id")).alias("b")).withColumn("s", quality.bucket_start(F.col("b"))).orderBy("id").collect()
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))
    assert all(r.s <= r.id <= r.s * 33 / 32 + 1 for r in rows)


def corpus(rng, n, source, symbols):
    base = ["word%d" % i for i in range(400)]
    return [(" ".join(rng.choice(base) + ("#" if rng.random() < symbols else "") for _ in range(60)), "en", source) for _ in range(n)]


def test_thresholds_follow_the_source(spark):
    """What is usual in one source is rejected in another; small sources take the language's limits."""
    rng = random.Random(2)
    rows = corpus(rng, 150, "plain", 0) + corpus(rng, 150, "tags", 1) + corpus(rng, 5, "small", 0) + corpus(rng, 1, "plain", 1)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge_quality(docs).collect()}
    assert [i for i, k in kept.items() if not k] == [305]
    counted = quality.with_features(docs, "f", keep_text=False)
    levels = {r.source: r.level for r in quality.thresholds(quality.sketch(counted, "f", ["lang", "source"]), "lang", "source").collect()}
    assert levels == {"plain": "source", "tags": "source", "small": "language"}


def test_quartiles_against_sorted_values(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 90) for _ in range(rng.randint(20, 40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' lang", "null source")
    counted = quality.with_features(docs, "f", keep_text=False).where(~quality.base_failed("f"))
    got = quality.bounds(quality.sketch(counted, "f", ["lang"]), ["lang"]).first().limits["word_length"]
    values = sorted(100 * f[1] // f[0] for f in map(plain_features, (t for _, t in rows)) if f[0] >= 20 and 100 * f[4] <= 30 * f[0])
    q1, q3 = (next(v for i, v in enumerate(values, 1) if 4 * i >= k * len(values)) for k in (1, 3))
    reach = max(200, 3 * (got.most - got.least) / 7)
    assert abs((got.least + reach) - q1) <= q1 / 16 + 2 and abs((got.most - reach) - q3) <= q3 / 16 + 2


def test_nulls_repeated_rows_and_extra_columns(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(1, good, None, None), (1, good, None, None), (None, None, "en", "a"), (2, "", "en", None), (3, good, "en", "a")]
    docs = spark.createDataFrame([(*r, 5, "v") for r in rows], "doc_id long, text string, lang string, source string, kept int, n_words string")
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.judge_quality(docs).collect()), key=str)
    assert got == sorted([(1, 30, False, True)] * 2 + [(None, 0, True, False), (2, 0, True, False), (3, 30, False, True)], key=str)
    kept = quality.keep_good(docs)
    assert kept.schema.names == docs.schema.names and sorted(r.doc_id for r in kept.collect()) == [1, 1, 3]
    assert quality.judge_quality(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


def test_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge_quality(docs).join(labels, "doc_id").collect()
    judged = [r for r in rows if not r.base_failed]
    assert all(r.kept for r in judged if r.quality == 1)
    assert sum(r.kept for r in judged if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in judged)


@pytest.mark.parametrize("window", [2, 8])
def test_repeats_at_the_ends(window):
    words = [b"%d" % i for i in range(window)] * 2
    assert quality.repeated_words(words, window) == 2 * window
    assert quality.repeated_words(words[: window + 1], window) == (0 if window > 1 else 2)
