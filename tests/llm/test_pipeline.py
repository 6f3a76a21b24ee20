"""The pipeline against its stages' plain versions, on the smallest tables and on odd rows."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from test_decontaminate import plain_leaks
from test_simhash import expected

import corpus_pipeline
from listmill.engine import cut
from listmill.llm import bpe, language_id, quality

FOLDER = "/root/testdata/sf0.001"


def test_run_against_plain_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.predict(docs, language_id.learn(docs)).collect()
    kept = {r.doc_id for r in found if r.lang_pred != "und" and r.score >= language_id.LEAST_SCORE}
    docs = docs.where(docs.doc_id.isin(list(kept)))
    kept = {r.doc_id for r in quality.judge_quality(docs).collect() if r.kept}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    first = {group for _, _, group in expected(rows)}
    rows = [r for r in rows if r[0] in first]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {r[0] for r in plain_leaks(rows, items)}
    rows = {i: t for i, t in rows if i not in held}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows) and 0 < len(held) and len(rows) > 50
    ranks = bpe.rank_of_tokens(bpe.rank_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        ids = library.encode_ordinary(rows[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()


def test_stages_keep_columns_and_stand_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(50)
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "s", 0), (8, "x " * 50_000, None, None, 1)], docs.schema)
    rows = docs.union(odd).selectExpr("*", "1 kept", "'x' fp")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = cut(stage(spark, rows, FOLDER))
        assert rows.columns == [*docs.columns, "kept", "fp"]
    assert corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).count() == rows.count() > 20
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = cut(stage(spark, none, FOLDER))
        assert none.count() == 0
