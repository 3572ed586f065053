"""The pipeline against its stages' definitions, on the smallest tables and on odd rows."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as C
from cirrus.llm import op9_pii
from cirrus.llm import op10_toxicity as T

from .conftest import SF
from .test_decontaminate import brute as contaminated
from .test_near import brute as groups


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(C.STAGES)
    one = stage["toxicity"](spark, docs, SF)
    model = T.learn(*T.training(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    want = {r["doc_id"] for r in T.score(docs, model, "doc_id").where("score < 0.7").collect()}
    assert {r["doc_id"] for r in one.collect()} == want

    two = stage["near"](spark, one, SF)
    texts = [(r["doc_id"], r["text"]) for r in one.collect()]
    found = groups(texts, 5, 80)
    assert {r["doc_id"] for r in two.collect()} == {i for i, (n, c) in found.items() if not n or i == c}

    three = stage["contamination"](spark, two, SF)
    texts = [(r["doc_id"], r["text"]) for r in two.collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = contaminated(texts, bench)
    assert {r["doc_id"] for r in three.collect()} == {i for i, x in bad.items() if not x[3]}

    four = {r["doc_id"]: r for r in stage["pii"](spark, three, SF).collect()}
    for r in three.collect():
        assert not op9_pii.base_spans(four[r["doc_id"]]["text"])
        if not re.search("[0-9@]", r["text"]):
            assert four[r["doc_id"]] == r


def test_odd_rows_and_clashing_columns(spark, odd_docs, no_docs):
    extra = ("_th", "keep_id", "bad_id", "_size", "_take", "component", "score", "segments", "spans", "node")
    for docs in (odd_docs, no_docs):
        wide = docs.select("*", *(F.lit(1).alias(c) for c in extra))
        for name, stage in C.STAGES:
            out = stage(spark, wide, SF)
            assert out.columns == wide.columns, name
            assert (out.count() > 0) == (docs is odd_docs), name
