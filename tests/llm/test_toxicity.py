import random

from pyspark.sql import functions as F

from cirrus.llm import op10_toxicity as T

from .conftest import SF


def slow_segments(values):
    """Definition: split at the best scoring run, take it, go on left and right of it (Ruzzo and Tompa)."""
    def go(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += values[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                    best = (i, j, total)
        return [] if best is None else go(a, best[0]) + [best] + go(best[1] + 1, b)
    return go(0, len(values))


def test_segments_against_definition():
    rng = random.Random(5)
    for _ in range(300):
        found = [(i, rng.uniform(0.2, 3.0)) for i in range(40) if rng.random() < 0.3]
        values = [-0.3] * 40
        for i, s in found:
            values[i] = s
        got = [(a, b, round(s, 6)) for a, b, s in T.segments(found, 0.3)]
        assert got == [(a, b, round(s, 6)) for a, b, s in slow_segments(values)]


def test_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    got = T.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    r = got.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")).alias("ok"), F.count("*").alias("n"),
                F.sum(F.col("predicted") * F.col("toxic")).alias("hit"), F.sum("toxic").alias("bad")).first()
    assert r["ok"] >= 0.9 * r["n"] and r["hit"] >= 0.7 * r["bad"]


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(9, 1), (1, 0), (2, 0), (None, 1), (3, None), (9, 1)], "doc_id long, toxic int")
    model = T.learn(odd_docs, labels)
    wide = odd_docs.withColumn("score", F.lit(1))
    got = T.score(odd_docs, model, "doc_id").collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert T.clean(wide, model).columns == wide.columns
    nothing = T.learn(no_docs, labels)
    assert T.clean(odd_docs, nothing).count() == odd_docs.count() and T.clean(no_docs, model).count() == 0
