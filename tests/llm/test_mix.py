from pyspark.sql import functions as F

from cirrus.llm import op6_mix as M


def test_words_taken_follow_the_targets(spark, odd_docs):
    plan = M.plan(odd_docs.withColumn("cut", F.lit(1)).withColumn("size", F.lit(1)))
    by = plan.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.sum("size").alias("s"),
                                    F.max("source_size").alias("n")).collect()
    total = sum(r["s"] for r in by)
    assert all(r["s"] == r["n"] and r["t"] == int(r["g"]) and r["t"] <= 2 * r["s"] for r in by)
    assert abs(sum(r["g"] for r in by) - 1.5 * total) < 1e-6
    assert plan.where("taken > 2 * size").count() == 0
    key = lambda df: sorted(map(str, df.collect()))
    assert key(plan) == key(M.plan(odd_docs))


def test_mixed_documents_hold_the_taken_words(spark, odd_docs, no_docs):
    wide = odd_docs.withColumn("_size", F.lit(1)).withColumn("whole", F.lit(1))
    mixed = M.mix(wide)
    assert mixed.columns == wide.columns
    count = lambda t: len((t or "").split())
    assert sum(count(r["text"]) for r in mixed.collect()) == M.plan(odd_docs).agg(F.sum("taken")).first()[0]
    assert M.mix(no_docs).count() == 0 and M.plan(no_docs).count() == 0


def test_excess_is_reshared(spark):
    rows = [(s, n, w) for s, n, w in (("a", 10, 5), ("b", 100, 2), ("c", 1000, 1))]
    out = M.water_fill(spark.createDataFrame(rows, "source string, source_size long, weight int"), 1.5, 2)
    assert {r["source"]: r["target"] for r in out.collect()} == {"a": 20.0, "b": 200.0, "c": 1445.0}
