"""Exact distinct counts by bitmaps: against sets, over any split, with bounded rows."""

from pyspark.sql import functions as F

from cirrus.operators import distinct as D


def test_equals_count_distinct_with_nulls_over_a_split(spark):
    rows = [(k, v) for k in ("a", "b", None) for v in ("x", "y", "x", None)] + [("c", None), ("a", "z"), ("a", "z")]
    df = spark.createDataFrame(rows, "k string, v string").withColumn("n", F.monotonically_increasing_id())
    early, late = df.where("n % 2 = 0"), df.where("n % 2 = 1")
    dictionary = D.extend_dictionary(None, early, "v")
    state = D.partial_bitmaps(early, dictionary, "v", ["k"])
    more = D.extend_dictionary(dictionary, late, "v")
    state = D.merge_bitmaps(state, late, more, "v", ["k"])
    got = {r["k"]: r["distinct_count"] for r in D.count_bitmaps(state, ["k"]).collect()}
    assert got == {"a": 3, "b": 2, None: 2}
    assert D.count_bitmaps(D.combine_bitmaps(state)).first()[0] == 3
    ids = {r["value"]: r["value_id"] for r in more.collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    assert all(ids[r["value"]] == r["value_id"] for r in dictionary.collect())


def test_empty(spark):
    none = spark.createDataFrame([], "k string, v string")
    dictionary = D.extend_dictionary(None, none, "v")
    assert D.extend_dictionary(dictionary, none, "v").count() == 0
    assert D.count_bitmaps(D.partial_bitmaps(none, dictionary, "v")).first()[0] == 0
    assert D.count_bitmaps(D.partial_bitmaps(none, dictionary, "v", ["k"]), ["k"]).count() == 0


def test_a_million_values_of_one_key_meet_in_no_row(spark):
    n = 1_000_000
    df = spark.range(n * 3 // 2).select(F.lit("hot").alias("k"), (F.col("id") % n).alias("v"))
    dictionary = D.extend_dictionary(None, df, "v")
    state = D.partial_bitmaps(df, dictionary, "v", ["k"])
    assert D.count_bitmaps(state, ["k"]).first()["distinct_count"] == n
    sizes = state.select(F.bitmap_count("bits").alias("c"), F.octet_length("bits").alias("b")).agg(
        F.max("c"), F.max("b"), F.count(F.lit(1))).first()
    assert sizes[0] <= 32768 and sizes[1] == 4096 and sizes[2] == -(-n // 32768)
    assert "collect_set" not in state._jdf.queryExecution().executedPlan().toString()
