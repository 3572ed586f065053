from pyspark.sql import functions as F

from cirrus.operators import quality as D


def test_checks(spark):
    df = spark.createDataFrame([(1, "Milan", "IT"), (1, None, "ITAL"), (2, "B" * 51, "IT")],
                               "city_id long, name string, country string")
    assert D.dq_not_null(df, ["name"]).count() == 1
    assert [tuple(r) for r in D.dq_unique(df, ["city_id"]).collect()] == [(1, 2)]
    assert D.dq_length(df, {"name": 50, "country": 3}).count() == 2
    parent = spark.createDataFrame([(1,)], "id long")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "k long, city_id long")
    assert [r.k for r in D.dq_foreign_key(child, parent, "city_id", "id").collect()] == [11]


def test_surrogate_key_dense_and_ordered(spark, tmp_path):
    n = 2000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), (F.col("id") % 5).alias("g"))
    out = D.surrogate_key(df, ["g", "k"], start=100, num_partitions=9, path=str(tmp_path / "sk"))
    rows = sorted((r.g, r.k, r.surrogate_id) for r in out.collect())
    assert [r[2] for r in rows] == list(range(101, 101 + n))


def test_surrogate_key_splits_a_hot_group_of_identical_rows(spark, tmp_path):
    """A third of the rows identical on the whole order still spreads over
    several range partitions, and the ids stay dense."""
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    out = D.surrogate_key(df, ["k"], num_partitions=6, path=str(tmp_path / "sk"))
    assert sorted(r.surrogate_id for r in out.collect()) == list(range(1, n + 1))
    stored = spark.read.parquet(str(tmp_path / "sk"))
    hot_parts = stored.where("k = 0").select("_pid").distinct().count()
    assert hot_parts > 1
    zero_ids = sorted(r.surrogate_id for r in out.where("k = 0").collect())
    assert zero_ids == list(range(1, 1001))
