"""Stored tables bucketed alike: no shuffle in their join, no hot bucket, replaced in one step."""

import uuid

import pytest
from pyspark.sql import functions as F

from cirrus.operators import joins


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def name(spark):
    own = f"by_city_{uuid.uuid4().hex[:8]}"
    yield own
    spark.sql(f"DROP VIEW IF EXISTS {own}")
    for side in ("fact", "dim"):
        for v in range(6):
            spark.sql(f"DROP TABLE IF EXISTS {own}_{side}_v{v}")


def facts(spark, n=20000):
    """A third of the rows on one city, a tenth on none."""
    i = F.col("id")
    city = F.when(i % 10 == 9, F.lit(None)).when(i % 3 == 0, F.lit(7)).otherwise(i % 500)
    return spark.range(n).select(city.cast("long").alias("city_id"), i.alias("event_id"), (i % 11).alias("temperature"))


def cities(spark):
    return spark.range(3, 400).select(F.col("id").alias("city_id"), F.concat(F.lit("c"), F.col("id")).alias("name")).union(
        spark.createDataFrame([(7, "second"), (None, "nowhere")], "city_id long, name string"))


def rows(df):
    return sorted(map(tuple, df.select("city_id", "event_id", "temperature", "name").collect()), key=str)


def test_no_exchange_and_equal_rows(spark, tmp_path, no_broadcast, name):
    fact, dim = facts(spark), cities(spark)
    got = joins.copartition(fact, dim, name, str(tmp_path), buckets=8)
    assert got.columns == ["city_id", "event_id", "temperature", "name"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert rows(got) == rows(joins.join_dimension(fact, dim))


def test_hot_key_is_split(spark, tmp_path, no_broadcast, name):
    joins.copartition(facts(spark), cities(spark), name, str(tmp_path), buckets=8)
    stored = spark.table(f"{name}_fact_v0")
    pieces = stored.where("city_id = 7").groupBy(joins.SALT).count().collect()
    assert len(pieces) >= 3 and max(r["count"] for r in pieces) <= 20000 // 8 * 1.2
    largest = stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 20000 / 3  # the hot key alone has a third
    assert stored.where("city_id IS NULL").select(joins.SALT).distinct().count() == 8


def test_view_moves_to_the_new_pair(spark, tmp_path, name):
    fact, dim = facts(spark, 300), cities(spark)
    before = joins.copartition(fact, dim, name, str(tmp_path), buckets=4)
    old = before.count()
    for more in (600, 900):
        joins.copartition(facts(spark, more), dim, name, str(tmp_path), buckets=4)
        assert rows(spark.table(name)) == rows(joins.join_dimension(facts(spark, more), dim))
    assert joins._tables(spark, name) == [1, 2] and old > 0


def test_empty_sides(spark, tmp_path, name):
    none = facts(spark, 0)
    assert joins.copartition(none, cities(spark), name, str(tmp_path), buckets=4).count() == 0
    assert joins.copartition(facts(spark, 30), cities(spark).limit(0), name, str(tmp_path), buckets=4).count() == 0
