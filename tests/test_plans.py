"""Plan-shape regression tests for the properties the design relies on at scale."""

import os

import pytest

from cirrus.plans import catalog

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def plan(spark, key) -> list[str]:
    df = catalog.QUERIES[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def subtrees(lines, marker):
    """Lines of every subtree whose root line contains ``marker``."""
    out = []
    for i, line in enumerate(lines):
        if marker in line:
            depth, sub = _indent(line), []
            for nxt in lines[i + 1:]:
                if _indent(nxt) <= depth:
                    break
                sub.append(nxt)
            out.append(sub)
    return out


def first_index(lines, text):
    return next(i for i, line in enumerate(lines) if text in line)


@pytest.mark.parametrize("key,partial", [
    ("q4_avg_temperature", "partial_sum(temperature"),
    ("q5_hottest_city", "partial_max(temperature"),
    ("q3_condition_rank", "partial_count("),
])
def test_fact_is_aggregated_below_the_dimension_join(spark, key, partial):
    lines = plan(spark, key)
    join = min(i for i, line in enumerate(lines) if "HashJoin" in line or "SortMergeJoin" in line)
    assert first_index(lines, partial) > join


def test_period_reaches_the_parquet_scan(spark):
    text = "\n".join(plan(spark, "q4_avg_temperature"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-08T00:00), " \
           "LessThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_top_row_per_day_uses_window_group_limit(spark):
    assert any("WindowGroupLimit" in line for line in plan(spark, "q6_daily_top_variation"))


def test_upsert_hash_aggregates_the_raw_rows(spark):
    lines = plan(spark, "merge_city")
    aggs = [line for line in lines if "Aggregate(" in line]
    assert aggs and "HashAggregate" in aggs[-1]  # the lowest aggregate reads the rows


@pytest.mark.parametrize("key", ["merge_city", "merge_consumption_city", "cdc_snapshot_diff"])
def test_upsert_reduces_the_fact_before_the_join(spark, key):
    joins = [t for t in subtrees(plan(spark, key), "Join") if any("event_id" in line for line in t)]
    assert joins and all(any("HashAggregate" in line for line in t) for t in joins)


@pytest.mark.parametrize("key", ["join_dimension", "q4_avg_temperature", "curated_observation", "scalar_lookup"])
def test_no_join_is_forced_to_broadcast(spark, key):
    """Without a threshold nothing is broadcast: no hint overrides Spark's own decision."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not any("BroadcastExchange" in line for line in plan(spark, key))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dimension_join_broadcasts_below_the_threshold(spark):
    assert subtrees(plan(spark, "join_dimension"), "BroadcastExchange")


def test_halving_splits_keys_by_range_not_by_hash(spark):
    text = "\n".join(plan(spark, "merge_avg_halving"))
    assert "rangepartitioning(_null" in text and "MapInPandas" in text


def test_hot_key_in_a_row_level_join_is_split(spark):
    """A key holding a third of the fact rows: with no broadcast possible the
    dimension join is a sort-merge join whose skewed partition AQE splits."""
    from pyspark.sql import functions as F
    from cirrus.operators.joins import join_dimension
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("city_id"),
            F.col("id").alias("event_id"))
        dim = spark.range(1000).select(F.col("id").alias("city_id"), F.concat(F.lit("c"), F.col("id")).alias("name"))
        joined = join_dimension(fact, dim, "city_id")
        rows = joined.collect()  # executes this very plan, so its adaptive plan is final
        hot = sum(1 for i in range(n) if (7 if i % 3 == 0 else i % 1000) == 7)
        assert len(rows) == n and sum(r.city_id == 7 for r in rows) == hot
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "SortMergeJoin(skew=true)" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
