"""The merge rules as SQL scripts: a batch of observations folded into an answer table, guarded by "has rows".

``merge(spark, rule, state, changes, target)`` takes the names of two views or tables and leaves the merged table as the
temporary view ``target``; nothing but the guard's answer passes through the driver. State and batch are brought to
partial rows and aggregated together, as the DataFrame forms do, so the raw batch is aggregated before any shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Rule -> merged rows out of {state} and {changes}.
RULES = {
    "condition_frequency": """
        SELECT city_id, weather_condition, sum(frequency) AS frequency FROM (
          SELECT city_id, weather_condition, frequency FROM {state}
          UNION ALL SELECT city_id, main, count(*) FROM {changes} GROUP BY city_id, main)
        GROUP BY city_id, weather_condition""",
    "avg_exact": """
        SELECT city_id, sum(sum_temperature) AS sum_temperature, sum(count_temperature) AS count_temperature FROM (
          SELECT city_id, sum_temperature, count_temperature FROM {state}
          UNION ALL SELECT city_id, sum(temperature), count(temperature) FROM {changes} GROUP BY city_id)
        GROUP BY city_id""",
    "running_max": """
        SELECT city_id, max(max_abs_temperature) AS max_abs_temperature FROM (
          SELECT city_id, max_abs_temperature FROM {state} UNION ALL SELECT city_id, temperature FROM {changes})
        GROUP BY city_id""",
    "strongest_wind": """
        SELECT city_id, max(max_wind_speed) AS max_wind_speed FROM (
          SELECT city_id, max_wind_speed FROM {state} UNION ALL SELECT city_id, wind_speed FROM {changes})
        GROUP BY city_id""",
    "daily_extremes": """
        SELECT city_id, date, max(hi) AS hi, min(lo) AS lo FROM (
          SELECT city_id, date, hi, lo FROM {state}
          UNION ALL SELECT city_id, CAST(dt AS DATE), temperature, temperature FROM {changes})
        GROUP BY city_id, date""",
    "distinct_conditions": """
        SELECT sort_array(collect_set(main)) AS distinct_conditions, count(DISTINCT main) AS distinct_conditions_count FROM (
          SELECT explode(distinct_conditions) AS main FROM {state} UNION ALL SELECT main FROM {changes})""",
    "city": """
        WITH grain AS (
          SELECT name, city_id, timezone, country, latitude, longitude, min(struct(dt, event_id)) AS early,
                 max(struct(dt, event_id)) AS late
          FROM {changes} GROUP BY name, city_id, timezone, country, latitude, longitude),
        batch AS (
          SELECT name, min_by(struct(timezone, country, latitude, longitude), early) AS first, max_by(city_id, late) AS last,
                 true AS there
          FROM grain GROUP BY name),
        kept AS (SELECT *, true AS there FROM {state})
        SELECT coalesce(s.name, b.name) AS name, CASE WHEN b.there THEN b.last ELSE s.city_id END AS city_id,
               CASE WHEN s.there THEN s.timezone ELSE b.first.timezone END AS timezone,
               CASE WHEN s.there THEN s.country ELSE b.first.country END AS country,
               CASE WHEN s.there THEN s.latitude ELSE b.first.latitude END AS latitude,
               CASE WHEN s.there THEN s.longitude ELSE b.first.longitude END AS longitude
        FROM kept s FULL JOIN batch b ON s.name <=> b.name""",
}

SCRIPT = """
BEGIN
  IF EXISTS (SELECT 1 FROM {changes} LIMIT 1) THEN
    CREATE OR REPLACE TEMPORARY VIEW {target} AS {merged};
  ELSE
    CREATE OR REPLACE TEMPORARY VIEW {target} AS SELECT * FROM {state};
  END IF;
END
"""
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


def script(rule: str, state: str, changes: str, target: str) -> str:
    """The text that ``merge`` runs."""
    for name in (state, changes, target):
        if not NAME.fullmatch(name):
            raise ValueError(f"not a table name: {name!r}")
    if target in (state, changes):
        raise ValueError("the merged view needs a name of its own")
    names = {"state": state, "changes": changes}
    return SCRIPT.format(merged=RULES[rule].format(**names), target=target, **names)


def merge(spark: SparkSession, rule: str, state: str, changes: str, target: str) -> DataFrame:
    spark.sql(script(rule, state, changes, target))
    return spark.table(target)
