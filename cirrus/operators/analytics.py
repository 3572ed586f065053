"""Analytic questions over (observation fact, location dimension).

All questions group by the location *name*; several ids may share one name.
Every question first aggregates the fact by ``city_id`` (map-side partial
aggregation, so a hot location only yields one partial row per task), then
joins the tiny per-id partials to the dimension and finishes the aggregate
by name. The join never sees the raw fact, so neither a large dimension nor a
skewed key makes the fact shuffle by join key. Exactly equivalent to
join-then-aggregate: duplicated dimension rows multiply partial sums/counts
the same way they multiply raw rows, and max/min/sets are idempotent.

Inputs: ``obs`` with city_id, main, temperature, wind_speed, dt;
``city`` with city_id, name. ``start``/``end`` bound ``dt`` (closed range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cirrus.operators.curate import filter_time_range


def _period(obs: DataFrame, start, end, date_col: str | None = None) -> DataFrame:
    if start is None and end is None:
        return obs
    return filter_time_range(obs, start, end, "dt", date_col)


def _names(city: DataFrame) -> DataFrame:
    return city.select("city_id", F.col("name").alias("city"))


def distinct_conditions(obs: DataFrame, start=None, end=None) -> DataFrame:
    """Q1: number and sorted set of distinct conditions (NULLs ignored).

    The set is bounded by the condition domain, not by the data."""
    s = _period(obs, start, end).agg(F.collect_set("main").alias("s"))
    return s.select(F.size("s").cast("long").alias("distinct_conditions_count"),
                    F.sort_array("s").alias("distinct_conditions"))


def distinct_conditions_per_city(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q2: Q1 per city name (cities without rows in the period are absent)."""
    pairs = _period(obs, start, end).select("city_id", "main").distinct()
    s = (pairs.join(_names(city), "city_id")
         .groupBy("city").agg(F.collect_set("main").alias("s")))
    return s.select("city", F.size("s").cast("long").alias("distinct_conditions_count"),
                    F.sort_array("s").alias("distinct_conditions"))


def condition_frequency(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """COUNT(*) per (city name, condition)."""
    partial = _period(obs, start, end).groupBy("city_id", "main").agg(F.count(F.lit(1)).alias("n"))
    return (partial.join(_names(city), "city_id")
            .groupBy("city", F.col("main").alias("weather_condition"))
            .agg(F.sum("n").alias("frequency")))


def condition_rank(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q3: RANK() of conditions per city by frequency (ties share a rank).

    The window runs over the aggregate: one partition per city holds one row
    per condition, bounded by the condition domain."""
    w = Window.partitionBy("city").orderBy(F.desc("frequency"))
    return condition_frequency(obs, city, start, end).withColumn(
        "weather_rank", F.rank().over(w).cast("long"))


def avg_temperature(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q4: AVG(temperature) per city name via (sum, count) partials."""
    partial = (_period(obs, start, end).groupBy("city_id")
               .agg(F.sum("temperature").alias("s"), F.count("temperature").alias("n")))
    return (partial.join(_names(city), "city_id").groupBy("city")
            .agg(F.try_divide(F.sum("s"), F.sum("n")).alias("avg_temperature")))


def max_per_city(obs: DataFrame, city: DataFrame, value: str, alias: str,
                 start=None, end=None) -> DataFrame:
    """MAX(value) per city name."""
    partial = _period(obs, start, end).groupBy("city_id").agg(F.max(value).alias("m"))
    return partial.join(_names(city), "city_id").groupBy("city").agg(F.max("m").alias(alias))


def maxima_per_city(obs: DataFrame, city: DataFrame, values: dict[str, str], start=None, end=None) -> DataFrame:
    """MAX of several columns (column -> alias) per city name, in one pass."""
    partial = _period(obs, start, end).groupBy("city_id").agg(*(F.max(c).alias(a) for c, a in values.items()))
    return partial.join(_names(city), "city_id").groupBy("city").agg(*(F.max(a).alias(a) for a in values.values()))


def top1(df: DataFrame, by: str, *tie_break: str) -> DataFrame:
    """ORDER BY by DESC NULLS LAST, tie-break ASC, LIMIT 1 (TakeOrderedAndProject:
    per-partition top-1, then one merge of #partitions rows)."""
    return df.orderBy(F.desc_nulls_last(by), *tie_break).limit(1)


def hottest_city(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q5: city with the highest (plain MAX) temperature."""
    return top1(max_per_city(obs, city, "temperature", "max_abs_temperature", start, end),
                "max_abs_temperature", "city")


def strongest_wind(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q8: city with the strongest wind."""
    return top1(max_per_city(obs, city, "wind_speed", "max_wind_speed", start, end),
                "max_wind_speed", "city")


def daily_variation(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """MAX - MIN temperature per (city name, UTC day)."""
    partial = (_period(obs, start, end)
               .groupBy("city_id", F.to_date("dt").alias("date"))
               .agg(F.max("temperature").alias("hi"), F.min("temperature").alias("lo")))
    return (partial.join(_names(city), "city_id").groupBy("city", "date")
            .agg((F.max("hi") - F.min("lo")).alias("temperature_variation")))


def daily_top_variation(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q6: per day, the city with the largest variation (ties -> smaller name).

    ROW_NUMBER over the (day, city) aggregate; Catalyst turns ``rn = 1`` into a
    WindowGroupLimit so each day keeps one row before and after the shuffle."""
    w = Window.partitionBy("date").orderBy(F.desc_nulls_last("temperature_variation"), "city")
    return (daily_variation(obs, city, start, end)
            .withColumn("rn", F.row_number().over(w))
            .where("rn = 1")
            .select("date", "city", "temperature_variation"))


def max_variation(obs: DataFrame, city: DataFrame, start=None, end=None) -> DataFrame:
    """Q7: the single largest daily variation (city, day)."""
    return top1(daily_variation(obs, city, start, end), "temperature_variation", "city", "date")
