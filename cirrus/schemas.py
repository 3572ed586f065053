"""Declared schemas of the curated and consumption tables.

Ids are ``bigint``: location keys of a 100 TB deployment do not fit ``int``.
Measures are ``double``; ``dt`` is ``timestamp_ntz`` in UTC.
"""

from pyspark.sql import types as T

CURATED_WEATHER = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("main", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("feels_like", T.DoubleType()),
    T.StructField("temp_min", T.DoubleType()),
    T.StructField("temp_max", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("visibility", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("wind_direction", T.StringType()),
    T.StructField("cloudiness", T.IntegerType()),
    T.StructField("rain_1h", T.DoubleType()),
    T.StructField("rain_3h", T.DoubleType()),
    T.StructField("snow_1h", T.DoubleType()),
    T.StructField("snow_3h", T.DoubleType()),
    T.StructField("dt", T.TimestampNTZType()),
])

CONSUMPTION = {
    "consumption_city": "city_id bigint, name string, timezone string, country string, latitude double, longitude double",
    "distinct_weather_conditions": "distinct_conditions array<string>, distinct_conditions_count bigint",
    "weather_conditions_rank_per_city": "city_id bigint, city string, weather_condition string, frequency bigint, rank int",
    "avg_temp_per_city": "city_id bigint, city string, avg_temperature double",
    "max_abs_temp": "city_id bigint, city string, max_abs_temperature double",
    "city_with_strongest_wind": "city_id bigint, city string, max_wind_speed double",
    "max_daily_temp_variation": "city_id bigint, city string, date date, temperature_variation double",
}

# Declared length limits (VARCHAR(n)) of the consumption tables.
LENGTH_LIMITS = {"name": 50, "city": 50, "timezone": 50, "weather_condition": 50, "country": 3}

# Declared keys: table -> (not-null/unique key columns).
PRIMARY_KEYS = {
    "curated_city": ("city_id",),
    "consumption_city": ("city_id",),
    "avg_temp_per_city": ("city_id",),
    "max_abs_temp": ("city_id",),
    "max_daily_temp_variation": ("city_id",),
    "city_with_strongest_wind": ("city_id",),
    "weather_conditions_rank_per_city": ("city_id", "weather_condition"),
}
