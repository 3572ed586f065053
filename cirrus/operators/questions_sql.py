"""The eight analytic questions as parameterised Spark SQL text.

For users who run SQL: register the curated tables as views, then
``ask(spark, "q4", start, end)``. The period is bound through named
parameter markers (``:start``, ``:end``), never by string formatting. Each
text aggregates the fact by ``city_id`` before joining the dimension (the
same plan shape as the DataFrame forms in ``analytics``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS_VIEW, CITY_VIEW = "curated_weather", "curated_city"

_PERIOD = "dt >= CAST(:start AS TIMESTAMP_NTZ) AND dt <= CAST(:end AS TIMESTAMP_NTZ)"
_NAMES = f"(SELECT city_id, name AS city FROM {CITY_VIEW}) c"

QUESTIONS = {
    "q1": f"""SELECT CAST(size(s) AS BIGINT) AS distinct_conditions_count, sort_array(s) AS distinct_conditions
        FROM (SELECT collect_set(main) AS s FROM {OBS_VIEW} WHERE {_PERIOD})""",
    "q2": f"""SELECT city, CAST(size(collect_set(main)) AS BIGINT) AS distinct_conditions_count,
            sort_array(collect_set(main)) AS distinct_conditions
        FROM (SELECT DISTINCT city_id, main FROM {OBS_VIEW} WHERE {_PERIOD}) p JOIN {_NAMES} USING (city_id)
        GROUP BY 1""",
    "q3": f"""SELECT city, weather_condition, frequency,
            CAST(RANK() OVER (PARTITION BY city ORDER BY frequency DESC) AS BIGINT) AS weather_rank
        FROM (SELECT city, main AS weather_condition, SUM(n) AS frequency
              FROM (SELECT city_id, main, COUNT(*) AS n FROM {OBS_VIEW} WHERE {_PERIOD} GROUP BY 1, 2) p
              JOIN {_NAMES} USING (city_id) GROUP BY 1, 2) f""",
    "q4": f"""SELECT city, try_divide(SUM(s), SUM(n)) AS avg_temperature
        FROM (SELECT city_id, SUM(temperature) AS s, COUNT(temperature) AS n FROM {OBS_VIEW}
              WHERE {_PERIOD} GROUP BY 1) p JOIN {_NAMES} USING (city_id) GROUP BY 1""",
    "q5": f"""SELECT city, MAX(m) AS max_abs_temperature
        FROM (SELECT city_id, MAX(temperature) AS m FROM {OBS_VIEW} WHERE {_PERIOD} GROUP BY 1) p
        JOIN {_NAMES} USING (city_id) GROUP BY 1 ORDER BY max_abs_temperature DESC NULLS LAST, city LIMIT 1""",
    "q6": f"""SELECT date, city, temperature_variation FROM (
            SELECT city, date, MAX(hi) - MIN(lo) AS temperature_variation,
                   ROW_NUMBER() OVER (PARTITION BY date ORDER BY MAX(hi) - MIN(lo) DESC NULLS LAST, city) AS rn
            FROM (SELECT city_id, TO_DATE(dt) AS date, MAX(temperature) AS hi, MIN(temperature) AS lo
                  FROM {OBS_VIEW} WHERE {_PERIOD} GROUP BY 1, 2) p
            JOIN {_NAMES} USING (city_id) GROUP BY 1, 2) v WHERE rn = 1""",
    "q7": f"""SELECT city, date, MAX(hi) - MIN(lo) AS temperature_variation
        FROM (SELECT city_id, TO_DATE(dt) AS date, MAX(temperature) AS hi, MIN(temperature) AS lo
              FROM {OBS_VIEW} WHERE {_PERIOD} GROUP BY 1, 2) p JOIN {_NAMES} USING (city_id)
        GROUP BY 1, 2 ORDER BY temperature_variation DESC NULLS LAST, city, date LIMIT 1""",
    "q8": f"""SELECT city, MAX(m) AS max_wind_speed
        FROM (SELECT city_id, MAX(wind_speed) AS m FROM {OBS_VIEW} WHERE {_PERIOD} GROUP BY 1) p
        JOIN {_NAMES} USING (city_id) GROUP BY 1 ORDER BY max_wind_speed DESC NULLS LAST, city LIMIT 1""",
}


def register_views(obs: DataFrame, city: DataFrame) -> None:
    obs.createOrReplaceTempView(OBS_VIEW)
    city.createOrReplaceTempView(CITY_VIEW)


def ask(spark: SparkSession, question: str, start, end) -> DataFrame:
    return spark.sql(QUESTIONS[question], args={"start": str(start), "end": str(end)})
