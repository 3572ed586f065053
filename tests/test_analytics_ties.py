import datetime as dt

from cirrus.operators import analytics as A


def _frames(spark, rows):
    obs = spark.createDataFrame(rows, "city_id long, main string, temperature double, wind_speed double, "
                                      "dt timestamp_ntz")
    city = spark.createDataFrame([(1, "Milan"), (2, "Bologna"), (3, "Milan")], "city_id long, name string")
    return obs, city


def test_rank_ties_share_rank_and_skip(spark):
    t = dt.datetime(2024, 3, 30, 10)
    rows = [(1, "Rain", 1.0, 1.0, t), (1, "Rain", 1.0, 1.0, t), (3, "Clouds", 1.0, 1.0, t),
            (1, "Clouds", 1.0, 1.0, t), (1, "Mist", 1.0, 1.0, t)]
    obs, city = _frames(spark, rows)
    got = {r.weather_condition: (r.frequency, r.weather_rank) for r in A.condition_rank(obs, city).collect()}
    assert got == {"Rain": (2, 1), "Clouds": (2, 1), "Mist": (1, 3)}   # two ids, one city name


def test_variation_tie_broken_by_name(spark):
    d = dt.datetime(2024, 3, 30, 1)
    rows = [(1, "x", 10.0, 0.0, d), (1, "x", 12.0, 0.0, d), (2, "x", 5.0, 0.0, d), (2, "x", 7.0, 0.0, d)]
    obs, city = _frames(spark, rows)
    top = A.daily_top_variation(obs, city).collect()
    assert [(r.city, r.temperature_variation) for r in top] == [("Bologna", 2.0)]
    assert A.max_variation(obs, city).first().city == "Bologna"
