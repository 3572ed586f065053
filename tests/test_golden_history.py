"""Golden answers on the 91 historical documents.

The documents are only read as input data; skipped when absent."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cirrus.operators import analytics as A, curate
from cirrus.sources import landing

from conftest import HIST_DATA

pytestmark = pytest.mark.skipif(not HIST_DATA or not os.path.isdir(HIST_DATA),
                                reason="CIRRUS_HISTORY_DIR not set")
START, END = "2024-03-29", "2024-04-02"


@pytest.fixture(scope="module")
def tables(spark):
    raw = landing.read_json_documents(spark, HIST_DATA).cache()
    return raw, curate.curated_observation(raw).cache(), curate.curated_city(raw).cache()


def test_counts(tables):
    raw, obs, _ = tables
    assert raw.count() == 91
    assert obs.count() == 89
    assert curate.filter_time_range(obs, START, END).count() == 54
    by_day = {r[0]: r[1] for r in obs.groupBy(F.to_date("dt")).count().collect()}
    assert by_day == {dt.date(2024, 3, 29): 5, dt.date(2024, 3, 30): 24, dt.date(2024, 3, 31): 3,
                      dt.date(2024, 4, 1): 22, dt.date(2024, 4, 2): 26, dt.date(2024, 4, 3): 9}


def test_city_dimension(tables):
    rows = sorted(tuple(r) for r in tables[2].collect())
    assert rows == sorted([(3173435, "Milan", 3600, "IT", 45.5, 9.2), (6542283, "Milan", 3600, "IT", 45.5, 9.2),
                           (3181928, "Bologna", 3600, "IT", 44.5, 11.3), (6540125, "Cagliari", 3600, "IT", 39.2, 9.1)])


def test_q1_q2(tables):
    _, obs, city = tables
    q1 = A.distinct_conditions(obs, START, END).first()
    assert (q1[0], q1[1]) == (4, ["Clear", "Clouds", "Mist", "Rain"])
    q2 = {r.city: (r[1], r[2]) for r in A.distinct_conditions_per_city(obs, city, START, END).collect()}
    assert q2 == {"Cagliari": (3, ["Clear", "Clouds", "Rain"]), "Milan": (3, ["Clouds", "Mist", "Rain"])}


def test_q3_rank(tables):
    _, obs, city = tables
    got = {(r.city, r.weather_condition): (r.frequency, r.weather_rank)
           for r in A.condition_rank(obs, city, START, END).collect()}
    assert got == {("Cagliari", "Clouds"): (16, 1), ("Cagliari", "Clear"): (6, 2), ("Cagliari", "Rain"): (2, 3),
                   ("Milan", "Clouds"): (25, 1), ("Milan", "Mist"): (4, 2), ("Milan", "Rain"): (1, 3)}


def test_q4_q5_q8(tables):
    _, obs, city = tables
    q4 = {r.city: round(r.avg_temperature, 6) for r in A.avg_temperature(obs, city, START, END).collect()}
    assert q4 == {"Cagliari": 289.765417, "Milan": 285.403333}
    assert tuple(A.hottest_city(obs, city, START, END).first()) == ("Cagliari", 293.04)
    assert tuple(A.strongest_wind(obs, city, START, END).first()) == ("Milan", 10.29)


def test_q6_q7(tables):
    _, obs, city = tables
    q6 = sorted((r.date, r.city, round(r.temperature_variation, 2))
                for r in A.daily_top_variation(obs, city, START, END).collect())
    assert q6 == [(dt.date(2024, 3, 29), "Milan", 1.65), (dt.date(2024, 3, 30), "Milan", 6.53),
                  (dt.date(2024, 3, 31), "Cagliari", 0.87), (dt.date(2024, 4, 1), "Cagliari", 6.85)]
    q7 = A.max_variation(obs, city, START, END).first()
    assert (q7.city, q7.date, round(q7.temperature_variation, 2)) == ("Cagliari", dt.date(2024, 4, 1), 6.85)
