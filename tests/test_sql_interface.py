"""SQL functions and merge scripts against the DataFrame forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cirrus.functions import scalars, sql
from cirrus.operators import incremental as H, merges_sql as M


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_functions_equal_the_column_forms(spark):
    assert set(sql.register(spark)) == set(sql.FUNCTIONS)
    rows = [(d, t, e) for d, t, e in zip([None, -1.0, 0.0, 22.5, 67.49, 112.5, 200.0, 247.5, 337.49, 337.5, 360.0, 361.0],
                                         [None, 0, 3600, 7200, 1, -3600] * 2, [None, 0, -1, 1711714980, 2**33, 7] * 2)]
    df = spark.createDataFrame(rows, "d double, t int, e long")
    ts = scalars.epoch_to_timestamp("e")
    want = df.select(scalars.wind_direction("d"), scalars.timezone_override("t"), scalars.utc_offset_label("t"),
                     scalars.round_coordinate("d"), ts, scalars.timestamp_to_epoch(ts))
    got = df.selectExpr("wind_direction(d)", "timezone_override(t)", "utc_offset_label(t)", "round_coordinate(d)",
                        "epoch_to_timestamp(e)", "timestamp_to_epoch(epoch_to_timestamp(e))")
    assert _rows(got) == _rows(want)
    assert "Python" not in got._jdf.queryExecution().toString()


T0 = dt.datetime(2024, 3, 29)
OBS = "city_id long, main string, temperature double, wind_speed double, dt timestamp_ntz, event_id long"
EARLY = [(1, "Rain", 280.0, 1.0, T0, 1), (1, "Rain", None, None, T0, 2), (None, None, 260.0, 3.0, T0, 3)]
LATE = [(1, "Clear", 290.0, 0.5, T0 + dt.timedelta(days=1), 4), (2, "Rain", 270.0, 9.0, T0, 5)]
RULES = {
    "condition_frequency": (H.FREQUENCY_STATE, H.merge_condition_frequency),
    "avg_exact": (H.AVG_STATE, H.merge_avg_exact),
    "running_max": (H.max_state("max_abs_temperature"), H.merge_running_max),
    "strongest_wind": (H.max_state("max_wind_speed"), lambda s, c: H.merge_running_max(s, c, "wind_speed", "max_wind_speed")),
    "daily_extremes": (H.DAILY_STATE, H.merge_daily_extremes),
    "distinct_conditions": (H.distinct_conditions_state(), H.merge_distinct_conditions),
}


@pytest.mark.parametrize("rule", RULES)
def test_scripts_equal_the_rules(spark, rule):
    schema, merge = RULES[rule]
    state = H.empty_state(spark, schema)
    state.createOrReplaceTempView("m_0")
    for i, part in enumerate((EARLY, [], LATE)):
        changes = spark.createDataFrame(part, OBS)
        changes.createOrReplaceTempView(f"c_{i}")
        got = M.merge(spark, rule, f"m_{i}", f"c_{i}", f"m_{i + 1}")
        state = merge(state, changes) if part else state
        assert _rows(got.select(state.columns)) == _rows(state)


def test_city_script_and_its_names(spark):
    schema = "name string, city_id long, timezone int, country string, latitude double, longitude double, dt timestamp_ntz, event_id long"
    parts = [[("Milan", 1, 3600, "IT", 45.5, 9.2, T0, 2), ("Milan", 2, 0, "IT", 1.0, 1.0, T0, 1), (None, 9, None, None, None, None, T0, 3)],
             [("Milan", 3, 7200, "FR", 2.0, 2.0, T0, 4), ("Rome", 4, 0, "IT", 41.9, 12.5, T0, 5)]]
    state = H.empty_state(spark, H.CITY_STATE)
    state.createOrReplaceTempView("u_0")
    for i, part in enumerate(parts):
        changes = spark.createDataFrame(part, schema)
        changes.createOrReplaceTempView(f"d_{i}")
        got = M.merge(spark, "city", f"u_{i}", f"d_{i}", f"u_{i + 1}")
        state = H.merge_city(state, changes)
        assert _rows(got.select(state.columns)) == _rows(state)
    for bad in (("a; DROP TABLE x", "b", "c"), ("a", "b", "a")):
        with pytest.raises(ValueError):
            M.script("city", *bad)
