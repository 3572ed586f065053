"""Property tests: any ordered split of the input, merged batch by batch,
gives the sequential / one-batch answer."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cirrus.operators import incremental as H

SCHEMA = "event_id long, city_id long, main string, temperature double, wind_speed double, dt timestamp_ntz"

rows_strategy = st.lists(
    st.tuples(st.integers(0, 2), st.sampled_from(["Rain", "Clear", "Mist"]),
              st.floats(-40, 50, allow_nan=False).map(lambda x: round(x, 2))),
    min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, cuts=st.lists(st.integers(0, 25), max_size=3))
def test_merges_equal_sequential_rules(spark, rows, cuts):
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, k, m, v, 0.0, t0 + dt.timedelta(minutes=i)) for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    bounds = sorted({c for c in cuts if 0 < c < len(rows)})
    edges = [0] + bounds + [len(rows)]
    parts = [df.where((F.col("event_id") >= a) & (F.col("event_id") < b)) for a, b in zip(edges, edges[1:])]

    halving = H.empty_state(spark, H.HALVING_STATE)
    freq = H.empty_state(spark, H.FREQUENCY_STATE)
    for p in parts:
        halving = H.merge_avg_halving(halving, p)
        freq = H.merge_condition_frequency(freq, p)

    expected_avg, expected_freq = {}, {}
    for _, k, m, v, _, _ in data:
        expected_avg[k] = v if k not in expected_avg else (expected_avg[k] + v) / 2
        expected_freq[(k, m)] = expected_freq.get((k, m), 0) + 1
    got_avg = {r.city_id: r.avg_temperature for r in halving.collect()}
    assert got_avg.keys() == expected_avg.keys()
    assert all(abs(got_avg[k] - expected_avg[k]) < 1e-9 for k in expected_avg)
    assert {(r.city_id, r.weather_condition): r.frequency for r in freq.collect()} == expected_freq
