"""Batch = incremental: merging any ordered split of the input gives the
state of one batch over all of it (SURVEY 5.4 (3)), plus rule edge cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cirrus.operators import incremental as H
from cirrus.operators.joins import scalar_lookup

SCHEMA = "event_id long, city_id long, main string, temperature double, wind_speed double, dt timestamp_ntz"


def _obs(spark, n=400, keys=5, hot=None, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = hot if (hot is not None and i % 3 == 0) else rnd.randrange(keys)
        rows.append((i, k, rnd.choice(["Rain", "Clouds", "Clear", "Mist"]), round(rnd.uniform(-5, 35), 2),
                     round(rnd.uniform(0, 12), 2), t0 + dt.timedelta(minutes=17 * i)))
    return spark.createDataFrame(rows, SCHEMA)


def _in_order_splits(df, pieces):
    bounds = sorted(random.Random(pieces).sample(range(1, 400), pieces - 1))
    edges = [0] + bounds + [400]
    return [df.where((F.col("event_id") >= a) & (F.col("event_id") < b)) for a, b in zip(edges, edges[1:])]


def _fold(spark, merge, schema, parts, **kw):
    state = H.empty_state(spark, schema)
    for p in parts:
        state = merge(state, p, **kw)
    return state


def _rows(df, digits=9):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else (tuple(v) if isinstance(v, list) else v)
                         for v in r))
    return sorted(out, key=str)


CASES = [
    (H.merge_condition_frequency, H.FREQUENCY_STATE, {}),
    (H.merge_distinct_conditions, H.distinct_conditions_state(), {}),
    (H.merge_distinct_conditions, H.distinct_conditions_state(("city_id",)), {"keys": ("city_id",)}),
    (H.merge_avg_exact, H.AVG_STATE, {}),
    (H.merge_avg_halving, H.HALVING_STATE, {}),
    (H.merge_running_max, H.max_state("max_abs_temperature"), {}),
    (H.merge_daily_extremes, H.DAILY_STATE, {}),
]


@pytest.mark.parametrize("merge,schema,kw", CASES, ids=[c[0].__name__ + str(i) for i, c in enumerate(CASES)])
def test_split_invariance(spark, merge, schema, kw):
    obs = _obs(spark)
    whole = _fold(spark, merge, schema, [obs], **kw)
    for pieces in (2, 5):
        assert _rows(_fold(spark, merge, schema, _in_order_splits(obs, pieces), **kw)) == _rows(whole)


def test_order_independent_states_accept_late_rows(spark):
    obs = _obs(spark)
    late_first = [obs.where("event_id >= 200"), obs.where("event_id < 200")]
    for merge, schema in ((H.merge_condition_frequency, H.FREQUENCY_STATE), (H.merge_avg_exact, H.AVG_STATE),
                          (H.merge_daily_extremes, H.DAILY_STATE)):
        assert _rows(_fold(spark, merge, schema, late_first)) == _rows(_fold(spark, merge, schema, [obs]))


def test_halving_rule_values(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, 1, "x", v, 0.0, t + dt.timedelta(hours=i)) for i, v in enumerate([10.0, 20.0, 40.0])]
    obs = spark.createDataFrame(rows, SCHEMA)
    halving = _fold(spark, H.merge_avg_halving, H.HALVING_STATE, [obs]).first()
    assert halving.avg_temperature == 27.5 and halving.n == 3
    exact = H.present_avg(_fold(spark, H.merge_avg_exact, H.AVG_STATE, [obs])).first()
    assert abs(exact.avg_temperature - 70 / 3) < 1e-12
    # split 1 | 2: the incremental rule new = old * 2^-k + T_batch
    split = _fold(spark, H.merge_avg_halving, H.HALVING_STATE, [obs.where("event_id = 0"), obs.where("event_id > 0")])
    assert split.first().avg_temperature == 27.5


def test_halving_hot_key_spread_over_many_partitions(spark):
    """One key with a third of the rows, range-split over many partitions and
    Arrow batches, equals the sequential rule."""
    old = (spark.conf.get("spark.sql.shuffle.partitions"),
           spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        obs = _obs(spark, n=400, keys=4, hot=99)
        got = {r.city_id: r.avg_temperature for r in H.halving_partials(obs).select(
            "city_id", (F.col("t") + F.col("first") * F.pow(F.lit(0.5), F.col("n"))).alias("avg_temperature"))
            .collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old[1])
    expected = {}
    for r in obs.orderBy("dt", "event_id").collect():
        expected[r.city_id] = r.temperature if r.city_id not in expected else (expected[r.city_id] + r.temperature) / 2
    assert got.keys() == expected.keys()
    for k in expected:
        assert abs(got[k] - expected[k]) < 1e-9


def test_merge_city_first_insert_then_id_updates(spark):
    rows = [(1, dt.datetime(2024, 1, 1), 3173435, "Milan", 3600, "IT", 45.5, 9.2),
            (2, dt.datetime(2024, 1, 2), 6542283, "Milan", 3600, "IT", 45.4, 9.1),
            (3, dt.datetime(2024, 1, 3), 3181928, "Bologna", 3600, "IT", 44.5, 11.3)]
    changes = spark.createDataFrame(rows, "event_id long, dt timestamp_ntz, city_id long, name string, "
                                          "timezone int, country string, latitude double, longitude double")
    state = H.merge_city(H.empty_state(spark, H.CITY_STATE), changes.where("event_id = 1"))
    state = H.merge_city(state, changes.where("event_id > 1"))
    got = {r.name: (r.city_id, r.latitude) for r in state.collect()}
    assert got == {"Milan": (6542283, 45.5), "Bologna": (3181928, 44.5)}
    cons = H.merge_consumption_city(H.empty_state(spark, H.CONSUMPTION_CITY_STATE), changes)
    assert {r.name: r.timezone for r in cons.collect()} == {"Milan": "UTC+01:00", "Bologna": "UTC+01:00"}


def test_snapshot_diff_ops(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, city_id long")
    after = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "name string, city_id long")
    got = sorted(tuple(r) for r in H.snapshot_diff(before, after, "name").collect())
    assert got == [("DELETE", "c", None), ("INSERT", "d", 4), ("UPDATE", "b", 5)]


def test_theta_update_only_raises_existing(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 30.0)], "city_id long, m double")
    changes = spark.createDataFrame([(1, 15.0), (2, 20.0), (3, 99.0)], "city_id long, temperature double")
    got = sorted(tuple(r) for r in H.theta_update(target, changes, "city_id", "m", "temperature").collect())
    assert got == [(1, 15.0), (2, 30.0)]


def test_anti_join_new_conditions(spark):
    state = spark.createDataFrame([(["Rain", "Clear"], 2)], "distinct_conditions array<string>, "
                                                            "distinct_conditions_count bigint")
    changes = spark.createDataFrame([("Rain",), ("Snow",), ("Snow",)], "main string")
    assert [r.main for r in H.anti_join_new_conditions(state, changes).collect()] == ["Snow", "Snow"]


def test_scalar_lookup_semantics(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "city_id long")
    dim = spark.createDataFrame([(1, "Milan"), (2, "Bologna")], "city_id long, name string")
    got = sorted((r.city_id, r.city) for r in scalar_lookup(df, dim, "city_id", "name", "city").collect())
    assert got == [(1, "Milan"), (2, "Bologna"), (3, None)]
    dup = dim.unionByName(spark.createDataFrame([(2, "Other")], "city_id long, name string"))
    with pytest.raises(Exception):
        scalar_lookup(df, dup, "city_id", "name", "city").collect()


def test_order_key_sorts_like_the_columns(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        ts = dt.datetime(1900, 1, 1) + dt.timedelta(microseconds=rnd.randrange(0, 10 ** 16))
        rows.append((i, ts, rnd.choice([-2 ** 63, -1, 0, 1, 2 ** 63 - 1, rnd.randrange(-10 ** 12, 10 ** 12)])))
    df = spark.createDataFrame(rows, "i int, t timestamp_ntz, e long")
    by_key = [r.i for r in df.orderBy(H.order_key(df, ("t", "e")), "i").collect()]
    by_cols = [r.i for r in df.orderBy("t", "e", "i").collect()]
    assert by_key == by_cols



def test_null_keys_are_kept_and_large_keys_exact(spark):
    big = 9007199254740993
    rows = [(big, 1.0, 1, 1), (big, 3.0, 2, 2), (None, 5.0, 1, 3), (None, 7.0, 3, 4), (big - 1, 2.0, 1, 5)]
    df = spark.createDataFrame(rows, "city_id long, temperature double, a long, b long")
    got = {r.city_id: (r.t, r.n, r.first) for r in H.halving_partials(df, order=("a", "b")).collect()}
    assert got == {big: (1.75, 2, 1.0), None: (4.75, 2, 5.0), big - 1: (1.0, 1, 2.0)}
    state = H.empty_state(spark, H.HALVING_STATE)
    for _ in range(2):
        state = H.merge_avg_halving(state, df, order=("a", "b"))
    assert {r.city_id: r.n for r in state.collect()} == {big: 4, None: 4, big - 1: 2}
    assert H.halving_partials(df.where("city_id IS NULL"), order=("a", "b")).count() == 1


def test_null_name_is_one_city(spark):
    rows = [(None, 7, 3600, "IT", 1.0, 2.0, 1, 1)]
    df = spark.createDataFrame(rows, "name string, city_id long, timezone int, country string, latitude double, "
                                     "longitude double, a long, b long")
    state = H.empty_state(spark, H.CITY_STATE)
    for _ in range(3):
        after = H.merge_city(state, df, order=("a", "b"))
        ops = [r.op for r in H.snapshot_diff(state, after, "name").collect()]
        state = after
    assert state.count() == 1 and state.first().city_id == 7 and ops == []


def test_first_and_last_rows_of_a_key(spark):
    rows = [(c, dt.datetime(1969, 12, 31, 23) + dt.timedelta(minutes=m * 7, microseconds=m), e)
            for c, m, e in [(1, 0, 5), (1, 0, -7), (1, 30, 2), (1, 30, 9), (2, 3, -1), (None, 4, 1), (None, 2, 8), (2, 3, -1)]]
    df = spark.createDataFrame(rows, "city_id long, dt timestamp_ntz, event_id long").repartition(3)
    got = [tuple(r) for r in H.first_and_last_rows(df, ["city_id"], ("dt", "event_id")).collect()]
    want = set()
    for key in (1, 2, None):
        own = sorted(r[1:] for r in rows if r[0] == key)
        want |= {(key, *own[0]), (key, *own[-1])}
    assert len(got) == len(want) == 5 and set(got) == want
    days = df.selectExpr("city_id", "CAST(dt AS DATE) AS day")
    assert {tuple(r) for r in H.first_and_last_rows(days, ["city_id"], ("day",)).collect()} == {
        (1, dt.date(1969, 12, 31)), (1, dt.date(1970, 1, 1)), (2, dt.date(1969, 12, 31)), (None, dt.date(1969, 12, 31))}
