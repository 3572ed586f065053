"""Answer tables in Spark's state store: restart, crash and cost; run history with idle and failed runs."""

import os

import pytest
from pyspark.sql import functions as F

from cirrus.operators import incremental as H
from cirrus.streaming import files, jobs as S
from cirrus.streaming.flow import ObservationFlow
from cirrus.streaming.history import RunHistory
from cirrus.streaming.native import PARTITIONS, PROVIDER, NativeTable
from cirrus.streaming.upsert import CityTables

from test_landing_curate import doc

OBS = "city_id long, main string, temperature double, dt timestamp_ntz"
ROWS = [[(1, "Rain", 280.0), (1, "Rain", None), (2, "Clear", 270.0)], [(1, "Rain", 285.0), (None, None, 260.0)],
        [(2, "Clear", 290.0)], [(1, "Mist", 250.0)]]


def _append(spark, path, rows):
    spark.createDataFrame(rows, "city_id long, main string, temperature double").selectExpr(
        "*", "timestamp_ntz'2024-03-29 12:00:00' AS dt").coalesce(1).write.mode("append").parquet(path)


def _tables(spark, tmp_path):
    make = lambda name, *how: NativeTable(spark, str(tmp_path / "ckpt" / name), *how)
    return {
        "avg": make("avg", H.partial_avg_exact, "city_id bigint", "s double, n bigint"),
        "frequency": make("frequency", H.partial_condition_frequency, "city_id bigint, weather_condition string", "frequency bigint"),
        "daily": make("daily", H.partial_daily_extremes, "city_id bigint, date date", "hi double, lo double"),
        "distinct": make("distinct", lambda s: s.groupBy("main").count(), "main string", "n bigint", H.partial_distinct_conditions)}


def _run(spark, src, table, files_=None):
    q = table.start(S.read_appends(spark, src, OBS, files_), None)
    q.awaitTermination()
    return q


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tables_equal_the_rules_and_survive_a_lost_commit(spark, tmp_path):
    """After each slice a crash behind the state's write, before Spark's commit record: the batch runs again, exactly once."""
    src, before = str(tmp_path / "src"), spark.conf.get(PROVIDER, None)
    tables = _tables(spark, tmp_path)
    assert all(t.read().count() == 0 and t.latest() is None for t in tables.values())
    seen = []
    for i, part in enumerate(ROWS):
        seen += part
        _append(spark, src, part)
        obs = spark.createDataFrame(seen, "city_id long, main string, temperature double").selectExpr(
            "*", "timestamp_ntz'2024-03-29 12:00:00' AS dt")
        for name, t in tables.items():
            if i and name != "avg":  # one table in full, the others at the first and last slice
                if i < len(ROWS) - 1:
                    continue
            _run(spark, src, t)
            if name == "avg" and i:
                commits = f"{t.checkpoint}/commits"
                os.remove(f"{commits}/{t.latest()}")
                for left in os.listdir(commits):
                    if left.endswith(".crc"):
                        os.remove(f"{commits}/{left}")
                assert _rows(t.read()) == _rows(H.partial_avg_exact(obs.limit(len(seen) - len(part))))  # the committed version
                _run(spark, src, t)
        assert _rows(tables["avg"].read()) == _rows(H.partial_avg_exact(obs))
    assert _rows(tables["frequency"].read()) == _rows(H.partial_condition_frequency(obs))
    assert _rows(tables["daily"].read()) == _rows(H.partial_daily_extremes(obs))
    assert sorted(tables["distinct"].read().first().distinct_conditions) == ["Clear", "Mist", "Rain"]
    assert spark.conf.get(PROVIDER, None) == before


def test_a_batch_aggregates_before_its_shuffle_and_keeps_no_history(spark, tmp_path):
    src = str(tmp_path / "src")
    for part in ROWS:
        _append(spark, src, part)
    table = _tables(spark, tmp_path)["avg"]
    q = _run(spark, src, table, files_=1)
    assert table.committed() == [0, 1, 2, 3]
    plan = q._jsq.explainInternal(False)
    assert plan.index("StateStoreSave") < plan.index("Exchange") < plan.rindex("HashAggregate")
    assert {r.city_id: r.n for r in table.read().collect()} == {1: 3, 2: 2, None: 1}


def test_state_partitions_follow_the_cores_not_the_sessions_shuffles(spark, tmp_path):
    """Each batch opens every state partition of every table, so their number is not the session's 200 shuffle partitions.
    A table that has begun keeps its number, and a caller may name one."""
    src, before = str(tmp_path / "src"), spark.conf.get(PARTITIONS)
    state = lambda checkpoint: len([n for n in os.listdir(f"{checkpoint}/state/0") if n.isdigit()])
    _append(spark, src, ROWS[0])
    avg = lambda name, n=None: NativeTable(
        spark, str(tmp_path / name), H.partial_avg_exact, "city_id bigint", "s double, n bigint", partitions=n)
    cities = CityTables(spark, str(tmp_path / "city"), str(tmp_path / "changes"), avg("bridge"))
    _city(spark, [("Milan", 1, 45.5, 5), ("Rome", 7, 41.9, 2)]).write.parquet(str(tmp_path / "names"))
    spark.conf.set(PARTITIONS, "40")
    try:
        for table in (avg("own"), avg("named", 3)):
            _run(spark, src, table)
        cities.start(spark.readStream.schema(CITY).parquet(str(tmp_path / "names")), None).awaitTermination()
        assert [state(tmp_path / n) for n in ("own", "named", "city")] == [8, 3, 8]
        assert spark.conf.get(PARTITIONS) == "40"
        _append(spark, src, ROWS[1])
        _run(spark, src, avg("named"))
        assert state(tmp_path / "named") == 3
        assert {r.city_id: r.n for r in avg("named").read().collect()} == {1: 2, 2: 1, None: 1}
    finally:
        spark.conf.set(PARTITIONS, before)
    assert cities.read("curated_city").count() == 2


def test_fact_folders_are_whole_when_they_appear(spark, tmp_path):
    root = str(tmp_path / "fact")
    attempt, folder = f"{root}/_attempt/batch=0", f"{root}/batch=0"
    spark.range(3).write.parquet(attempt)
    assert files.names(spark, root) == []
    files.rename(spark, attempt, folder)
    assert files.names(spark, root) == ["batch=0"] and spark.read.parquet(folder).count() == 3
    spark.range(9).write.parquet(attempt)
    with pytest.raises(OSError):
        files.rename(spark, attempt, folder)


def test_history_lists_finished_idle_and_failed_runs(spark, tmp_path):
    src = str(tmp_path / "src")
    history = RunHistory(spark, str(tmp_path), str(tmp_path / "_runs"))
    fail = F.udf(lambda t: 1 / 0 if t == 250.0 else t, "double")
    table = NativeTable(spark, str(tmp_path / "ckpt"), lambda s: H.partial_avg_exact(s.withColumn("temperature", fail("temperature"))),
                        "city_id bigint", "s double, n bigint")

    def run(expect_failure=False):
        q = table.start(S.read_appends(spark, src, OBS), None, history.name("avg"))
        if expect_failure:
            with pytest.raises(Exception):
                q.awaitTermination()
        else:
            q.awaitTermination()
        history.wait(str(q.runId))

    with history:
        _append(spark, src, ROWS[0])
        run()
        run()  # nothing new
        _append(spark, src, ROWS[3])
        run(expect_failure=True)
        # a query of another flow is not listed
        other = NativeTable(spark, str(tmp_path / "other"), H.partial_avg_exact, "city_id bigint", "s double, n bigint")
        other.start(S.read_appends(spark, src, OBS), None, "avg@elsewhere").awaitTermination()
    got = [(r.job, r.state, r.rows) for r in history.read().orderBy("completed_time").collect()]
    assert [g for i, g in enumerate(got) if i == 0 or g != got[i - 1]] == [
        ("avg", "SUCCEEDED", 3), ("avg", "SKIPPED", 0), ("avg", "FAILED", None)]
    failed = history.read().where("state = 'FAILED'").first()
    assert "ZeroDivisionError" in failed.error and failed.scheduled_time <= failed.completed_time
    # a batch whose event was lost is listed without rows and times
    batches = {(r.job, r.batch_id): r.rows for r in history.batches({"avg": [0, 1]}).collect()}
    assert batches == {("avg", 0): 3, ("avg", 1): None}


def test_flow_history(spark, tmp_path):
    flow = ObservationFlow(spark, str(tmp_path / "flow"))
    os.makedirs(flow.source_dir)
    with open(f"{flow.source_dir}/m.json", "w") as f:
        f.write(doc(3173435, "Milan", 285.0, 1711714980))
    flow.run_once()
    flow.run_once()
    state = {(r.job, r.state) for r in flow.run_history().collect()}
    jobs_ = {"landing", "curated_weather", "curated_city", "city_bridge", *flow.consumption}
    assert state == {(j, s) for j in jobs_ for s in ("SUCCEEDED", "SKIPPED")}
    log = {(r.job, r.batch_id): r.rows for r in flow.run_log().collect()}
    assert all(log[(j, 0)] == 1 for j in flow.consumption) and len(log) == len(flow.consumption) + 4


CITY = "name string, city_id long, timezone int, country string, latitude double, longitude double, dt timestamp_ntz"


def _city(spark, rows):
    import datetime as dt
    t0 = dt.datetime(2024, 3, 29)
    return spark.createDataFrame([(n, i, 3600, "IT", lat, 9.0, None if h is None else t0 + dt.timedelta(hours=h))
                                  for n, i, lat, h in rows], CITY)


def test_city_upsert_equals_the_rule_and_replays(spark, tmp_path, monkeypatch):
    """Three batches, the last with a name that holds most rows: state as the batch rule's, changes as the snapshots'
    difference; a batch that crashes before its commit emits the same changes when it runs again."""
    from cirrus.streaming import upsert
    src = str(tmp_path / "src")
    batches = [[("Milan", 1, 45.5, 5), ("Milan", 2, 45.6, 1), ("Rome", 7, 41.9, 2), (None, 3, 0.0, 1)],
               [("Milan", 1, 40.0, 9), ("Rome", 7, 0.0, 9), ("Bari", 9007199254740993, 41.1, 9)],
               [("Rome", 8, 1.0, 10 + i % 5) for i in range(500)] + [("Rome", 11, 1.0, 14), ("Bari", 5, 1.0, 20)]]
    bridge = NativeTable(spark, str(tmp_path / "bridge"), lambda s: s.groupBy("city_id", "name").count(),
                         "city_id bigint, name string", "n bigint")
    tables = CityTables(spark, str(tmp_path / "ckpt"), str(tmp_path / "changes"), bridge)
    assert tables.read("curated_city").count() == tables.changes().count() == 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")

    def run():
        tables.start(spark.readStream.schema(CITY).parquet(src), None).awaitTermination()

    try:
        state = H.empty_state(spark, H.CITY_STATE)
        for b, rows in enumerate(batches):
            new = _city(spark, rows).coalesce(1)
            new.write.mode("append").parquet(src)
            if b == 1:  # the changes are written, the driver dies before Spark's commit
                real = upsert.files.rename
                monkeypatch.setattr(upsert.files, "rename", lambda *a: (real(*a), 1 / 0))
                with pytest.raises(Exception):
                    run()
                monkeypatch.setattr(upsert.files, "rename", real)
                assert tables.latest() == 0 and tables.changes().where("batch = 1").count() == 0
            run()
            after = spark.createDataFrame(H.merge_city(state, new, ("dt", "city_id")).collect(), H.CITY_STATE)
            for name in ("curated_city", "consumption_city"):
                assert _rows(tables.read(name).select(after.columns)) == _rows(after)
            diff = H.snapshot_diff(state, after, "name")
            assert _rows(tables.changes().where(F.col("batch") == b).select(diff.columns)) == _rows(diff)
            state = after
        # rows without a time or an id: the batch's other rows decide first, alone they count as they are
        _city(spark, [("Bari", 6, 1.0, None), ("Oslo", None, 59.9, None), ("Rome", 9, 2.0, 30), ("Rome", 10, 2.0, None)]
              ).coalesce(1).write.mode("append").parquet(src)
        run()
        got = {r["name"]: (r.city_id, r.latitude) for r in tables.read("curated_city").collect()}
        assert got == {"Milan": (1, 45.6), "Rome": (9, 41.9), "Bari": (6, 41.1), "Oslo": (None, 59.9), None: (3, 0.0)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
