"""What a micro-batch of the flow costs besides its rows."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from cirrus.operators import incremental as H
from cirrus.streaming import files, jobs as S
from cirrus.streaming.flow import CURATED_WEATHER_STREAM, ObservationFlow
from cirrus.streaming.native import NativeTable, PARTITIONS, rocksdb
from cirrus.streaming.state import COMMIT_SCHEMA, StateGroup, records


def test_tables_of_a_flow_share_the_cores(spark, tmp_path):
    """Their batches run side by side, so each has its share of state partitions; a caller may name another number."""
    flow = ObservationFlow(spark, str(tmp_path))
    tables = [flow.consumption["max_abs_temp"], flow.curated, flow.curated.bridge]
    assert [t.partitions for t in tables] == [4, 4, 4]
    assert ObservationFlow(spark, str(tmp_path), state_partitions=3).consumption["max_abs_temp"].partitions == 3


def test_state_commits_changes_not_copies(spark, tmp_path):
    """Each batch adds a change log to a state partition; the table reads right, also by a handle of another settings."""
    src = str(tmp_path / "src")
    table = NativeTable(spark, str(tmp_path / "avg"), H.partial_avg_exact, "city_id bigint", "s double, n bigint", partitions=1)
    for part in range(3):
        spark.createDataFrame([(1, 1.0 + part), (2 + part, 5.0)], "city_id long, temperature double").write.mode("append").parquet(src)
        table.start(spark.readStream.schema("city_id long, temperature double").parquet(src), None).awaitTermination()
    found = os.listdir(tmp_path / "avg/state/0/0")
    assert {f"{i}.changelog" for i in (1, 2, 3)} <= set(found)
    assert {r.city_id: (r.s, r.n) for r in table.read().collect()} == {1: (6.0, 3), 2: (5.0, 1), 3: (5.0, 1), 4: (5.0, 1)}


def test_keyed_append_of_no_rows_leaves_no_batch(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "keyed")
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    for part, city in enumerate((1, 2, 1)):
        full = spark.createDataFrame([(city, dt.datetime(2024, 3, 29, part))], "city_id long, dt timestamp_ntz")
        full.select(*[F.col(f.name) if f.name in ("city_id", "dt") else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in CURATED_WEATHER_STREAM.fields]).withColumn(
            "obs_date", F.to_date("dt")).coalesce(1).write.mode("append").parquet(src)
    S.keyed_append(spark, S.read_appends(spark, src, CURATED_WEATHER_STREAM, max_files_per_trigger=1), counter, target,
                   str(tmp_path / "ckpt"), transform=lambda b: b.where("city_id = 1"))
    assert len(files.names(spark, target)) == 2 and len(counter.committed()) == 2
    assert sorted(r.weather_id for r in spark.read.parquet(target).collect()) == [1, 2]


def test_answers_do_not_wait_for_the_city_tables(spark, tmp_path, monkeypatch):
    """They read the fact only: a city upsert that fails does not keep them from their rows, and its error is raised."""
    flow = ObservationFlow(spark, str(tmp_path / "flow"), allow=None, one_document_per_file=False)
    os.makedirs(flow.source_dir)
    with open(f"{flow.source_dir}/a.json", "w") as f:
        f.write('{"id": 1, "name": "Milan", "weather": [{"main": "Rain"}], "main": {"temp": 280.5}, "wind": {"speed": 2.0}, "dt": 1711700000}\n')

    def broken(*_):
        raise ValueError("no city today")

    monkeypatch.setattr(flow.curated, "start", broken)
    with pytest.raises(ValueError, match="no city today"):
        flow.run_once()
    assert [r.max_abs_temperature for r in flow.state("max_abs_temp").collect()] == [280.5]


def test_curation_is_part_of_the_stream(spark, tmp_path):
    """Its paths then reach the scan; rows handed to foreachBatch come whole, and each path is looked up in the whole document."""
    seen = []
    stream = spark.readStream.format("rate").load()

    def curate(rows):
        seen.append(rows.isStreaming)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        S.keyed_append(spark, stream, StateGroup(spark, str(tmp_path / "c"), {"id_counter": "max_id bigint"}),
                       str(tmp_path / "keyed"), str(tmp_path / "ckpt"), transform=curate)
    assert seen == [True]


def test_numbers_run_on_over_ranges_and_batches(spark, tmp_path, monkeypatch):
    """Several ranges a batch, rows without a time, equal rows and a day that most rows share: dense numbers in time order."""
    monkeypatch.setattr(S, "ROWS_IN_RANGE", 3)
    src, target = str(tmp_path / "src"), str(tmp_path / "keyed")
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    hours = [None, *[dt.datetime(2024, 3, 29 + part, hour) for part in (0, 1) for hour in (5, 5, 5, 9, 1, 7, 5)]]
    for part, times in enumerate((hours[:8], hours[8:])):
        rows = spark.createDataFrame([(i % 3, t) for i, t in enumerate(times)], "city_id long, dt timestamp_ntz")
        rows.select(*[F.col(f.name) if f.name in ("city_id", "dt") else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in CURATED_WEATHER_STREAM.fields]).withColumn("obs_date", F.to_date("dt")).coalesce(1).write.mode("append").parquet(src)
        S.keyed_append(spark, S.read_appends(spark, src, CURATED_WEATHER_STREAM), counter, target, str(tmp_path / "ckpt"))
    got = spark.read.parquet(target).orderBy("weather_id").collect()
    assert [r.weather_id for r in got] == list(range(1, 16))
    first, second = got[:8], got[8:]
    for batch in (first, second):
        assert batch == sorted(batch, key=lambda r: (r.dt is not None, r.dt or dt.datetime.min, r.city_id))
    assert first[0].dt is None and {r.dt.day for r in second} == {30}


def test_one_job_reads_the_table_and_keeps_no_copy(spark, tmp_path, monkeypatch):
    flow = ObservationFlow(spark, str(tmp_path / "flow"), allow=None, one_document_per_file=False)
    os.makedirs(flow.source_dir)
    with open(f"{flow.source_dir}/a.json", "w") as f:
        f.write('{"id": 1, "name": "Milan", "weather": [{"main": "Rain"}], "main": {"temp": 280.5}, "wind": {"speed": 2.0}, "dt": 1711700000}\n')
    kept, merge = [], S.merge_batch
    monkeypatch.setattr(S, "merge_batch", lambda spark_, group, jobs, batch, *more: kept.append(batch.is_cached) or merge(
        spark_, group, jobs, batch, *more))
    flow.run_once()
    assert kept == [False]
    assert [(r.city_id, r.avg_temperature) for r in flow.state("avg_temp_halving").collect()] == [(1, 280.5)]


def _documents(flow, *parts):
    """An arrival for each part: one more file with its (id, hour) documents."""
    def arrival(i, part):
        def write():
            os.makedirs(flow.source_dir, exist_ok=True)
            with open(f"{flow.source_dir}/{i}.json", "w") as f:
                f.writelines(f'{{"id": {c}, "name": "Milan", "weather": [{{"main": "Rain"}}], "main": {{"temp": {280.5 + i}}}, '
                             f'"wind": {{"speed": 2.0}}, "dt": {1711700000 + 3600 * h}}}\n' for c, h in part)
        return write
    return [arrival(i, part) for i, part in enumerate(parts)]


def test_next_arrival_is_landed_beside_the_answers(spark, tmp_path, monkeypatch):
    """The answers of an arrival may wait for the landing of the next; each layer still takes an arrival as a batch of its own."""
    flow = ObservationFlow(spark, str(tmp_path / "flow"), allow=None, one_document_per_file=False)
    came, landed, table, first = threading.Event(), [], flow.consumption["max_abs_temp"], _documents(flow, [(1, 0), (2, 0)], [(1, 1)], [(1, 2)])
    begin, ingest = table.start, S.ingest_json

    def second():
        first[1]()
        came.set()

    monkeypatch.setattr(table, "start", lambda *how: came.wait(60) and begin(*how))
    monkeypatch.setattr(S, "ingest_json", lambda *a, **k: landed.append(1) or ingest(*a, **k))
    flow.run_each([first[0], second, first[2]])
    assert came.is_set() and len(landed) == 3
    assert {r.city_id: r.max_abs_temperature for r in flow.state("max_abs_temp").collect()} == {1: 282.5, 2: 280.5}
    runs = {(r.job, r.batch_id): r.rows for r in flow.run_log().collect()}
    jobs = {"curated_weather", "curated_city", "consumption_city", "city_bridge", *flow.consumption}
    assert runs == {(job, i): n for job in jobs for i, n in enumerate((2, 1, 1))}


def test_a_failed_layer_lets_no_further_arrival_come(spark, tmp_path, monkeypatch):
    flow = ObservationFlow(spark, str(tmp_path / "flow"), allow=None, one_document_per_file=False)
    came = _documents(flow, [(1, 0)], [(1, 1)])

    def broken(*_):
        raise ValueError("no city today")

    monkeypatch.setattr(flow.curated, "start", broken)
    with pytest.raises(ValueError, match="no city today"):
        flow.run_each(came)
    assert os.listdir(flow.source_dir) == ["0.json"]


def test_a_batch_of_the_fact_is_counted_by_its_records(spark, tmp_path, monkeypatch):
    """No job counts its rows again, and they are read in the batch's session, which keeps the settings it began with."""
    flow = ObservationFlow(spark, str(tmp_path / "flow"), allow=None, one_document_per_file=False)
    seen, merge = [], S.merge_batch

    def watched(spark_, group, jobs, batch, batch_id, query, rows):
        seen.append((rows, batch.sparkSession._jsparkSession.equals(spark._jsparkSession)))
        return merge(spark_, group, jobs, batch, batch_id, query, rows)

    monkeypatch.setattr(S, "merge_batch", watched)
    flow.run_each(_documents(flow, [(1, 0), (2, 0), (1, 5)]))
    assert seen == [(3, False)]
    assert {r.city_id: r.n for r in flow.state("avg_temp_halving").collect()} == {1: 2, 2: 1}


def test_a_starting_query_does_not_take_the_settings_of_another(spark):
    """State tables have few partitions; a query that starts beside them must not keep their number for its own shuffles."""
    seen = []

    class Writer:
        def trigger(self, **_):
            return self

        def start(self):
            seen.append(spark.conf.get(PARTITIONS))

    with rocksdb(spark, 3):
        other = threading.Thread(target=S._start, args=(Writer(), None))
        other.start()
        other.join(1)
        assert not seen
    other.join(10)
    assert seen == [spark.conf.get(PARTITIONS)] != ["3"]


def test_records_need_no_python_worker(spark):
    rows = [("a", 1, None, None, dt.datetime(2024, 3, 29, 5, 0, 0, 7), "q"), (None, 2, 5, dt.datetime(2024, 1, 1), None, None)]
    made = records(spark, rows, COMMIT_SCHEMA)
    assert [tuple(r) for r in made.collect()] == rows
    assert made.schema.simpleString() == spark.createDataFrame([], COMMIT_SCHEMA).schema.simpleString()
    assert "RDD" not in made._jdf.queryExecution().toString()
