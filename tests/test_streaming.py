"""Streaming: exactly-once ingest, restart and replay safety (SURVEY 5.4 (4))."""

import os

import pytest
from pyspark.sql import functions as F

from cirrus.operators import analytics as A, curate, incremental as H
from cirrus.sources import landing
from cirrus.streaming import jobs as S
from cirrus.streaming.flow import ObservationFlow
from cirrus.streaming.state import StateGroup

from test_landing_curate import doc

BASE = 1711714980


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


@pytest.fixture
def flow(spark, tmp_path):
    return ObservationFlow(spark, str(tmp_path / "flow"))


def test_flow_end_to_end_matches_batch(spark, flow):
    temps = {"Milan": [280.0, 284.0, 290.0, 281.5], "Cagliari": [289.0, 291.0, 288.0, 292.5]}
    rounds = 0
    for i in range(4):
        for j, (name, cid) in enumerate((("Milan", 3173435), ("Cagliari", 6540125))):
            _write(flow.source_dir, f"{name}_{i}.json",
                   doc(cid, name, temps[name][i], BASE + 3600 * i + j, weather=(["Clouds", "Rain"][i % 2],),
                       pretty=(i == 0)))
        _write(flow.source_dir, f"other_{i}.json", doc(2523281, "Sant'Avendrace", 300.0, BASE + 3600 * i))
        flow.run_once()
        rounds += 1
    raw = landing.read_table(spark, flow.landing)
    assert raw.count() == 12
    obs = curate.curated_observation(landing.read_json_documents(spark, flow.source_dir))
    assert landing.read_table(spark, flow.curated_weather).count() == obs.count() == 8
    ans = flow.answers()
    avg = {r.city: r.avg_temperature for r in ans["avg_temp_per_city"].collect()}
    city = flow.curated.read("city_bridge").select("city_id", "name")
    batch = {r.city: r.avg_temperature for r in A.avg_temperature(obs, city).collect()}
    assert avg == pytest.approx(batch)
    halving = {r.city_id: r.avg_temperature for r in flow.state("avg_temp_halving").collect()}
    expected = {}
    for name, cid in (("Milan", 3173435), ("Cagliari", 6540125)):
        a = temps[name][0]
        for x in temps[name][1:]:
            a = (a + x) / 2
        expected[cid] = a
    assert halving == pytest.approx(expected)
    assert ans["distinct_weather_conditions"].first().distinct_conditions == ["Clouds", "Rain"]
    cons = {r.name: (r.city_id, r.timezone) for r in flow.consumption_city().collect()}
    assert cons == {"Milan": (3173435, "UTC+01:00"), "Cagliari": (6540125, "UTC+01:00")}
    log = flow.run_log()
    assert log.where("job = 'avg_temp_per_city'").count() == rounds
    keyed = [(r.weather_id, r.dt) for r in flow.keyed_observations().orderBy("weather_id").collect()]
    assert [k for k, _ in keyed] == list(range(1, 9))
    assert [d for _, d in keyed] == sorted(d for _, d in keyed)
    report = {r.check: r.violations for r in flow.data_quality().collect()}
    assert report["consumption_city.city_id unique"] == 0
    assert report["avg_temp_per_city.city_id -> consumption_city"] == 0
    assert report["weather_conditions_rank_per_city length limits"] == 0
    assert all(v == 0 for v in report.values()), report
    from cirrus.__main__ import main
    main(["quality", "--root", flow.root, "--flow"])  # same report through the command line

    # restart with nothing new: no batch, no new version, run log unchanged
    newest = lambda: {n: g.latest() for n, g in flow.consumption.items()}
    versions = newest()
    flow.run_once()
    assert newest() == versions
    assert flow.run_log().count() == log.count()
    assert {r.job for r in log.collect()} >= {"consumption_city", "curated_weather", "curated_city"}
    for name in flow.publish():
        assert spark.table(name).count() > 0

    # the same files uploaded again under the same names are not ingested again
    for i in range(4):
        _write(flow.source_dir, f"Milan_{i}.json", doc(3173435, "Milan", 999.0, BASE + 3600 * i))
    flow.run_once()
    assert landing.read_table(spark, flow.landing).count() == 12
    assert newest() == versions
    assert [r.weather_id for r in flow.keyed_observations().orderBy("weather_id").collect()] == list(range(1, 9))


def test_replayed_and_empty_batches_change_nothing(spark, tmp_path):
    jobs_ = [S.MergeJob("freq", H.FREQUENCY_STATE, H.merge_condition_frequency)]
    group = StateGroup(spark, str(tmp_path / "g"), {"freq": H.FREQUENCY_STATE})
    batch = spark.createDataFrame([(1, "Rain"), (1, "Rain"), (2, "Clear")], "city_id long, main string")
    assert S.merge_batch(spark, group, jobs_, batch, 0) == 3
    assert S.merge_batch(spark, group, jobs_, batch, 0) == 0          # replay of batch 0
    empty = batch.where(F.lit(False))
    assert S.merge_batch(spark, group, jobs_, empty, 1) == 0          # guard
    assert group.latest() == 0
    assert S.merge_batch(spark, group, jobs_, batch, 2) == 3
    got = {(r.city_id, r.weather_condition): r.frequency for r in group.read("freq").collect()}
    assert got == {(1, "Rain"): 4, (2, "Clear"): 2}
    # a fresh handle (restarted driver) reads the committed state from storage
    again = StateGroup(spark, str(tmp_path / "g"), {"freq": H.FREQUENCY_STATE})
    assert again.latest() == 2 and again.is_committed(2) and not again.is_committed(3)


def test_uncommitted_snapshot_is_not_read(spark, tmp_path):
    group = StateGroup(spark, str(tmp_path / "g"), {"m": "k long"})
    group.commit(0, {"m": spark.createDataFrame([(1,)], "k long")})
    # a lost job wrote the snapshot of batch 1 but never its commit record
    spark.createDataFrame([(9,)], "k long").write.parquet(group.version_path("m", 1))
    fresh = StateGroup(spark, str(tmp_path / "g"), {"m": "k long"})
    assert [r.k for r in fresh.read("m").collect()] == [1]
    assert fresh.commit(1, {"m": spark.createDataFrame([(2,)], "k long")})
    assert [r.k for r in fresh.read("m").collect()] == [2]


def test_run_history_filters_and_orders(spark):
    import datetime as dt
    log = spark.createDataFrame([("a", dt.datetime(2024, 1, 2)), ("b", dt.datetime(2024, 1, 1)),
                                 ("c", dt.datetime(2024, 1, 3))], "job string, scheduled_time timestamp_ntz")
    assert [r.job for r in S.run_history(log, ["a", "b"]).collect()] == ["b", "a"]


def test_continuous_cadence_runs_all_layers(spark, tmp_path):
    import time
    flow = ObservationFlow(spark, str(tmp_path / "live"))
    _write(flow.source_dir, "m.json", doc(3173435, "Milan", 285.0, BASE))
    queries = flow.start(landing="1 second", curated_weather="1 second", curated_city="1 second",
                         consumption="1 second")
    try:
        deadline = time.time() + 120
        # layers are asynchronous: wait until both answer layers have committed
        while time.time() < deadline and (flow.consumption["max_abs_temp"].latest() is None
                                          or flow.curated.latest() is None):
            time.sleep(2)
    finally:
        for q in queries:
            q.stop()
    assert [r.max_abs_temperature for r in flow.state("max_abs_temp").collect()] == [285.0]
    assert flow.consumption_city().count() == 1


def test_snapshot_storage_is_bounded(spark, tmp_path):
    group = StateGroup(spark, str(tmp_path / "g"), {"m": "k long"}, retain=2, min_age=0)
    for b in range(5):
        assert group.commit(b, {"m": spark.createDataFrame([(b,)], "k long")})
        assert [r.k for r in group.read("m").collect()] == [b]
    assert sorted(p.name for p in (tmp_path / "g" / "m").iterdir()) == ["batch=3", "batch=4"]
    assert [r.k for r in group.read("m", 3).collect()] == [3]


def _sums(spark, path, **options):
    from cirrus.streaming.state import StateGroup as G
    add = lambda d: d.groupBy("k").agg(F.sum("v").alias("v"))
    return G(spark, str(path), {"m": "k long, v long"}, combine={"m": add}, **options)


def test_deltas_do_not_grow_with_the_state_and_readers_keep_their_frame(spark, tmp_path):
    group = _sums(spark, tmp_path / "g", compact_every=3, min_age=0)
    reader = _sums(spark, tmp_path / "g")
    frames, sizes = [], []
    for b in range(8):
        group.commit(b, {"m": spark.createDataFrame([(b, 1), (0, 1)], "k long, v long")})
        frames.append((b, reader.read("m")))
        folder = tmp_path / "g" / "m" / f"batch={b}"
        sizes.append(sum(p.stat().st_size for p in folder.glob("part-*")))
        # the frame read at an earlier commit, and before a compaction, is still what it was
        for at, frame in frames[-2:]:
            assert sum(r.v for r in frame.collect()) == 2 * (at + 1)
    assert max(sizes) <= 1.5 * min(sizes)
    assert {r.k: r.v for r in reader.read("m").collect()} == {0: 9, **{k: 1 for k in range(1, 8)}}
    assert sorted(p.name for p in (tmp_path / "g" / "m" / "_base").iterdir()) == ["batch=2", "batch=5"]


def test_readers_never_see_an_uncommitted_delta(spark, tmp_path):
    group = _sums(spark, tmp_path / "g")
    group.commit(0, {"m": spark.createDataFrame([(1, 1)], "k long, v long")})
    spark.createDataFrame([(1, 100)], "k long, v long").write.parquet(group.version_path("m", 1))
    assert [r.v for r in _sums(spark, tmp_path / "g").read("m").collect()] == [1]


def test_lost_checkpoint_is_reported(spark, tmp_path):
    group = _sums(spark, tmp_path / "g")
    batch = spark.createDataFrame([(1, 1)], "k long, v long")
    job = S.MergeJob("m", "k long, v long", partial=lambda b: b, combine=group.combine["m"])
    assert S.merge_batch(spark, group, [job], batch, 0, query_id="one") == 1
    assert S.merge_batch(spark, group, [job], batch, 0, query_id="one") == 0
    with pytest.raises(RuntimeError, match="checkpoint"):
        S.merge_batch(spark, group, [job], batch, 0, query_id="two")


def test_late_and_resent_files_count_once(spark, tmp_path):
    import time
    src, out, ckpt = str(tmp_path / "stage"), str(tmp_path / "landing"), str(tmp_path / "ckpt")
    now, day = time.time(), 86400

    def drop(name, days):
        _write(src, name, doc(1, "Milan", 280.0, BASE))
        os.utime(os.path.join(src, name), (now - days * day,) * 2)

    for name, days in (("a.json", 20), ("b.json", 0), ("c.json", 15), ("a.json", 0)):
        drop(name, days)
        S.ingest_json(spark, src, out, ckpt)  # each call restarts the query from its checkpoint
    rows = spark.read.schema(S.LANDING_SCHEMA).parquet(out)
    assert rows.count() == 3 and rows.select("source_file").distinct().count() == 3


def test_backlog_is_taken_in_limited_batches(spark, tmp_path):
    flow = ObservationFlow(spark, str(tmp_path / "flow"), max_files_per_trigger=2)
    for i in range(5):
        _write(flow.source_dir, f"{i}.json", doc(3173435, "Milan", 280.0 + i, BASE + i))
    flow.run_once()
    assert landing.read_table(spark, flow.landing).count() == 5
    assert len(flow.curated.committed()) >= 2
    assert flow.state("avg_temp_halving").first().n == 5


def test_bad_documents_do_not_stop_the_flow(spark, tmp_path):
    flow = ObservationFlow(spark, str(tmp_path / "flow"), allow=None)
    good = doc(3173435, "Milan", 280.0, BASE)
    _write(flow.source_dir, "good.json", good)
    flow.run_once()
    _write(flow.source_dir, "no_id.json", doc(None, "Milan", 290.0, BASE + 1))
    _write(flow.source_dir, "no_name.json", doc(5, None, 270.0, BASE + 2))
    _write(flow.source_dir, "broken.json", '{"id": 1, ')
    flow.run_once()
    _write(flow.source_dir, "later.json", doc(3173435, "Milan", 284.0, BASE + 3, pretty=True))
    flow.run_once()
    report = {r.check: r.violations for r in flow.data_quality().collect()}
    assert report["landing documents unparsable"] == 1
    assert report["landing documents without id"] == 1 and report["landing documents without name"] == 1
    halving = {r.city_id: (r.avg_temperature, r.n) for r in flow.state("avg_temp_halving").collect()}
    exact = {r.city_id: r.avg_temperature for r in H.present_avg(flow.state("avg_temp_per_city")).collect()}
    assert halving[3173435] == (282.0, 2) and exact[3173435] == 282.0 and exact[5] == 270.0
    assert {k for k, v in halving.items() if v[1]} == {3173435, 5, None}
