"""A merge job that dies mid-batch and is restarted from its checkpoint ends
with exactly the state of an uninterrupted run (no lost or doubled rows)."""

import pytest

from cirrus.operators import incremental as H
from cirrus.streaming import jobs as S
from cirrus.streaming.state import StateGroup

SCHEMA = "city_id long, main string"


class Crash(RuntimeError):
    pass


def _append(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _run(spark, src, group, ckpt):
    jobs_ = [S.MergeJob("freq", H.FREQUENCY_STATE, H.merge_condition_frequency)]
    S.consume(spark, S.read_appends(spark, src, SCHEMA, max_files_per_trigger=1), group, jobs_, ckpt)


@pytest.mark.parametrize("when", ["before_commit_record", "after_commit_record"])
def test_restart_after_crash_gives_exact_state(spark, tmp_path, monkeypatch, when):
    src, root, ckpt = str(tmp_path / "src"), str(tmp_path / "state"), str(tmp_path / "ckpt")
    _append(spark, src, [(1, "Rain"), (1, "Rain"), (2, "Clear")])
    _append(spark, src, [(1, "Rain"), (2, "Mist")])
    _append(spark, src, [(2, "Clear")])

    real_commit = StateGroup.commit
    crashed = []

    def flaky_commit(self, batch_id, frames, *more):
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            if when == "before_commit_record":
                for name, df in frames.items():  # snapshot written, record never appended
                    df.write.mode("overwrite").parquet(self.version_path(name, batch_id))
                raise Crash("lost before the commit record")
            real_commit(self, batch_id, frames, *more)
            raise Crash("lost after the commit record")
        return real_commit(self, batch_id, frames, *more)

    monkeypatch.setattr(StateGroup, "commit", flaky_commit)
    with pytest.raises(Exception):
        _run(spark, src, StateGroup(spark, root, {"freq": H.FREQUENCY_STATE}), ckpt)
    # restart: a fresh driver-side handle and the same stream checkpoint
    group = StateGroup(spark, root, {"freq": H.FREQUENCY_STATE})
    _run(spark, src, group, ckpt)
    assert crashed == [1]
    got = {(r.city_id, r.weather_condition): r.frequency for r in group.read("freq").collect()}
    assert got == {(1, "Rain"): 3, (2, "Clear"): 2, (2, "Mist"): 1}
    assert group.latest() == 2


def test_keyed_append_restart_keeps_ids_dense(spark, tmp_path, monkeypatch):
    import datetime as dt
    from pyspark.sql import functions as F
    from cirrus.streaming.flow import CURATED_WEATHER_STREAM
    src, ckpt, target = str(tmp_path / "src"), str(tmp_path / "ckpt"), str(tmp_path / "keyed")
    t0 = dt.datetime(2024, 3, 29)
    for part in range(3):
        rows = spark.createDataFrame([(i, t0 + dt.timedelta(hours=i)) for i in range(part * 4, part * 4 + 4)],
                                     "city_id long, dt timestamp_ntz")
        full = rows.select(*[F.col(f.name) if f.name in ("city_id", "dt") else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in CURATED_WEATHER_STREAM.fields])
        full.withColumn("obs_date", F.to_date("dt")).coalesce(1).write.mode("append").parquet(src)
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    real_commit = StateGroup.commit
    crashed = []

    def flaky(self, batch_id, frames, *more):
        if batch_id == 1 and not crashed:
            crashed.append(1)
            raise Crash("lost after the batch folder was written")
        return real_commit(self, batch_id, frames, *more)

    monkeypatch.setattr(StateGroup, "commit", flaky)

    def run(counter_):
        S.keyed_append(spark, S.read_appends(spark, src, CURATED_WEATHER_STREAM, max_files_per_trigger=1),
                       counter_, target, ckpt)

    with pytest.raises(Exception):
        run(counter)
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    run(counter)
    latest = counter.latest()
    got = spark.read.parquet(target).where(F.col("batch") <= latest)
    ids = sorted((r.weather_id, r.city_id) for r in got.collect())
    assert [i for i, _ in ids] == list(range(1, 13))
    assert [c for _, c in ids] == list(range(12))


def _sums(spark, path):
    from pyspark.sql import functions as F
    add = lambda d: d.groupBy("k").agg(F.sum("v").alias("v"))
    return StateGroup(spark, str(path), {"m": "k long, v long"}, combine={"m": add}, compact_every=1000, min_age=0)


def test_a_compaction_that_dies_after_any_file_loses_nothing(spark, tmp_path):
    """The marker comes last: a base with some of its files is no base, for readers and for the next compaction."""
    import shutil
    whole = tmp_path / "whole"
    group = _sums(spark, whole)
    for b in range(4):
        group.commit(b, {"m": spark.range(40).selectExpr("id AS k", "1L AS v").repartition(4)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        group.compact()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p.name for p in (whole / "m" / "_base" / "batch=3").glob("part-*"))
    assert len(parts) >= 4
    for kept in range(len(parts)):
        at = tmp_path / f"crash{kept}"
        shutil.copytree(whole, at)
        base = at / "m" / "_base" / "batch=3"
        (base / "_SUCCESS").unlink()
        for name in parts[kept:]:
            (base / name).unlink()
        total = lambda g: sum(r.v for r in g.read("m").collect())
        assert total(_sums(spark, at)) == 160
        if kept in (0, len(parts) - 1):
            again = _sums(spark, at)
            again.commit(4, {"m": spark.range(40).selectExpr("id AS k", "1L AS v")})
            again.compact()
            again.tidy()
            assert total(_sums(spark, at)) == 200


def test_a_lookup_does_not_open_old_commits(spark, tmp_path, monkeypatch):
    """Finished commits are looked into once: a later lookup costs one listing and the new folders."""
    group = _sums(spark, tmp_path / "g")
    record = spark.createDataFrame([(1, 1)], "k long, v long")
    for b in range(3):
        group.commit(b, {"m": record})
    assert group._finished[group.commit_path] == {0, 1, 2}
    for b in range(3):  # without their markers they are still known to this handle, and to it alone
        (tmp_path / "g" / "_commits" / f"batch={b}" / "_SUCCESS").unlink()
    assert group.latest() == 2 and _sums(spark, tmp_path / "g").latest() is None
