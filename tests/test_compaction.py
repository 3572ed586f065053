"""The streamed fact is compacted into segments; readers and the change stream see the same rows meanwhile."""

import datetime as dt
import os
import threading

from pyspark.sql import functions as F, types as T

from cirrus.streaming import jobs as S
from cirrus.streaming.state import StateGroup

SCHEMA = (T.StructType().add("weather_id", "long").add("city_id", "long").add("dt", T.TimestampNTZType())
          .add("obs_date", "date"))


def _commit(spark, counter, target, batch):
    """One small batch, as keyed_append leaves it: two rows on each of two days."""
    t0 = dt.datetime(2024, 3, 29)
    rows = [(4 * batch + i, (7 * batch + i) % 5, t0 + dt.timedelta(days=i % 2, minutes=batch)) for i in range(4)]
    spark.createDataFrame(rows, "weather_id bigint, city_id bigint, dt timestamp_ntz").withColumn("obs_date", F.to_date("dt")).coalesce(
        1).write.partitionBy("obs_date").parquet(f"{target}/batch={batch}")
    counter.commit(batch, {"id_counter": spark.createDataFrame([(4 * batch + 4,)], "max_id bigint")})


def _ids(df):
    return sorted(r.weather_id for r in df.select("weather_id").collect())


def test_files_read_are_bounded_and_readers_undisturbed(spark, tmp_path):
    target, every, batches = str(tmp_path / "fact"), 4, 40
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    whole = lambda: S.committed_rows(spark, counter, target, SCHEMA)
    assert whole().count() == 0
    done, errors, files_read = threading.Event(), [], []

    def read():
        while not done.is_set():
            try:
                ids = _ids(whole())
                assert ids == list(range(len(ids))) and len(ids) % 4 == 0  # whole batches, each row once
            except Exception as e:  # any failure of a reader fails the test
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for b in range(batches):
            _commit(spark, counter, target, b)
            S.compact_fact(spark, counter, target, SCHEMA, every, min_age=60.0)
            files_read.append(len(whole().inputFiles()))
    finally:
        done.set()
        reader.join()
    assert not errors, errors[0]
    assert _ids(whole()) == list(range(4 * batches))
    # a batch has 2 files and so has a segment: fewer than ``every`` of each, however many batches there were
    assert max(files_read) <= 2 * 2 * every and files_read[-1] < 2 * batches / 4
    # the change stream over the batch folders holds every row once
    S.read_fact(spark, target, SCHEMA).drop("batch").writeStream.format("parquet").option("path", str(tmp_path / "copy")).option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    assert _ids(spark.read.parquet(str(tmp_path / "copy"))) == list(range(4 * batches))


def test_segments_are_sorted_by_city_and_survive_a_crash(spark, tmp_path):
    import pyarrow.parquet as pq
    target = str(tmp_path / "fact")
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    for b in range(5):
        _commit(spark, counter, target, b)
    assert S.compact_fact(spark, counter, target, SCHEMA, 6) is None
    folder = S.compact_fact(spark, counter, target, SCHEMA, 5)
    assert folder.endswith("batches=0-4")
    parts = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    for part in parts:
        cities = pq.read_table(part)["city_id"].to_pylist()
        assert cities == sorted(cities)
    os.remove(f"{folder}/_SUCCESS")  # the job died behind a file: the batches count, and the next compaction writes it anew
    os.remove(parts[0])
    assert _ids(S.committed_rows(spark, counter, target, SCHEMA)) == list(range(20))
    assert S.compact_fact(spark, counter, target, SCHEMA, 5) == folder
    assert _ids(S.committed_rows(spark, counter, target, SCHEMA)) == list(range(20))
    assert {r.path.split("/")[-3] for r in S.committed_rows(spark, counter, target, SCHEMA).select(
        F.input_file_name().alias("path")).collect()} == {"batches=0-4"}


def test_segments_with_many_cities_have_bloom_filters(spark, tmp_path):
    import pyarrow.parquet as pq
    target = str(tmp_path / "fact")
    counter = StateGroup(spark, str(tmp_path / "counter"), {"id_counter": "max_id bigint"})
    spark.range(3000).selectExpr("id AS weather_id", "xxhash64(id) AS city_id", "timestamp_ntz'2024-03-29 00:00:00' AS dt",
                                 "DATE'2024-03-29' AS obs_date").coalesce(1).write.partitionBy("obs_date").parquet(f"{target}/batch=0")
    counter.commit(0, {"id_counter": spark.createDataFrame([(3000,)], "max_id bigint")})
    folder = S.compact_fact(spark, counter, target, SCHEMA, 1)

    def behind_pages(path):  # bytes of indexes, Bloom filters and footer
        group = pq.read_metadata(path).row_group(0)
        columns = [group.column(i) for i in range(group.num_columns)]
        return os.path.getsize(path) - 4 - sum(c.total_compressed_size for c in columns)

    paths = {root: [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
             for root in (folder, f"{target}/batch=0")}
    assert len(paths[folder]) == 1 and behind_pages(paths[folder][0]) > 1024 + behind_pages(paths[f"{target}/batch=0"][0])
