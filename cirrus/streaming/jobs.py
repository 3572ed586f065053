"""Structured Streaming wiring: ingest, append-only consumers, merge jobs.

* File ingest: the JSON file source remembers every path it has read in its
  checkpoint, so a folder that is re-uploaded wholesale is still ingested once
  per file; the Parquet file sink commits exactly once per batch.
* Append-only change streams: a streaming read of a table written by a file
  sink sees only committed files; one checkpoint per consumer gives
  independent fan-out (a new consumer reads everything from the start).
* Merge jobs: ``foreachBatch`` skips empty batches (the "has new rows" guard;
  ``availableNow`` also starts no batch without new files), merges the batch
  into each versioned state, and appends one run-log row per job and batch.
* Cadence: ``trigger(processingTime=...)`` in production; ``availableNow`` to
  drain what is there and stop (tests, and layer-by-layer ordering).
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cirrus.operators.quality import placed, position
from cirrus.sources.landing import LANDING_COLUMN, REJECTED, json_reader, landing_rows
from cirrus.streaming import files
from cirrus.streaming.native import own_settings
from cirrus.streaming.state import COMMIT_SCHEMA, StateGroup, records

LANDING_SCHEMA = T.StructType([T.StructField(LANDING_COLUMN, T.VariantType()), T.StructField("source_file", T.StringType()),
                               T.StructField(REJECTED, T.BinaryType())])
#: How long the file stream remembers a path, counted back from the newest file it has seen: beyond any load.
MAX_FILE_AGE = "36500d"
#: Rows of a micro-batch of the fact that one task sorts and numbers.
ROWS_IN_RANGE = 100_000


def _now():
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _start(writer, trigger: str | None, name: str | None = None):
    writer = writer.queryName(name) if name else writer
    with own_settings():
        return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def _finish(q: StreamingQuery, trigger: str | None) -> StreamingQuery:
    if not trigger:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


def ingest_json(spark: SparkSession, source_dir: str, landing_path: str, checkpoint: str,
                one_document_per_file: bool = True, max_files_per_trigger: int | None = None,
                trigger: str | None = None, max_file_age: str = MAX_FILE_AGE, clean_source: str = "off",
                archive_dir: str | None = None, name: str | None = None) -> StreamingQuery:
    """Continuous ingest of new JSON files into the VARIANT landing table, each path once (``source_file`` keeps it).
    A document that is no JSON is a row too, with its text as it came (``landing.rejects``).

    Spark forgets paths, and skips files, older than ``maxFileAge`` before the newest file; its default of a week
    would drop late files of a historical load and load re-sent ones again. The default here is 100 years, so the
    memory of paths grows with the number of files; ``clean_source`` ("archive" with ``archive_dir``, or "delete")
    moves read files away and keeps the listing short."""
    reader = json_reader(spark, one_document_per_file, streaming=True, rejects=True).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source != "off":
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    stream = landing_rows(reader.load(source_dir))
    w = (stream.writeStream.format("parquet").option("path", landing_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _finish(_start(w, trigger, name), trigger)


def read_appends(spark: SparkSession, table_path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Append-only change stream over a table (each new row seen once per checkpoint)."""
    r = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(table_path)


def append_transform(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target_path: str,
                     checkpoint: str, trigger: str | None = None,
                     partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Stateless incremental insert (e.g. landing -> curated fact)."""
    w = (transform(stream).writeStream.format("parquet").option("path", target_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _finish(_start(w, trigger), trigger)


@dataclass
class MergeJob:
    """One incrementally maintained table of a state group.

    With ``combine`` each batch stores ``merge(empty, prepare(batch))``'s counterpart ``partial(prepare(batch))`` only
    and readers combine the batches' partials; else ``merge(state, prepare(batch))`` is stored as a new snapshot."""
    name: str
    schema: str
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    prepare: Callable[[DataFrame, int], DataFrame] | None = None
    partial: Callable[[DataFrame], DataFrame] | None = None
    combine: Callable[[DataFrame], DataFrame] | None = None


def state_group(spark: SparkSession, root: str, jobs_: Sequence[MergeJob], **options) -> StateGroup:
    return StateGroup(spark, root, {j.name: j.schema for j in jobs_},
                      combine={j.name: j.combine for j in jobs_ if j.combine}, **options)


def merge_batch(spark: SparkSession, group: StateGroup, jobs: Sequence[MergeJob], batch: DataFrame,
                batch_id: int, query_id: str | None = None, rows: int | None = None) -> int:
    """Apply every job of a group to one micro-batch and commit them together;
    returns the batch row count (0: empty batch, nothing written), counted unless ``rows`` is known. The commit record holds a
    run-log row for each job."""
    if group.is_committed(batch_id):  # replay of a finished batch
        group.check_writer(query_id)
        return 0
    started = _now()
    rows = batch.count() if rows is None else rows  # fills the cache, if there is one, that the merge jobs read
    if not rows:  # guard: no new rows -> no work, no new version
        return 0
    frames = {}
    for j in jobs:
        ready = j.prepare(batch, batch_id) if j.prepare else batch
        frames[j.name] = j.partial(ready) if j.combine else j.merge(group.read(j.name), ready)
    group.commit(batch_id, frames, [(name, rows, started) for name in frames], query_id)
    return rows


def query_of(checkpoint: str, spark: SparkSession) -> str:
    """The id of the streaming query that owns a checkpoint (written by Spark before the first batch)."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def consume(spark: SparkSession, stream: DataFrame, group: StateGroup, jobs: Sequence[MergeJob],
            checkpoint: str, trigger: str | None = None,
            rows: Callable[[DataFrame], tuple[DataFrame, int | None]] | None = None, name: str | None = None) -> StreamingQuery:
    """One streaming query feeding several merge jobs from the same batch: the
    batch is persisted once and read by every job (instead of one stream per
    job re-reading the same files). A lost cached block is recomputed from
    the batch's source files, which the file source replays identically.
    ``rows`` turns a batch of commit records into the rows they stand for and their number; a single
    job reads its columns of these from the table, which costs less than a copy of all."""
    def on_batch(batch: DataFrame, batch_id: int):
        kept = not rows or len(jobs) > 1
        batch, count = rows(batch) if rows else (batch, None)
        batch = batch.persist() if kept else batch
        try:
            merge_batch(spark, group, jobs, batch, batch_id, query_of(checkpoint, spark), count)
        finally:
            if kept:
                batch.unpersist()

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _finish(_start(w, trigger, name), trigger)


def run_history(log: DataFrame, jobs: Sequence[str], job_col: str = "job",
                time_col: str = "scheduled_time") -> DataFrame:
    """Runs of the named jobs in scheduled order."""
    return log.where(F.col(job_col).isin(list(jobs))).orderBy(time_col, job_col)


def keyed_append(spark: SparkSession, stream: DataFrame, counter: StateGroup, target: str, checkpoint: str,
                 trigger: str | None = None, transform: Callable[[DataFrame], DataFrame] | None = None,
                 name: str | None = None, compact_every: int = 16) -> StreamingQuery:
    """Append with an AUTOINCREMENT-style ``weather_id``: dense ids after the
    stored maximum, in time order inside each batch.

    Per micro-batch: read the committed counter (one scalar), lay the rows out in ranges of the time order and keep them,
    count the ranges (a row for each to the driver), write the rows with start + rows of the ranges before + position to a
    hidden folder, rename that to ``<target>/batch=<id>`` in one step, commit the new counter. The ranges hold the same rows
    at the same positions if a kept block is lost and built again. So a batch folder is whole and final from the moment it
    is there, also for file streams over the table, and a replay after the rename takes the folder as it is. (The file system
    must rename a folder in one step, as HDFS and its kind do.)"""
    from cirrus.plans.warehouse import WEATHER_ID_ORDER

    def on_batch(batch: DataFrame, batch_id: int):
        if counter.is_committed(batch_id):
            counter.check_writer(query_of(checkpoint, spark))
            return
        rows = batch.persist()  # the bounds of the ranges are sampled from the rows before these are dealt out
        try:
            number(rows, batch_id)
        finally:
            rows.unpersist()

    def number(rows: DataFrame, batch_id: int):
        started = _now()
        written = rows.count()  # fills the cache
        if not written:  # guard: no new rows -> no batch of the table, no commit
            return
        start = max((r["max_id"] for r in counter.read("id_counter").collect()), default=0)  # a row
        schema = T.StructType([*rows.schema.fields, T.StructField("weather_id", T.LongType())])
        folder = f"{target.rstrip('/')}/batch={int(batch_id)}"
        if not files.exists(spark, folder):
            ranged = placed(rows, WEATHER_ID_ORDER, -(-written // ROWS_IN_RANGE)).persist()
            try:
                sizes = {r["_pid"]: r["n"] for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
                before = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes)))]
                weather_id = F.lit(start).cast("long") + F.lit(before)[F.col("_pid").cast("int")] + position() + 1
                attempt = f"{target.rstrip('/')}/_attempt/batch={int(batch_id)}"
                # A range of the time order holds few days, so each task writes few files; a hot day spans several ranges.
                ranged.withColumn("weather_id", weather_id).select(*schema.names).write.mode("overwrite").partitionBy(
                    "obs_date").parquet(attempt)
            finally:
                ranged.unpersist()
            files.rename(spark, attempt, folder)
        counter.commit(batch_id, {"id_counter": records(spark, [(start + written,)], "max_id bigint")},
                       [("curated_weather", written, started)], query_of(checkpoint, spark))
        compact_fact(spark, counter, target, schema, compact_every)

    # The transform is part of the stream: inside foreachBatch the rows come whole, and no path would reach the scan.
    rows = transform(stream) if transform else stream
    w = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _finish(_start(w, trigger, name), trigger)


def read_fact(spark: SparkSession, target: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Append-only change stream over the rows of a keyed_append table, straight from its batch folders."""
    return read_appends(spark, files.make(spark, target), T.StructType([*schema.fields, T.StructField("batch", T.LongType())]),
                        max_files_per_trigger)


def segments(spark: SparkSession, target: str) -> list[tuple[int, int, str]]:
    """(first batch, last batch, folder) of the finished segments of a keyed_append table, the widest that do not overlap."""
    root = f"{target.rstrip('/')}/_segments"
    found = []
    for name in files.names(spark, root):
        if files.exists(spark, f"{root}/{name}/_SUCCESS"):
            first, last = (int(x) for x in name.removeprefix("batches=").split("-"))
            found.append((first, last, f"{root}/{name}"))
    chosen, upto = [], -1
    for first, last, folder in sorted(found, key=lambda s: (s[0], -s[1])):
        if first > upto:
            chosen.append((first, last, folder))
            upto = last
    return chosen


def compact_fact(spark: SparkSession, counter: StateGroup, target: str, schema: T.StructType, every: int = 16,
                 min_age: float = 3600.0) -> str | None:
    """Fold batches that no segment holds, once there are ``every`` of them, into one segment; and all segments, once there
    are so many, into one. The new segment's folder, or None.

    A segment is sorted by city inside its days, in files of a size that adaptive execution chooses, with Bloom filters on
    ``city_id`` where its ids are too many for a dictionary (which serves as well). It counts from the moment its job leaves the success marker; until then, and if the job dies, readers
    take what they took before. Replaced segments go after ``min_age`` seconds. Batch folders stay: they are the table's
    change stream. Each row is written again once for every power of ``every`` of batches, not with every compaction."""
    have = segments(spark, target)
    upto = have[-1][1] if have else -1
    loose = [i for i in counter.committed() if i > upto]
    if len(loose) < every:
        return None
    merged = have if len(have) + 1 >= every else []
    first = merged[0][0] if merged else loose[0]
    folder = f"{target.rstrip('/')}/_segments/batches={first}-{loose[-1]}"
    rows = committed_rows(spark, counter, target, schema, loose)
    if merged:
        rows = rows.unionByName(_rows_at(spark, schema, [s[2] for s in merged]))
    (rows.hint("rebalance", "obs_date").sortWithinPartitions("obs_date", "city_id").write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#city_id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
     .partitionBy("obs_date").parquet(folder))
    kept = {s[2] for s in segments(spark, target)}
    root = f"{target.rstrip('/')}/_segments"
    for name in files.names(spark, root):
        if f"{root}/{name}" not in kept:
            files.delete_older(spark, f"{root}/{name}", min_age)
    return folder


def _rows_at(spark: SparkSession, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    base = folders[0].rsplit("/", 1)[0]
    return spark.read.option("basePath", base).schema(schema).parquet(*folders).select(*schema.names)


def committed_rows(spark: SparkSession, counter: StateGroup, target: str, schema: T.StructType,
                   ids: Sequence[int] | None = None) -> DataFrame:
    """Rows of a keyed_append table: all committed batches, those in segments from there, or the batches named."""
    if ids is not None:
        return _rows_at(spark, schema, [f"{target.rstrip('/')}/batch={int(i)}" for i in ids]) if ids else spark.createDataFrame([], schema)
    have = segments(spark, target)
    loose = [i for i in counter.committed() if not have or i > have[-1][1]]
    parts = [_rows_at(spark, schema, [s[2] for s in have])] if have else []
    parts += [committed_rows(spark, counter, target, schema, loose)] if loose or not have else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_commits(spark: SparkSession, counter: StateGroup, max_files_per_trigger: int | None = None) -> DataFrame:
    """Append-only change stream over a keyed_append table: its commit records, one file for each batch. A batch
    arrives once it is committed, and never twice."""
    spark._jvm.org.apache.hadoop.fs.Path(counter.commit_path).getFileSystem(
        spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(counter.commit_path))
    return read_appends(spark, f"{counter.commit_path}/batch=*", COMMIT_SCHEMA, max_files_per_trigger)


def new_rows(commits: DataFrame, counter: StateGroup, target: str, schema) -> tuple[DataFrame, int | None]:
    """The rows that a micro-batch of commit records stands for (as many ids as the trigger took files), and their number, as
    the records have it. They are read in the batch's session: the flow's own has other queries' settings while these start."""
    found = {r["batch_id"]: r["rows"] for r in commits.select("batch_id", "rows").collect()}
    count = None if None in found.values() else sum(found.values())
    return committed_rows(commits.sparkSession, counter, target, schema, sorted(found)), count
