"""Tables maintained by micro-batches: immutable folders and one commit record a batch.

    <root>/<table>/batch=<id>     what batch <id> wrote (a snapshot, or its delta)
    <root>/<table>/_base/batch=<id>   all deltas up to <id>, folded by a compaction
    <root>/_commits/batch=<id>    the batch's commit record: one row for each job that ran

A batch writes its folders, then its record; readers look up the newest record on every read and never see folders
without one. No folder is rewritten but by a replay of its own uncommitted batch, so a reader's frame stays what it
was. A table with a ``combine`` function stores each batch's partial result only and is combined on reading, so what a
batch writes does not grow with the table; compaction folds old deltas into a base beside them. Old folders go by
number and age (``retain``, ``min_age``), so a running reader keeps its files.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrus.streaming import files

COMMIT_SCHEMA = ("job string, batch_id bigint, rows bigint, scheduled_time timestamp_ntz, "
                 "completed_time timestamp_ntz, query_id string")
Combine = Callable[[DataFrame], DataFrame]


def _now():
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def records(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows that the driver has, in a plan of their own: no Python worker makes them again."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "timestamp_ntz": pa.timestamp("us")}
    fields = [f.split(" ") for f in schema.split(", ")]
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
                                          names=[n for n, _ in fields]), schema)


class StateGroup:
    """Single writer per group (its streaming query); batch ids only grow."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str], retain: int = 3,
                 combine: Mapping[str, Combine] | None = None, compact_every: int = 16, min_age: float = 3600.0):
        if retain < 2:
            raise ValueError("retain must be >= 2 so the newest committed snapshot is never deleted")
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(schemas)
        self.retain = retain
        self.combine = dict(combine or {})
        self.compact_every = compact_every
        self.min_age = min_age
        self._finished: dict[str, set[int]] = {}  # folder -> batches known to be finished

    def _numbered(self, path: str) -> list[int]:
        return files.numbered(self.spark, path, "batch", self._finished.setdefault(path, set()))

    @property
    def commit_path(self) -> str:
        return f"{self.root}/_commits"

    def version_path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch={int(batch_id)}"

    def base_path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/_base/batch={int(batch_id)}"

    def commits(self) -> DataFrame:
        """The commit records: a row for each job and batch. An unreadable log is an error, an absent one empty."""
        if not self._numbered(self.commit_path):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.commit_path}/batch=*")

    def committed(self) -> list[int]:
        return self._numbered(self.commit_path)

    def latest(self) -> int | None:
        """Newest committed batch id, looked up anew on every call."""
        ids = self.committed()
        return ids[-1] if ids else None

    def is_committed(self, batch_id: int) -> bool:
        latest = self.latest()
        return latest is not None and int(batch_id) <= latest

    def check_writer(self, query_id: str | None) -> None:
        """Fail if the newest commit comes from another streaming query: a lost checkpoint restarts batch ids at 0,
        and its batches would all be skipped as committed."""
        if query_id is None or self.latest() is None:
            return
        last = self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.commit_path}/batch={self.latest()}").first()
        if last and last["query_id"] and last["query_id"] != query_id:
            raise RuntimeError(f"{self.root}: committed by query {last['query_id']}, not {query_id}; "
                               "was the checkpoint lost?")

    def read(self, name: str, batch_id: int | None = None) -> DataFrame:
        """The table as of the newest commit, or as of ``batch_id``."""
        ids = [i for i in self.committed() if batch_id is None or i <= batch_id]
        schema = self.schemas[name]
        if not ids:
            return self.spark.createDataFrame([], schema)
        if name not in self.combine:
            return self.spark.read.schema(schema).parquet(self.version_path(name, ids[-1]))
        bases = [b for b in self._numbered(f"{self.root}/{name}/_base") if b <= ids[-1]]
        base = bases[-1] if bases else -1
        paths = [self.version_path(name, i) for i in ids if i > base]
        parts = [self.spark.read.schema(schema).parquet(p) for p in paths]
        parts = [p.withColumn("batch", F.lit(i).cast("long")) for p, i in zip(parts, [i for i in ids if i > base],
                                                                              strict=True)]
        if bases:
            parts.insert(0, self.spark.read.schema(schema).parquet(self.base_path(name, base)).withColumn(
                "batch", F.lit(base).cast("long")))
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return self.combine[name](whole)

    def commit(self, batch_id: int, frames: dict[str, DataFrame], log: Sequence[tuple] = (),
               query_id: str | None = None) -> bool:
        """Write every folder of ``batch_id`` (concurrent Spark jobs), then the commit record with its run-log rows
        (job, rows, scheduled, completed). False if the batch id was already committed."""
        if self.is_committed(batch_id):
            return False
        with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
            done = [pool.submit(df.write.mode("overwrite").parquet, self.version_path(name, batch_id))
                    for name, df in frames.items()]
            for f in done:
                f.result()
        now = _now()
        rows = [(j, int(batch_id), int(n), start, now, query_id) for j, n, start in log] or [
            (None, int(batch_id), None, now, now, query_id)]
        records(self.spark, rows, COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.commit_path}/batch={int(batch_id)}")
        if self.combine and len(self.committed()) % self.compact_every == 0:
            self.compact()
        self.tidy()
        return True

    def compact(self) -> None:
        """Fold the deltas of every combined table up to the newest commit into a new base."""
        latest = self.latest()
        for name in self.combine:
            if latest is not None and latest not in self._numbered(f"{self.root}/{name}/_base"):
                self.read(name, latest).write.mode("overwrite").parquet(self.base_path(name, latest))

    def tidy(self) -> None:
        """Delete folders that newer ones replace, once old enough: snapshots but the newest ``retain``, deltas below
        the base before the newest. Commit records stay: they are the run log."""
        ids = self.committed()
        for name in self.schemas:
            if name in self.combine:
                bases = self._numbered(f"{self.root}/{name}/_base")
                if len(bases) < 2:
                    continue
                spent = [self.version_path(name, i) for i in self._numbered(f"{self.root}/{name}")
                         if i <= bases[-2]] + [self.base_path(name, b) for b in bases[:-2]]
            else:
                keep = set(ids[-self.retain:])
                spent = [self.version_path(name, i) for i in self._numbered(f"{self.root}/{name}")
                         if i not in keep and i < ids[-1]]
            for path in spent:
                files.delete_older(self.spark, path, self.min_age)
