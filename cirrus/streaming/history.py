"""Run history of streaming queries, from Spark's own listener: finished, idle and failed runs alike.

A micro-batch with rows gives a row SUCCEEDED, a trigger that found no data SKIPPED, a query that ended by an error
FAILED with its message. Rows are kept as JSON lines, one file for several events, below the flow's folder.
"""

from __future__ import annotations

import datetime as _dt
import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from cirrus.streaming import files

HISTORY = ("job string, batch_id bigint, rows bigint, scheduled_time timestamp_ntz, completed_time timestamp_ntz, "
           "state string, error string, run_id string")


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()


def _plain(timestamp: str) -> str:
    return timestamp.rstrip("Z")


class RunHistory(StreamingQueryListener):
    """Records the runs of the queries named ``<job>@<root>``. ``listening`` registers it for a block of code."""

    def __init__(self, spark: SparkSession, root: str, path: str, every: int = 50):
        self.spark, self.root, self.path, self.every = spark, root, path.rstrip("/"), every
        self._lock = threading.RLock()
        self._jobs: dict[str, tuple[str, str]] = {}  # run id -> job, time of the start
        self._seen: set[str] = set()  # runs that gave a row
        self._ended: set[str] = set()
        self._rows: list[dict] = []

    def name(self, job: str) -> str:
        return f"{job}@{self.root}"

    def _add(self, run: str, batch, rows, scheduled: str, completed: str, state: str, error: str | None = None) -> None:
        with self._lock:
            job = self._jobs.get(run)
            if job:
                self._seen.add(run)
                self._rows.append({"job": job[0], "batch_id": batch, "rows": rows, "scheduled_time": scheduled,
                                   "completed_time": completed, "state": state, "error": error, "run_id": run})
                if len(self._rows) >= self.every or state == "FAILED":
                    self.flush()

    def onQueryStarted(self, event) -> None:
        if event.name and event.name.endswith(f"@{self.root}"):
            with self._lock:
                self._jobs[str(event.runId)] = (event.name.split("@", 1)[0], _plain(event.timestamp))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        begun = _dt.datetime.fromisoformat(_plain(p.timestamp))
        done = begun + _dt.timedelta(milliseconds=p.durationMs.get("triggerExecution", 0))
        if p.numInputRows:
            self._add(str(p.runId), p.batchId, p.numInputRows, begun.isoformat(), done.isoformat(), "SUCCEEDED")
        else:
            self._add(str(p.runId), None, 0, begun.isoformat(), done.isoformat(), "SKIPPED")

    def onQueryIdle(self, event) -> None:
        self._add(str(event.runId), None, 0, _plain(event.timestamp), _plain(event.timestamp), "SKIPPED")

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._lock:
            if run not in self._jobs:
                return
            started = self._jobs[run][1]
            if event.exception:
                self._add(run, None, None, started, _now(), "FAILED", event.exception)
            elif run not in self._seen:
                self._add(run, None, 0, started, _now(), "SKIPPED")
            self.flush()
            self._ended.add(run)

    def wait(self, run: str, seconds: float = 60.0) -> None:
        """Until the run's last event has arrived; events come some time after the query's end."""
        end = time.time() + seconds
        while run not in self._ended and time.time() < end:
            time.sleep(0.05)

    def flush(self) -> None:
        with self._lock:
            if self._rows:
                files.write_text(self.spark, f"{self.path}/{uuid.uuid4().hex}.json",
                                 "".join(json.dumps(r) + "\n" for r in self._rows))
                self._rows = []

    def read(self) -> DataFrame:
        self.flush()
        if not files.names(self.spark, self.path):
            return self.spark.createDataFrame([], HISTORY)
        return self.spark.read.schema(HISTORY).json(self.path)

    def batches(self, jobs: dict[str, list[int]]) -> DataFrame:
        """A row for each committed batch: those recorded, and, without rows and times, those of ``jobs`` (job ->
        committed batch ids) that a crash kept from being recorded. A batch that was run again counts once."""
        known = self.read().where((F.col("state") == "SUCCEEDED") & F.col("job").isin(list(jobs))).groupBy("job", "batch_id").agg(
            *(F.max_by(c, "completed_time").alias(c) for c in ("rows", "scheduled_time")),
            F.max("completed_time").alias("completed_time"))
        ids = self.spark.createDataFrame([(j, i) for j, all_ids in jobs.items() for i in all_ids], "job string, batch_id bigint")
        return known.join(ids, ["job", "batch_id"], "full")

    def __enter__(self) -> RunHistory:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()
