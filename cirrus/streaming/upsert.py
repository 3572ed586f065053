"""City upserts as keyed state: one query keeps the curated and the consumption city and emits what changed.

A micro-batch is reduced to the first and last row of each name inside its tasks, before the shuffle, so a name that holds
most rows costs a row for each Arrow batch. Each name's state is then changed in place by ``transformWithState`` on the
RocksDB state store, which emits an INSERT or UPDATE row for a name that changed. Nothing compares whole tables, a batch's
cost follows the names it holds, and a batch that is run again starts from the state before it and emits the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from cirrus.operators.incremental import CITY_ATTRS, CITY_STATE
from cirrus.streaming import files
from cirrus.streaming.jobs import query_of
from cirrus.streaming.native import NativeTable, rocksdb

CITY_VALUE = CITY_STATE.split(", ", 1)[1]
CHANGES = "op string, " + CITY_STATE
FIELDS = ["dt", "city_id", *CITY_ATTRS]


def ends_of_names(rows: DataFrame) -> DataFrame:
    """(name, first, last): for each name of an Arrow batch its first and last row in (dt, city_id) order, as JSON lists
    of ``FIELDS`` with dt in microseconds. A row without an order column comes last among firsts and first among lasts."""
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            at = pa.array(range(table.num_rows), pa.int64())
            picked = {}
            for side, nulls in (("first", "at_end"), ("last", "at_start")):
                order = pa.compute.sort_indices(table, [("dt", "ascending"), ("city_id", "ascending")], null_placement=nulls)
                one = table.take(order).append_column("_at", at).group_by("name", use_threads=False).aggregate([("_at", side)])
                taken = table.take(order).take(one[f"_at_{side}"])
                picked[side] = {r.pop("name"): json.dumps([r[c] for c in FIELDS]) for r in taken.to_pylist()}
            names = list(picked["first"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([picked[s][n] for n in names], pa.string()) for s in ("first", "last"))],
                ["name", "first", "last"])

    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("dt"))
    return rows.select("name", micros.alias("dt"), *FIELDS[1:]).mapInArrow(run, "name string, first string, last string")


def city_processor() -> StatefulProcessor:
    """The rule of a name. Its class is made here, so that it travels to the workers whole, wherever they import from."""
    class CityProcessor(StatefulProcessor):
        """State of a name: the attributes of the row that inserted it and the newest id (curated), and the copy of it that the
        emitted changes have made (consumption)."""

        def init(self, handle) -> None:
            self.curated = handle.getValueState("curated_city", CITY_VALUE)
            self.consumption = handle.getValueState("consumption_city", CITY_VALUE)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            first = last = None
            for part in rows:
                for f, x in zip(part["first"], part["last"]):
                    f, x = json.loads(f), json.loads(x)
                    first = f if first is None or self._early(f) < self._early(first) else first
                    last = x if last is None or self._late(x) > self._late(last) else last
            old = self.curated.get() if self.curated.exists() else None
            new = (last[1], *(old[1:] if old else first[2:]))
            if old and tuple(old) == new:
                return
            self.curated.update(new)
            self.consumption.update(new)
            op = "UPDATE" if old else "INSERT"
            yield pd.DataFrame([(op, key[0], *new)], columns=["op", "name", "city_id", *CITY_ATTRS], dtype=object)

        @staticmethod
        def _early(row):
            return [(v is None, v or 0) for v in row[:2]]

        @staticmethod
        def _late(row):
            return [(v is not None, v or 0) for v in row[:2]]

        def close(self) -> None:
            pass

    return CityProcessor()


class CityTables:
    """The city tables of a flow: curated_city and consumption_city (state of one query), city_bridge (of another), and
    the changes that the first has emitted."""

    def __init__(self, spark: SparkSession, checkpoint: str, changes: str, bridge: NativeTable, partitions: int | None = None):
        self.partitions = partitions
        self.spark, self.checkpoint, self.changes_path, self.bridge = spark, checkpoint, changes, bridge

    def start(self, rows: DataFrame, trigger: str | None, name: str | None = None):
        def on_batch(changes: DataFrame, batch_id: int):
            # One action: it runs the keyed state. A replay emits the same rows, so a folder that is there stays.
            folder = f"{self._own()}/batch={batch_id}"
            attempt = f"{self.changes_path}/_attempt/batch={batch_id}"
            changes.write.mode("overwrite").parquet(attempt)
            if not files.exists(self.spark, folder):
                files.rename(self.spark, attempt, folder)

        w = (ends_of_names(rows).groupBy("name")
             .transformWithStateInPandas(city_processor(), CHANGES, "Update", "None")
             .writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", self.checkpoint))
        w = w.queryName(name) if name else w
        with rocksdb(self.spark, self.partitions):
            return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()

    def _own(self) -> str:
        """The changes' folder of this query: a query that starts anew from a new checkpoint emits its own."""
        return f"{self.changes_path}/query={query_of(self.checkpoint, self.spark)}"

    def committed(self) -> list[int]:
        return sorted(int(n) for n in files.names(self.spark, f"{self.checkpoint}/commits") if n.isdigit())

    def latest(self) -> int | None:
        ids = self.committed()
        return ids[-1] if ids else None

    def read(self, name: str) -> DataFrame:
        if name == "city_bridge":
            return self.bridge.read().select("city_id", "name")
        if self.latest() is None:
            return self.spark.createDataFrame([], CITY_STATE)
        kept = self.spark.read.format("statestore").option("stateVarName", name).load(self.checkpoint)
        return kept.select("key.name", "value.*")

    def changes(self) -> DataFrame:
        """INSERT and UPDATE rows of all committed batches, with their ``batch``."""
        schema = f"{CHANGES}, batch long"
        latest = self.latest()
        if latest is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._own()).where(F.col("batch") <= latest)
