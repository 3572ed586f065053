"""Answer tables that Spark keeps itself: a streaming aggregation whose state store is the table.

The rule runs as ``groupBy().agg()`` in the stream, in update mode, on Spark's RocksDB state store: a micro-batch is
aggregated before its shuffle, changes the keys it touches and commits with the query's own commit log. A batch's cost
follows its rows, not the table's size or the number of batches before it, a replay changes nothing, and a crash leaves
the last committed version. Readers use Spark's state reader, which sees committed versions only, so there is no second
copy of the table to keep in step.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrus.streaming import files

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
#: A batch commits the changes of a state partition, not a copy of its files; Spark folds them into snapshots on the side.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Counting a table's rows would look up each key again before it is written; nothing reads that count.
ROW_COUNT = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Queries start side by side, and the settings are the session's.
_setting = threading.Lock()


def default_state_partitions(spark: SparkSession) -> int:
    """A task for each core (8 at least, as executors may still be coming), and no more than the session's shuffles have:
    every batch opens and commits each state partition, also those that it brings no rows."""
    return min(int(spark.conf.get(PARTITIONS)), max(8, spark.sparkContext.defaultParallelism))


def shared_state_partitions(spark: SparkSession, tables: int = 4) -> int:
    """Of each of the tables whose batches run so many at a time: their tasks fill the cores together (4 each at least)."""
    return min(int(spark.conf.get(PARTITIONS)), max(4, spark.sparkContext.defaultParallelism // tables))


@contextmanager
def own_settings():
    """Queries started inside get the session's own settings, also while others start that keep their state in RocksDB."""
    with _setting:
        yield


@contextmanager
def rocksdb(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in RocksDB, in so many partitions (a query that has a checkpoint keeps the
    number it began with); the session's own settings come back afterwards."""
    with _setting:
        own = {PROVIDER: ROCKSDB, CHANGELOG: "true", ROW_COUNT: "false", PARTITIONS: str(partitions or default_state_partitions(spark))}
        before = {k: spark.conf.get(k, None) for k in own}
        for k, v in own.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class NativeTable:
    """One maintained table. ``aggregate(stream)`` groups by ``keys``; ``values`` ("name type, ..") names what its
    aggregate functions keep, in their order (a maximum, minimum, sum or count each keep one column)."""

    def __init__(self, spark: SparkSession, checkpoint: str, aggregate: Callable[[DataFrame], DataFrame], keys: str,
                 values: str, present: Callable[[DataFrame], DataFrame] | None = None, partitions: int | None = None):
        self.spark = spark
        self.partitions = partitions
        self.checkpoint = checkpoint
        self.aggregate = aggregate
        self.keys, self.values = ([f.split(" ") for f in fields.split(", ")] for fields in (keys, values))
        self.present = present

    def start(self, stream: DataFrame, trigger: str | None, name: str | None = None):
        """Start the query (``availableNow`` without a trigger) and return it."""
        w = (self.aggregate(stream).writeStream.outputMode("update").format("noop")
             .option("checkpointLocation", self.checkpoint))
        w = w.queryName(name) if name else w
        with rocksdb(self.spark, self.partitions):
            return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()

    def committed(self) -> list[int]:
        """Batch ids of the query's commit log (Spark keeps the newest)."""
        return sorted(int(n) for n in files.names(self.spark, f"{self.checkpoint}/commits") if n.isdigit())

    def latest(self) -> int | None:
        ids = self.committed()
        return ids[-1] if ids else None

    def read(self) -> DataFrame:
        """The table as of the newest committed batch."""
        fields = [*self.keys, *self.values]
        if self.latest() is None:
            rows = self.spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in fields))
            return self.present(rows).where(F.lit(False)) if self.present else rows
        kept = self.spark.read.format("statestore").load(self.checkpoint)
        # The columns of the state are named by function, so they are taken by position.
        struct = lambda c, fs: F.col(c).cast("struct<" + ", ".join(f"{n}: {t}" for n, t in fs) + ">").alias(c)
        rows = kept.select(struct("key", self.keys), struct("value", self.values)).select("key.*", "value.*")
        return self.present(rows) if self.present else rows
