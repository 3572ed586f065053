"""Shared pieces of the training-data operators: word arrays, keys, scratch tables, global order, components.

A document row is keyed by ``(doc_id, hash of its text)`` inside the operators, compared null-safe, so that missing
or repeated ids neither lose nor multiply rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cirrus.session import scratch_path

# Fixed values of the word definitions (Java regular expressions).
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all other letters untouched."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, pattern: str = SPACE_WORD) -> Column:
    """All words of a text, in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def word_count(text: Column, pattern: str = SPACE_WORD) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def word_hashes(text: Column, pattern: str = SPACE_WORD) -> Column:
    """One 64-bit hash for each word of a text, in order."""
    return F.transform(words(text, pattern), lambda x: F.xxhash64(x))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside lambdas.

    (Spark merges projections and would compute a plain column again for every element of a lambda.)"""
    return F.transform(F.array(value), body)[0]


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; an absent id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text, the named columns and the key column ``_th``; other columns cannot clash."""
    return docs.select("doc_id", "text", *columns, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_th"] == b["_th"])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts lineage, survives lost executors.

    Nothing reads the write's shuffle files afterwards, so Spark may drop them at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    try:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """The rows in range partitions of the given order, each row with its partition number ``_part``, stored.

    The partition number is written with the rows, so later reads agree on it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)


def with_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds ``_rank`` (0, 1, ...) in the given total order without gathering all rows in one task.

    Rows are numbered inside range partitions; the partitions' counts (one row each) give the offsets."""
    rows = ranged(df, name, *order)
    offsets = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return rows.withColumn("_i", inside).join(offsets, "_part").withColumn(
        "_rank", F.col("_before") + F.col("_i")).drop("_part", "_i", "_before")


def sorted_rows(df: DataFrame, name: str, order: list[str], *keep: Column | str) -> DataFrame:
    """The columns ``keep`` of the rows in range partitions by ``order``, sorted, stored, each with its partition ``_part``
    and position ``_pos`` in it. Both are written with the rows, and only one shuffle moves them."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = stored(rows.select(*keep, F.monotonically_increasing_id().alias("_at")), name)
    return at.withColumn("_part", F.shiftright("_at", 33)).withColumn(
        "_pos", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def numbered(df: DataFrame, name: str, order: list[str], *keep: Column | str) -> DataFrame:
    """The columns ``keep`` and ``_rank`` (0, 1, ..) in the given total order: positions and the partitions' counts."""
    rows = sorted_rows(df, name, order, *keep)
    offsets = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(offsets, "_part").withColumn("_rank", F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_before")


def spans(rows: DataFrame, *groups: str) -> DataFrame:
    """For rows of ``sorted_rows`` by ``groups`` first: one row for each group and partition that holds some of it, with
    ``_lo`` (the first position there), ``_before`` (the group's rows in earlier partitions) and ``_total`` (all its rows).

    A row's index in its group is ``_before + _pos - _lo``, joined by group and partition: a group of any size meets in no
    task, for a key's rows are those of one partition. Groups are never null."""
    group = Window.partitionBy(*groups)
    here = rows.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_lo"))
    return here.select(*groups, "_part", "_lo", F.sum("_n").over(group).alias("_total"),
                       (F.sum("_n").over(group.orderBy("_part")) - F.col("_n")).alias("_before"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of edges (u, v): one row (node, component) for each node, component the smallest node.

    Each round hooks every node to its smallest neighbour, shortcuts once and contracts the edges; the
    tables of each round are stored. A star of any size is one round, a chain takes logarithmically many."""
    edges = stored(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                   .distinct(), name)
    labels = None
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = stored(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("p"))
                        .select("node", F.least("node", "p").alias("p")), name)
        up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        hop = stored(parent.join(up, "p").select("node", F.col("pp").alias("to")), name)
        if labels is None:
            labels = hop.withColumnRenamed("to", "component")
        else:
            labels = labels.join(hop.withColumnRenamed("node", "component"), "component", "left").select(
                "node", F.coalesce("to", "component").alias("component"))
        labels = stored(labels, name)
        edges = stored(
            edges.join(hop.select(F.col("node").alias("u"), F.col("to").alias("a")), "u")
            .join(hop.select(F.col("node").alias("v"), F.col("to").alias("b")), "v")
            .where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), name)
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return labels


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of at most ``rows`` rows, so that batches of long texts stay small in the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def sample_of_texts(docs: DataFrame, n: int) -> DataFrame:
    """(h, text): at most ``n`` distinct texts, those with the smallest hashes.

    The bound is found on the hashes alone; only the chosen texts are moved, copies of one text once."""
    digest = F.xxhash64("text")
    cut = docs.select(digest.alias("h")).distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    chosen = docs.where(F.lit(False) if cut is None else digest <= cut)
    return chosen.select(digest.alias("h"), "text").groupBy("h").agg(F.min("text").alias("text"))


ARROW = {"double": pa.float64(), "string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def from_texts(docs: DataFrame, work, made: str, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` untouched, and the columns ``made`` ("name type, ..") that Python finds.

    ``work()`` is called once in a task and returns a function from a list of texts to a tuple of columns. Kept columns
    stay in Arrow: ids beside missing ones keep all their digits."""
    fields = [f.split(" ") for f in made.split(", ")]
    names = [*keep, *(n for n, _ in fields)]

    def run(batches):
        columns = work()
        for batch in batches:
            at = batch.schema.get_field_index
            found = columns(batch.column(at("text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(c)) for c in keep),
                 *(pa.array(v, ARROW[t]) for v, (_, t) in zip(found, fields, strict=True))], names)

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes), made])
    small_batches(docs.sparkSession)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)
