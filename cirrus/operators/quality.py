"""Declared constraints as data-quality checks returning the violating rows.

Each check is one distributed job (filter, aggregate or anti-join); none
collects rows to the driver. The limits of single rows (NOT NULL, lengths) can
also be enforced while a table is written: ``limits``, ``enforce``, ``counts``. ``surrogate_key`` assigns dense, ordered ids
without a single-partition window over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from cirrus.session import scratch_path


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns`` (NOT NULL constraint)."""
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.where(cond)


def dq_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row (UNIQUE / PRIMARY KEY). Partial
    aggregation collapses duplicates map-side, so a hot key stays cheap."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def dq_foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (FOREIGN KEY)."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def dq_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows whose string columns exceed their declared VARCHAR(n) length."""
    cond = None
    for c, n in limits.items():
        over = F.length(c) > n
        cond = over if cond is None else cond | over
    return df.where(cond)


def limits(not_null: Sequence[str] = (), lengths: Mapping[str, int] | None = None) -> dict[str, Column]:
    """The declared limits of a row: what breaks each, by the limit's name."""
    return {**{f"{c} is null": F.col(c).isNull() for c in not_null},
            **{f"{c} longer than {n}": F.coalesce(F.length(c) > n, F.lit(False)) for c, n in (lengths or {}).items()}}


def enforce(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The rows with ``violations`` (names of the limits that a row breaks) and ``accepted`` (none), and an observation of
    the counts: ``rows`` and ``rejected``, and one for each limit by its position (``limit_0``, ..). The counts are taken
    while the rows are written; ``counts`` reads them afterwards."""
    names = F.array(*(F.when(broken, F.lit(name)) for name, broken in rules.items())) if rules else F.array().cast("array<string>")
    seen = Observation()
    marked = df.withColumn("violations", F.array_compact(names)).withColumn("accepted", F.size("violations") == 0)
    # Counted behind the marks, so that a row is judged once.
    return marked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("accepted")).alias("rejected"),
        *(F.count_if(F.array_contains("violations", n)).alias(f"limit_{i}") for i, n in enumerate(rules))), seen


def counts(seen: Observation, rules: Mapping[str, Column]) -> dict[str, int]:
    """Rows, rejected rows, and rows that break each limit, once the observed rows have been written."""
    got = seen.get
    return {"rows": got["rows"], "rejected": got["rejected"], **{n: got[f"limit_{i}"] for i, n in enumerate(rules)}}


def placed(df: DataFrame, order: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """The rows range-partitioned by ``order`` and sorted inside the partitions, with their partition number ``_pid`` and,
    in the lower 33 bits of ``_at``, their position in it. Equal on every run over rows that come in the same order."""
    # Rows equal on the whole order are interchangeable; a per-row tie-break
    # lets the range partitioner split even a huge group of such rows.
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    full = [*order, "_tie"]
    ranged = keyed.repartitionByRange(num_partitions, *full) if num_partitions else keyed.repartitionByRange(*full)
    return (ranged.sortWithinPartitions(*full).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright("_at", 33)))


def position() -> Column:
    """A row's position in its partition, of ``placed`` rows."""
    return F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))


def surrogate_key(df: DataFrame, order: Sequence[str], key_col: str = "surrogate_id",
                  start: int = 0, num_partitions: int | None = None, path: str | None = None) -> DataFrame:
    """Dense ids ``start+1 ..`` in ``order`` (which must be unique), distributed.

    1. range-partition by ``order``, sort inside the partitions and write the rows with their partition number and
       position in it (the two halves of ``monotonically_increasing_id``), so that both are fixed;
    2. per-partition counts -> running offsets (one row per partition);
    3. id = start + offset(partition) + position. No second shuffle or sort of the rows."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "surrogate_key")
    placed(df, order, num_partitions).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (stored.join(offsets, "_pid").withColumn(key_col, F.lit(start) + F.col("_offset") + position() + 1)
            .drop("_pid", "_offset", "_at"))
