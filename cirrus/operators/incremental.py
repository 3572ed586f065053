"""Incrementally maintained answer tables as pure ``merge(state, changes)``.

Every state stores *mergeable partials* (count; sum+count; max; min/max per
day; set; ordered halving partial), so

    new_state = unionByName(state, partial(changes)).groupBy(key).agg(merge)

Both inputs stay distributed; the batch side is pre-aggregated (map-side
partial aggregation) before anything is shuffled, so a key holding a third
of all rows costs one partial row per task. Merging any split of the input,
in order, gives the same state as one batch over all of it.

``changes`` are observation rows (city_id, main, temperature, wind_speed,
dt, event_id) unless stated otherwise; empty states are made with
``empty_state``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from cirrus.functions.scalars import utc_offset_label

ORDER = ("dt", "event_id")


def empty_state(spark, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------------------
# H10 frequency per (city, condition): matched -> + batch count, else insert
# ---------------------------------------------------------------------------
FREQUENCY_STATE = "city_id bigint, weather_condition string, frequency bigint"


def partial_condition_frequency(changes: DataFrame) -> DataFrame:
    return (changes.groupBy("city_id", F.col("main").alias("weather_condition"))
            .agg(F.count(F.lit(1)).alias("frequency")))


def combine_condition_frequency(parts: DataFrame) -> DataFrame:
    return parts.groupBy("city_id", "weather_condition").agg(F.sum("frequency").alias("frequency"))


def merge_condition_frequency(state: DataFrame, changes: DataFrame) -> DataFrame:
    return combine_condition_frequency(state.select("city_id", "weather_condition", "frequency").unionByName(
        partial_condition_frequency(changes)))


def present_condition_rank(state: DataFrame) -> DataFrame:
    """Rank of each condition inside its city by frequency, ties sharing a rank."""
    w = Window.partitionBy("city_id").orderBy(F.desc("frequency"))
    return state.withColumn("rank", F.rank().over(w))


# ---------------------------------------------------------------------------
# H9 set of distinct conditions (+ its size); optional grouping keys
# ---------------------------------------------------------------------------
def distinct_conditions_state(keys: Sequence[str] = ()) -> str:
    key_cols = {"city_id": "bigint", "city": "string", "name": "string"}
    cols = [f"{k} {key_cols.get(k, 'string')}" for k in keys]
    return ", ".join(cols + ["distinct_conditions array<string>", "distinct_conditions_count bigint"])


def merge_distinct_conditions(state: DataFrame, changes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add only unseen conditions. The set is bounded by the condition domain."""
    return combine_distinct_conditions(state.select(*keys, "distinct_conditions").unionByName(
        partial_distinct_conditions(changes, keys).select(*keys, "distinct_conditions")), keys)


def partial_distinct_conditions(changes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    batch = changes.groupBy(*keys).agg(F.collect_set("main").alias("distinct_conditions"))
    return batch.withColumn("distinct_conditions_count", F.size("distinct_conditions").cast("long"))


def combine_distinct_conditions(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One set out of many: the members are exploded and collected anew, so partial aggregation folds them."""
    merged = parts.select(*keys, F.explode_outer("distinct_conditions").alias("main")).groupBy(*keys).agg(
        F.sort_array(F.collect_set("main")).alias("distinct_conditions"))
    return merged.withColumn("distinct_conditions_count", F.size("distinct_conditions").cast("long"))


def anti_join_new_conditions(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows of ``changes`` whose condition is not yet in the state's set
    (the NOT MATCHED side of a MERGE on ``array_contains``). The set is
    exploded into a key column so the membership test is an equi anti-join."""
    seen = state.select(F.explode("distinct_conditions").alias("main")).distinct()
    return changes.join(seen, "main", "left_anti")


# ---------------------------------------------------------------------------
# H11 exact average: (sum, count) partials
# ---------------------------------------------------------------------------
AVG_STATE = "city_id bigint, sum_temperature double, count_temperature bigint"


def partial_avg_exact(changes: DataFrame) -> DataFrame:
    return changes.groupBy("city_id").agg(F.sum("temperature").alias("sum_temperature"),
                                          F.count("temperature").alias("count_temperature"))


def combine_avg_exact(parts: DataFrame) -> DataFrame:
    return parts.groupBy("city_id").agg(F.sum("sum_temperature").alias("sum_temperature"),
                                        F.sum("count_temperature").alias("count_temperature"))


def merge_avg_exact(state: DataFrame, changes: DataFrame) -> DataFrame:
    return combine_avg_exact(state.select("city_id", "sum_temperature", "count_temperature").unionByName(
        partial_avg_exact(changes)))


def present_avg(state: DataFrame) -> DataFrame:
    return state.select("city_id", F.try_divide("sum_temperature", "count_temperature").alias("avg_temperature"))


# ---------------------------------------------------------------------------
# H11 literal halving average: avg_1 = x_1, avg_i = (avg_{i-1} + x_i) / 2
# ---------------------------------------------------------------------------
# Closed form over n ordered values: S = T + x_1 * 2^-n with
# T = sum_i x_i * 2^-(rows after i + 1). For ordered chunks A then B:
# T_AB = T_A * 2^-n_B + T_B, n_AB = n_A + n_B, x_1 = first of A.
HALVING_STATE = "city_id bigint, avg_temperature double, n bigint"


def _ordered_chunks(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Per (key, contiguous run inside one range partition) partials.

    Rows are range-partitioned on (key, order) -- a hot key is split over
    several partitions -- and sorted inside each partition; one pandas pass
    per partition folds each key's run into (t, n, first value, run start),
    carrying the open run across Arrow batches."""
    o1, o2 = order
    # A NULL key is a group of its own; it travels as a flag beside a plain key, so that no column needs NULLs and
    # pandas keeps whole numbers exact.
    kind = df.schema[key].dataType
    src = (df.where(F.col(value).isNotNull())
           .select(F.col(key).isNull().alias("_null"), F.coalesce(F.col(key), F.lit(0).cast(kind)).alias("_k"),
                   F.col(value).alias("_v"), F.col(o1).alias("_o1"), F.col(o2).alias("_o2")))
    schema = T.StructType([
        T.StructField("_null", T.BooleanType()), T.StructField("_k", kind),
        T.StructField("_o1", src.schema["_o1"].dataType), T.StructField("_o2", src.schema["_o2"].dataType),
        T.StructField("t", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("first", T.DoubleType()),
    ])
    cols = [f.name for f in schema.fields]

    def fold(batches):
        carry = None  # partial of the last key of the previous Arrow batch, a frame of one row
        for pdf in batches:
            if pdf.empty:
                continue
            g = pdf.groupby(["_null", "_k"], sort=False)
            after = g.cumcount(ascending=False).to_numpy()
            weighted = pdf["_v"].to_numpy() * np.ldexp(1.0, -(after + 1))
            parts = (pdf.assign(_w=weighted).groupby(["_null", "_k"], sort=False)
                     .agg(_o1=("_o1", "first"), _o2=("_o2", "first"), t=("_w", "sum"),
                          n=("_v", "size"), first=("_v", "first"))
                     .reset_index())[cols]
            if carry is not None:
                if carry["_k"].iloc[0] == parts["_k"].iloc[0] and carry["_null"].iloc[0] == parts["_null"].iloc[0]:
                    at = parts.index[0]
                    parts.loc[at, "t"] += carry["t"].iloc[0] * np.ldexp(1.0, -int(parts["n"].iloc[0]))
                    parts.loc[at, "n"] += carry["n"].iloc[0]
                    for c in ("_o1", "_o2", "first"):
                        parts[c] = pd.concat([carry[c], parts[c].iloc[1:]]).to_numpy()
                else:
                    parts = pd.concat([carry, parts], ignore_index=True)
            carry = parts.iloc[-1:].reset_index(drop=True)
            if len(parts) > 1:
                yield parts.iloc[:-1]
        if carry is not None:
            yield carry

    # The per-row tie-break lets the range partitioner split a key even when
    # many of its rows share the whole order (they carry equal values then).
    src = src.withColumn("_tie", F.monotonically_increasing_id())
    ranged = (src.repartitionByRange("_null", "_k", "_o1", "_o2", "_tie")
              .sortWithinPartitions("_null", "_k", "_o1", "_o2", "_tie").drop("_tie"))
    return ranged.mapInPandas(fold, schema).select(
        F.when(~F.col("_null"), F.col("_k")).alias(key), "_o1", "_o2", "t", "n", "first")


def halving_partials(changes: DataFrame, key: str = "city_id", value: str = "temperature",
                     order: Sequence[str] = ORDER) -> DataFrame:
    """(key, t, n, first) of the ordered rows of each key: exact, and no key's
    rows are ever gathered into one task (only its few run partials are).
    ``order`` (two columns) must make the order of unequal values unique."""
    chunks = _ordered_chunks(changes, key, value, order)
    later = Window.partitionBy(key).orderBy("_o1", "_o2").rowsBetween(1, Window.unboundedFollowing)
    return (chunks.withColumn("after", F.coalesce(F.sum("n").over(later), F.lit(0)))
            .groupBy(key)
            .agg(F.sum(F.col("t") * F.pow(F.lit(0.5), F.col("after"))).alias("t"),
                 F.sum("n").alias("n"),
                 F.min_by("first", F.struct("_o1", "_o2")).alias("first")))


def merge_avg_halving(state: DataFrame, changes: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Existing key: new = old * 2^-k + T_batch; new key: T_batch + x_1 * 2^-k."""
    b = halving_partials(changes, order=order).withColumn("there", F.lit(True)).alias("b")
    s = state.select("city_id", "avg_temperature", "n", F.lit(True).alias("there")).alias("s")
    half_k = F.pow(F.lit(0.5), F.col("b.n"))
    avg = (F.when(F.col("b.there").isNull(), F.col("s.avg_temperature"))
           .when(F.col("s.there").isNull(), F.col("b.t") + F.col("b.first") * half_k)
           .otherwise(F.col("s.avg_temperature") * half_k + F.col("b.t")))
    return (s.join(b, F.col("s.city_id").eqNullSafe(F.col("b.city_id")), "full")
            .select(F.coalesce("s.city_id", "b.city_id").alias("city_id"),
                    avg.alias("avg_temperature"),
                    (F.coalesce("s.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n")))


HALVING_DELTA = "city_id bigint, t double, n bigint, first double"


def combine_avg_halving(parts: DataFrame) -> DataFrame:
    """Partials (city_id, t, n, first) of consecutive batches (column ``batch``) folded into one for each key."""
    later = Window.partitionBy("city_id").orderBy("batch").rowsBetween(1, Window.unboundedFollowing)
    return (parts.withColumn("after", F.coalesce(F.sum("n").over(later), F.lit(0)))
            .groupBy("city_id")
            .agg(F.sum(F.col("t") * F.pow(F.lit(0.5), F.col("after"))).alias("t"), F.sum("n").alias("n"),
                 F.min_by("first", "batch").alias("first")))


def present_avg_halving(state: DataFrame) -> DataFrame:
    return state.select("city_id", (F.col("t") + F.col("first") * F.pow(F.lit(0.5), F.col("n"))).alias("avg_temperature"),
                        "n")


# ---------------------------------------------------------------------------
# H12 / H13 running maxima per city; theta form
# ---------------------------------------------------------------------------
def max_state(value_alias: str) -> str:
    return f"city_id bigint, {value_alias} double"


def merge_running_max(state: DataFrame, changes: DataFrame, value: str = "temperature",
                      alias: str = "max_abs_temperature", key: str = "city_id") -> DataFrame:
    """Raise where ``old < new``; keys first seen in ``changes`` are inserted."""
    return combine_running_max(state.select(key, alias).unionByName(
        partial_running_max(changes, value, alias, key)), alias, key)


def partial_running_max(changes: DataFrame, value: str = "temperature", alias: str = "max_abs_temperature",
                        key: str = "city_id") -> DataFrame:
    return changes.groupBy(key).agg(F.max(value).alias(alias))


def combine_running_max(parts: DataFrame, alias: str = "max_abs_temperature", key: str = "city_id") -> DataFrame:
    return parts.groupBy(key).agg(F.max(alias).alias(alias))


def theta_update(target: DataFrame, changes: DataFrame, key: str, target_col: str,
                 value_col: str) -> DataFrame:
    """MERGE ... ON target.col < source.value WHEN MATCHED THEN UPDATE, keyed.

    Only existing target rows change (no insert branch). The changes are
    reduced to one max per key first, so the theta predicate becomes a keyed
    left join plus ``greatest`` instead of a nested-loop join."""
    best = changes.groupBy(key).agg(F.max(value_col).alias("_best"))
    return (target.join(best, key, "left")
            .withColumn(target_col, F.when(F.col("_best") > F.col(target_col), F.col("_best"))
                        .otherwise(F.col(target_col)))
            .drop("_best"))


# ---------------------------------------------------------------------------
# H14 maximum daily variation per city: min/max per (city, day)
# ---------------------------------------------------------------------------
DAILY_STATE = "city_id bigint, date date, hi double, lo double"


def merge_daily_extremes(state: DataFrame, changes: DataFrame) -> DataFrame:
    return combine_daily_extremes(state.select("city_id", "date", "hi", "lo").unionByName(
        partial_daily_extremes(changes)))


def partial_daily_extremes(changes: DataFrame) -> DataFrame:
    return (changes.groupBy("city_id", F.to_date("dt").alias("date"))
            .agg(F.max("temperature").alias("hi"), F.min("temperature").alias("lo")))


def combine_daily_extremes(parts: DataFrame) -> DataFrame:
    return parts.groupBy("city_id", "date").agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"))


def present_daily_variation(state: DataFrame) -> DataFrame:
    """Per city the day with the largest max-min (ties -> earliest day).
    The window holds one row per (city, day): bounded by the calendar."""
    w = Window.partitionBy("city_id").orderBy(F.desc_nulls_last("temperature_variation"), "date")
    return (state.select("city_id", "date", (F.col("hi") - F.col("lo")).alias("temperature_variation"))
            .withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn"))


# ---------------------------------------------------------------------------
# H6 / H8 upsert of the city dimension by natural key ``name``
# ---------------------------------------------------------------------------
CITY_ATTRS = ("timezone", "country", "latitude", "longitude")
CITY_STATE = "name string, city_id bigint, timezone int, country string, latitude double, longitude double"
CONSUMPTION_CITY_STATE = ("name string, city_id bigint, timezone string, country string, "
                          "latitude double, longitude double")


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _as_long(df: DataFrame, c: str):
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ).cast(t), F.col(c))
    if isinstance(t, T.DateType):
        return F.date_diff(F.col(c), F.lit("1970-01-01").cast("date"))
    if isinstance(t, T.IntegralType):
        return F.col(c).cast("long")
    raise TypeError(f"order column {c} must be a timestamp, date or integer, not {t.simpleString()}")


def order_key(df: DataFrame, order: Sequence[str]):
    """One fixed-width DECIMAL(38,0) that sorts like the order columns.

    Two columns pack as ``first * 2^64 + (second + 2^63)``; the first must lie
    within +-2^60 (timestamps as epoch microseconds: +-36,000 years). A single
    fixed-width key keeps min/max in a hash aggregate (a struct key would force
    a sort-based aggregate over every row)."""
    if not 1 <= len(order) <= 2:
        raise ValueError("order key packs one or two columns")
    first = _as_long(df, order[0]).cast("decimal(38,0)")
    if len(order) == 1:
        return first
    second = _as_long(df, order[1]).cast("decimal(38,0)") + F.lit(str(2 ** 63)).cast("decimal(38,0)")
    return first * F.lit(str(2 ** 64)).cast("decimal(38,0)") + second


def _from_long(value, kind: T.DataType):
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.timestamp_add("MICROSECOND", value, F.expr(_EPOCH_NTZ).cast(kind))
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), value.cast("int"))
    return value.cast(kind)


def first_and_last_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """For each key its earliest and its latest place in ``order``: all that an upsert reads of a fact.

    ``keys`` and the order columns, one or two rows a key. One hash aggregate (see ``order_key``) brings a fact down to
    the dimension's size before it meets the dimension, so the join sees no raw row."""
    k, unit = order_key(rows, order), F.lit(str(2 ** 64)).cast("decimal(38,0)")
    ends = rows.groupBy(*keys).agg(F.min(k).alias("_lo"), F.max(k).alias("_hi")).select(
        *keys, F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_k"))
    if len(order) == 1:
        parts = [F.col("_k").cast("long")]
    else:
        low = F.pmod("_k", unit)
        parts = [F.call_function("div", F.col("_k") - low, unit), (low - F.lit(str(2 ** 63)).cast("decimal(38,0)")).cast("long")]
    return ends.select(*keys, *(_from_long(p, rows.schema[c].dataType).alias(c) for p, c in zip(parts, order, strict=True)))


def _first_last_per_name(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per name: attributes of its earliest row (what an insert would write)
    and the id / timezone of its latest row (what later updates write).

    Hash-aggregates the rows down to the dimension grain (name + attribute
    values, earliest/latest packed order key) first; picking first/last per
    name then runs on dimension-sized data only."""
    k = order_key(changes, order)
    grain = (changes.groupBy("name", "city_id", *CITY_ATTRS)
             .agg(F.min(k).alias("_first_key"), F.max(k).alias("_last_key")))
    return grain.groupBy("name").agg(
        F.min_by(F.struct(*CITY_ATTRS), "_first_key").alias("first"),
        F.max_by(F.struct("city_id", "timezone"), "_last_key").alias("last"))


def _upsert_by_name(state: DataFrame, changes: DataFrame, order: Sequence[str],
                    updated: dict) -> DataFrame:
    b = _first_last_per_name(changes, order).withColumn("there", F.lit(True)).alias("b")
    s = state.withColumn("there", F.lit(True)).alias("s")
    new = F.col("s.there").isNull()
    out = [F.coalesce("s.name", "b.name").alias("name")]
    for col in ("city_id",) + CITY_ATTRS:
        if col in updated:
            value = updated[col]
            out.append(F.when(F.col("b.there").isNull(), F.col(f"s.{col}")).otherwise(value).alias(col))
        else:
            out.append(F.when(new, F.col(f"b.first.{col}")).otherwise(F.col(f"s.{col}")).alias(col))
    return s.join(b, F.col("s.name").eqNullSafe(F.col("b.name")), "full").select(*out)


def merge_city(state: DataFrame, changes: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """H6: matched name -> overwrite city_id with the latest one; unmatched ->
    insert the row. ``changes``: name, city_id, timezone, country, latitude,
    longitude and the order columns."""
    return _upsert_by_name(state, changes, order, {"city_id": F.col("b.last.city_id")})


def merge_consumption_city(state: DataFrame, changes: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """H8: as H6, and the timezone becomes its UTC offset label (also on update)."""
    changes = changes.withColumn("timezone", utc_offset_label("timezone"))
    return _upsert_by_name(state, changes, order, {"city_id": F.col("b.last.city_id"),
                                                   "timezone": F.col("b.last.timezone")})


# ---------------------------------------------------------------------------
# H3 change capture with INSERT / UPDATE (/ DELETE) rows by snapshot diff
# ---------------------------------------------------------------------------
def snapshot_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of ``after`` that are new (INSERT) or changed (UPDATE), and keys
    gone from it (DELETE), with an ``op`` column. Null-safe comparison."""
    cols = [c for c in after.columns if c != key]
    b = before.withColumn("_there", F.lit(True)).alias("b")
    a = after.withColumn("_there", F.lit(True)).alias("a")
    same = F.struct(*[F.col(f"b.{c}") for c in cols]).eqNullSafe(F.struct(*[F.col(f"a.{c}") for c in cols]))
    op = (F.when(F.col("b._there").isNull(), F.lit("INSERT"))
          .when(F.col("a._there").isNull(), F.lit("DELETE"))
          .when(~same, F.lit("UPDATE")))
    return (b.join(a, F.col("b." + key).eqNullSafe(F.col("a." + key)), "full")
            .select(op.alias("op"), F.coalesce(f"a.{key}", f"b.{key}").alias(key),
                    *[F.col(f"a.{c}").alias(c) for c in cols])
            .where(F.col("op").isNotNull()))
