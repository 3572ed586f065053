"""Landing (VARIANT) -> curated tables: location dimension and observation fact.

Pure DataFrame transforms: filters are applied before extraction so rows
outside the allow-list are never decoded, and every expression is built-in,
so the whole curation runs inside one whole-stage-codegen span per scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from cirrus.functions.paths import CITY_FIELDS, OBSERVATION_FIELDS, extract
from cirrus.functions.scalars import (
    CITY_ALLOW_LIST, epoch_to_timestamp, round_coordinate, timezone_override,
    wind_direction,
)
from cirrus.sources.landing import LANDING_COLUMN

# The columns of the curated fact.
OBSERVATION_COLUMNS = (
    "city_id", "main", "description", "temperature", "feels_like", "temp_min",
    "temp_max", "pressure", "humidity", "visibility", "wind_speed", "wind_direction",
    "cloudiness", "rain_1h", "rain_3h", "snow_1h", "snow_3h", "dt",
)
CITY_COLUMNS = ("city_id", "name", "timezone", "country", "latitude", "longitude")


def filter_allow_list(df: DataFrame, column, values: Iterable[str]) -> DataFrame:
    """OR of equalities on one column (``IN`` list); pushed into Parquet scans."""
    c = F.col(column) if isinstance(column, str) else column
    return df.where(c.isin(list(values)))


def filter_time_range(df: DataFrame, start, end, ts_col: str = "dt",
                      date_col: str | None = None) -> DataFrame:
    """Closed range ``start <= ts <= end`` on a TIMESTAMP_NTZ column.

    Literals are cast to TIMESTAMP_NTZ (zone independent). With ``date_col``
    (the partition column of curated tables) a redundant date predicate is
    added so partition pruning skips whole days."""
    s = F.lit(str(start)).cast("timestamp_ntz")
    e = F.lit(str(end)).cast("timestamp_ntz")
    cond = (F.col(ts_col) >= s) & (F.col(ts_col) <= e)
    if date_col:
        cond = cond & F.col(date_col).between(F.to_date(s), F.to_date(e))
    return df.where(cond)


def _name_filter(landing: DataFrame, column: str, allow, strict: bool) -> DataFrame:
    if allow is None:
        return landing
    return filter_allow_list(landing, extract(column, "$.name", "string", strict), allow)


def curated_city(landing: DataFrame, column: str = LANDING_COLUMN,
                 allow: Iterable[str] | None = CITY_ALLOW_LIST, strict: bool = False) -> DataFrame:
    """Distinct location rows: id, name, canonical timezone, country and
    coordinates rounded to one decimal (so jitter in the 3rd-4th decimal does
    not create duplicate rows)."""
    raw = _name_filter(landing, column, allow, strict).select(
        *[extract(column, path, t, strict).alias(name) for name, path, t in CITY_FIELDS])
    return (raw.select("city_id", "name", timezone_override("timezone").alias("timezone"), "country",
                       round_coordinate("latitude").alias("latitude"),
                       round_coordinate("longitude").alias("longitude"))
            .distinct())


_DERIVED = {
    "wind_direction": lambda: wind_direction("wind_deg"),
    # FLOAT -> INT on insert rounds (the declared column is INT).
    "cloudiness": lambda: F.round("cloudiness").cast("int"),
    "dt": lambda: epoch_to_timestamp("epoch"),
}


def observation_columns(column: str = LANDING_COLUMN, strict: bool = False) -> list:
    """The extracted fields (each VARIANT path decoded exactly once)."""
    return [extract(column, path, t, strict).alias(name) for name, path, t in OBSERVATION_FIELDS]


def curated_observation(landing: DataFrame, column: str = LANDING_COLUMN,
                        allow: Iterable[str] | None = CITY_ALLOW_LIST, strict: bool = False,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """The 18-column observation fact (primary condition = weather[0]).

    Two projections: the first decodes every path once, the second derives
    columns from the decoded values. (Catalyst keeps them apart because the
    decoded values are reused; derived CASE branches would otherwise decode
    the same path again per branch.)"""
    raw = _name_filter(landing, column, allow, strict).select(*keep, *observation_columns(column, strict))
    return raw.select(*keep, *[(_DERIVED[c]() if c in _DERIVED else F.col(c)).alias(c)
                               for c in OBSERVATION_COLUMNS])


def with_partition_date(obs: DataFrame, ts_col: str = "dt", date_col: str = "obs_date") -> DataFrame:
    """Adds the day column curated facts are partitioned by."""
    return obs.withColumn(date_col, F.to_date(ts_col))
