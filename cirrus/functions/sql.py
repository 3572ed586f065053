"""The scalar rules as SQL functions, for users of ``spark.sql``: the same fixed values, one expression each.

Spark puts a SQL function's body in place of its call, so a query runs as if the expression had been written out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cirrus.functions import scalars as S


def _case(branches, default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN '{then}'" for when, then in branches) + f" ELSE {default} END"


#: Name -> (parameters, result type, expression).
FUNCTIONS = {
    "wind_direction": ("deg DOUBLE", "STRING", _case([
        (f"deg >= {S.NORTH_LOW}D OR deg < {S.NORTH_HIGH}D", S.NORTH),
        *((f"deg >= {low}D AND deg < {high}D", label) for label, low, high in S.COMPASS_SECTORS)])),
    "timezone_override": ("tz INT", "INT", f"CASE WHEN tz <> {S.CANONICAL_TIMEZONE} THEN {S.CANONICAL_TIMEZONE} ELSE tz END"),
    "utc_offset_label": ("tz INT", "STRING", _case([(f"tz = {s}", label) for s, label in S.UTC_OFFSET_LABELS.items()])),
    "round_coordinate": ("x DOUBLE", "DOUBLE", "round(x, 1)"),
    "epoch_to_timestamp": ("seconds BIGINT", "TIMESTAMP_NTZ",
                           "TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, seconds)"),
    "timestamp_to_epoch": ("ts TIMESTAMP_NTZ", "BIGINT",
                           "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
