"""Scalar column functions (all JVM-side, inside whole-stage codegen).

Each function maps Column -> Column and has no side effects, so the same
expression is reused by the batch curation, the streaming jobs and tests.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# They must stay exactly as given for identical results.
# ---------------------------------------------------------------------------
# Cities kept by the curation step (allow-list on the document's name).
CITY_ALLOW_LIST = ("Milan", "Bologna", "Cagliari")
# Every timezone other than this one is overwritten with it.
CANONICAL_TIMEZONE = 3600
# Offset in seconds -> label; any other offset has no label (NULL).
UTC_OFFSET_LABELS = {0: "UTC+00:00", 3600: "UTC+01:00", 7200: "UTC+02:00"}
# 8-point compass: North is [337.5, 360] or [0, 22.5); the other sectors are
# half-open [low, high) bins of 45 degrees.
NORTH = "North"
NORTH_LOW, NORTH_HIGH = 337.5, 22.5
COMPASS_SECTORS = (
    ("North-East", 22.5, 67.5),
    ("East", 67.5, 112.5),
    ("South-East", 112.5, 157.5),
    ("South", 157.5, 202.5),
    ("South-West", 202.5, 247.5),
    ("West", 247.5, 292.5),
    ("North-West", 292.5, 337.5),
)
# ---------------------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wind_direction(deg) -> Column:
    """Degrees -> compass label; NULL (or out-of-domain) -> NULL, no default."""
    d = _col(deg).cast("double")
    expr = F.when((d >= NORTH_LOW) | (d < NORTH_HIGH), F.lit(NORTH))
    for label, low, high in COMPASS_SECTORS:
        expr = expr.when((d >= low) & (d < high), F.lit(label))
    return expr


def timezone_override(tz) -> Column:
    """Any offset other than the canonical one becomes canonical; NULL stays NULL."""
    t = _col(tz)
    return F.when(t != CANONICAL_TIMEZONE, F.lit(CANONICAL_TIMEZONE)).otherwise(t)


def utc_offset_label(tz) -> Column:
    """Offset in seconds -> 'UTC+hh:mm' label for the known offsets, else NULL."""
    t = _col(tz)
    expr = None
    for seconds, label in UTC_OFFSET_LABELS.items():
        expr = (F.when if expr is None else expr.when)(t == seconds, F.lit(label))
    return expr


def round_coordinate(c, digits: int = 1) -> Column:
    """ROUND(x, 1), half-up on the decimal representation."""
    return F.round(_col(c).cast("double"), digits)


def epoch_to_timestamp(seconds) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ, independent of the session time zone."""
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(secs=_col(seconds).cast("long"))


def timestamp_to_epoch(ts) -> Column:
    """TIMESTAMP_NTZ -> whole epoch seconds (truncated), zone independent."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _col(ts))


def to_date(ts) -> Column:
    return F.to_date(_col(ts))
