"""Schema-on-read extraction from the VARIANT landing column.

``try_variant_get`` is the lenient form (missing path or uncastable value ->
NULL); ``variant_get`` the strict form (raises INVALID_VARIANT_CAST).
Quoted keys that start with a digit (``rain."1h"``) use the bracket path form.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (output column, JSON path, Spark type) of the curated location dimension.
CITY_FIELDS = (
    ("city_id", "$.id", "bigint"),
    ("name", "$.name", "string"),
    ("timezone", "$.timezone", "int"),
    ("country", "$.sys.country", "string"),
    ("latitude", "$.coord.lat", "double"),
    ("longitude", "$.coord.lon", "double"),
)

# (output column, JSON path, Spark type) of the observation fact, before the
# derived columns (wind_direction from wind.deg, dt from epoch seconds).
# weather[0] is the primary condition; further array entries are ignored.
OBSERVATION_FIELDS = (
    ("city_id", "$.id", "bigint"),
    ("main", "$.weather[0].main", "string"),
    ("description", "$.weather[0].description", "string"),
    ("temperature", "$.main.temp", "double"),
    ("feels_like", "$.main.feels_like", "double"),
    ("temp_min", "$.main.temp_min", "double"),
    ("temp_max", "$.main.temp_max", "double"),
    ("pressure", "$.main.pressure", "double"),
    ("humidity", "$.main.humidity", "double"),
    ("visibility", "$.visibility", "int"),
    ("wind_speed", "$.wind.speed", "double"),
    ("wind_deg", "$.wind.deg", "double"),
    ("cloudiness", "$.clouds.all", "double"),
    ("rain_1h", '$.rain["1h"]', "double"),
    ("rain_3h", '$.rain["3h"]', "double"),
    ("snow_1h", '$.snow["1h"]', "double"),
    ("snow_3h", '$.snow["3h"]', "double"),
    ("epoch", "$.dt", "bigint"),
)


def extract(variant, path: str, type_: str, strict: bool = False) -> Column:
    v = F.col(variant) if isinstance(variant, str) else variant
    fn = F.variant_get if strict else F.try_variant_get
    return fn(v, path, type_)


def extraction_report(landing, variant: str, fields) -> "DataFrame":  # noqa: F821
    """One row: unparsable documents, and per field the number of values that
    are present but were NULLed by lenient extraction (wrong type)."""
    v = F.col(variant)
    aggs = [F.count_if(v.isNull()).alias("unparsable_documents")]
    for name, path, t in fields:
        present = F.try_variant_get(v, path, "variant").isNotNull()
        aggs.append(F.count_if(present & F.try_variant_get(v, path, t).isNull()).alias(f"nulled_{name}"))
    return landing.agg(*aggs)
