"""Batch layout of the three zones: historical load and questions.

    <root>/landing_zone/landing_json     VARIANT documents (file-sink table)
    <root>/curated_zone/curated_city     distinct location rows (by id)
    <root>/curated_zone/curated_weather  typed fact + weather_id, partitioned by day

``copy_into_landing`` has COPY semantics: the file source's checkpoint lists
every file already loaded, so running it again loads only new files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrus.functions.scalars import CITY_ALLOW_LIST
from cirrus.operators import analytics, curate, questions_sql
from cirrus.operators.joins import copartition
from cirrus.operators.quality import surrogate_key
from cirrus.session import scratch_path
from cirrus.sources.landing import point_table, read_table, replace_table, zone_path
from cirrus.streaming import files, jobs
from cirrus.streaming.files import delete_older

# Order that numbers observations (unique up to fully identical rows).
WEATHER_ID_ORDER = ("dt", "city_id", "main", "temperature", "wind_speed", "rain_1h")


def paths(root: str) -> dict[str, str]:
    return {
        "landing": zone_path(root, "landing_zone", "landing_json"),
        "landing_checkpoint": f"{root.rstrip('/')}/_checkpoints/copy_into_landing",
        "curated_city": zone_path(root, "curated_zone", "curated_city"),
        "curated_weather": zone_path(root, "curated_zone", "curated_weather"),
    }


def copy_into_landing(spark: SparkSession, stage: str, root: str, one_document_per_file: bool = True) -> None:
    p = paths(root)
    jobs.ingest_json(spark, stage, p["landing"], p["landing_checkpoint"], one_document_per_file)


def with_weather_id(obs: DataFrame, start: int = 0, path: str | None = None) -> DataFrame:
    """AUTOINCREMENT surrogate key: dense ids after ``start`` in time order; ``path`` names its scratch table."""
    return surrogate_key(obs, WEATHER_ID_ORDER, key_col="weather_id", start=start, path=path)


def build_curated(spark: SparkSession, root: str, allow: Iterable[str] | None = CITY_ALLOW_LIST) -> None:
    """(Re)build both curated tables from the whole landing table; each is replaced in one step."""
    p = paths(root)
    raw = read_table(spark, p["landing"])
    replace_table(curate.curated_city(raw, allow=allow), p["curated_city"])
    scratch = scratch_path(spark, "weather_id")
    obs = curate.with_partition_date(with_weather_id(curate.curated_observation(raw, allow=allow), path=scratch))
    # Rebalanced by day: few files a day, and a hot day is split.
    replace_table(obs.hint("rebalance", "obs_date"), p["curated_weather"], partition_by=("obs_date",))
    delete_older(spark, scratch, 0)


def load_history(spark: SparkSession, stage: str, root: str, allow: Iterable[str] | None = CITY_ALLOW_LIST,
                 one_document_per_file: bool = True) -> None:
    copy_into_landing(spark, stage, root, one_document_per_file)
    build_curated(spark, root, allow)


def tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    p = paths(root)
    return read_table(spark, p["curated_weather"]), read_table(spark, p["curated_city"])


QUESTIONS = {
    "q1": lambda o, c, s, e: analytics.distinct_conditions(o, s, e),
    "q2": analytics.distinct_conditions_per_city,
    "q3": analytics.condition_rank,
    "q4": analytics.avg_temperature,
    "q5": analytics.hottest_city,
    "q6": analytics.daily_top_variation,
    "q7": analytics.max_variation,
    "q8": analytics.strongest_wind,
}


def ask(spark: SparkSession, root: str, question: str, start, end, sql: bool = False) -> DataFrame:
    """Answer one question over the curated tables for the closed period.
    The period also prunes the day partitions of the fact."""
    obs, city = tables(spark, root)
    obs = curate.filter_time_range(obs, start, end, date_col="obs_date")
    if sql:
        questions_sql.register_views(obs, city)
        return questions_sql.ask(spark, question, start, end)
    return QUESTIONS[question](obs, city, start, end)


def data_quality(spark: SparkSession, root: str) -> DataFrame:
    """Violation counts of the declared constraints of the curated tables."""
    from cirrus.operators import quality as D
    obs, city = tables(spark, root)
    checks = [
        ("curated_city.city_id not null", D.dq_not_null(city, ["city_id"])),
        ("curated_city.city_id unique", D.dq_unique(city, ["city_id"])),
        ("curated_weather.weather_id unique", D.dq_unique(obs, ["weather_id"])),
        ("curated_weather.city_id -> curated_city", D.dq_foreign_key(obs, city, "city_id", "city_id")),
    ]
    out = None
    for name, df in checks:
        row = df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def register_tables(spark: SparkSession, root: str) -> list[str]:
    """Expose the zones as schemas of the session catalog, the stored tables as external Parquet tables and the fact,
    whose days are folders, as a view (``curated_zone.curated_weather``). Only metadata is written; the data stays where
    it is. Registered again after a rebuild, each name moves to the new version in one catalog change."""
    p = paths(root)
    names = []
    for zone in ("landing_zone", "curated_zone"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {zone} LOCATION '{root.rstrip('/')}/{zone}'")
    for name, key in (("landing_zone.landing_json", "landing"), ("curated_zone.curated_city", "curated_city")):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_table(spark, p[key]).schema)
        point_table(spark, name, ddl, files.current(spark, p[key]))
        names.append(name)
    fact = "curated_zone.curated_weather"
    spark.sql(f"CREATE OR REPLACE VIEW {fact} AS SELECT * FROM parquet.`{files.current(spark, p['curated_weather'])}`")
    return [*names, fact]


def build_by_city(spark: SparkSession, root: str, buckets: int = 64) -> DataFrame:
    """``curated_zone.weather_by_city``: fact and dimension stored in equal buckets, for joins that shuffle nothing once the
    dimension is too large to broadcast. Built again, the view moves to the new pair in one catalog change."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS curated_zone LOCATION '{root.rstrip('/')}/curated_zone'")
    obs, city = tables(spark, root)
    return copartition(obs, city, "curated_zone.weather_by_city", zone_path(root, "curated_zone", "weather_by_city"),
                       buckets=buckets)
