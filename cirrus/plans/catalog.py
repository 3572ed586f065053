"""Registered queries: one per operator of the inventory, bound to the test
tables (see ``bindings``), each with the DuckDB SQL that must give the same
rows. Float results that depend on summation order are rounded to 6 digits
in both forms; everything else is compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrus.functions import paths, scalars
from cirrus.operators import analytics, curate, distinct, joins
from cirrus.plans import bindings as B
from cirrus.session import checkpoint_root, scratch_path
from cirrus.sources import landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---- shared SQL views of the oracle (same bindings as ``bindings``) ----------
_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
OBS = f"""obs AS (SELECT event_id, user_id AS city_id, event_type AS main, value AS temperature,
    ts AS dt, {_K} AS wind_speed, {_K} * 3.75 AS wind_deg FROM events)"""
CITY = """city AS (SELECT c_custkey AS city_id, n_name AS name, 3600 * (c_nationkey % 4) AS timezone,
    'R' || CAST(n_regionkey AS VARCHAR) AS country, c_acctbal AS latitude,
    CAST(c_nationkey AS DOUBLE) AS longitude FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
DOCS = """docs AS (SELECT o.event_id, o.city_id, c.name, c.timezone, c.country, c.latitude, c.longitude,
    o.main, upper(o.main) AS description, o.temperature, o.wind_speed, o.wind_deg,
    CAST(o.wind_speed AS INTEGER) AS clouds_all,
    CASE WHEN o.event_id % 10 = 0 THEN o.temperature END AS rain_1h,
    CAST(epoch(date_trunc('second', o.dt)) AS BIGINT) AS epoch,
    date_trunc('second', o.dt) AS dt FROM obs o JOIN city c ON o.city_id = c.city_id)"""
PERIOD = "dt >= TIMESTAMP '2024-01-08 00:00:00' AND dt <= TIMESTAMP '2024-01-15 00:00:00'"
ALLOW_SQL = ", ".join(f"'{n}'" for n in B.BOUND_ALLOW_LIST)


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body


def _obs(spark, sf):
    return B.observations(spark, sf)


def _city(spark, sf):
    return B.cities(spark, sf)


_LANDINGS: dict = {}


def _parsed_docs(spark, sf) -> DataFrame:
    """The landing table of the bound documents: parsed into VARIANT once per
    session and data folder, stored below the checkpoint folder, then read
    like any landing table (as the historical load does: load once, curate
    many times)."""
    key = (checkpoint_root(spark), sf, B.input_state(spark, sf))
    if key not in _LANDINGS:
        path = scratch_path(spark, "landing_zone", "landing_json")
        landing.write_table(
            B.documents(spark, sf).select("event_id", F.parse_json("value").alias(landing.LANDING_COLUMN)), path)
        _LANDINGS[key] = path
    return landing.read_table(spark, _LANDINGS[key])


# The sector's number counts 45-degree steps from north, half a step early.
WIND_CASE = ("['North', 'North-East', 'East', 'South-East', 'South', 'South-West', 'West', 'North-West']"
             "[CAST(floor((wind_deg + 22.5) / 45) AS INTEGER) % 8 + 1]")

# ============================================================================
# Sources and sinks
# ============================================================================


@register("json_landing_load", with_views(
    "SELECT city_id, name, main, temperature, dt FROM docs", OBS, CITY, DOCS))
def q_json_landing_load(spark, sf):
    folder = scratch_path(spark, "landing", "json_folder")
    B.documents(spark, sf).select("value").write.mode("overwrite").text(folder)
    raw = landing.read_json_documents(spark, folder, one_document_per_file=False)
    v = landing.LANDING_COLUMN
    return raw.select(paths.extract(v, "$.id", "bigint").alias("city_id"),
                      paths.extract(v, "$.name", "string").alias("name"),
                      paths.extract(v, "$.weather[0].main", "string").alias("main"),
                      paths.extract(v, "$.main.temp", "double").alias("temperature"),
                      scalars.epoch_to_timestamp(paths.extract(v, "$.dt", "bigint")).alias("dt"))


@register("variant_table_roundtrip", with_views(
    "SELECT event_id, city_id, name, temperature, rain_1h FROM docs", OBS, CITY, DOCS))
def q_variant_table_roundtrip(spark, sf):
    path = scratch_path(spark, "landing", "variant_table")
    landing.write_table(_parsed_docs(spark, sf), path)
    back = landing.read_table(spark, path)
    v = landing.LANDING_COLUMN
    return back.select("event_id",
                       paths.extract(v, "$.id", "bigint").alias("city_id"),
                       paths.extract(v, "$.name", "string").alias("name"),
                       paths.extract(v, "$.main.temp", "double").alias("temperature"),
                       paths.extract(v, '$.rain["1h"]', "double").alias("rain_1h"))


@register("table_scan_period", with_views(
    f"SELECT city_id, main, temperature, date_trunc('second', dt) AS dt FROM obs WHERE {PERIOD}", OBS))
def q_table_scan_period(spark, sf):
    """Curated fact written partitioned by day, then scanned with the period:
    the date predicate prunes partitions, the timestamp one is pushed down."""
    path = scratch_path(spark, "curated_zone", "curated_weather")
    obs = curate.with_partition_date(curate.curated_observation(_parsed_docs(spark, sf), allow=None))
    landing.write_table(obs, path, partition_by=("obs_date",))
    scanned = curate.filter_time_range(landing.read_table(spark, path), B.PERIOD_START, B.PERIOD_END,
                                       date_col="obs_date")
    return scanned.select("city_id", "main", "temperature", "dt")


@register("insert_select", with_views(
    "SELECT city_id, main, temperature, date_trunc('second', dt) AS dt FROM obs", OBS))
def q_insert_select(spark, sf):
    """CREATE OR REPLACE typed table, then two INSERT ... SELECT appends."""
    from cirrus.schemas import CURATED_WEATHER
    path = scratch_path(spark, "curated_zone", "insert_select")
    landing.create_table(spark, path, CURATED_WEATHER)
    obs = curate.curated_observation(_parsed_docs(spark, sf), allow=None, keep=("event_id",))
    split = F.col("dt") < F.lit(B.SPLIT_TS).cast("timestamp_ntz")
    cols = [f.name for f in CURATED_WEATHER.fields]
    landing.insert_select(obs.where(split), path, cols)
    landing.insert_select(obs.where(~split), path, cols)
    return landing.read_table(spark, path).select("city_id", "main", "temperature", "dt")


# ============================================================================
# Projections and scalar functions
# ============================================================================


@register("json_path_extract", with_views(
    "SELECT event_id, city_id, name, timezone, country, latitude, longitude, temperature, wind_speed "
    "FROM docs", OBS, CITY, DOCS))
def q_json_path_extract(spark, sf):
    v = landing.LANDING_COLUMN
    f = {n: paths.extract(v, p, t) for n, p, t in paths.CITY_FIELDS}
    return _parsed_docs(spark, sf).select(
        "event_id", *[f[n].alias(n) for n in ("city_id", "name", "timezone", "country", "latitude", "longitude")],
        paths.extract(v, "$.main.temp", "double").alias("temperature"),
        paths.extract(v, "$.wind.speed", "double").alias("wind_speed"))


@register("json_array_first", with_views(
    "SELECT event_id, main, description FROM docs", OBS, CITY, DOCS))
def q_json_array_first(spark, sf):
    v = landing.LANDING_COLUMN
    return _parsed_docs(spark, sf).select(
        "event_id", paths.extract(v, "$.weather[0].main", "string").alias("main"),
        paths.extract(v, "$.weather[0].description", "string").alias("description"))


@register("json_optional_key", with_views(
    "SELECT event_id, rain_1h, CAST(NULL AS DOUBLE) AS rain_3h, CAST(NULL AS DOUBLE) AS snow_1h, "
    "CAST(NULL AS DOUBLE) AS snow_3h FROM docs", OBS, CITY, DOCS))
def q_json_optional_key(spark, sf):
    v = landing.LANDING_COLUMN
    return _parsed_docs(spark, sf).select(
        "event_id", *[paths.extract(v, p, "double").alias(n)
                      for n, p in (("rain_1h", '$.rain["1h"]'), ("rain_3h", '$.rain["3h"]'),
                                   ("snow_1h", '$.snow["1h"]'), ("snow_3h", '$.snow["3h"]'))])


@register("typed_casts", with_views(
    "SELECT event_id, CAST(city_id AS VARCHAR) AS id_text, CAST(city_id AS INTEGER) AS id_int, "
    "CAST(timezone AS DOUBLE) AS timezone_double, CAST(clouds_all AS BIGINT) AS clouds_bigint, "
    "temperature AS temp_double, CAST(NULL AS VARCHAR) AS missing_as_null FROM docs", OBS, CITY, DOCS))
def q_typed_casts(spark, sf):
    v = landing.LANDING_COLUMN
    return _parsed_docs(spark, sf).select(
        "event_id",
        paths.extract(v, "$.id", "string").alias("id_text"),
        paths.extract(v, "$.id", "int").alias("id_int"),
        paths.extract(v, "$.timezone", "double").alias("timezone_double"),
        paths.extract(v, "$.clouds.all", "bigint").alias("clouds_bigint"),
        paths.extract(v, "$.main.temp", "double").alias("temp_double"),
        paths.extract(v, "$.wind.gust", "string").alias("missing_as_null"))


@register("wind_direction", with_views(
    f"SELECT {WIND_CASE} AS wind_direction, count(*) AS n FROM obs GROUP BY 1", OBS))
def q_wind_direction(spark, sf):
    return (_obs(spark, sf).groupBy(scalars.wind_direction("wind_deg").alias("wind_direction"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("timezone_override", with_views(
    "SELECT city_id, timezone, CASE WHEN timezone <> 3600 THEN 3600 ELSE timezone END AS timezone_fixed "
    "FROM city", CITY))
def q_timezone_override(spark, sf):
    return _city(spark, sf).select("city_id", "timezone",
                                    scalars.timezone_override("timezone").alias("timezone_fixed"))


@register("utc_offset_label", with_views(
    "SELECT city_id, timezone, CASE WHEN timezone = 0 THEN 'UTC+00:00' WHEN timezone = 3600 THEN 'UTC+01:00' "
    "WHEN timezone = 7200 THEN 'UTC+02:00' END AS timezone_label FROM city", CITY))
def q_utc_offset_label(spark, sf):
    return _city(spark, sf).select("city_id", "timezone",
                                    scalars.utc_offset_label("timezone").alias("timezone_label"))


@register("round_coords", with_views(
    "SELECT city_id, round(latitude, 1) AS latitude, round(longitude, 1) AS longitude FROM city", CITY))
def q_round_coords(spark, sf):
    return _city(spark, sf).select("city_id", scalars.round_coordinate("latitude").alias("latitude"),
                                    scalars.round_coordinate("longitude").alias("longitude"))


@register("epoch_to_timestamp", with_views("SELECT event_id, epoch, dt FROM docs", OBS, CITY, DOCS))
def q_epoch_to_timestamp(spark, sf):
    e = paths.extract(landing.LANDING_COLUMN, "$.dt", "bigint")
    return _parsed_docs(spark, sf).select("event_id", e.alias("epoch"),
                                          scalars.epoch_to_timestamp(e).alias("dt"))


@register("ts_to_date", with_views("SELECT event_id, CAST(dt AS DATE) AS date FROM obs", OBS))
def q_ts_to_date(spark, sf):
    return _obs(spark, sf).select("event_id", scalars.to_date("dt").alias("date"))


@register("array_contains", with_views(
    "SELECT city_id, list_contains(list(DISTINCT main), 'purchase') AS has_purchase, "
    "list_contains(list(DISTINCT main), 'refund') AS has_refund FROM obs GROUP BY city_id", OBS))
def q_array_contains(spark, sf):
    s = _obs(spark, sf).groupBy("city_id").agg(F.collect_set("main").alias("s"))
    return s.select("city_id", F.array_contains("s", "purchase").alias("has_purchase"),
                    F.array_contains("s", "refund").alias("has_refund"))


@register("array_append", with_views(
    f"""SELECT city_id, CASE WHEN latest IS NULL OR list_contains(before, latest) THEN before
            ELSE list_append(before, latest) END AS conditions
        FROM (SELECT city_id,
                 list_sort(list_distinct(list(main) FILTER (WHERE dt < TIMESTAMP '{B.SPLIT_TS}'))) AS before,
                 arg_max(main, (dt, event_id)) FILTER (WHERE dt >= TIMESTAMP '{B.SPLIT_TS}') AS latest
              FROM obs GROUP BY city_id) s""", OBS))
def q_array_append(spark, sf):
    """Set state before T0, then the latest later condition appended if unseen."""
    obs = _obs(spark, sf)
    t0 = F.lit(B.SPLIT_TS).cast("timestamp_ntz")
    s = obs.groupBy("city_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("dt") < t0, F.col("main")))).alias("before"),
        F.max_by(F.when(F.col("dt") >= t0, F.col("main")),
                 F.when(F.col("dt") >= t0, F.struct("dt", "event_id"))).alias("latest"))
    return s.select("city_id", F.when(F.col("latest").isNull() | F.array_contains("before", F.col("latest")),
                                      F.col("before"))
                    .otherwise(F.array_append("before", F.col("latest"))).alias("conditions"))


# ============================================================================
# Filters, joins
# ============================================================================


@register("filter_allow_list", with_views(
    "SELECT event_id, main FROM obs WHERE main IN ('view', 'click', 'purchase')", OBS))
def q_filter_allow_list(spark, sf):
    return curate.filter_allow_list(_obs(spark, sf), "main", ("view", "click", "purchase")).select("event_id", "main")


@register("filter_time_range", with_views(f"SELECT event_id, dt FROM obs WHERE {PERIOD}", OBS))
def q_filter_time_range(spark, sf):
    return curate.filter_time_range(_obs(spark, sf), B.PERIOD_START, B.PERIOD_END).select("event_id", "dt")


@register("join_dimension", with_views(
    "SELECT o.event_id, o.city_id, c.name FROM obs o JOIN city c ON o.city_id = c.city_id", OBS, CITY))
def q_join_dimension(spark, sf):
    return joins.join_dimension(_obs(spark, sf), _city(spark, sf), "city_id").select("event_id", "city_id", "name")


@register("join_copartitioned", with_views(
    "SELECT o.event_id, o.city_id, c.name FROM obs o JOIN city c ON o.city_id = c.city_id", OBS, CITY))
def q_join_copartitioned(spark, sf):
    """The same join between stored tables bucketed alike: no shuffle when it is asked."""
    path = scratch_path(spark, "curated_zone", "by_city")
    name = "by_city_" + path.rsplit("/", 1)[1]
    return joins.copartition(_obs(spark, sf), _city(spark, sf), name, path, buckets=16).select("event_id", "city_id", "name")


@register("scalar_lookup", with_views(
    "SELECT o.event_id, o.city_id, (SELECT c.name FROM city c WHERE c.city_id = o.city_id) AS city FROM obs o",
    OBS, CITY))
def q_scalar_lookup(spark, sf):
    return joins.scalar_lookup(_obs(spark, sf).select("event_id", "city_id"), _city(spark, sf),
                               "city_id", "name", "city")


# ============================================================================
# Aggregations, windows, top-k, whole questions
# ============================================================================


@register("distinct_dimension", with_views(
    "SELECT DISTINCT name, CASE WHEN timezone <> 3600 THEN 3600 ELSE timezone END AS timezone, country "
    "FROM docs", OBS, CITY, DOCS))
def q_distinct_dimension(spark, sf):
    v = landing.LANDING_COLUMN
    return _parsed_docs(spark, sf).select(
        paths.extract(v, "$.name", "string").alias("name"),
        scalars.timezone_override(paths.extract(v, "$.timezone", "int")).alias("timezone"),
        paths.extract(v, "$.sys.country", "string").alias("country")).distinct()


@register("q1_distinct_conditions", with_views(
    f"SELECT count(DISTINCT main) AS distinct_conditions_count, "
    f"list_sort(list_distinct(list(main))) AS distinct_conditions FROM obs WHERE {PERIOD}", OBS))
def q_q1(spark, sf):
    return analytics.distinct_conditions(_obs(spark, sf), B.PERIOD_START, B.PERIOD_END)


_JOINED = f"SELECT c.name AS city, o.* FROM obs o JOIN city c ON o.city_id = c.city_id WHERE {PERIOD}"


@register("q2_distinct_conditions_per_city", with_views(
    "SELECT city, count(DISTINCT main) AS distinct_conditions_count, "
    "list_sort(list_distinct(list(main))) AS distinct_conditions FROM j GROUP BY city",
    OBS, CITY, f"j AS ({_JOINED})"))
def q_q2(spark, sf):
    return analytics.distinct_conditions_per_city(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)


@register("condition_frequency", with_views(
    "SELECT c.name AS city, o.main AS weather_condition, count(*) AS frequency "
    "FROM obs o JOIN city c ON o.city_id = c.city_id GROUP BY 1, 2", OBS, CITY))
def q_condition_frequency(spark, sf):
    return analytics.condition_frequency(_obs(spark, sf), _city(spark, sf))


@register("q3_condition_rank", with_views(
    "SELECT city, weather_condition, frequency, "
    "CAST(rank() OVER (PARTITION BY city ORDER BY frequency DESC) AS BIGINT) AS weather_rank "
    "FROM (SELECT city, main AS weather_condition, count(*) AS frequency FROM j GROUP BY 1, 2) r",
    OBS, CITY, f"j AS ({_JOINED})"))
def q_q3(spark, sf):
    return analytics.condition_rank(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)


@register("q4_avg_temperature", with_views(
    "SELECT city, round(avg(temperature), 6) AS avg_temperature FROM j GROUP BY city",
    OBS, CITY, f"j AS ({_JOINED})"))
def q_q4(spark, sf):
    r = analytics.avg_temperature(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)
    return r.select("city", F.round("avg_temperature", 6).alias("avg_temperature"))


@register("max_by_key", with_views(
    "SELECT c.name AS city, max(o.temperature) AS max_temperature, max(o.wind_speed) AS max_wind_speed "
    "FROM obs o JOIN city c ON o.city_id = c.city_id GROUP BY 1", OBS, CITY))
def q_max_by_key(spark, sf):
    obs, city = _obs(spark, sf), _city(spark, sf)
    return analytics.maxima_per_city(obs, city, {"temperature": "max_temperature", "wind_speed": "max_wind_speed"})


@register("q5_hottest_city", with_views(
    "SELECT city, max(temperature) AS max_abs_temperature FROM j GROUP BY city "
    "ORDER BY max_abs_temperature DESC NULLS LAST, city LIMIT 1", OBS, CITY, f"j AS ({_JOINED})"))
def q_q5(spark, sf):
    return analytics.hottest_city(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)


_DAILY = "SELECT city, CAST(dt AS DATE) AS date, max(temperature) - min(temperature) AS temperature_variation " \
         "FROM j GROUP BY 1, 2"


@register("daily_variation", with_views(
    "SELECT c.name AS city, CAST(o.dt AS DATE) AS date, max(o.temperature) - min(o.temperature) "
    "AS temperature_variation FROM obs o JOIN city c ON o.city_id = c.city_id GROUP BY 1, 2", OBS, CITY))
def q_daily_variation(spark, sf):
    return analytics.daily_variation(_obs(spark, sf), _city(spark, sf))


@register("q6_daily_top_variation", with_views(
    "SELECT date, city, temperature_variation FROM (SELECT *, row_number() OVER (PARTITION BY date "
    "ORDER BY temperature_variation DESC NULLS LAST, city) AS rn FROM d) x WHERE rn = 1",
    OBS, CITY, f"j AS ({_JOINED})", f"d AS ({_DAILY})"))
def q_q6(spark, sf):
    return analytics.daily_top_variation(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)


@register("q7_max_variation", with_views(
    "SELECT city, date, temperature_variation FROM d "
    "ORDER BY temperature_variation DESC NULLS LAST, city, date LIMIT 1",
    OBS, CITY, f"j AS ({_JOINED})", f"d AS ({_DAILY})"))
def q_q7(spark, sf):
    return analytics.max_variation(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)


@register("q8_strongest_wind", with_views(
    "SELECT city, max(wind_speed) AS max_wind_speed FROM j GROUP BY 1 "
    "ORDER BY max_wind_speed DESC NULLS LAST, city LIMIT 1", OBS, CITY, f"j AS ({_JOINED})"))
def q_q8(spark, sf):
    return analytics.strongest_wind(_obs(spark, sf), _city(spark, sf), B.PERIOD_START, B.PERIOD_END)


@register("limit_preview", with_views(
    "SELECT event_id, city_id, main, dt FROM obs ORDER BY dt, event_id LIMIT 10", OBS))
def q_limit_preview(spark, sf):
    return _obs(spark, sf).orderBy("dt", "event_id").limit(10).select("event_id", "city_id", "main", "dt")


# ============================================================================
# Whole transforms (curation)
# ============================================================================


@register("curated_city", with_views(
    f"SELECT DISTINCT city_id, name, CASE WHEN timezone <> 3600 THEN 3600 ELSE timezone END AS timezone, "
    f"country, round(latitude, 1) AS latitude, round(longitude, 1) AS longitude FROM docs "
    f"WHERE name IN ({ALLOW_SQL})", OBS, CITY, DOCS))
def q_curated_city(spark, sf):
    return curate.curated_city(_parsed_docs(spark, sf), allow=B.BOUND_ALLOW_LIST)


_CURATED_OBS_SQL = f"""SELECT city_id, main, description, temperature, CAST(NULL AS DOUBLE) AS feels_like,
    CAST(NULL AS DOUBLE) AS temp_min, CAST(NULL AS DOUBLE) AS temp_max, CAST(NULL AS DOUBLE) AS pressure,
    CAST(NULL AS DOUBLE) AS humidity, CAST(NULL AS INTEGER) AS visibility, wind_speed,
    {WIND_CASE} AS wind_direction, clouds_all AS cloudiness, rain_1h, CAST(NULL AS DOUBLE) AS rain_3h,
    CAST(NULL AS DOUBLE) AS snow_1h, CAST(NULL AS DOUBLE) AS snow_3h, dt FROM docs"""


@register("curated_observation", with_views(
    f"{_CURATED_OBS_SQL} WHERE name IN ({ALLOW_SQL})", OBS, CITY, DOCS))
def q_curated_observation(spark, sf):
    return curate.curated_observation(_parsed_docs(spark, sf), allow=B.BOUND_ALLOW_LIST)


# ============================================================================
# Incremental answer tables: state from rows before T0, merged with the rest
# ============================================================================
from cirrus.operators import incremental as H, quality as D  # noqa: E402

T0 = f"TIMESTAMP '{B.SPLIT_TS} 00:00:00'"


def _split(df: DataFrame):
    t0 = F.lit(B.SPLIT_TS).cast("timestamp_ntz")
    return df.where(F.col("dt") < t0), df.where(F.col("dt") >= t0)


def _two_step(spark, merge, schema, changes: DataFrame, **kw) -> DataFrame:
    """Existing target = merge of the early rows into an empty state; then the
    later rows are merged as one more batch."""
    early, late = _split(changes)
    state = merge(H.empty_state(spark, schema), early, **kw)
    return merge(state, late, **kw)


@register("merge_condition_frequency", with_views(
    "SELECT f.city_id, c.name AS city, f.weather_condition, f.frequency FROM (SELECT city_id, "
    "main AS weather_condition, count(*) AS frequency FROM obs GROUP BY 1, 2) f "
    "LEFT JOIN city c ON f.city_id = c.city_id", OBS, CITY))
def q_merge_condition_frequency(spark, sf):
    state = _two_step(spark, H.merge_condition_frequency, H.FREQUENCY_STATE, _obs(spark, sf))
    return joins.scalar_lookup(state, _city(spark, sf), "city_id", "name", "city")


@register("merge_distinct_conditions", with_views(
    "SELECT c.name, list_sort(list_distinct(list(o.main))) AS distinct_conditions, "
    "count(DISTINCT o.main) AS distinct_conditions_count FROM obs o JOIN city c "
    "ON o.city_id = c.city_id GROUP BY c.name", OBS, CITY))
def q_merge_distinct_conditions(spark, sf):
    # The members of the set first, then the names: the join sees a row for each city, condition and side only.
    t0 = F.lit(B.SPLIT_TS).cast("timestamp_ntz")
    members = _obs(spark, sf).select("city_id", "main", F.when(F.col("dt") < t0, t0 - F.expr("INTERVAL 1 DAY")).otherwise(
        t0).alias("dt")).distinct()
    named = members.join(_city(spark, sf).select("city_id", "name"), "city_id")
    return _two_step(spark, H.merge_distinct_conditions, H.distinct_conditions_state(("name",)), named, keys=("name",))


@register("merge_distinct_conditions_global", with_views(
    "SELECT list_sort(list_distinct(list(main))) AS distinct_conditions, "
    "count(DISTINCT main) AS distinct_conditions_count FROM obs", OBS))
def q_merge_distinct_conditions_global(spark, sf):
    return _two_step(spark, H.merge_distinct_conditions, H.distinct_conditions_state(), _obs(spark, sf))


@register("merge_distinct_bitmaps", with_views(
    "SELECT c.name, count(DISTINCT o.main) AS distinct_conditions_count FROM obs o JOIN city c "
    "ON o.city_id = c.city_id GROUP BY c.name HAVING count(o.main) > 0", OBS, CITY))
def q_merge_distinct_bitmaps(spark, sf):
    """Conditions of each city by id, rolled up by name; the later rows meet a dictionary and a state of the earlier."""
    early, late = _split(_obs(spark, sf))
    dictionary = distinct.extend_dictionary(None, early, "main")
    state = distinct.partial_bitmaps(early, dictionary, "main", ["city_id"])
    dictionary = distinct.extend_dictionary(dictionary, late, "main")
    state = distinct.merge_bitmaps(state, late, dictionary, "main", ["city_id"])
    named = state.join(_city(spark, sf).select("city_id", "name"), "city_id")
    return distinct.count_bitmaps(distinct.combine_bitmaps(named, ["name"]), ["name"], "distinct_conditions_count")


@register("distinct_bitmaps_rollup", with_views(
    f"SELECT main, count(DISTINCT city_id) AS n_cities FROM obs WHERE {PERIOD} GROUP BY main", OBS))
def q_distinct_bitmaps_rollup(spark, sf):
    """Cities that report each condition: one state by day, rolled up to the period."""
    obs = curate.filter_time_range(_obs(spark, sf), B.PERIOD_START, B.PERIOD_END).withColumn("date", F.to_date("dt"))
    dictionary = distinct.extend_dictionary(None, obs, "city_id")
    daily = distinct.partial_bitmaps(obs, dictionary, "city_id", ["main", "date"])
    return distinct.count_bitmaps(distinct.combine_bitmaps(daily, ["main"]), ["main"], "n_cities")


@register("anti_join_new_conditions", with_views(
    f"SELECT event_id, main || '-' || city_id AS main FROM obs WHERE dt >= {T0} AND main || '-' || city_id NOT IN "
    f"(SELECT main || '-' || city_id FROM obs WHERE dt < {T0} AND main IS NOT NULL AND city_id IS NOT NULL)", OBS))
def q_anti_join_new_conditions(spark, sf):
    """Conditions told apart by city: the later rows hold some that the whole early state does not."""
    own = _obs(spark, sf).withColumn("main", F.concat_ws("-", "main", F.col("city_id").cast("string")))
    early, late = _split(own)
    state = H.merge_distinct_conditions(H.empty_state(spark, H.distinct_conditions_state()), early)
    return H.anti_join_new_conditions(state, late).select("event_id", "main")


@register("merge_avg_exact", with_views(
    "SELECT city_id, round(avg(temperature), 6) AS avg_temperature FROM obs GROUP BY city_id", OBS))
def q_merge_avg_exact(spark, sf):
    state = _two_step(spark, H.merge_avg_exact, H.AVG_STATE, _obs(spark, sf))
    return H.present_avg(state).select("city_id", F.round("avg_temperature", 6).alias("avg_temperature"))


HALVING_SQL = """SELECT city_id, round(sum(temperature * power(0.5, n - rn + CASE WHEN rn = 1 THEN 0 ELSE 1 END)), 6)
    AS avg_temperature FROM (SELECT city_id, temperature,
        row_number() OVER (PARTITION BY city_id ORDER BY dt, event_id) AS rn,
        count(*) OVER (PARTITION BY city_id) AS n FROM obs WHERE temperature IS NOT NULL) x GROUP BY city_id"""


@register("merge_avg_halving", with_views(HALVING_SQL, OBS))
def q_merge_avg_halving(spark, sf):
    state = _two_step(spark, H.merge_avg_halving, H.HALVING_STATE, _obs(spark, sf))
    return state.select("city_id", F.round("avg_temperature", 6).alias("avg_temperature"))


@register("merge_running_max", with_views(
    "SELECT city_id, max(temperature) AS max_abs_temperature FROM obs GROUP BY city_id", OBS))
def q_merge_running_max(spark, sf):
    return _two_step(spark, H.merge_running_max, H.max_state("max_abs_temperature"), _obs(spark, sf))


@register("merge_strongest_wind", with_views(
    "SELECT city_id, max(wind_speed) AS max_wind_speed FROM obs GROUP BY city_id", OBS))
def q_merge_strongest_wind(spark, sf):
    return _two_step(spark, H.merge_running_max, H.max_state("max_wind_speed"), _obs(spark, sf),
                     value="wind_speed", alias="max_wind_speed")


@register("theta_update", with_views(
    f"SELECT t.main, CASE WHEN c.m > t.max_value THEN c.m ELSE t.max_value END AS max_value FROM "
    f"(SELECT main, max(temperature) AS max_value FROM obs WHERE dt < {T0} GROUP BY main) t LEFT JOIN "
    f"(SELECT main, max(temperature) AS m FROM obs WHERE dt >= {T0} GROUP BY main) c ON t.main = c.main", OBS))
def q_theta_update(spark, sf):
    early, late = _split(_obs(spark, sf))
    target = early.groupBy("main").agg(F.max("temperature").alias("max_value"))
    return H.theta_update(target, late, "main", "max_value", "temperature")


@register("merge_daily_variation", with_views(
    "SELECT city_id, date, temperature_variation FROM (SELECT *, row_number() OVER (PARTITION BY city_id "
    "ORDER BY temperature_variation DESC NULLS LAST, date) AS rn FROM (SELECT city_id, CAST(dt AS DATE) AS date, "
    "max(temperature) - min(temperature) AS temperature_variation FROM obs GROUP BY 1, 2) d) x WHERE rn = 1", OBS))
def q_merge_daily_variation(spark, sf):
    return H.present_daily_variation(_two_step(spark, H.merge_daily_extremes, H.DAILY_STATE, _obs(spark, sf)))


# City change rows: one per observation, as the curated dimension sees them.
_CITY_ROWS = """r AS (SELECT o.event_id, o.dt, o.city_id, c.name, {tz} AS timezone, c.country,
    round(c.latitude, 1) AS latitude, round(c.longitude, 1) AS longitude
    FROM obs o JOIN city c ON o.city_id = c.city_id)"""
_TZ_FIXED = "CASE WHEN c.timezone <> 3600 THEN 3600 ELSE c.timezone END"
_TZ_LABEL = ("CASE WHEN c.timezone = 0 THEN 'UTC+00:00' WHEN c.timezone = 3600 THEN 'UTC+01:00' "
             "WHEN c.timezone = 7200 THEN 'UTC+02:00' END")


def _upsert_sql(where: str = "") -> str:
    return (f"SELECT name, arg_max(city_id, (dt, event_id)) AS city_id, "
            f"arg_max(timezone, (dt, event_id)) AS last_tz, arg_min(timezone, (dt, event_id)) AS timezone, "
            f"arg_min(country, (dt, event_id)) AS country, arg_min(latitude, (dt, event_id)) AS latitude, "
            f"arg_min(longitude, (dt, event_id)) AS longitude FROM r {where} GROUP BY name")


def _city_rows(spark, sf, label: bool = False) -> DataFrame:
    # The earliest and latest observation of an id in each of the two batches is all that the rules read.
    c = _city(spark, sf)
    tz = F.col("timezone") if label else scalars.timezone_override("timezone")
    batch = (F.col("dt") >= F.lit(B.SPLIT_TS).cast("timestamp_ntz")).alias("late")
    return (H.first_and_last_rows(_obs(spark, sf).select("event_id", "dt", "city_id", batch), ("city_id", "late"))
            .select("event_id", "dt", "city_id")
            .join(c.select("city_id", "name", tz.alias("timezone"), "country",
                           scalars.round_coordinate("latitude").alias("latitude"),
                           scalars.round_coordinate("longitude").alias("longitude")), "city_id"))


@register("merge_city", with_views(
    f"SELECT city_id, name, timezone, country, latitude, longitude FROM ({_upsert_sql()}) u",
    OBS, CITY, _CITY_ROWS.format(tz=_TZ_FIXED)))
def q_merge_city(spark, sf):
    return _two_step(spark, H.merge_city, H.CITY_STATE, _city_rows(spark, sf))


@register("merge_consumption_city", with_views(
    f"SELECT city_id, name, last_tz AS timezone, country, latitude, longitude FROM ({_upsert_sql()}) u",
    OBS, CITY, _CITY_ROWS.format(tz=_TZ_LABEL)))
def q_merge_consumption_city(spark, sf):
    return _two_step(spark, H.merge_consumption_city, H.CONSUMPTION_CITY_STATE, _city_rows(spark, sf, label=True))


@register("cdc_snapshot_diff", with_views(
    f"""SELECT CASE WHEN b.name IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS op, a.name, a.city_id,
        a.timezone, a.country, a.latitude, a.longitude
        FROM ({_upsert_sql(f'WHERE dt < {T0}')}) b FULL OUTER JOIN ({_upsert_sql()}) a ON b.name = a.name
        WHERE b.name IS NULL OR b.city_id IS DISTINCT FROM a.city_id OR b.timezone IS DISTINCT FROM a.timezone
           OR b.country IS DISTINCT FROM a.country OR b.latitude IS DISTINCT FROM a.latitude
           OR b.longitude IS DISTINCT FROM a.longitude""",
    OBS, CITY, _CITY_ROWS.format(tz=_TZ_FIXED)))
def q_cdc_snapshot_diff(spark, sf):
    early, late = _split(_city_rows(spark, sf))
    before = H.merge_city(H.empty_state(spark, H.CITY_STATE), early)
    after = H.merge_city(before, late)
    return H.snapshot_diff(before, after, "name").select(
        "op", "name", "city_id", "timezone", "country", "latitude", "longitude")


# ============================================================================
# Declared constraints as data-quality checks
# ============================================================================


@register("dq_not_null", """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l
    ON d.doc_id = l.doc_id WHERE l.quality IS NULL""")
def q_dq_not_null(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id")
    labels = B.table(spark, sf, "labels").select("doc_id", "quality")
    return D.dq_not_null(docs.join(labels, "doc_id", "left"), ["quality"])


@register("dq_unique", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dq_unique(spark, sf):
    return D.dq_unique(B.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_foreign_key", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL
    AND o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def q_dq_foreign_key(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return D.dq_foreign_key(orders, B.table(spark, sf, "events"), "o_custkey", "user_id")


@register("dq_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 11")
def q_dq_length(spark, sf):
    return D.dq_length(B.table(spark, sf, "part").select("p_partkey", "p_name"), {"p_name": 11})


@register("limits_on_write", """SELECT p_partkey, p_name, violation FROM (
    SELECT p_partkey, p_name, CASE WHEN length(p_name) > 11 THEN 'p_name longer than 11' END AS violation FROM part UNION ALL
    SELECT p_partkey, p_name, CASE WHEN p_name IS NULL THEN 'p_name is null' END FROM part) v WHERE violation IS NOT NULL""")
def q_limits_on_write(spark, sf):
    """The parts written with their limits enforced: the rows kept apart, one for each limit that they break."""
    path = scratch_path(spark, "limits_on_write")
    part = B.table(spark, sf, "part").select("p_partkey", "p_name")
    landing.replace_checked(part, path, not_null=["p_name"], lengths={"p_name": 11})
    return landing.rejected_rows(spark, path, "p_partkey bigint, p_name string").select(
        "p_partkey", "p_name", F.explode("violations").alias("violation"))


@register("surrogate_key", """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey)
    AS surrogate_id FROM orders""")
def q_surrogate_key(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return D.surrogate_key(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "surrogate_id")


# ============================================================================
# Streaming: the whole flow fed with 5 time slices of the documents
# ============================================================================
from cirrus.streaming import jobs as S  # noqa: E402
from cirrus.streaming.flow import ObservationFlow  # noqa: E402

SLICES = 5
_FLOWS: dict = {}


def feed_in_slices(spark, docs: DataFrame, flow: ObservationFlow, pieces: int = SLICES) -> None:
    """Write the documents into the flow's incoming folder one time slice at a
    time (oldest first) and drain every layer after each slice. The documents
    are built once, stored partitioned by slice, and each arrival reads only
    its own partition."""
    lo, hi = docs.agg(F.min("dt"), F.max("dt")).first()
    step = (hi - lo) / pieces
    # slice = number of inner bounds at or below dt: first slice open below,
    # last open above, so every document lands exactly once
    slice_no = sum((F.col("dt") >= F.lit(str(lo + step * i)).cast("timestamp_ntz")).cast("int")
                   for i in range(1, pieces))
    staged = scratch_path(spark, "feed")
    docs.select("value", slice_no.alias("slice")).write.partitionBy("slice").parquet(staged)

    def arrival(i: int):
        return lambda: (spark.read.schema("value string, slice int").parquet(staged).where(F.col("slice") == i).select("value")
                        .write.mode("append").text(flow.source_dir))

    flow.run_each([arrival(i) for i in range(pieces)])


def _flow(spark, sf) -> ObservationFlow:
    """The flow fed once per shared checkpoint folder and data folder; later
    calls (from any session) rebind a flow object to the stored tables."""
    key = (checkpoint_root(spark), sf, B.input_state(spark, sf))
    if key not in _FLOWS:
        root = scratch_path(spark, "flow")
        feed_in_slices(spark, B.documents(spark, sf), _bind_flow(spark, root))
        _FLOWS[key] = root
    return _bind_flow(spark, _FLOWS[key])


def _bind_flow(spark, root: str) -> ObservationFlow:
    return ObservationFlow(spark, root, allow=B.BOUND_ALLOW_LIST, one_document_per_file=False)


ALLOWED_DOCS = f"adocs AS (SELECT * FROM docs WHERE name IN ({ALLOW_SQL}))"


def _sv(body: str, *extra: str) -> str:
    return with_views(body, OBS, CITY, DOCS, ALLOWED_DOCS, *extra)


@register("stream_json_ingest", with_views("SELECT city_id, name, main, temperature, dt FROM docs",
                                           OBS, CITY, DOCS))
def q_stream_json_ingest(spark, sf):
    v = landing.LANDING_COLUMN
    raw = landing.read_table(spark, _flow(spark, sf).landing)
    return raw.select(paths.extract(v, "$.id", "bigint").alias("city_id"),
                      paths.extract(v, "$.name", "string").alias("name"),
                      paths.extract(v, "$.weather[0].main", "string").alias("main"),
                      paths.extract(v, "$.main.temp", "double").alias("temperature"),
                      scalars.epoch_to_timestamp(paths.extract(v, "$.dt", "bigint")).alias("dt"))


@register("stream_curated_observation", with_views(
    f"{_CURATED_OBS_SQL} WHERE name IN ({ALLOW_SQL})", OBS, CITY, DOCS))
def q_stream_curated_observation(spark, sf):
    return _flow(spark, sf).keyed_observations().select(*curate.OBSERVATION_COLUMNS)


@register("stream_append_only", _sv("SELECT city_id, main, temperature, dt FROM adocs"))
def q_stream_append_only(spark, sf):
    """A new append-only consumer of the curated fact copies what it sees."""
    flow = _flow(spark, sf)
    out = scratch_path(spark, "append_only_copy")
    stream = S.read_commits(spark, flow.id_counter)

    def copy(batch, batch_id):
        # One folder a batch, overwritten: a replayed batch does not double its rows.
        flow.new_observations(batch).select("city_id", "main", "temperature", "dt").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (stream.writeStream.foreachBatch(copy).option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")


@register("stream_fan_out", _sv(
    "SELECT 'consumer_a' AS consumer, count(*) AS n_rows FROM docs UNION ALL "
    "SELECT 'consumer_b' AS consumer, count(*) AS n_rows FROM docs"))
def q_stream_fan_out(spark, sf):
    """Two independent consumers of the landing stream (own checkpoints): the
    second one, started after the first has drained, still sees every row."""
    flow = _flow(spark, sf)
    out = scratch_path(spark, "fan_out")
    for name in ("consumer_a", "consumer_b"):
        def count_rows(batch, batch_id, name=name):
            batch.agg(F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(
                f"{out}/consumer={name}/batch={batch_id}")
        q = (S.read_appends(spark, flow.landing, S.LANDING_SCHEMA).writeStream.foreachBatch(count_rows)
             .option("checkpointLocation", scratch_path(spark, "ckpt", name)).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out).groupBy("consumer").agg(F.sum("n_rows").alias("n_rows"))


_CONSUMERS = ("distinct_weather_conditions", "weather_conditions_rank_per_city", "avg_temp_per_city",
              "avg_temp_halving", "max_abs_temp", "city_with_strongest_wind", "max_daily_temp_variation")


@register("stream_guard", _sv(
    f"SELECT job, CAST({SLICES} AS BIGINT) AS n_batches, n AS n_rows FROM "
    f"(VALUES ('curated_city'), ('city_bridge'), ('consumption_city')) j(job), (SELECT count(*) AS n FROM docs) c UNION ALL "
    f"SELECT job, CAST({SLICES} AS BIGINT), n FROM (VALUES {', '.join(f'({chr(39)}{c}{chr(39)})' for c in (*_CONSUMERS, 'curated_weather'))}) "
    f"j(job), (SELECT count(*) AS n FROM adocs) c"))
def q_stream_guard(spark, sf):
    """Run every layer again with no new files: no batch starts, no state
    version is written, the run log is unchanged."""
    flow = _flow(spark, sf)
    flow.run_once()
    log = flow.run_log()
    return log.groupBy("job").agg(F.count_distinct("batch_id").alias("n_batches"),
                                  F.sum("rows").alias("n_rows"))


@register("run_history", """SELECT event_type AS job, event_id, ts AS scheduled_time FROM events
    WHERE event_type IN ('click', 'purchase') ORDER BY scheduled_time, job""")
def q_run_history(spark, sf):
    log = B.table(spark, sf, "events").select(F.col("event_type").alias("job"), "event_id",
                                              F.col("ts").alias("scheduled_time"))
    return S.run_history(log, ["click", "purchase"])


@register("stream_run_history", _sv(
    f"""SELECT job, batch_id, count(*) AS rows FROM (VALUES ('avg_temp_per_city'), ('curated_weather')) j(job),
    (SELECT greatest(0, least({SLICES - 1}, CAST(floor((epoch_us(d.dt) - lo) / ((hi - lo) / {SLICES}.0)) AS BIGINT)))
       AS batch_id FROM adocs d, (SELECT min(epoch_us(dt)) AS lo, max(epoch_us(dt)) AS hi FROM docs) b) s
    GROUP BY 1, 2 ORDER BY 1, 2"""))
def q_stream_run_history(spark, sf):
    """Runs of two jobs in the log that the flow's commits hold, with the rows each took in."""
    return S.run_history(_flow(spark, sf).run_log(), ["avg_temp_per_city", "curated_weather"]).select(
        "job", "batch_id", "rows")


_ROUND6 = {"avg_temperature"}


def _state_query(name: str, cols: tuple[str, ...], with_city: bool = True):
    def fn(spark, sf):
        flow = _flow(spark, sf)
        df = flow.answers()[name] if with_city else flow.state(name)
        return df.select(*[F.round(c, 6).alias(c) if c in _ROUND6 else F.col(c) for c in cols])
    return fn


_STREAM_STATES = {
    "stream_merge_distinct_conditions": (
        "distinct_weather_conditions", ("distinct_conditions", "distinct_conditions_count"),
        "SELECT list_sort(list_distinct(list(main))) AS distinct_conditions, count(DISTINCT main) "
        "AS distinct_conditions_count FROM adocs"),
    "stream_merge_condition_frequency": (
        "weather_conditions_rank_per_city", ("city_id", "city", "weather_condition", "frequency"),
        "SELECT city_id, name AS city, main AS weather_condition, count(*) AS frequency FROM adocs GROUP BY 1, 2, 3"),
    "stream_condition_rank": (
        "weather_conditions_rank_per_city", ("city_id", "city", "weather_condition", "frequency", "rank"),
        "SELECT *, rank() OVER (PARTITION BY city_id ORDER BY frequency DESC) AS rank FROM (SELECT city_id, "
        "name AS city, main AS weather_condition, count(*) AS frequency FROM adocs GROUP BY 1, 2, 3) f"),
    "stream_merge_avg_exact": (
        "avg_temp_per_city", ("city_id", "city", "avg_temperature"),
        "SELECT city_id, name AS city, round(avg(temperature), 6) AS avg_temperature FROM adocs GROUP BY 1, 2"),
    "stream_merge_running_max": (
        "max_abs_temp", ("city_id", "city", "max_abs_temperature"),
        "SELECT city_id, name AS city, max(temperature) AS max_abs_temperature FROM adocs GROUP BY 1, 2"),
    "stream_merge_strongest_wind": (
        "city_with_strongest_wind", ("city_id", "city", "max_wind_speed"),
        "SELECT city_id, name AS city, max(wind_speed) AS max_wind_speed FROM adocs GROUP BY 1, 2"),
    "stream_merge_daily_variation": (
        "max_daily_temp_variation", ("city_id", "city", "date", "temperature_variation"),
        "SELECT city_id, city, date, temperature_variation FROM (SELECT *, row_number() OVER (PARTITION BY city_id "
        "ORDER BY temperature_variation DESC NULLS LAST, date) AS rn FROM (SELECT city_id, name AS city, "
        "CAST(dt AS DATE) AS date, max(temperature) - min(temperature) AS temperature_variation FROM adocs "
        "GROUP BY 1, 2, 3) d) x WHERE rn = 1"),
}
for _key, (_state, _cols, _sql) in _STREAM_STATES.items():
    register(_key, _sv(_sql))(_state_query(_state, _cols, _state != "distinct_weather_conditions"))


@register("stream_merge_avg_halving", _sv(HALVING_SQL.replace("FROM obs", "FROM adocs")
                                          .replace("ORDER BY dt, event_id", "ORDER BY dt, temperature")))
def q_stream_merge_avg_halving(spark, sf):
    s = _flow(spark, sf).state("avg_temp_halving")
    return s.select("city_id", F.round("avg_temperature", 6).alias("avg_temperature"))


_FLOW_CITY = """SELECT name, arg_max(city_id, (dt, city_id)) AS city_id,
    arg_min(CASE WHEN timezone <> 3600 THEN 3600 ELSE timezone END, (dt, city_id)) AS timezone,
    arg_min(country, (dt, city_id)) AS country, arg_min(round(latitude, 1), (dt, city_id)) AS latitude,
    arg_min(round(longitude, 1), (dt, city_id)) AS longitude FROM adocs GROUP BY name"""


@register("stream_merge_city", _sv(f"SELECT name, city_id, timezone, country, latitude, longitude FROM ({_FLOW_CITY}) u"))
def q_stream_merge_city(spark, sf):
    return _flow(spark, sf).city()


@register("stream_merge_consumption_city", _sv(
    f"SELECT name, city_id, CASE WHEN timezone = 0 THEN 'UTC+00:00' WHEN timezone = 3600 THEN 'UTC+01:00' "
    f"WHEN timezone = 7200 THEN 'UTC+02:00' END AS timezone, country, latitude, longitude FROM ({_FLOW_CITY}) u"))
def q_stream_merge_consumption_city(spark, sf):
    return _flow(spark, sf).consumption_city()


# ============================================================================
# The same questions through the SQL interface (views + named parameters)
# ============================================================================
from cirrus.operators import questions_sql  # noqa: E402

_SQL_KEYS = {"q1": "q1_distinct_conditions", "q2": "q2_distinct_conditions_per_city", "q3": "q3_condition_rank",
             "q4": "q4_avg_temperature", "q5": "q5_hottest_city", "q6": "q6_daily_top_variation",
             "q7": "q7_max_variation", "q8": "q8_strongest_wind"}


def _sql_question(q: str):
    def fn(spark, sf):
        questions_sql.register_views(_obs(spark, sf), _city(spark, sf))
        df = questions_sql.ask(spark, q, B.PERIOD_START, B.PERIOD_END)
        return df.select(*[F.round(c, 6).alias(c) if c == "avg_temperature" else F.col(c) for c in df.columns])
    return fn


for _q, _key in _SQL_KEYS.items():
    register(f"sql_{_key}", ORACLE_SQL[_key])(_sql_question(_q))


@register("table_scan", with_views(_CURATED_OBS_SQL, OBS, CITY, DOCS))
def q_table_scan(spark, sf):
    """Every row and column of the curated fact, written as a typed table and read back."""
    path = scratch_path(spark, "curated_zone", "full_scan")
    landing.write_table(curate.curated_observation(_parsed_docs(spark, sf), allow=None), path)
    return landing.read_table(spark, path)


@register("curated_observation_keyed", with_views(
    f"""SELECT row_number() OVER (ORDER BY dt, city_id, main, temperature, wind_speed, rain_1h NULLS FIRST)
        AS weather_id, city_id, main, temperature, wind_speed, rain_1h, dt FROM docs WHERE name IN ({ALLOW_SQL})""",
    OBS, CITY, DOCS))
def q_curated_observation_keyed(spark, sf):
    """Curated fact with its AUTOINCREMENT key (distributed, time ordered)."""
    from cirrus.plans.warehouse import with_weather_id
    obs = curate.curated_observation(_parsed_docs(spark, sf), allow=B.BOUND_ALLOW_LIST)
    return with_weather_id(obs).select("weather_id", "city_id", "main", "temperature", "wind_speed",
                                       "rain_1h", "dt")


@register("stream_curated_observation_keyed", ORACLE_SQL["curated_observation_keyed"])
def q_stream_curated_observation_keyed(spark, sf):
    """The streamed fact numbered batch after batch (ids continue after the
    stored maximum; slices arrive in time order)."""
    return _flow(spark, sf).keyed_observations().select(
        "weather_id", "city_id", "main", "temperature", "wind_speed", "rain_1h", "dt")


# ============================================================================
# Scalar rules and merges through the SQL interface (functions and scripts)
# ============================================================================
from cirrus.functions import sql as sql_functions  # noqa: E402
from cirrus.operators import merges_sql  # noqa: E402


@register("sql_functions", with_views(
    f"""SELECT o.event_id, {WIND_CASE} AS wind, (epoch_us(o.dt) // 1000000)::BIGINT AS epoch, date_trunc('second', o.dt) AS dt,
    CASE WHEN c.timezone <> 3600 THEN 3600 ELSE c.timezone END AS timezone,
    CASE WHEN c.timezone = 0 THEN 'UTC+00:00' WHEN c.timezone = 3600 THEN 'UTC+01:00' WHEN c.timezone = 7200 THEN 'UTC+02:00' END
    AS label, round(c.latitude, 1) AS latitude FROM obs o JOIN city c ON o.city_id = c.city_id""", OBS, CITY))
def q_sql_functions(spark, sf):
    sql_functions.register(spark)
    _obs(spark, sf).createOrReplaceTempView("sql_obs")
    _city(spark, sf).createOrReplaceTempView("sql_city")
    return spark.sql("""SELECT event_id, wind_direction(wind_deg) AS wind, timestamp_to_epoch(dt) AS epoch,
        epoch_to_timestamp(timestamp_to_epoch(dt)) AS dt, timezone_override(timezone) AS timezone,
        utc_offset_label(timezone) AS label, round_coordinate(latitude) AS latitude
        FROM sql_obs JOIN sql_city USING (city_id)""")


def _sql_merge(spark, rule: str, schema: str, changes: DataFrame) -> DataFrame:
    """The early rows merged into an empty table and the late ones into that, by the scripts."""
    H.empty_state(spark, schema).createOrReplaceTempView(f"{rule}_none")
    for name, rows in zip(("early", "late"), _split(changes)):
        rows.createOrReplaceTempView(f"{rule}_{name}")
    merges_sql.merge(spark, rule, f"{rule}_none", f"{rule}_early", f"{rule}_state")
    return merges_sql.merge(spark, rule, f"{rule}_state", f"{rule}_late", f"{rule}_merged")


@register("sql_merge_condition_frequency", ORACLE_SQL["merge_condition_frequency"])
def q_sql_merge_condition_frequency(spark, sf):
    state = _sql_merge(spark, "condition_frequency", H.FREQUENCY_STATE, _obs(spark, sf))
    return joins.scalar_lookup(state, _city(spark, sf), "city_id", "name", "city")


@register("sql_merge_city", ORACLE_SQL["merge_city"])
def q_sql_merge_city(spark, sf):
    return _sql_merge(spark, "city", H.CITY_STATE, _city_rows(spark, sf))
