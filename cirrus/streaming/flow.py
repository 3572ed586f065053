"""The continuous observation flow, layer by layer.

    incoming JSON files --(file stream, exactly-once sink)--> landing (VARIANT)
    landing --(foreachBatch, id counter state)--> curated_weather
        (the one stored fact: typed rows with a dense weather_id after the
        stored maximum, one folder per batch, days inside)
    landing --(keyed state by name)--> curated_city, its INSERT/UPDATE rows and,
        from those, consumption_city; --(aggregation)--> id->name bridge
    curated_weather --(a streaming aggregation and trigger for each)--> answer tables in Spark's state store

``run_once`` drains every layer in order with ``availableNow`` -- the same
ordering the staggered schedules of the original jobs aim at, but explicit.
``start`` runs every layer continuously on its own processing-time cadence
(1 .. 4 minutes by default, staggered by layer) and returns the queries.
Every hop hands over through a stored table with its own checkpoint, so a
lost executor or a restarted driver resumes where the checkpoints say.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cirrus.functions.paths import extract
from cirrus.functions.scalars import (
    CITY_ALLOW_LIST, epoch_to_timestamp, round_coordinate, timezone_override, utc_offset_label,
)
from cirrus.operators import curate, incremental as H
from cirrus.operators.joins import scalar_lookup
from cirrus.schemas import CONSUMPTION, CURATED_WEATHER, LENGTH_LIMITS, PRIMARY_KEYS
from cirrus.sources.landing import LANDING_COLUMN, point_table, rejected_rows, rejects, replace_checked
from cirrus.streaming import jobs
from cirrus.streaming.history import RunHistory
from cirrus.streaming.native import NativeTable, shared_state_partitions
from cirrus.streaming.upsert import CityTables

CURATED_WEATHER_STREAM = T.StructType(CURATED_WEATHER.fields + [T.StructField("obs_date", T.DateType())])
KEYED_WEATHER = T.StructType([T.StructField("weather_id", T.LongType())] + CURATED_WEATHER_STREAM.fields)
# Ties in dt are broken by the value itself, which fixes the halving result.
HALVING_ORDER = ("dt", "temperature")


# Minutes between the runs of each answer table's job.
CADENCE = {
    "distinct_weather_conditions": "3 minutes", "weather_conditions_rank_per_city": "4 minutes",
    "avg_temp_per_city": "5 minutes", "avg_temp_halving": "5 minutes", "max_abs_temp": "6 minutes",
    "city_with_strongest_wind": "7 minutes", "max_daily_temp_variation": "8 minutes",
}


class ObservationFlow:
    def __init__(self, spark: SparkSession, root: str, allow: Iterable[str] | None = CITY_ALLOW_LIST,
                 one_document_per_file: bool = True, max_files_per_trigger: int | None = None,
                 state_partitions: int | None = None):
        """``state_partitions``: of each table in Spark's state store (``native.shared_state_partitions``)."""
        self.spark = spark
        self.root = root.rstrip("/")
        state_partitions = state_partitions or shared_state_partitions(spark)
        self.allow = tuple(allow) if allow is not None else None
        self.one_document_per_file = one_document_per_file
        self.max_files = max_files_per_trigger
        p = self.path
        self.source_dir = p("stage")
        self.landing = p("landing_zone/landing_json")
        self.curated_weather = p("curated_zone/curated_weather")
        self.id_counter = jobs.StateGroup(spark, p("curated_zone/id_counter"), {"id_counter": "max_id bigint"})
        self.curated = CityTables(
            spark, self.checkpoint("curated_city"), p("curated_zone/city_changes"),
            NativeTable(spark, self.checkpoint("city_bridge"), lambda s: s.groupBy("city_id", "name").count(),
                        "city_id bigint, name string", "n bigint", partitions=state_partitions), state_partitions)
        self.halving = jobs.MergeJob("avg_temp_halving", H.HALVING_DELTA, combine=H.combine_avg_halving,
                                     partial=lambda b: H.halving_partials(b, order=HALVING_ORDER))
        # One query, state and trigger for each table: a rule that fails stops its own table only.
        table = lambda name, *how: NativeTable(
            spark, self.checkpoint(f"consumption_{name}"), *how, partitions=state_partitions)
        self.consumption = {
            "distinct_weather_conditions": table(
                "distinct_weather_conditions", lambda s: s.groupBy("main").count(), "main string", "n bigint",
                lambda rows: H.combine_distinct_conditions(H.partial_distinct_conditions(rows))),
            "weather_conditions_rank_per_city": table(
                "weather_conditions_rank_per_city", H.partial_condition_frequency,
                "city_id bigint, weather_condition string", "frequency bigint"),
            "avg_temp_per_city": table("avg_temp_per_city", H.partial_avg_exact, "city_id bigint",
                                       "sum_temperature double, count_temperature bigint"),
            "avg_temp_halving": jobs.state_group(spark, p("consumption_zone/states/avg_temp_halving"), [self.halving]),
            "max_abs_temp": table("max_abs_temp", H.partial_running_max, "city_id bigint", "max_abs_temperature double"),
            "city_with_strongest_wind": table(
                "city_with_strongest_wind", lambda s: H.partial_running_max(s, "wind_speed", "max_wind_speed"),
                "city_id bigint", "max_wind_speed double"),
            "max_daily_temp_variation": table("max_daily_temp_variation", H.partial_daily_extremes,
                                              "city_id bigint, date date", "hi double, lo double"),
        }
        self.published: dict[str, dict[str, int]] = {}  # table -> rows, rejected rows and rows that break each limit
        self.runs = RunHistory(spark, self.root, p("_runs"))

    def path(self, rel: str) -> str:
        return f"{self.root}/{rel}"

    def checkpoint(self, name: str) -> str:
        return self.path(f"_checkpoints/{name}")

    # -- layer transforms -----------------------------------------------------
    def _curate_weather(self, landing: DataFrame) -> DataFrame:
        return curate.with_partition_date(curate.curated_observation(landing, allow=self.allow))

    def _city_rows(self, landing: DataFrame, batch_id: int | None = None) -> DataFrame:
        v = LANDING_COLUMN
        rows = landing
        if self.allow is not None:
            rows = curate.filter_allow_list(rows, extract(v, "$.name", "string"), self.allow)
        return rows.select(
            extract(v, "$.id", "bigint").alias("city_id"),
            extract(v, "$.name", "string").alias("name"),
            timezone_override(extract(v, "$.timezone", "int")).alias("timezone"),
            extract(v, "$.sys.country", "string").alias("country"),
            round_coordinate(extract(v, "$.coord.lat", "double")).alias("latitude"),
            round_coordinate(extract(v, "$.coord.lon", "double")).alias("longitude"),
            epoch_to_timestamp(extract(v, "$.dt", "bigint")).alias("dt"))

    # -- scheduling -----------------------------------------------------------------
    def _layers(self, cadence: dict[str, str | None]):
        spark, name = self.spark, self.runs.name
        landing = lambda: jobs.read_appends(spark, self.landing, jobs.LANDING_SCHEMA, self.max_files)
        layers = {
            "landing": lambda: jobs.ingest_json(
                spark, self.source_dir, self.landing, self.checkpoint("landing"), self.one_document_per_file, self.max_files,
                cadence["landing"], name=name("landing")),
            "curated_weather": lambda: jobs.keyed_append(
                spark, landing(), self.id_counter, self.curated_weather, self.checkpoint("curated_weather"),
                cadence["curated_weather"], self._curate_weather, name("curated_weather")),
            "curated_city": lambda: jobs._finish(self.curated.start(
                self._city_rows(landing()), cadence["curated_city"], name("curated_city")), cadence["curated_city"]),
            "city_bridge": lambda: jobs._finish(self.curated.bridge.start(
                self._city_rows(landing()), cadence["city_bridge"], name("city_bridge")), cadence["city_bridge"]),
            **{t: self._consumer(t, cadence[t]) for t in self.consumption},
        }
        return [self._recorded(run, cadence[layer]) for layer, run in layers.items()]

    def _recorded(self, run, trigger: str | None):
        def layer():
            query = run()
            if not trigger:
                self.runs.wait(str(query.runId))
            return query
        return layer

    def _consumer(self, table: str, trigger: str | None):
        name = self.runs.name(table)
        if table == self.halving.name:  # its rule depends on the rows' order, which no aggregate function keeps
            return lambda: jobs.consume(
                self.spark, jobs.read_commits(self.spark, self.id_counter, self.max_files), self.consumption[table],
                [self.halving], self.checkpoint(f"consumption_{table}"), trigger, rows=self._new_rows, name=name)
        return lambda: jobs._finish(self.consumption[table].start(
            jobs.read_fact(self.spark, self.curated_weather, KEYED_WEATHER, self.max_files), trigger, name), trigger)

    def new_observations(self, records: DataFrame) -> DataFrame:
        """The fact rows of a micro-batch of the fact's commit records."""
        return self._new_rows(records)[0]

    def _new_rows(self, records: DataFrame) -> tuple[DataFrame, int | None]:
        return jobs.new_rows(records, self.id_counter, self.curated_weather, KEYED_WEATHER)

    def run_once(self) -> None:
        """Drain every layer once along its dependencies (``availableNow``):
        landing, then the fact append and the city upsert side by side (both
        only read landing) and, once the fact is appended, the consumption states (all only read the fact). Every layer that
        has begun runs to its end before a failure is raised."""
        self.run_each([lambda: None])

    def run_each(self, arrivals: Sequence[Callable[[], None]]) -> None:
        """``run_once`` after each arrival, a call that brings files into ``source_dir``.

        The next arrival comes and is landed beside the answer tables' batch of the one before, which reads the fact only: once
        all readers of landing have ended, as each of them takes an arrival in a batch of its own. The next rows join the fact
        when the answer tables have ended. After a failure no further arrival is called."""
        names = ("landing", "curated_weather", "curated_city", "city_bridge", *self.consumption)
        ingest, fact, city, pairs, *rest = self._layers(dict.fromkeys(names))

        def land(arrive: Callable[[], None]) -> None:
            arrive()
            ingest()

        with self.runs, ThreadPoolExecutor(max_workers=len(names) + 1) as pool:
            landed = pool.submit(land, arrivals[0]) if arrivals else None
            for after in [*arrivals[1:], None]:
                if landed is None:
                    break
                landed.result()
                landed, done = None, [pool.submit(layer) for layer in (fact, city, pairs)]
                if done[0].exception() is None:  # waits for the fact
                    done += [pool.submit(layer) for layer in rest]
                if after and not any(d.exception() for d in done[:3]):  # waits for the readers of landing
                    landed = pool.submit(land, after)
                failed = [d.exception() for d in done if d.exception()]
                if failed:
                    raise failed[0]

    def start(self, landing: str = "1 minute", curated_weather: str = "2 minutes", curated_city: str = "1 minute",
              consumption: str | dict[str, str] | None = None) -> list:
        """Run every layer continuously with its own processing-time trigger; ``consumption`` gives one trigger for
        all answer tables or one for each. The run history listens until the session ends."""
        own = dict(CADENCE, **consumption) if isinstance(consumption, dict) else (
            dict.fromkeys(self.consumption, consumption) if consumption else CADENCE)
        cadence = {"landing": landing, "curated_weather": curated_weather, "curated_city": curated_city,
                   "city_bridge": curated_city, **own}
        self.spark.streams.addListener(self.runs)
        return [layer() for layer in self._layers(cadence)]

    def run_log(self) -> DataFrame:
        """A row for each job and committed batch: from the commit records of the state groups, and from the run history
        for the tables that Spark keeps."""
        log = self.id_counter.commits().unionByName(self.consumption[self.halving.name].commits())
        native = {name: t.committed() for name, t in self.consumption.items() if isinstance(t, NativeTable)}
        runs = self.runs.batches({**native, "curated_city": self.curated.committed(),
                                  "city_bridge": self.curated.bridge.committed()})
        # One run of the city upsert changes both city tables.
        both = runs.where("job = 'curated_city'").withColumn("job", F.lit("consumption_city"))
        return log.where("job IS NOT NULL").drop("query_id").unionByName(runs).unionByName(both)

    def run_history(self) -> DataFrame:
        """All runs of the flow's queries, also those that found no data or failed: state, error and times."""
        return self.runs.read()

    def keyed_observations(self) -> DataFrame:
        """The curated fact with its weather_id, committed batches only."""
        return jobs.committed_rows(self.spark, self.id_counter, self.curated_weather, KEYED_WEATHER)

    def consumption_city(self) -> DataFrame:
        """The city table fed by the curated one's INSERT and UPDATE rows; it stores the time zone's label."""
        return self.curated.read("consumption_city").withColumn("timezone", utc_offset_label("timezone"))

    def city_changes(self) -> DataFrame:
        """curated_city's INSERT and UPDATE rows."""
        return self.curated.changes()

    # -- answer tables ------------------------------------------------------------
    def state(self, name: str) -> DataFrame:
        if name == self.halving.name:
            return H.present_avg_halving(self.consumption[name].read(name))
        return self.consumption[name].read()

    def city(self) -> DataFrame:
        return self.curated.read("curated_city")

    def with_city(self, df: DataFrame) -> DataFrame:
        """Adds the city name through the id->name bridge (scalar lookup)."""
        return scalar_lookup(df, self.curated.read("city_bridge"), "city_id", "name", "city")

    def data_quality(self) -> DataFrame:
        """Violation counts of the declared constraints of the consumption
        tables: NOT NULL and UNIQUE keys, FOREIGN KEY to consumption_city,
        VARCHAR(n) limits. One aggregate job per check, nothing collected."""
        from cirrus.operators import quality as D
        cities = self.consumption_city()
        tables = {"consumption_city": cities, **self.answers()}
        v = LANDING_COLUMN
        raw = self.spark.read.schema(jobs.LANDING_SCHEMA).parquet(self.landing)
        checks = [("landing documents unparsable", raw.where(F.col(v).isNull())),
                  ("landing documents without id", raw.where(F.col(v).isNotNull() & extract(v, "$.id", "bigint").isNull())),
                  ("landing documents without name",
                   raw.where(F.col(v).isNotNull() & extract(v, "$.name", "string").isNull()))]
        for name, df in tables.items():
            key = PRIMARY_KEYS.get(name)
            if key:
                checks.append((f"{name}.{','.join(key)} not null", D.dq_not_null(df, list(key))))
                checks.append((f"{name}.{','.join(key)} unique", D.dq_unique(df, list(key))))
            if name != "consumption_city" and "city_id" in df.columns:
                checks.append((f"{name}.city_id -> consumption_city",
                               D.dq_foreign_key(df, cities, "city_id", "city_id")))
            limits = {c: n for c, n in LENGTH_LIMITS.items() if c in df.columns}
            if limits:
                checks.append((f"{name} length limits", D.dq_length(df, limits)))
        out = None
        for label, df in checks:
            row = df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(label).alias("check"), "violations")
            out = row if out is None else out.unionByName(row)
        return out

    def answers(self) -> dict[str, DataFrame]:
        return {
            "distinct_weather_conditions": self.state("distinct_weather_conditions"),
            "weather_conditions_rank_per_city": self.with_city(H.present_condition_rank(
                self.state("weather_conditions_rank_per_city"))),
            "avg_temp_per_city": self.with_city(H.present_avg(self.state("avg_temp_per_city"))),
            "max_abs_temp": self.with_city(self.state("max_abs_temp")),
            "city_with_strongest_wind": self.with_city(self.state("city_with_strongest_wind")),
            "max_daily_temp_variation": self.with_city(H.present_daily_variation(
                self.state("max_daily_temp_variation"))),
        }

    def rejected_documents(self) -> DataFrame:
        """File, text and reason of each landed document that is no JSON."""
        return rejects(self.spark.read.schema(jobs.LANDING_SCHEMA).parquet(self.landing))

    def published_rejects(self, name: str) -> DataFrame:
        return rejected_rows(self.spark, self.path(f"consumption_zone/{name}"), CONSUMPTION[name])

    def publish(self) -> list[str]:
        """Write the answers and the city table as typed Parquet tables of ``consumption_zone`` and register them. Each
        table is replaced in one step; queries that run meanwhile see its old or its new version, whole. Rows that break a
        declared limit (NOT NULL keys, lengths) are kept apart (``published_rejects``); ``published`` has the counts."""
        root = self.path("consumption_zone")
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS consumption_zone LOCATION '{root}'")
        names = []
        for name, df in {"consumption_city": self.consumption_city(), **self.answers()}.items():
            fields = [f.split(" ", 1) for f in CONSUMPTION[name].split(", ")]
            typed = df.select(*(F.col(c).cast(kind).alias(c) for c, kind in fields))
            accepted, self.published[name] = replace_checked(
                typed, f"{root}/{name}", PRIMARY_KEYS.get(name, ()), {c: n for c, n in LENGTH_LIMITS.items() if c in typed.columns})
            point_table(self.spark, f"consumption_zone.{name}", CONSUMPTION[name], accepted)
            names.append(f"consumption_zone.{name}")
        return names
