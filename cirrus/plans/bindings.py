"""Views that bind the generic test tables to the observation data model.

obs  = events: event_id, user_id -> city_id, event_type -> main, value ->
       temperature, ts -> dt, props.k -> wind_speed, wind_speed*3.75 -> wind_deg
city = customer JOIN nation: c_custkey -> city_id, n_name -> name (many ids share
       a name, as two ids share one city in the raw data)
docs = one raw JSON observation document per event, in the API's layout
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrus.functions.scalars import timestamp_to_epoch

PERIOD_START = "2024-01-08"
PERIOD_END = "2024-01-15"
# Splits "existing target state" (ts < T0) from "changes" (ts >= T0).
SPLIT_TS = "2024-01-20"
# City allow-list used with the bound tables (every second nation).
BOUND_ALLOW_LIST = tuple(f"NATION_{i}" for i in range(0, 25, 2))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wind = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("city_id"),
        F.col("event_type").alias("main"),
        F.col("value").alias("temperature"),
        F.col("ts").alias("dt"),
        wind.alias("wind_speed"),
        (wind * 3.75).alias("wind_deg"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location dimension; Spark's own threshold decides which side is broadcast."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return (customer
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("city_id"),
                    F.col("n_name").alias("name"),
                    (F.lit(3600) * (F.col("c_nationkey") % 4)).alias("timezone"),
                    F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"),
                    F.col("c_acctbal").alias("latitude"),
                    F.col("c_nationkey").cast("double").alias("longitude")))


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the bound tables' files: what is derived from them is kept under this."""
    found = []
    for name in ("events", "customer", "nation"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files = fs.listStatus(path)
        found += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    return tuple(found)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per event (column ``value``) with the raw API layout:
    id, name, timezone, sys.country, coord, weather[0], main.temp, wind,
    clouds.all, rain."1h" on every tenth event, dt in epoch seconds."""
    obs = observations(spark, sf_dir)
    city = cities(spark, sf_dir)
    doc = F.struct(
        F.col("city_id").alias("id"),
        F.col("name"),
        F.col("timezone"),
        F.struct(F.col("country").alias("country")).alias("sys"),
        F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("coord"),
        F.array(F.struct(F.col("main").alias("main"),
                         F.upper("main").alias("description"))).alias("weather"),
        F.struct(F.col("temperature").alias("temp")).alias("main"),
        F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg")).alias("wind"),
        F.struct(F.col("wind_speed").cast("int").alias("all")).alias("clouds"),
        F.when(F.col("event_id") % 10 == 0,
               F.struct(F.col("temperature").alias("1h"))).alias("rain"),
        timestamp_to_epoch("dt").alias("dt"),
    )
    return (obs.join(city, "city_id")
            .select("event_id", "dt", F.to_json(doc).alias("value")))
