import datetime as dt

from pyspark.sql import functions as F

from cirrus.functions import scalars


def _col(spark, values, fn, type_="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    return [r[0] for r in df.orderBy("i").select(fn("x")).collect()]


def test_wind_direction_edges(spark):
    degs = [0.0, 22.4, 22.5, 67.5, 112.5, 157.5, 202.5, 247.5, 292.5, 337.4, 337.5, 360.0, None]
    expected = ["North", "North", "North-East", "East", "South-East", "South", "South-West", "West",
                "North-West", "North-West", "North", "North", None]
    assert _col(spark, degs, scalars.wind_direction) == expected


def test_timezone_override(spark):
    assert _col(spark, [3600, 7200, 0, None], scalars.timezone_override, "int") == [3600, 3600, 3600, None]


def test_utc_offset_label(spark):
    assert _col(spark, [0, 3600, 7200, 19800, None], scalars.utc_offset_label, "int") == [
        "UTC+00:00", "UTC+01:00", "UTC+02:00", None, None]


def test_round_coordinate_half_up(spark):
    assert _col(spark, [45.4637, 45.4647, 0.15, -0.15, 9.25], scalars.round_coordinate) == [
        45.5, 45.5, 0.2, -0.2, 9.3]


def test_epoch_round_trip_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(1711714980,)], "e long")
            row = df.select(scalars.epoch_to_timestamp("e").alias("t")).select(
                "t", scalars.timestamp_to_epoch("t").alias("back")).first()
            assert row.t == dt.datetime(2024, 3, 29, 12, 23, 0)
            assert row.back == 1711714980
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_to_date_of_ntz(spark):
    df = spark.createDataFrame([("2024-03-31 23:59:59",)], "s string")
    d = df.select(scalars.to_date(F.col("s").cast("timestamp_ntz"))).first()[0]
    assert d == dt.date(2024, 3, 31)
