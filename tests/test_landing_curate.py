"""Landing load and curation on hand-written documents (FIXTURES section 4)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cirrus.functions import paths
from cirrus.operators import curate
from cirrus.sources import landing


def doc(id_, name, temp, epoch, deg=180, tz=3600, rain=None, snow=None, weather=("Clouds",),
        lat=45.4642, lon=9.19, pretty=False):
    d = {"coord": {"lat": lat, "lon": lon},
         "weather": [{"id": 800, "main": w, "description": w.lower(), "icon": "01d"} for w in weather],
         "main": {"temp": temp, "pressure": 1010, "humidity": 60},
         "visibility": 10000, "wind": {"speed": 3.5, "deg": deg}, "clouds": {"all": 20},
         "dt": epoch, "sys": {"country": "IT"}, "timezone": tz, "id": id_, "name": name, "cod": 200}
    if rain is not None:
        d["rain"] = rain
    if snow is not None:
        d["snow"] = snow
    return json.dumps(d, indent=2 if pretty else None)


def test_pretty_and_one_line_files_give_one_row_each(spark, tmp_json):
    folder = tmp_json([doc(1, "Milan", 290, 1711714980, pretty=True), doc(2, "Bologna", 280.5, 1711714981)])
    df = landing.read_json_documents(spark, folder)
    assert df.count() == 2
    obs = curate.curated_observation(df).orderBy("city_id").collect()
    assert [r.temperature for r in obs] == [290.0, 280.5]   # JSON integer read as double


def test_optional_keys_and_first_condition(spark, tmp_json):
    folder = tmp_json([
        doc(1, "Milan", 290.1, 1711714980),
        doc(2, "Milan", 290.2, 1711714990, rain={"1h": 0.4}, snow={"3h": 1.5}, weather=("Snow", "Mist")),
    ])
    rows = {r.city_id: r for r in curate.curated_observation(landing.read_json_documents(spark, folder)).collect()}
    assert (rows[1].rain_1h, rows[1].rain_3h, rows[1].snow_1h, rows[1].snow_3h) == (None, None, None, None)
    assert (rows[2].rain_1h, rows[2].snow_3h, rows[2].snow_1h) == (0.4, 1.5, None)
    assert rows[2].main == "Snow" and rows[2].description == "snow"
    assert rows[1].dt == dt.datetime(2024, 3, 29, 12, 23, 0)
    assert rows[1].cloudiness == 20 and rows[1].wind_direction == "South"


def test_allow_list_and_dimension_dedup(spark, tmp_json):
    folder = tmp_json([
        doc(3173435, "Milan", 290, 1, lat=45.4637, tz=3600),
        doc(3173435, "Milan", 291, 2, lat=45.4647, tz=7200),     # jitter + other offset: same row
        doc(6542283, "Milan", 292, 3),                           # second id for the same city
        doc(2523281, "Sant'Avendrace", 293, 4),                  # outside the allow-list
    ])
    city = curate.curated_city(landing.read_json_documents(spark, folder)).orderBy("city_id").collect()
    assert [(r.city_id, r.name, r.timezone, r.latitude) for r in city] == [
        (3173435, "Milan", 3600, 45.5), (6542283, "Milan", 3600, 45.5)]


def test_period_bounds_are_closed(spark):
    df = spark.createDataFrame([("2024-03-29 00:00:00",), ("2024-04-02 00:00:00",), ("2024-04-02 00:00:01",)],
                               "s string").select(F.col("s").cast("timestamp_ntz").alias("dt"))
    kept = curate.filter_time_range(df, "2024-03-29", "2024-04-02").count()
    assert kept == 2


def test_unparsable_and_wrong_type_lenient_vs_strict(spark, tmp_json):
    folder = tmp_json([doc(1, "Milan", 290, 1), '{"id": "x", "name": "Milan", "dt": 5}', "not json"])
    df = landing.read_json_documents(spark, folder)
    rep = paths.extraction_report(df, landing.LANDING_COLUMN, [("city_id", "$.id", "bigint")]).first()
    assert rep.unparsable_documents == 1 and rep.nulled_city_id == 1
    ids = sorted((r.city_id for r in curate.curated_observation(df).collect()), key=lambda x: (x is None, x))
    assert ids == [1, None]
    with pytest.raises(Exception):
        curate.curated_observation(df, strict=True).collect()
    with pytest.raises(Exception):
        landing.read_json_documents(spark, folder, strict=True).collect()


def test_variant_table_round_trip(spark, tmp_json, tmp_path):
    folder = tmp_json([doc(1, "Milan", 290.5, 1, rain={"1h": 2.0})])
    path = str(tmp_path / "landing_json")
    landing.write_table(landing.read_json_documents(spark, folder), path)
    back = landing.read_table(spark, path)
    assert back.schema[landing.LANDING_COLUMN].dataType.typeName() == "variant"
    r = back.select(paths.extract(landing.LANDING_COLUMN, '$.rain["1h"]', "double")).first()[0]
    assert r == 2.0


def test_zone_paths():
    assert landing.zone_path("/x/", "curated_zone", "curated_city") == "/x/curated_zone/curated_city"
    with pytest.raises(ValueError):
        landing.zone_path("/x", "nowhere", "t")
