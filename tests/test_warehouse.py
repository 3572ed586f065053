"""Historical batch load into the zones, questions and quality report."""

import datetime as dt

from cirrus.plans import warehouse

from test_landing_curate import doc

BASE = 1711714980


def test_load_ask_and_copy_semantics(spark, tmp_json, tmp_path):
    docs = [doc(3173435, "Milan", 280.0 + i, BASE + 3600 * i, weather=("Rain" if i % 2 else "Clouds",))
            for i in range(6)]
    docs += [doc(6540125, "Cagliari", 290.0 + i, BASE + 3600 * i + 1) for i in range(3)]
    docs.append(doc(2523281, "Sant'Avendrace", 300.0, BASE))
    stage = tmp_json(docs)
    root = str(tmp_path / "wh")
    warehouse.load_history(spark, stage, root)
    obs, city = warehouse.tables(spark, root)
    assert obs.count() == 9 and city.count() == 2
    ids = [r.weather_id for r in obs.orderBy("dt", "city_id").collect()]
    assert ids == list(range(1, 10))
    q4 = {r.city: r.avg_temperature for r in warehouse.ask(spark, root, "q4", "2024-03-29", "2024-04-02").collect()}
    assert q4 == {"Milan": 282.5, "Cagliari": 291.0}
    q4_sql = {r.city: r.avg_temperature
              for r in warehouse.ask(spark, root, "q4", "2024-03-29", "2024-04-02", sql=True).collect()}
    assert q4_sql == q4
    q6 = warehouse.ask(spark, root, "q6", "2024-03-29", "2024-04-02").collect()
    assert [(r.date, r.city) for r in q6] == [(dt.date(2024, 3, 29), "Milan")]
    assert {r.check: r.violations for r in warehouse.data_quality(spark, root).collect()} == {
        "curated_city.city_id not null": 0, "curated_city.city_id unique": 0,
        "curated_weather.weather_id unique": 0, "curated_weather.city_id -> curated_city": 0}
    # the zones as catalog tables
    assert warehouse.register_tables(spark, root)[-1] == "curated_zone.curated_weather"
    n = spark.sql("SELECT count(*) FROM curated_zone.curated_weather w JOIN curated_zone.curated_city c "
                  "ON w.city_id = c.city_id WHERE w.obs_date = DATE'2024-03-29'").first()[0]
    assert n == 9
    # the fact beside the dimension in equal buckets, and again over the same data
    for _ in range(2):
        by_city = warehouse.build_by_city(spark, root, buckets=2)
        assert by_city.count() == 9 and {r.name for r in by_city.select("name").distinct().collect()} == {"Milan", "Cagliari"}
    # loading again without new files adds nothing (COPY semantics)
    warehouse.load_history(spark, stage, root)
    assert warehouse.tables(spark, root)[0].count() == 9


def test_command_line(spark, tmp_json, tmp_path, capsys):
    from cirrus.__main__ import main
    stage = tmp_json([doc(3173435, "Milan", 280.0 + i, BASE + 3600 * i) for i in range(4)])
    root = str(tmp_path / "cli")
    main(["load", "--stage", stage, "--root", root])
    main(["ask", "--root", root, "--question", "q5", "--start", "2024-03-29", "--end", "2024-04-02", "--sql"])
    main(["quality", "--root", root])
    out = capsys.readouterr().out
    assert "Milan" in out and "283.0" in out
    assert "curated_weather.weather_id unique" in out
