"""Tables are replaced in one step: readers see the old or the new version, whole."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from cirrus.plans import warehouse
from cirrus.sources import landing
from cirrus.streaming import files

from test_landing_curate import doc


def test_readers_of_a_catalog_table_never_fail_or_see_half(spark, tmp_path):
    path, name = str(tmp_path / "t"), "default.replaced_t"
    write = lambda n: landing.replace_table(spark.range(n * 100).selectExpr("id", f"{n} AS n").repartition(4), path)
    landing.point_table(spark, name, "id bigint, n int", write(1))
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.sql(f"SELECT count(*), min(n), max(n) FROM {name}").first()))
                seen.append(tuple(landing.read_table(spark, path).agg(F.count("*"), F.min("n"), F.max("n")).first()))
            except Exception as e:  # any failure of a reader fails the test
                errors.append(e)

    readers = [threading.Thread(target=read) for _ in range(2)]
    try:
        for r in readers:
            r.start()
        for n in range(2, 8):
            landing.point_table(spark, name, "id bigint, n int", write(n))
    finally:
        stop.set()
        for r in readers:
            r.join()
        last = tuple(spark.sql(f"SELECT count(*), min(n), max(n) FROM {name}").first())
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not errors, errors[0]
    assert all(rows == 100 * lo and lo == hi for rows, lo, hi in seen) and len({s[1] for s in seen}) > 1
    assert last == (700, 7, 7)


def test_a_dead_writer_changes_nothing_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    landing.replace_table(spark.range(3).toDF("id"), path)
    half = landing.replace_table(spark.range(9).toDF("id"), path)
    os.remove(f"{half}/_SUCCESS")  # as if the job had died behind its last file
    assert landing.read_table(spark, path).count() == 3
    assert landing.replace_table(spark.range(5).toDF("id"), path).endswith("v=2")  # the half version's name is not taken again
    frame = landing.read_table(spark, path)
    for n in range(6, 9):
        landing.replace_table(spark.range(n).toDF("id"), path, keep=2, min_age=0)
    assert files.numbered(spark, path, "v") == [4, 5] and landing.read_table(spark, path).count() == 8
    with pytest.raises(Exception):
        frame.count()  # only a reader older than ``min_age`` loses its files
    landing.create_table(spark, path, "id long")
    landing.insert_select(spark.range(2).toDF("id"), path)
    assert landing.read_table(spark, path).count() == 2


def test_a_rebuild_moves_the_registered_names(spark, tmp_json, tmp_path):
    stage = tmp_json([doc(3173435, "Milan", 280.0 + i, 1711714980 + 90000 * i) for i in range(3)])
    root = str(tmp_path / "wh")
    warehouse.load_history(spark, stage, root)
    try:
        warehouse.register_tables(spark, root)
        count = lambda: spark.sql("SELECT count(*) FROM curated_zone.curated_weather w JOIN curated_zone.curated_city c "  # noqa: E731
                                  "ON w.city_id = c.city_id").first()[0]
        assert count() == 3
        obs, _ = warehouse.tables(spark, root)
        with open(os.path.join(stage, "more.json"), "w") as f:
            f.write(doc(3173435, "Milan", 290.0, 1711714980 + 40))
        warehouse.load_history(spark, stage, root)
        assert count() == 3 and obs.count() == 3  # names and frames stay on their version
        warehouse.register_tables(spark, root)
        assert count() == 4 and warehouse.tables(spark, root)[0].count() == 4
        plan = spark.sql("SELECT count(*) FROM curated_zone.curated_weather WHERE obs_date = DATE'2024-03-29'")
        assert "PartitionFilters: [isnotnull(obs_date" in plan._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert plan.first()[0] == 2
    finally:
        spark.sql("DROP VIEW IF EXISTS curated_zone.curated_weather")


BAD = {"cut.json": b'{"id": 1, "name": "Milan", ', "bytes.json": b'{"name": "\xff\xfe"} {', "text.json": "café ☃\n\n ".encode()}


@pytest.mark.parametrize("streamed", [False, True])
def test_bad_documents_keep_every_byte(spark, tmp_path, streamed):
    stage = tmp_path / "stage"
    stage.mkdir()
    good = [doc(3173435, "Milan", 280.0, 1711714980, pretty=True), doc(1, "Rome", 281.0, 1711714980), "[1, 2.50]", "{'id': 7}"]
    for i, text in enumerate(good):
        (stage / f"good{i}.json").write_text(text)
    plain = landing.read_json_documents(spark, str(stage))
    before = sorted(r[0] for r in plain.select(F.to_json(landing.LANDING_COLUMN)).collect())
    for name, data in {**BAD, "empty.json": b""}.items():
        (stage / name).write_bytes(data)
    if streamed:
        from cirrus.streaming import jobs as S
        S.ingest_json(spark, str(stage), str(tmp_path / "landing"), str(tmp_path / "ckpt"))
        got = spark.read.schema(S.LANDING_SCHEMA).parquet(str(tmp_path / "landing"))
    else:
        got = landing.landing_rows(landing.json_reader(spark, rejects=True).load(str(stage)))
    kept = {os.path.basename(r.source_file): (bytes(r.rejected_text), r.reason) for r in landing.rejects(got.cache()).collect()}
    assert {n: t for n, (t, _) in kept.items()} == BAD
    assert kept["bytes.json"][1] == "invalid UTF-8" and kept["cut.json"][1] == "malformed JSON"
    fine = got.where(F.col(landing.REJECTED).isNull())
    assert sorted(r[0] for r in fine.select(F.to_json(landing.LANDING_COLUMN)).collect()) == before
    got.unpersist()


def test_limits_are_enforced_and_counted_in_the_writing_job(spark, tmp_path):
    from cirrus.operators import quality as D
    path = str(tmp_path / "t")
    rows = [(1, "Milan", "IT"), (None, "x" * 51, "ITAL"), (2, None, "IT"), (3, "y" * 51, None), (3, "y" * 50, "ITA")]
    schema = "city_id long, name string, country string"
    df, lengths = spark.createDataFrame(rows, schema), {"name": 50, "country": 3}
    accepted, counts = landing.replace_checked(df, path, ["city_id"], lengths)
    assert counts == {"rows": 5, "rejected": 2, "city_id is null": D.dq_not_null(df, ["city_id"]).count(),
                      **{f"{c} longer than {n}": D.dq_length(df, {c: n}).count() for c, n in lengths.items()}}
    assert sorted(map(str, spark.read.schema(schema).parquet(accepted).collect())) == sorted(map(str, (
        df.where("city_id IS NOT NULL AND coalesce(length(name), 0) <= 50 AND coalesce(length(country), 0) <= 3").collect())))
    broken = {r.city_id: r.violations for r in landing.rejected_rows(spark, path, schema).collect()}
    assert broken == {None: ["city_id is null", "name longer than 50", "country longer than 3"], 3: ["name longer than 50"]}
    # one scan: the counts ride on the written plan
    marked, _ = D.enforce(df, D.limits(["city_id"], lengths))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    only_bad, counts = landing.replace_checked(df.where("city_id IS NULL"), path, ["city_id"])
    landing.point_table(spark, "default.only_bad", schema.replace("long", "bigint"), only_bad)
    assert counts["rejected"] == 1 and spark.table("default.only_bad").count() == 0
    spark.sql("DROP TABLE default.only_bad")
    clean, counts = landing.replace_checked(df.where("city_id = 1"), path, ["city_id"], lengths)
    assert counts["rejected"] == 0 and landing.rejected_rows(spark, path, schema).count() == 0
