import pytest
from conftest import tuples
from pyspark.sql import functions as F, types as T

from rushcart.sources.folders import intermediates, stored, work_folder
from rushcart.sources.samples import SAMPLES, read_points, read_samples, samples_from_events, write_samples


def test_bad_json_goes_to_the_second_frame(spark, tmp_path):
    good_row = '{"version":"V1","route":1,"ts":"2024-01-01T00:00:00","latency_ms":1.5,"is_error":false}'
    (tmp_path / "a.json").write_text(
        "\n".join(
            [
                good_row,
                good_row.replace('"V1"', '"V2"').replace(',"is_error":false', ""),
                good_row.replace('"route":1,', ""),
                good_row.replace("1.5", '"fast"'),
                good_row[:40],
                good_row.replace('"is_error":false', '"is_error":"maybe"'),
            ]
        )
    )
    good, bad = read_samples(spark, str(tmp_path), "json")
    assert tuples(good, "version", "latency_ms", "is_error") == [("V1", 1.5, False), ("V2", 1.5, None)]
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed"] * 3 + ["missing route"]
    # the verdict does not depend on the columns a query happens to use
    assert good.count() == 2 and bad.count() == 4
    assert good.select("version").count() == 2 and bad.select("reason").count() == 4


def test_bad_csv_goes_to_the_second_frame(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "version,route,ts,latency_ms,is_error\n"
        "V1,1,2024-01-01T00:00:00,1.5,false\n"
        "V1,,2024-01-01T00:00:00,1.5,false\n"
        "V1,1,2024-01-01T00:00:00,fast,false\n"
        "V1,1,2024-01-01T00:00:00,1.5,maybe\n"
        "V1,1,2024-01\n"
    )
    good, bad = read_samples(spark, str(tmp_path), "csv")
    assert tuples(good, "version", "route", "latency_ms") == [("V1", 1, 1.5)]
    assert good.count() == 1 and bad.count() == 4
    assert good.select("version").count() == 1 and bad.select("reason").count() == 4


def test_csv_columns_stand_as_the_header_says(spark, tmp_path):
    (tmp_path / "a.csv").write_text("host,latency_ms,route,version,is_error,ts\nh,1.5,7,V1,true,2024-01-01T00:00:00\nh,x,7,V1,true,2024-01-01T00:00:00\n")
    good, bad = read_samples(spark, str(tmp_path), "csv")
    assert tuples(good, "version", "route", "latency_ms", "is_error") == [("V1", 7, 1.5, True)]
    assert bad.count() == 1
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.csv").write_text("V1,7,2024-01-01T00:00:00,1.5,true\n")
    good, bad = read_samples(spark, str(tmp_path / "b"), "csv")
    assert tuples(good, "version", "route", "latency_ms") == [("V1", 7, 1.5)] and bad.count() == 0


def test_points_of_the_load_tool_become_samples(spark, tmp_path):
    point = '{"metric":"http_req_duration","type":"Point","data":{"time":"2024-01-01T09:00:00.25+09:00","value":12.5,"tags":{"name":"/buy","version":"V2","status":"%s"%s}}}'
    (tmp_path / "a.json").write_text(
        "\n".join(
            [
                '{"type":"Metric","data":{"name":"http_req_duration","type":"trend"},"metric":"http_req_duration"}',
                point % (200, ""), point % (503, ""), point % (0, ""), point % (404, ',"expected_response":"true"'),
                point.replace("http_req_duration", "http_reqs") % (200, ""),
                point.replace('"version":"V2",', "") % (200, ""),
                (point % (200, ""))[:60],
            ]
        )
    )
    good, bad = read_points(spark, str(tmp_path))
    assert tuples(good, "version", "route", F.col("ts").cast("string"), "latency_ms", "is_error") == [
        ("V2", "/buy", "2024-01-01 00:00:00.25", 12.5, False),
        ("V2", "/buy", "2024-01-01 00:00:00.25", 12.5, False),
        ("V2", "/buy", "2024-01-01 00:00:00.25", 12.5, True),
        ("V2", "/buy", "2024-01-01 00:00:00.25", 12.5, True),
    ]
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "missing version"]


def test_parquet_rows_without_required_values_are_bad(spark, samples, tmp_path):
    path = str(tmp_path / "s")
    samples([("V1", 1, 0, 1.0, None), ("V1", 1, 0, None, True)]).write.parquet(path)
    good, bad = read_samples(spark, path, "parquet")
    assert tuples(good, "latency_ms") == [(1.0,)]
    assert tuples(bad, "reason") == [("missing latency_ms",)]


def test_runs_add_up_and_a_named_run_is_replaced_alone(spark, samples, tmp_path):
    path, day = str(tmp_path / "s"), 86_400
    write_samples(samples([("V1", 1, 0, 1.0, False), ("V2", 1, 0, 2.0, False), ("V2", 1, day, 3.0, False)]), path)
    write_samples(samples([("V2", 1, day, 4.0, False)]), path, "late")
    back = spark.read.parquet(path)
    assert tuples(back, "version", "latency_ms") == [("V1", 1.0), ("V2", 2.0), ("V2", 3.0), ("V2", 4.0)]
    write_samples(samples([("V2", 1, day, 5.0, False)]), path, "late")
    back = spark.read.parquet(path)
    assert tuples(back, "version", "latency_ms") == [("V1", 1.0), ("V2", 2.0), ("V2", 3.0), ("V2", 5.0)]
    some = back.where("version = 'V2' AND day = DATE'2024-01-02'")
    assert tuples(some, "latency_ms") == [(3.0,), (5.0,)]
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in text


def test_unreadable_props_give_nulls(spark):
    rows = [(1, None, 1, "error", 1.0, '{"k": 7}'), (2, None, 1, "view", 1.0, '{"k": "x"}'), (3, None, 1, "view", 1.0, "{")]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    assert tuples(samples_from_events(df), "version", "route", "is_error") == [
        ("V4", 1, True),
        (None, None, False),
        (None, None, False),
    ]


def test_work_goes_to_the_folder_the_session_names(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(shared)
    assert stored(spark.range(3), "three").inputFiles()[0].startswith(f"file://{shared}")


def test_intermediates_go_with_their_block(spark, tmp_path):
    import os

    before = stored(spark.range(2), "kept")
    with intermediates(spark):
        inner = stored(spark.range(3), "gone")
        inner.write.parquet(str(tmp_path / "result"))
        path = inner.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    assert before.count() == 2 and spark.read.parquet(str(tmp_path / "result")).count() == 3


@pytest.mark.parametrize("where", ["spark://somewhere:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_that_setting_is_refused(where):
    class Context:
        master = where

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session(), "x")


def test_schema_declares_what_must_be_there():
    assert [f.name for f in SAMPLES if not f.nullable] == ["version", "route", "ts", "latency_ms"]
    assert isinstance(SAMPLES["latency_ms"].dataType, T.DoubleType)


def test_each_csv_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('version,route,ts,latency_ms,is_error\nV1,1,2024-01-01 00:00:00,1.5,false\nbad,x\n')
    (tmp_path / "b.csv").write_text('"is_error", "latency_ms","extra","route","ts","version"\ntrue,2.5,zz,2,2024-01-02 00:00:00,V2\n')
    (tmp_path / "c.csv").write_text("V3,3,2024-01-03 00:00:00,3.5,true\n\nV3,4,2024-01-03 00:00:00,4.5,true\n")
    (tmp_path / "d.csv").write_text("version,route,ts,latency_ms,is_error\n")
    good, bad = read_samples(spark, str(tmp_path), "csv")
    assert tuples(good, "version", "route", "latency_ms", "is_error") == [
        ("V1", 1, 1.5, False), ("V2", 2, 2.5, True), ("V3", 3, 3.5, True), ("V3", 4, 4.5, True),
    ]
    assert tuples(bad, "reason", "malformed_record") == [("malformed", "bad,x")]


def test_a_header_is_found_in_files_of_many_blocks(spark, tmp_path):
    rows = "".join(f"{i}.5,V1,2024-01-01 00:00:00,{i},false\n" for i in range(5_000))
    (tmp_path / "a.csv").write_text("latency_ms,version,ts,route,is_error\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        good, bad = read_samples(spark, str(tmp_path), "csv")
        assert good.where("latency_ms = route + 0.5").count() == 5_000 and bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
