import json

from daygrain.sources.ready import distinct_days, notice_keys, ready_days
from daygrain.streaming.arrivals import notices, run_ready_days
from tests.conftest import collected

KEYS = [
    "dt=2017-11-20/_READY", "dt%3D2017-11-21/_READY", "dt=2017-11-22/events/part-0.json.gz",
    "raw/dt=2017-11-23/_READY", "dt=2017-11-24/_READY.tmp", "dt=17-11-25/_READY",
]


def notice(*keys):
    return json.dumps({"Records": [{"s3": {"object": {"key": k}}} for k in keys]})


def test_only_markers_start_a_day(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "key string")
    assert collected(ready_days(df)) == [("2017-11-20",), ("2017-11-21",)]


def test_notices_hold_many_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(notice(*KEYS) + "\n" + notice(KEYS[0]) + "\n")
    df = spark.read.schema("Records array<struct<s3: struct<object: struct<key: string>>>>").json(
        str(tmp_path)
    )
    assert notice_keys(df).count() == 7
    assert ready_days(notice_keys(df)).count() == 2


def test_days_of_any_table_count(spark):
    a = spark.createDataFrame([("2017-11-20",)], "dt string")
    b = spark.createDataFrame([("2017-11-20",), ("2017-11-21",)], "dt string")
    assert collected(distinct_days([a, b])) == [("2017-11-20",), ("2017-11-21",)]


def test_stream_runs_each_new_day_once_in_order(spark, tmp_path):
    inbox, seen = tmp_path / "inbox", []
    inbox.mkdir()

    def run():
        query = run_ready_days(
            notices(spark, str(inbox)), lambda _, dt: seen.append(dt), str(tmp_path / "state")
        )
        query.awaitTermination()

    (inbox / "a.json").write_text(notice("dt=2017-11-21/_READY", "dt=2017-11-20/_READY"))
    run()
    assert seen == ["2017-11-20", "2017-11-21"]
    (inbox / "b.json").write_text(notice("dt=2017-11-22/_READY"))
    run()
    assert seen == ["2017-11-20", "2017-11-21", "2017-11-22"]
