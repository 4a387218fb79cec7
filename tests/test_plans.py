"""What the physical plans have to look like for the work to hold at scale."""

import pytest
from pyspark.sql import functions as F

from daygrain.operators.lookup import HOT_KEYS, attach, hot_keys
from daygrain.plans import gold, kpi
from daygrain.session import shared_dir
from daygrain.sinks.partitions import overwrite_partitions
from daygrain.sources.readers import read_events_upto


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("event_id"),
        (F.col("id") % 50).cast("string").alias("session_id"),
        F.lit("u").alias("customer_unique_id"),
        F.lit("page_view").alias("event_type"),
        F.lit("2017-11-20 10:00:00").cast("timestamp").alias("event_ts"),
        F.lit("mobile").alias("device"),
        F.lit("unused").alias("wide"),
        F.concat(F.lit("2017-11-2"), (F.col("id") % 5).cast("string")).alias("ingest_dt"),
    )
    base = str(tmp_path / "clean")
    overwrite_partitions(df, f"{base}/events", "ingest_dt")
    return base


def test_later_days_are_not_read(spark, events):
    plan = executed(read_events_upto(spark, events, "2017-11-21"))
    assert "PartitionFilters: [isnotnull(ingest_dt" in plan
    assert "2017-11-21" in plan or "17491" in plan


def test_one_day_and_one_device_reach_the_scan(spark, events):
    df = read_events_upto(spark, events, "2017-11-23")
    day = executed(kpi.events_by_type(df, "2017-11-21"))
    assert "ReadSchema: struct<event_type:string>" in day
    mobile = executed(kpi.device_events_per_day(df))
    assert "PushedFilters: [IsNotNull(device), EqualTo(device,mobile)]" in mobile


def test_sessions_read_no_unused_column(spark, events):
    plan = executed(gold.build_sessions(read_events_upto(spark, events, "2017-11-23")))
    assert "wide" not in plan and "WindowGroupLimit" in plan


def test_no_plan_runs_python_or_a_cross_join(spark, events):
    df = read_events_upto(spark, events, "2017-11-23")
    plan = executed(kpi.funnel(gold.build_sessions(df, "2017-11-23")))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoop"):
        assert operator not in plan


def test_hot_keys_and_missing_keys_are_spread(spark):
    """Half of the facts have one key, a quarter none: neither meets in one join partition."""
    facts = spark.range(40000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "hot")
        .when(F.col("id") % 4 == 1, F.col("id").cast("string"))
        .alias("k"),
        F.col("id").alias("v"),
    )
    # Aggregated by the key, as most lookups are: Spark's own skew join would not apply.
    lookup = facts.where("k is not null").groupBy("k").agg(F.min("v").alias("first"))
    lookup = lookup.where("first != 1")
    joined = attach(facts, lookup, ["k"])
    assert joined.columns == ["k", "v", "first"] and joined.count() == 40000
    assert joined.where("k = 'hot' and first = 0").count() == 20000
    assert joined.where("k is null and first is null").count() == 10000
    assert joined.where("k != 'hot' and first = v").count() == 9999
    assert attach(facts, lookup, ["k"], "inner").count() == 29999
    plan = executed(joined)
    assert "BroadcastHashJoin [k#" in plan and "_lane#" in plan


def test_hot_keys_are_few_whatever_the_data(spark):
    same = spark.range(5000).select(F.lit("k").alias("k"), F.lit(1).alias("n"))
    all_different = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert hot_keys(same.groupBy("k").agg(F.sum("n").alias("n")), "n").count() == 1
    assert hot_keys(all_different, "n").count() == 0
    few = spark.range(HOT_KEYS - 1).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert hot_keys(few, "n").count() < HOT_KEYS


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second
