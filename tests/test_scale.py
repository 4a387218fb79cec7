"""What a query builds and moves: only the tables it reads, and rows that travel once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain.operators.versions import SURROGATE, as_of, history
from daygrain.plans import reconcile
from daygrain.registry import reports, runs, star
from daygrain.registry.invariants import _both
from daygrain.registry.star import Star
from daygrain.sinks import files

FEED = "customer_unique_id string, zip string, city string, state string, effective_date date"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def shop(spark, tmp_path, frame):
    """Tables of our own: six orders of two people, two lines each, one event."""

    def put(name, rows, ddl):
        frame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("region", [(0, "R")], "r_regionkey int, r_name string")
    put("nation", [(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(k, f"C{k}", 0, 1.5, "AUTO") for k in (1, 2)],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("supplier", [(1, "S", 0, 2.5)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    put("part", [(k, "nut", "Brand#1", "SMALL", 5, 9.0) for k in (1, 2)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("orders", [(k, k % 2 + 1, "O", 10.0, f"199{k}-05-0{k} 00:00:00", "5-LOW") for k in range(1, 7)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
        " o_orderpriority string")
    put("lineitem", [(k, n, 1, n, 2.0, 8.0, 0.02, 0.01, "A", "O", "1999-01-01 00:00:00")
                     for k in range(1, 7) for n in (1, 2)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp")
    put("events", [(1, "2024-01-05 10:00:00", 1, "view", 1.0, '{"k": 9}')],
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    return Star(spark, str(tmp_path))


def built(shop):
    return {key[3] for key in star._WRITTEN if key[1] == shop.folder}


def test_a_check_builds_only_the_tables_it_reads(shop):
    none = shop.fact_orders.where("false")
    got = {(r["dataset"], r["violations"]) for r in _both(shop, "v9", fact_orders=none).collect()}
    assert got == {("built", 0), ("planted", 12)}
    assert {"fact_orders", "fact_order_items"} <= built(shop)
    assert not {"fact_sessions", "clean_events", "dim_product", "dim_seller", "dim_date"} & built(shop)
    assert len({**shop.warehouse}) == 7


def test_a_single_table_is_shipped_alone_and_once(spark, shop):
    path = runs.ship(shop, "order_items")
    assert files.children(spark, files.join(path, f"dt={runs.DAY}")) == ["order_items"]
    at = files.join(path, f"dt={runs.DAY}", "order_items")
    before = files.children(spark, at)
    assert runs.ship(shop) == path and files.children(spark, at) == before
    assert len(files.children(spark, files.join(path, f"dt={runs.DAY}"))) == 8
    assert runs.drift(shop).count() == 3


def test_lines_of_an_order_lie_together(shop):
    lines = shop.order_items.withColumn("at", F.spark_partition_id())
    per_order = lines.groupBy("order_id").agg(F.count_distinct("at").alias("parts"), F.count("*").alias("n"))
    assert [(r["parts"], r["n"]) for r in per_order.collect()] == [(1, 2)] * 6
    exchanges = [line for line in executed(shop.order_items).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "l_linenumber" not in exchanges[0]


def test_facts_are_not_joined_with_what_was_found_for_them(spark):
    """Half of the facts are one person's; some have no person, some no date, some are repeated."""
    day = lambda n: dt.date(2017, 3, 1) + dt.timedelta(days=n)
    feed = [(p, z, "c", "s", day(n)) for p in ("hot", "cold") for n, z in ((2, "1"), (6, "2"), (9, None))]
    dim = history(spark.createDataFrame(feed, FEED))
    facts = spark.range(6000, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, "cold")
        .when(F.col("id") % 8 == 3, F.concat(F.lit("p"), "id")).alias("customer_unique_id"),
        F.when(F.col("id") % 11 != 0, F.date_add(F.lit(day(0)), (F.col("id") % 12).cast("int"))).alias("on_day"),
    )
    facts = facts.unionByName(facts.where("id < 40"))
    key = {(r["customer_unique_id"], r["valid_from"]): r[SURROGATE] for r in dim.collect()}
    got = as_of(facts, dim, "on_day", ["zip", SURROGATE])
    assert got.columns == ["id", "customer_unique_id", "on_day", "zip", SURROGATE]
    want = []
    for i, p, d in [tuple(r) for r in facts.collect()]:
        start = max((s for s in (day(2), day(6), day(9)) if d and s <= d), default=None)
        known = p in ("hot", "cold") and start is not None
        want.append((i, p, d, {day(2): "1", day(6): "2"}.get(start) if known else None, key[p, start] if known else None))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("on_day" in j for j in joins)


def test_rows_of_equal_buckets_are_not_shuffled(spark):
    """Also where the buckets look too many to be broadcast without being told."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    a = spark.range(20000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    b = a.withColumn("v", F.when(F.col("k") == 77, "y").otherwise(F.col("v")))
    try:
        found = reconcile.row_difference(a, b, ["k"])
        assert [(r["k"], r["kind"], r["columns"]) for r in found.collect()] == [(77, "changed", ["v"])]
        semi = [line for line in executed(found).splitlines() if "LeftSemi" in line]
    finally:
        spark.conf.set(threshold, before)
    assert semi and all("BroadcastHashJoin" in line for line in semi)


def test_revenue_moves_lines_only_to_their_product(spark, shop):
    """Tables by order are stored so that sums and joins per order move nothing, and no row travels with
    its version key but one per order."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    shop.fact_items, shop.gold_orders, shop.dim_product, shop.dim_customer
    spark.conf.set(threshold, "-1")
    try:
        found = reports.revenue(shop)
        moved = [line for line in executed(found).splitlines() if "Exchange hashpartitioning" in line]
        got = [tuple(r) for r in found.select("category", "customer_state", "orders", "revenue", "freight").collect()]
    finally:
        spark.conf.set(threshold, before)
    assert [(c, s, n, float(r), float(f)) for c, s, n, r, f in got] == [("small", "5-LOW", 6, 96.0, 0.96)]
    assert not any("price" in line or "product_id" in line and "order_id" in line for line in moved)
    # Versions to the customers, customers to them, both back; lines and products to each other; two sums.
    assert len(moved) <= 7
    assert sum(SURROGATE in line for line in moved) == 2
