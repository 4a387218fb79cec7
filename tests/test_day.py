"""Two days from raw files to the published warehouse and its reports."""

import json
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daygrain.operators.versions import SURROGATE
from daygrain.plans import clean, gold, kpi
from daygrain.plans.warehouse import Warehouse
from daygrain.sources import schemas
from daygrain.sources.readers import read_gold_day
from tests.conftest import collected

D1, D2, D3 = "2017-11-24", "2017-11-25", "2017-11-26"


def event(n, session, kind, at):
    return {"event_id": f"e{n}", "session_id": session, "customer_unique_id": "u1",
            "product_id": "p1", "event_type": kind, "event_ts": at, "device": "mobile"}


def order(n, customer, day, status="delivered", delivered="2017-12-01 00:00:00"):
    return f"o{n},{customer},{status},{day} 12:00:00,,,{delivered},2017-12-05 00:00:00"


RAW = {
    D1: {
        "events": [event(1, "s1", "page_view", f"{D1}T10:00:00"),
                   event(1, "s1", "page_view", f"{D1}T10:00:00"),
                   event(2, "s2", "add_to_cart", f"{D1}T11:00:00")],
        # o3 was delivered without a date: quarantined, and its item is dropped.
        "orders": [order(1, "c1", D1), order(3, "c3", D1, delivered="")],
        "order_items": ["o1,1,p1,s1,,10.00,1.50", "o1,2,p2,s1,,5.50,0.50", "o3,1,p1,s1,,9.00,1.00"],
        "order_payments": ["o1,1,voucher,1,10.00", "o1,2,credit_card,1,7.50", "o3,1,boleto,1,10"],
        "customer_snapshots": [f"c1,u1,1046,sao paulo,SP,{D1}", f"c3,u3,1,x,RJ,{D1}"],
        "products": ["p1,brinquedos,1,1,1,500,1,1,1", "p2,,1,1,1,1,1,1,1"],
        "product_category_name_translation": ["brinquedos,toys"],
        "sellers": ["s1,1000,sao paulo,SP"],
    },
    D2: {
        "events": [event(3, "s2", "purchase", f"{D1}T23:50:00")],  # late
        "orders": [order(2, "c2", D2, delivered="2017-12-24 00:00:00")],
        "order_items": ["o2,1,p1,s1,,20.00,2.00"],
        "order_payments": ["o2,1,boleto,1,22.00"],
        "customer_snapshots": [f"c2,u1,20000,rio,RJ,{D2}"],
    },
    D3: {"events": [event(4, "s3", "page_view", f"{D3}T10:00:00")]},
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    for day, tables in RAW.items():
        for name, rows in tables.items():
            folder = base / "raw" / f"dt={day}" / name
            folder.mkdir(parents=True)
            if name == "events":
                (folder / "part-0.json").write_text("\n".join(map(json.dumps, rows)) + "\n")
            else:
                header = ",".join(schemas.RAW[name].fieldNames())
                (folder / "part-0.csv").write_text("\n".join([header, *rows]) + "\n")
    counts = {}
    for day in RAW:
        clean.run(spark, day, str(base / "raw"), str(base))
        counts[day] = gold.run(spark, day, str(base / "clean"), str(base / "gold"))
    warehouse = Warehouse(spark, str(base / "warehouse"))
    assert warehouse.load_all(str(base / "gold")) == [D1, D2, D3]
    return base, counts, warehouse


def test_gold_rows_of_each_day(lake):
    _, counts, _ = lake
    assert counts[D1] == {
        "dim_product": 2, "dim_seller": 1, "customer_feed": 1, "fact_orders": 1,
        "fact_order_items": 2, "fact_sessions": 2, "items_without_order": 1,
    }
    assert counts[D2]["fact_sessions"] == 1 and counts[D2]["dim_product"] == 0
    assert counts[D3] == {**dict.fromkeys(schemas.GOLD, 0), "fact_sessions": 1}


@pytest.mark.parametrize("table, column", [
    ("clean/orders", "order_purchase_timestamp"),
    ("gold/fact_orders", "purchase_ts"),
    ("warehouse/fact_orders", "purchase_ts"),
])
def test_stored_timestamps_are_in_milliseconds(spark, lake, table, column):
    file = next((lake[0] / table).rglob("*.parquet"))
    assert "timestamp[ms" in str(pq.read_schema(file).field(column).type)
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") != "TIMESTAMP_MILLIS"


def test_reports_on_the_published_tables(lake):
    wh = lake[2]
    t = wh.tables()
    assert collected(t["dim_customer"], "zip", "is_current") == [("01046", False), ("20000", True)]
    funnel = kpi.funnel(t["fact_sessions"]).collect()
    assert [(str(r["session_date"]), r["sessions"], r["purchased"]) for r in funnel] == [
        (D1, 2, 1), (D3, 1, 0)
    ]
    revenue = kpi.revenue_by_category_and_state(
        t["fact_order_items"], t["fact_orders"], t["dim_product"], t["dim_customer"]
    ).collect()
    assert [(r["category"], r["customer_state"], r["orders"], float(r["revenue"]))
            for r in revenue] == [("toys", "RJ", 1, 20.0), ("toys", "SP", 1, 10.0),
                                  ("unknown", "SP", 1, 5.5)]
    on_time = kpi.on_time(t["fact_orders"]).collect()
    assert [(str(r["order_date"]), r["on_time_pct"]) for r in on_time] == [(D1, 100.0), (D2, 0.0)]
    late = kpi.seller_totals(t["fact_order_items"], t["fact_orders"], min_orders=2).first()
    assert (late["orders"], float(late["revenue"]), late["late_pct"]) == (2, 35.5, 50.0)
    assert t["fact_orders"].where(f"{SURROGATE} is null").count() == 0


def test_cleaning_and_loading_again_changes_nothing(spark, lake):
    base, counts, wh = lake
    before = {n: collected(wh.read(n)) for n in ("dim_customer", "fact_orders", "fact_sessions")}
    clean.run(spark, D2, str(base / "raw"), str(base))
    assert gold.run(spark, D2, str(base / "clean"), str(base / "gold")) == counts[D2]
    wh.load_day(D2, str(base / "gold"))
    assert {n: collected(wh.read(n)) for n in before} == before


def test_a_query_leaves_no_shuffle_files(spark):
    """what queries had shuffled stayed on disk until the driver collected its garbage."""

    def left() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for k in range(found.size()) if (n := found.apply(k).getName()).startswith("shuffle_")}

    before = left()
    held = [spark.range(1000).groupBy((F.col("id") % (7 + k)).alias("k")).count() for k in range(3)]
    assert [len(df.collect()) for df in held] == [7, 8, 9]
    deadline = time.monotonic() + 20
    while (still := left() - before) and time.monotonic() < deadline:
        time.sleep(0.1)
    assert still == set()
    # A frame that is asked again shuffles again.
    assert [len(df.collect()) for df in held] == [7, 8, 9]


def test_orders_are_linked_with_their_person_once(spark, lake, tmp_path, monkeypatch):
    """the gold run looked up the person of each order for both facts; zones are packed by zstd."""
    base, counts, _ = lake
    calls, attach = [], gold.attach_customer
    monkeypatch.setattr(gold, "attach_customer", lambda *a: calls.append(1) or attach(*a))
    assert gold.run(spark, D1, str(base / "clean"), str(tmp_path)) == counts[D1]
    assert len(calls) == 1
    rows = [read_gold_day(spark, at, "fact_order_items", D1) for at in (str(tmp_path), str(base / "gold"))]
    assert collected(rows[0]) == collected(rows[1]) and rows[0].count() == 2
    for zone in ("clean/orders", "quarantine", "gold/fact_orders", "warehouse/dim_customer", "warehouse/fact_orders"):
        assert all(".zstd." in f.name for f in (base / zone).rglob("*.parquet"))
    assert any((base / "clean").rglob("*.parquet"))
