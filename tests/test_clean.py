import json
import random
from collections import Counter

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.plans import clean, sessions, slices
from daygrain.plans.clean import columns_drift
from daygrain.sinks import files, partitions
from daygrain.sinks.watermark import Watermarks, advance, latest
from daygrain.sources import readers, schemas
from daygrain.sources.definitions import create_table, defined_tables, register_views
from tests.conftest import collected

DAY = "2017-06-14"
DAYS = ("2017-06-12", "2017-06-13", DAY)
KINDS = ("page_view", "add_to_cart", "checkout_start", "purchase")
ORDER_HEADER = ",".join(schemas.RAW["orders"].fieldNames())


def drop(seed, size=120, bad=0.2):
    """Events of one day: some ids repeat, some types are unknown, one line has no id. Times differ."""
    rnd = random.Random(seed)
    rows = []
    for k, minute in enumerate(rnd.sample(range(28 * 1440), size)):
        day, rest = divmod(minute, 1440)
        rows.append({
            "event_id": f"w{seed}-{rnd.randrange(size) if rnd.random() < bad else size + k}",
            "session_id": f"visit{rnd.randrange(9)}", "customer_unique_id": f"p{rnd.randrange(5)}",
            "product_id": rnd.choice(["lamp", None]),
            "event_type": "hover" if rnd.random() < bad / 2 else rnd.choice(KINDS),
            "event_ts": f"2017-06-{day + 1:02d}T{rest // 60:02d}:{rest % 60:02d}:00",
            "device": rnd.choice(["tablet", "desktop"]),
        })
    if bad:
        rows[size // 2]["event_id"] = None
    return rows


def judged(rows):
    """(accepted ids, rows per reason, rejected rows) by a loop over the rows in time order."""
    seen, good, reasons, rejected = set(), [], Counter(), 0
    for row in sorted(rows, key=lambda r: r["event_ts"]):
        found = []
        if row["event_id"] is None:
            found.append("null:event_id")
        if row["event_type"] not in KINDS:
            found.append("bad_value:event_type")
        if row["event_id"] in seen:
            found.append("duplicate:event_id")
        seen.add(row["event_id"])
        reasons.update(found)
        rejected += bool(found)
        if not found:
            good.append(row["event_id"])
    return sorted(good), dict(reasons), rejected


def ship(raw, dt, events, orders=0):
    folder = raw / f"dt={dt}"
    (folder / "events").mkdir(parents=True, exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    (folder / "events" / "part-0.json").write_text("\n".join(lines) + "\n")
    if orders:
        (folder / "orders").mkdir(exist_ok=True)
        rows = [f"q{k},buyer{k},invoiced,2017-06-{k + 1:02d} 08:30:00,,,,2017-07-02 00:00:00" for k in range(orders)]
        (folder / "orders" / "part-0.csv").write_text("\n".join([ORDER_HEADER, *rows]) + "\n")


@pytest.fixture
def lake(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "lake"

    def run(dt=DAY, **options):
        return {s["table"]: s for s in clean.run(spark, dt, str(raw), str(out), **options)}

    def ids(zone, table="events", key="event_id"):
        df = readers.read_partitions(spark, str(out / zone / table))
        return [] if df is None else sorted(r[0] or "" for r in df.select(key).collect())

    run.raw, run.out, run.ids = raw, out, ids
    return run


def test_day_equals_a_loop_however_often_it_runs(spark, lake, monkeypatch):
    """Counts are taken while writing: no cached table, and a repetition replaces what it wrote."""
    monkeypatch.setattr(DataFrame, "persist", None)
    rows = drop(1)
    good, reasons, rejected = judged(rows)
    assert set(reasons) == {"null:event_id", "bad_value:event_type", "duplicate:event_id"}
    ship(lake.raw, DAY, rows, orders=7)
    for moved in (True, False):
        done = lake()
        assert done["events"] == {
            "table": "events", "total": len(rows), "quarantined": rejected, "pct": round(100 * rejected / len(rows), 3),
            "by_reason": reasons, "clean": len(good), "warned": 0, "dups_dropped": 0, "watermark_moved": moved,
        }
        assert list(done["events"]["by_reason"]) == sorted(reasons, key=lambda r: (-reasons[r], r))
        assert lake.ids("clean") == good and len(lake.ids("quarantine")) == rejected
        assert done["orders"]["clean"] == len(lake.ids("clean", "orders", "order_id")) == 7
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_broken_lines_are_kept_with_their_text(spark, lake):
    rows = drop(2, 10, bad=0)
    torn = '{"event_id": "torn", "session'
    ship(lake.raw, DAY, [*rows, torn])
    assert lake()["events"]["clean"] == 10
    row = readers.read_partitions(spark, str(lake.out / "quarantine" / "events")).first()
    assert row["dq_reason"].startswith("corrupt_record") and row["_corrupt_record"] == torn


def test_second_shipment_replaces_the_first(lake):
    """The better drop has no bad row: what the worse one left in quarantine goes with its folder."""
    for seed, bad in ((3, 0.5), (4, 0.0), (5, 0.3)):
        rows = drop(seed, 40, bad)
        ship(lake.raw, DAY, rows)
        lake()
        good, _, rejected = judged(rows)
        assert lake.ids("clean") == good and len(lake.ids("quarantine")) == rejected
        assert (lake.out / "quarantine" / "events" / f"ingest_dt={DAY}").exists() == bool(rejected)


def test_rows_stay_with_the_day_they_arrived_on(spark, lake):
    """Event times spread over the month; the folder is the arrival day's all the same."""
    arrived = {dt: drop(10 + k, 30) for k, dt in enumerate(DAYS)}
    for dt, rows in arrived.items():
        ship(lake.raw, dt, rows)
        lake(dt)
    zone, so_far = str(lake.out / "clean"), 0
    for dt, rows in arrived.items():
        good = judged(rows)[0]
        so_far += len(good)
        assert collected(readers.read_day(spark, zone, "events", dt), "event_id") == [(i,) for i in good]
        assert readers.read_events_upto(spark, zone, dt).count() == so_far
    assert readers.read_events_upto(spark, zone, "2017-06-15") is None


@pytest.mark.parametrize("broken", ["clean", "quarantine"])
def test_nothing_counts_as_done_after_half_a_run(spark, lake, monkeypatch, broken):
    ship(lake.raw, DAY, drop(6, 20))
    marks, write = Watermarks(spark, str(lake.out / "marks")), clean.write_partition

    def failing(df, base, dt):
        if f"/{broken}/" in base:
            raise OSError("no space left")
        return write(df, base, dt)

    indexed = lake.out / "clean" / sessions.INDEX / sessions.MARKERS / DAY
    for attempt in (failing, write, failing):
        monkeypatch.setattr(clean, "write_partition", attempt)
        if attempt is failing:
            before = marks.get("events")
            with pytest.raises(OSError):
                lake(watermarks=marks, tables=["events"])
            assert marks.get("events") == before and not indexed.exists()
        else:
            lake(watermarks=marks, tables=["events"])
            assert marks.get("events") == DAY and indexed.exists()


def test_watermark_never_moves_back(spark, tmp_path):
    marks = Watermarks(spark, str(tmp_path / "marks"))
    assert advance(marks, "events", "2017-11-25")
    assert not advance(marks, "events", "2017-11-24")
    assert marks.get("events") == "2017-11-25"
    log = spark.createDataFrame([("a", "2017-01-01"), ("a", "2017-01-03")], "table string, dt string")
    assert collected(latest(log)) == [("a", "2017-01-03")]


def test_reviews_are_kept_once_per_order(spark, lake):
    folder = lake.raw / f"dt={DAY}" / "order_reviews"
    folder.mkdir(parents=True)
    header = ",".join(schemas.RAW["order_reviews"].fieldNames())
    stamp = "2017-06-14 00:00:00,2017-06-15 00:00:00"
    (folder / "part-0.csv").write_text(
        f'{header}\nr1,o1,5,t,"two\nlines, ""quoted""",{stamp}\nr1,o1,5,t,again,{stamp}\n'
        f"r1,o2,4,,,{stamp}\nr2,o3,9,,,{stamp}\n"
    )
    done = lake()["order_reviews"]
    assert (done["total"], done["quarantined"], done["clean"], done["dups_dropped"]) == (4, 1, 2, 1)


def test_columns_out_of_order_are_refused(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_city,seller_id,seller_zip_code_prefix,seller_state\nrio,s1,1046,RJ\n")
    with pytest.raises(Exception, match="header"):
        readers.read_table(spark, "sellers", str(path)).collect()
    shifted = readers.read_table(spark, "sellers", str(path), strict_header=False).first()
    assert shifted["seller_id"] == "rio"


def test_cells_that_do_not_fit_become_null(spark, tmp_path):
    path = tmp_path / "pay.csv"
    path.write_text(",".join(schemas.RAW["order_payments"].fieldNames()) + "\no1,one,voucher,2,x\n")
    row = readers.read_table(spark, "order_payments", str(path)).first()
    assert tuple(row) == ("o1", None, "voucher", 2, None)
    text = readers.read_text_table(spark, "order_payments", str(path)).first()
    assert tuple(text) == ("o1", "one", "voucher", "2", "x")
    assert dict(readers.read_inferred(spark, str(path)).dtypes)["payment_installments"] == "int"


def test_empty_write_removes_only_its_partition(spark, tmp_path):
    base = str(tmp_path / "t")
    one = spark.range(1)
    for dt in ("2017-11-2", "2017-11-24"):
        partitions.write_partition(one, base, dt)
    assert partitions.write_partition(one.where("id < 0"), base, "2017-11-2") == 0
    assert files.children(spark, base) == ["ingest_dt=2017-11-24"]
    assert partitions.write_partition(one.limit(0), base, "2017-11-24") == 0
    assert files.children(spark, base) == []
    assert readers.read_partitions(spark, base) is None


def test_file_system_root_is_safe(spark):
    with pytest.raises(ValueError):
        files.delete_folder(spark, "file:///")


def test_definitions_follow_the_schemas(spark, lake):
    rows = drop(7, 12)
    ship(lake.raw, DAY, rows, orders=1)
    lake()
    rules = {"events": {}, "orders": {}}
    assert defined_tables("quarantine", rules) == ["orders", "events"]
    assert len(defined_tables("clean", rules)) == 9
    ddl = create_table("events", "quarantine", "/lake/quarantine", rules)
    assert "`event_ts` timestamp" in ddl and "`dq_reason` string" in ddl
    assert "PARTITIONED BY (ingest_dt)" in ddl and "'/lake/quarantine/events'" in ddl
    made = register_views(spark, str(lake.out / "clean"), "clean", rules)
    assert sorted(made) == ["clean_events", "clean_orders"]
    query = f"SELECT event_id, dq_warn FROM clean_events WHERE ingest_dt = '{DAY}'"
    assert collected(spark.sql(query)) == [(i, "") for i in judged(rows)[0]]


def test_drift_between_declared_and_observed(spark):
    observed = spark.createDataFrame([("s", 1, "x")], "seller_id string, seller_city int, extra string")
    drift = collected(columns_drift(observed, "sellers").where("drift != ''"), "column", "drift")
    assert drift == [
        ("extra", "unexpected"), ("seller_city", "type"), ("seller_state", "missing"),
        ("seller_zip_code_prefix", "missing"),
    ]


def test_slices_go_to_their_day(spark, frame, tmp_path):
    def table(name, rows):
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW[name])
        return frame(rows, ddl)

    stamp = "2017-11-20 23:59:59"
    source = {
        "orders": table("orders", [
            ("o1", "c1", "shipped", stamp, None, None, None, None),
            ("o2", "c2", "shipped", "2017-12-05 00:00:00", None, None, None, None)]),
        "order_items": table("order_items", [("o1", 1, "p", "s", None, 1, 1),
                                             ("o2", 1, "p", "s", None, 1, 1)]),
        "order_payments": table("order_payments", [("o1", 1, "voucher", 1, 2)]),
        "order_reviews": table("order_reviews", [
            ("r1", "o1", 5, None, None, "2017-11-21", None),
            ("r2", "o1", 5, None, None, "2017-12-24", None),
            ("r3", "o2", 5, None, None, "2017-11-21", None)]),
        "customer_snapshots": table("customer_snapshots", [("c1", "u1", "1", "x", "SP", None),
                                                           ("c2", "u2", "1", "x", "SP", None)]),
        "products": table("products", [("p", None, 1, 1, 1, 1, 1, 1, 1)]),
        "sellers": table("sellers", [("s", "1", "x", "SP")]),
        "product_category_name_translation": table("product_category_name_translation", [("a", "b")]),
    }
    cut = slices.slice_tables(source, "2017-11-20", "2017-11-30")
    days = {name: [r["dt"] for r in df.collect()] for name, df in cut.items()}
    assert days == {
        "orders": ["2017-11-20"], "order_items": ["2017-11-20"], "order_payments": ["2017-11-20"],
        "order_reviews": ["2017-11-21"], "customer_snapshots": ["2017-11-20"],
        "products": ["2017-11-20"], "sellers": ["2017-11-20"],
        "product_category_name_translation": ["2017-11-20"],
    }
    slices.ship(cut, str(tmp_path))
    back = readers.read_table(spark, "customer_snapshots",
                              str(tmp_path / "customer_snapshots" / "dt=2017-11-20"))
    assert tuple(back.first()) == ("c1", "u1", "1", "x", "SP", "2017-11-20")
    assert cut["orders"].where(F.col("dt") == "2017-11-20").count() == 1
