"""Racing loads, customer parts, late addresses."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from daygrain.operators.versions import history
from daygrain.plans import warehouse
from daygrain.plans.warehouse import CUSTOMERS, LOG, Warehouse
from daygrain.sinks import files
from daygrain.sources import schemas
from tests.conftest import collected
from tests.test_warehouse import DAY1, DAY2, addresses, wh  # noqa: F401


def test_one_of_many_writers_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "state" / "1")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.create_text(spark, path, f"text of {k}"), range(8)))
    assert sum(won) == 1 and files.read_text(spark, path) == f"text of {won.index(True)}"
    assert files.children(spark, str(tmp_path / "state")) == ["1"]


def test_two_racing_loads_both_end_up_published(wh, monkeypatch):  # noqa: F811
    """The second load is published while the first one has its folders ready."""
    wh.stage(DAY1, [("ana", "07044", "guarulhos", "SP", DAY1)], [("m7", "ana", DAY1)])
    wh.stage(DAY2, [("bea", "88034", "lages", "SC", DAY2)], [("m8", "bea", DAY2)])
    prepare, other, runs = Warehouse._prepare, Warehouse(wh.spark, wh.folder), []

    def slow(self, day, gold_dir, number, before, run):
        ready = prepare(self, day, gold_dir, number, before, run)
        runs.append((day, run))
        if len(runs) == 1:
            other.load_day(DAY2, wh.gold)
        return ready

    monkeypatch.setattr(Warehouse, "_prepare", slow)
    wh.load_day(DAY1, wh.gold)
    assert [day for day, _ in runs] == [DAY1, DAY2, DAY1] and wh.manifests.numbers() == [1, 2]
    assert addresses(wh) == [("m7", "07044"), ("m8", "88034")]
    folders = [f for parts in wh.manifest().values() for f in parts.values()]
    assert any(runs[1][1] in f for f in folders) and any(runs[2][1] in f for f in folders)
    for table in wh.manifest():
        assert f"run={runs[0][1]}" not in files.children(wh.spark, files.join(wh.folder, table))


def test_load_of_one_person_leaves_other_parts(wh):  # noqa: F811
    people = [(f"p{k}", "07044", "guarulhos", "SP", DAY1) for k in range(60)]
    wh.stage(DAY1, people)
    wh.load_day(DAY1, wh.gold)
    before = wh.manifest()[CUSTOMERS]
    assert 10 < len(before) <= 16 and all(p.startswith("open-") for p in before)
    wh.stage(DAY2, [("p5", "88034", "lages", "SC", DAY2)])
    wh.load_day(DAY2, wh.gold)
    after = wh.manifest()[CUSTOMERS]
    changed = [p for p in before if after.get(p) != before[p]]
    added = [p for p in after if p not in before]
    assert len(changed) == len(added) == 1 and added[0].startswith(changed[0].replace("open", "closed"))
    dim = wh.read(CUSTOMERS)
    assert dim.count() == 61 and dim.where("is_current").count() == 60
    assert collected(dim.where("not is_current"), "customer_unique_id", "valid_to") == [("p5", dt.date(2018, 3, 9))]


def test_late_addresses_are_put_in_their_place(spark, wh, monkeypatch):  # noqa: F811
    """Days in any order give the versions of the days in order, and orders their version."""
    monkeypatch.setattr(warehouse, "FAN", 2)
    w = Warehouse(spark, wh.folder, backfill=True, buckets=2, grain="month")
    first, last = "2018-03-01", "2018-03-20"
    days = {
        first: [("ana", "01", "a", "SP", first), ("bea", "11", "b", "SP", first), ("eva", "21", "c", "SP", first)],
        last: [("ana", "02", "a", "SP", last), ("bea", "11", "b", "SP", last)],
        # Of bea the 20th told nothing new then; a move and a return on the 5th make it a version.
        "2018-03-05": [("ana", "03", "a", "RJ", "2018-03-05"), ("bea", "12", "b", "RJ", "2018-03-05")],
        "2018-03-12": [("ana", "01", "a", "SP", "2018-03-12")],
    }
    orders = {first: [("o0", "eva", "2018-03-02")], last: [("o1", "ana", "2018-03-15"), ("o2", "bea", "2018-03-15"), ("o3", "bea", last)]}
    for day, people in days.items():
        wh.stage(day, people, orders.get(day, ()))
        w.load_day(day, wh.gold)
    w.load_day(last, wh.gold)  # a repetition
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.GOLD["customer_feed"])
    feed = spark.createDataFrame([(*p[:4], dt.date.fromisoformat(p[4])) for rows in days.values() for p in rows], ddl)
    assert collected(w.read(CUSTOMERS)) == collected(history(feed).select(*w.read(CUSTOMERS).columns))
    assert addresses(w) == [("o0", "21"), ("o1", "01"), ("o2", "12"), ("o3", "11")]
    assert w.violations() == []
    parts = w.manifest()
    assert any(int(p.split("-")[3]) > 0 for p in parts[LOG]) and w.read(LOG, parts).count() == 10
    before = {t: collected(w.read(t)) for t in parts if t != LOG}
    assert w.vacuum() > 0 and w.manifests.numbers() == [5]
    assert {t: collected(w.read(t)) for t in before} == before
    assert w.vacuum() == 0
