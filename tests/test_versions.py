import datetime as dt
import random

from pyspark.sql import functions as F

from daygrain.operators.merge import upsert
from daygrain.operators.versions import SURROGATE, apply_feed, as_of, history
from daygrain.plans.checks import overlapping_ranges, violations
from daygrain.plans.warehouse import DIM_CUSTOMER
from tests.conftest import collected

FEED = "customer_unique_id string, zip string, city string, state string, effective_date date"


def day(n):
    return dt.date(2017, 11, 1) + dt.timedelta(days=n)


def replay(days):
    """The same history in plain Python."""
    dim = []
    for feed in days:
        for person, address, at in feed:
            now = next((v for v in dim if v["p"] == person and v["to"] is None), None)
            if now and now["a"] != address and at > now["from"]:
                now["to"], now = at, None
            elif now:
                continue
            if now is None:
                dim.append({"p": person, "a": address, "from": at, "to": None})
    return sorted(((v["p"], v["a"], v["from"], v["to"]) for v in dim), key=str)


def versions(df):
    rows = (
        (r["customer_unique_id"], (r["zip"], r["city"], r["state"]), r["valid_from"], r["valid_to"])
        for r in df.collect()
    )
    return sorted(rows, key=str)


def feed_of(spark, rows):
    return spark.createDataFrame([(p, *a, d) for p, a, d in rows], FEED)


def random_days(rnd, n_days=8, people=12):
    addresses = [("1", "a", "SP"), ("1", None, "SP"), ("2", "b", "RJ"), (None, None, None)]
    return [
        [(f"u{p}", rnd.choice(addresses), day(n)) for p in range(people) if rnd.random() < 0.6]
        for n in range(n_days)
    ]


def test_history_equals_replaying_the_days(spark):
    days = random_days(random.Random(5))
    dim = spark.createDataFrame([], DIM_CUSTOMER)
    for feed in days:
        dim = apply_feed(dim, feed_of(spark, feed))
    batch = history(feed_of(spark, [r for feed in days for r in feed]))
    assert versions(dim) == versions(batch) == replay(days)
    assert collected(dim, SURROGATE) == collected(batch, SURROGATE)


def test_old_repeated_and_same_day_snapshots_change_nothing(spark):
    first = [("u1", ("1", "a", "SP"), day(3))]
    dim = apply_feed(spark.createDataFrame([], DIM_CUSTOMER), feed_of(spark, first))
    for rows in (
        first,
        [("u1", ("2", "b", "RJ"), day(3))],
        [("u1", ("2", "b", "RJ"), day(1))],
    ):
        assert versions(apply_feed(dim, feed_of(spark, rows))) == replay([first])


def test_version_of_a_date_against_brute_force(spark):
    """One person places a third of the facts; some dates lie before any version."""
    rnd = random.Random(11)
    days = random_days(rnd)
    dim = history(feed_of(spark, [r for feed in days for r in feed]))
    stored = dim.collect()
    facts = [
        (i, "u1" if rnd.random() < 0.34 else f"u{rnd.randrange(14)}", day(rnd.randrange(-2, 12)))
        for i in range(900)
    ]
    df = spark.createDataFrame(facts, "id int, customer_unique_id string, on_day date")
    got = {r["id"]: r[SURROGATE] for r in as_of(df, dim, "on_day").collect()}
    want = {
        i: next(
            (v[SURROGATE] for v in stored
             if v["customer_unique_id"] == p and v["valid_from"] <= d
             and (v["valid_to"] is None or d < v["valid_to"])), None)
        for i, p, d in facts
    }
    assert got == want and None in got.values()


def test_as_of_never_compares_facts_with_versions_pairwise(spark):
    dim = history(feed_of(spark, [("u1", ("1", "a", "SP"), day(1))]))
    df = spark.createDataFrame([("u1", day(2))], "customer_unique_id string, on_day date")
    plan = as_of(df, dim, "on_day")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(">=" in j or "Cross" in j for j in joins)


def test_overlapping_pairs_against_brute_force(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        person = "hot" if rnd.random() < 0.4 else f"u{rnd.randrange(20)}"
        start = rnd.randrange(40)
        end = None if rnd.random() < 0.1 else day(start + rnd.randrange(1, 12))
        rows.append((i, person, "1", "a", "SP", day(start), end, end is None))
    dim = spark.createDataFrame(rows, DIM_CUSTOMER)
    top = dt.date(9999, 12, 31)
    pairs = sum(
        a[1] == b[1] and a[5] < (b[6] or top) and b[5] < (a[6] or top)
        for n, a in enumerate(rows) for b in rows[n + 1:]
    )
    assert pairs > 0
    assert overlapping_ranges({"dim_customer": dim}).first()["violations"] == pairs
    none = overlapping_ranges({"dim_customer": dim.where("customer_sk = ''")}).first()
    assert none["violations"] == 0


MERGE = "id int, a string, b int, n int"


def test_upsert_updates_changed_inserts_new_and_keeps_the_rest(spark):
    target = spark.createDataFrame(
        [(1, "x", 1, 1), (2, None, 2, 1), (3, "z", 3, 1), (5, "q", None, 1)], MERGE
    )
    source = spark.createDataFrame(
        [(1, "x", 1, 9), (2, "y", 2, 9), (4, "w", 4, 9), (5, "q", None, 9)], MERGE
    )
    out = upsert(target, source, ["id"], compare=["a", "b"], action="did")
    assert collected(out) == [
        (1, "x", 1, 1, "keep"), (2, "y", 2, 9, "update"), (3, "z", 3, 1, "keep"),
        (4, "w", 4, 9, "insert"), (5, "q", None, 1, "keep"),
    ]
    always = upsert(target, source, ["id"], update=["a", "n"], when_changed=False)
    assert collected(always.where("id in (1, 4)")) == [(1, "x", 1, 9), (4, "w", 4, 9)]
    guarded = upsert(target, source, ["id"], guard=F.col("s.n") <= F.col("t.n"))
    assert collected(guarded, "id", "n") == [(1, 1), (2, 1), (3, 1), (4, 9), (5, 1)]


def test_merging_twice_is_merging_once(spark):
    target = spark.createDataFrame([(1, "x", 1, 1)], MERGE)
    source = spark.createDataFrame([(1, "y", 1, 1), (2, "z", 2, 2)], MERGE)
    once = upsert(target, source, ["id"])
    again = upsert(once, source, ["id"], action="did")
    assert collected(again.drop("did")) == collected(once)
    assert {r["did"] for r in again.collect()} == {"keep"}


def test_violations_lists_only_what_is_broken(spark):
    from daygrain.plans.gold import dim_date
    from daygrain.plans.warehouse import TABLES

    empty = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    tables = {**empty, "dim_date": dim_date(spark)}
    assert violations(tables) == []
    bad = spark.createDataFrame(
        [(1, "u1", "1", "a", "SP", day(5), day(5), True)], DIM_CUSTOMER
    )
    assert set(dict(violations({**tables, "dim_customer": bad}))) == {
        "valid_to after valid_from", "current rows have no end"
    }
