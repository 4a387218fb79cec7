"""Row differences by checksums and calendar windows, against loops."""

import datetime as dt
import random
from collections import Counter

import pytest

from daygrain.plans import profile, reconcile
from tests.conftest import collected

DDL = "k int, part string, price double, note string"


def table(rnd, n=400):
    return [
        (rnd.randrange(60) if rnd.random() < 0.1 else 100 + i, rnd.choice([None, "x", "y"]), rnd.choice([None, 0.5, 2.0]), rnd.choice([None, "", "n"]))
        for i in range(n)
    ]


def by_loops(a, b, keys=2):
    sides = []
    for rows in (a, b):
        groups = {}
        for r in rows:
            groups.setdefault(r[:keys], []).append(r)
        sides.append(groups)
    out = set()
    for key in sides[0].keys() | sides[1].keys():
        left, right = sides[0].get(key, []), sides[1].get(key, [])
        if Counter(left) != Counter(right):
            out.add((*key, "only_a" if not right else "only_b" if not left else "changed", len(left), len(right)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_differences_equal_loops(spark, seed):
    rnd = random.Random(seed)
    a = table(rnd)
    b = [r for r in a if rnd.random() > 0.03]
    b = [(*r[:2], 9.0, r[3]) if rnd.random() < 0.05 else r for r in b] + table(rnd, 5) + b[:2]
    rnd.shuffle(b)
    found = reconcile.row_difference(spark.createDataFrame(a, DDL), spark.createDataFrame(b, DDL), ["k", "part"])
    got = {(r.k, r.part, r.kind, r.copies_a, r.copies_b) for r in found.collect()}
    assert got == by_loops(a, b) and {g[2] for g in got} == {"only_a", "only_b", "changed"}


def test_one_changed_cell(spark):
    """The cell is named, and only rows of its bucket reach the join."""
    a = spark.range(20_000).selectExpr("cast(id as int) k", "'p' part", "id / 2 price", "if(id % 2 = 0, null, 'n') note")
    b = a.selectExpr("k", "part", "price", "if(k = 777, 'm', note) note").repartition(3)
    found = reconcile.row_difference(a, b, ["k"])
    assert [(r.k, r.kind, r.columns) for r in found.collect()] == [(777, "changed", ["note"])]
    assert reconcile.row_difference(a, a.repartition(5), ["k"]).collect() == []
    sums = reconcile._unequal(*(reconcile._with_buckets(df, ["k"]) for df in (a, b)), ["_coarse", "_fine"])
    assert sums.count() == 1
    assert reconcile.row_difference(a.limit(0), a.limit(0), ["k"]).collect() == []
    with pytest.raises(ValueError, match="different columns"):
        reconcile.row_difference(a, b.drop("note"), ["k"])


def test_null_and_neighbouring_columns_are_told_apart(spark):
    a = spark.createDataFrame([(1, "x", None, None), (None, "x", None, "n")], DDL)
    b = spark.createDataFrame([(1, None, None, "x"), (None, "x", None, "n")], DDL)
    assert [(r.k, r.columns) for r in reconcile.row_difference(a, b, ["k"]).collect()] == [(1, ["part", "note"])]


@pytest.mark.parametrize("days", [1, 7, 45])
def test_calendar_windows_equal_loops(spark, days):
    rnd = random.Random(days)
    start = dt.date(2019, 11, 20)
    rows = [(k, start + dt.timedelta(d), rnd.randrange(9)) for k in "ab" for d in sorted(rnd.sample(range(200), 60))]
    daily = spark.createDataFrame(rows, "shop string, day date, n int")
    got = collected(profile.calendar_windows(daily, days, "n", keys=["shop"]))
    last = dt.timedelta(days - 1)
    want = [(k, d, d + last, sum(n for j, e, n in rows if j == k and d <= e <= d + last)) for k, d, _ in rows]
    assert got == sorted(want, key=lambda r: tuple(map(str, r)))
