import random
import re

import pytest
from pyspark.sql import functions as F

from daygrain.functions.time import parse_ts
from daygrain.operators import quality
from daygrain.operators.copies import dedupe, keep_first, mark_copies, require_unique
from tests.conftest import collected

SCAN_RULES = {
    "reject": {
        "unique": ["scan_id"],
        "valid_timestamp": ["seen_at"],
        "not_null": ["scan_id", "dock", "seen_at"],
        "ts_range": {"column": "seen_at", "min": "2021-03-01", "max": "2021-03-31"},
        "allowed_values": {"dock": ["north", "south", "yard"]},
    }
}
SCANS = [
    ("a", "north", "2021-03-02T06:30:00"),
    ("b", "cellar", "2021-03-04T00:00:00"),
    ("c", "yard", "2021-02-28T23:59:59"),
    ("d", "south", "at noon"),
    ("a", "yard", "2021-03-09T12:00:00"),
    ("f", None, "2021-03-09T12:00:00"),
    (None, "yard", "2021-03-30T18:45:10"),
    ("g", "south", "2021-03-31T00:00:00"),
]


@pytest.fixture
def scans(frame):
    return parse_ts(frame(SCANS, "scan_id string, dock string, seen_at string"), "seen_at")


def reasons(tagged, key="scan_id"):
    return {(r[key], r["dq_reason"]) for r in tagged.where("dq_reason != ''").collect()}


def test_each_rule_gives_its_reason(scans):
    assert reasons(quality.tag_rows(scans, SCAN_RULES, order_by=["dock"])) == {
        ("a", "duplicate:scan_id"),
        ("b", "bad_value:dock"),
        ("c", "out_of_range:seen_at"),
        ("d", "null:seen_at,bad_timestamp:seen_at"),
        ("f", "null:dock"),
        (None, "null:scan_id"),
    }


def test_valid_and_bad_are_the_input(scans):
    valid, bad = quality.apply_rules(scans, SCAN_RULES)
    assert (valid.count(), bad.count()) == (2, 6)
    assert "dq_reason" not in valid.columns and "dq_warn" in valid.columns


def test_range_ends_belong_to_the_range(frame):
    df = frame([("2016-01-01",), ("2019-01-01",), ("2019-01-01 00:00:01",), (None,)], "t timestamp")
    block = {"ts_range": {"column": "t", "min": "2016-01-01", "max": "2019-01-01"}}
    tagged = quality.with_reasons(df, block, "dq_reason")
    assert tagged.where("dq_reason != ''").count() == 1


@pytest.mark.parametrize("kinds", [["positive"], ["not_null"], ["positive", "not_null"]])
def test_a_missing_number_breaks_not_null_alone(frame, kinds):
    weights = {"anvil": 31.5, "balloon": -0.25, "crate": 0.0, "drum": None, "egg": 0.01}
    tagged = quality.tag_rows(
        frame(list(weights.items()), "part string, kg double"), {"reject": {kind: ["kg"] for kind in kinds}}
    )
    want = {(p, "non_positive:kg") for p, kg in weights.items() if "positive" in kinds and kg is not None and kg <= 0}
    want |= {("drum", "null:kg")} if "not_null" in kinds else set()
    assert reasons(tagged, "part") == want


LOANS = "id string, state string, due date, returned date, fined date"
LOAN_RULES = {
    "warn": {"date_order": [{"earlier": "due", "later": "fined"}]},
    "reject": {
        "required_when": [{"column": "returned", "when_column": "state", "equals": "closed"}]
    },
}


def test_required_only_under_its_condition(frame):
    df = frame(
        [("x", "open", None, None, None), ("y", "closed", "2020-05-01", None, None),
         ("z", "closed", None, "2020-05-02", None), ("w", None, None, None, None)],
        LOANS,
    )
    assert reasons(quality.tag_rows(df, LOAN_RULES), "id") == {
        ("y", "missing_when:returned:state=closed")
    }


def test_warned_rows_are_kept(frame):
    df = frame(
        [("x", "open", "2020-05-09", None, "2020-05-08"), ("y", "open", "2020-05-09", None, "2020-05-09"),
         ("z", "open", None, None, "2020-01-01")],
        LOANS,
    )
    valid, bad = quality.apply_rules(df, LOAN_RULES)
    assert bad.count() == 0
    assert collected(valid, "id", "dq_warn") == [("x", "date_order:fined<due"), ("y", ""), ("z", "")]


def test_copy_of_a_rejected_row_is_still_a_copy(frame):
    df = frame([("e1", "bad"), ("e1", "good")], "id string, kind string")
    rules = {"reject": {"allowed_values": {"kind": ["good"]}, "unique": ["id"]}}
    tagged = quality.tag_rows(df, rules, order_by=["kind"])
    assert collected(tagged, "kind", "dq_reason") == [
        ("bad", "bad_value:kind"), ("good", "duplicate:id")
    ]


def test_counts_of_a_write_and_of_a_query_agree(spark, tmp_path):
    """Random docks and repeated scans: the tally of the write, the report's query and a loop."""
    rnd = random.Random(8)
    docks = ["north", "south", "cellar", None]
    rows = [(f"s{rnd.randrange(400)}", rnd.choice(docks), f"2021-03-{rnd.randrange(1, 30):02d}T10:00:00") for _ in range(500)]
    tagged = quality.tag_rows(
        parse_ts(spark.createDataFrame(rows, "scan_id string, dock string, seen_at string"), "seen_at"),
        SCAN_RULES | {"warn": {"allowed_values": {"dock": ["north"]}}},
    )
    tally = quality.Tally("scans", SCAN_RULES)
    tally.attach(tagged).write.parquet(str(tmp_path / "scans"))
    written = spark.read.parquet(str(tmp_path / "scans"))
    found = tally.summary()
    texts = [r[0].split(",") if r[0] else [] for r in written.select("dq_reason").collect()]
    flat = [reason for given in texts for reason in given]
    assert found["by_reason"] == {r: flat.count(r) for r in set(flat)} and len(found["by_reason"]) == 3
    assert (found["total"], found["quarantined"]) == (500, sum(map(bool, texts)))
    assert found["warned"] == sum(d == "south" and not t for d, t in zip(
        [r[0] for r in written.select("dock").collect()], texts, strict=True))
    warned = found.pop("warned")
    assert warned > 0
    assert quality.summarize("scans", 500, written.where("dq_reason != ''")) == found
    nothing = quality.summarize("scans", 0, written.where("false"))
    assert nothing == {"table": "scans", "total": 0, "quarantined": 0, "pct": 0.0, "by_reason": {}}


def test_shipped_rules_load():
    rules = quality.load_rules()
    assert set(rules) == {"events", "orders", "order_items", "order_payments", "order_reviews"}
    assert rules["order_reviews"]["reject"]["allowed_values"]["review_score"] == [1, 2, 3, 4, 5]


def test_unknown_rule_kind_is_an_error(frame):
    with pytest.raises(ValueError, match="unknown rule kinds"):
        quality.tag_rows(frame([("a",)], "id string"), {"reject": {"uniqe": ["id"]}})


def test_copies_against_brute_force(spark):
    """A third of the rows share one key and are identical; others repeat or have no key."""
    rnd = random.Random(7)
    rows = [("hot", "same", 1)] * 3000
    rows += [(f"k{rnd.randrange(2500)}", rnd.choice("ab"), rnd.randrange(3)) for _ in range(5000)]
    rows += [(None, "x", 1)] * 1000
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v string, n int").repartition(7)
    marked = mark_copies(df, "k", "is_copy", ["v", "n"])
    kept = marked.where("not is_copy and k is not null")
    best = {}
    for k, v, n in rows:
        if k is not None:
            best[k] = min(best.get(k, (v, n)), (v, n))
    assert {r["k"]: (r["v"], r["n"]) for r in kept.collect()} == best
    assert kept.count() == len(best)
    assert marked.count() == len(rows)
    assert marked.where("k is null and is_copy").count() == 0


def test_hot_key_is_split_over_its_input_partitions(spark):
    """No ranking group holds more of a hot key than one input partition, or one row of each."""
    df = spark.range(8000, numPartitions=8).select(
        F.expr("id div 8000").alias("k"), F.col("id").alias("v")
    )
    plan = mark_copies(df, "k", "is_copy")._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\[k#\w+, _is_copy_part#", plan)
    assert re.search(r"\[k#\w+, _is_copy_lane#", plan)
    sizes = (
        df.withColumn("p", F.spark_partition_id()).groupBy("k", "p").count().agg(F.max("count"))
    )
    assert sizes.first()[0] == 1000
    assert mark_copies(df, "k", "is_copy").where("not is_copy").count() == 1


def test_composite_key(frame):
    df = frame([("o", 1), ("o", 2), ("o", 1), ("o", None), ("o", None)], "id string, n int")
    assert mark_copies(df, ["id", "n"], "c").where("c").count() == 1


def test_keep_first_is_cut_before_the_shuffle(spark):
    plan = keep_first(spark.range(10).withColumn("k", F.col("id") % 2), "k", ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_dedupe_by_one_or_several_columns(frame):
    df = frame([("a", 1), ("a", 2), ("b", 1), ("a", 1)], "k string, v int")
    assert dedupe(df, "k").count() == 2
    assert dedupe(df, ["k", "v"]).count() == 3


def test_staged_copies_fail_loudly(frame):
    df = frame([("u1", "a"), ("u1", "b"), ("u2", "c")], "id string, v string")
    with pytest.raises(Exception, match="more than one row for key"):
        require_unique(df, ["id"], "staged people").collect()
    assert require_unique(df.where("v != 'b'"), ["id"], "staged").count() == 2


@pytest.mark.parametrize("turned", [False, True])
def test_first_of_equal_rows_does_not_depend_on_layout(spark, turned):
    """Rows whose values differ only in which column is NULL."""
    rows = [("k", None, "x"), ("k", "x", None), ("k", "x", "x")]
    df = spark.createDataFrame(rows[::-1] if turned else rows, "k string, a string, b string")
    for parts in (1, 3):
        assert collected(dedupe(df.repartition(parts), "k")) == [("k", None, "x")]
        marked = mark_copies(df.repartition(parts), "k", "late").where("NOT late")
        assert collected(marked, "a", "b") == [(None, "x")]


def test_rules_on_a_path_with_a_scheme(spark, tmp_path):
    (tmp_path / "rules.yaml").write_text("t:\n  reject:\n    not_null: [a]\n")
    assert quality.load_rules(f"file:{tmp_path}/rules.yaml", spark) == {"t": {"reject": {"not_null": ["a"]}}}
