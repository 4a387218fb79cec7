"""Distinct counts from bitmaps of days against sets."""

import random

from daygrain.plans import distinct
from daygrain.sinks import files

DDL = "person string, kind string, shop int, ingest_dt string"


def test_counts_of_any_days_equal_sets(spark, tmp_path):
    """Days come one by one, one of them again with other rows; a person is in a third of all rows."""
    rnd = random.Random(4)
    at, held = str(tmp_path / "people"), {}

    def rows(dt, n):
        return [
            ("hot" if rnd.random() < 0.3 else None if rnd.random() < 0.1 else f"p{rnd.randrange(300)}", rnd.choice("xy"), rnd.randrange(2), dt)
            for _ in range(n)
        ]

    for dt in ("2020-01-01", "2020-01-02", "2020-01-03", "2020-01-02"):
        held[dt] = rows(dt, 400)
        distinct.index_days(spark.createDataFrame(held[dt], DDL).repartition(3), at, "person", ["kind", "shop"])
    numbers = distinct.dictionary(spark, at)
    assert numbers.count() == numbers.select("value").distinct().count() == numbers.select("number").distinct().count()
    for days in (None, ["2020-01-02"], ["2020-01-01", "2020-01-03"]):
        chosen = [r for dt, part in held.items() if days is None or dt in days for r in part if r[0] is not None]
        for by in (["kind", "shop"], ["kind"]):
            want = {}
            for person, kind, shop, _ in chosen:
                want.setdefault((kind, shop)[: len(by)], set()).add(person)
            found = distinct.count_distinct(spark, at, by, days)
            assert {tuple(r)[:-1]: r.n for r in found.collect()} == {k: len(v) for k, v in want.items()}
            assert all(f"/{distinct.BITMAPS}/" in f for f in found.inputFiles())


def test_half_written_generation_does_not_count(spark, tmp_path):
    at = str(tmp_path / "people")
    first = distinct.extend_dictionary(spark, at, spark.createDataFrame([("a",), ("b",), (None,)], "value string"))
    assert first.count() == 2
    files.replace_text(spark, files.join(at, distinct.NUMBERS, "generation=1", "part-0"), "torn")
    again = distinct.extend_dictionary(spark, at, spark.createDataFrame([("b",), ("c",)], "value string"))
    assert sorted(r.value for r in again.collect()) == ["a", "b", "c"]
    assert {r.number >> 48 for r in again.collect()} == {0, 2}
