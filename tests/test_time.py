from pyspark.sql import functions as F

from daygrain.functions.time import date_key, in_days, iso_weekday, local_date, parse_ts, to_utc
from daygrain.functions.values import distinct_from, lookup, percent, ratio, zip_code
from tests.conftest import collected


def test_bad_text_becomes_null_and_is_kept(frame):
    df = parse_ts(frame([("2017-11-24T10:00:00",), ("garbage",), (None,)], "t string"), "t")
    assert collected(df.select(F.col("t").cast("string"), "t_raw")) == [
        ("2017-11-24 10:00:00", "2017-11-24T10:00:00"), (None, None), (None, "garbage")
    ]


def test_wall_clock_to_utc_follows_daylight_saving(frame):
    df = to_utc(frame([("2017-11-24 12:00",), ("2017-06-15 12:00",)], "t timestamp"), "t")
    assert collected(df.select(F.col("t").cast("string"))) == [
        ("2017-06-15 15:00:00",), ("2017-11-24 14:00:00",)
    ]


def test_business_day_is_the_local_date(frame):
    df = frame([("2017-11-25 01:30",), ("2017-11-25 02:00",)], "t timestamp")
    assert collected(df.select(local_date("t").cast("string"))) == [
        ("2017-11-24",), ("2017-11-25",)
    ]


def test_calendar_parts(frame):
    day = F.col("d")
    df = frame([("2017-11-26",)], "d date").select(iso_weekday(day), date_key(day))
    assert tuple(df.first()) == (7, 20171126)


def test_day_range_is_half_open(frame):
    df = frame(
        [("2017-11-09 23:59:59",), ("2017-11-10",), ("2017-11-11 23:59:59",), ("2017-11-12",)],
        "t timestamp",
    )
    assert df.where(in_days("t", "2017-11-10", "2017-11-11")).count() == 2


def test_zip_gets_its_zeros_back(frame):
    df = frame([("1046",), ("01046",), ("123456",)], "z string").select(zip_code("z"))
    assert collected(df) == [("01046",), ("01046",), ("12345",)]


def test_rounding_is_half_up_and_zero_safe(frame):
    df = frame([(1, 8), (1, 0), (1, 3), (1005, 100000), (0, 5)], "a int, b int")
    a, b = F.col("a"), F.col("b")
    assert collected(df.select("a", "b", percent(a, b, 1), percent(a, b, 2))) == [
        (0, 5, 0.0, 0.0), (1, 0, None, None), (1, 3, 33.3, 33.33), (1, 8, 12.5, 12.5),
        (1005, 100000, 1.0, 1.01),
    ]
    assert df.select(ratio(F.lit(5), F.lit(2), 0)).first()[0] == 3.0


def test_differing_counts_null_as_a_value(frame):
    df = frame(
        [(1, 1, 2, 2), (1, None, 2, 2), (None, None, 2, 2), (None, 1, 2, 3)],
        "a int, b int, c int, d int",
    )
    left, right = [F.col("a"), F.col("c")], [F.col("b"), F.col("d")]
    assert [r[0] for r in df.select(distinct_from(left, right)).collect()] == [
        False, True, False, True
    ]


def test_lookup_of_a_missing_key_is_null(frame):
    df = frame([("x",), ("y",), (None,)], "k string").select(lookup({"x": 1}, "k"))
    assert [r[0] for r in df.collect()] == [1, None, None]
