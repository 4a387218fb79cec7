"""Sessions of a day from the days its index names, against the whole history."""

import random

import pytest
from pyspark.sql import functions as F

from daygrain.plans import gold, sessions
from daygrain.sinks import files
from daygrain.sinks.partitions import overwrite_partitions, write_partition
from daygrain.sources.readers import read_day, read_events_upto
from tests.conftest import collected

DDL = ("event_id string, session_id string, customer_unique_id string, event_type string, event_ts string, "
       "device string, ingest_dt string")
DAYS = [f"2018-02-{d:02d}" for d in range(1, 13)]


def late_events(seed):
    """Most sessions live for a day; late rows reach back, some copies are filed under another session."""
    rnd = random.Random(seed)
    rows = []
    for k in range(600):
        day = rnd.randrange(12)
        session = "hot" if rnd.random() < 0.3 else f"d{day}-{rnd.randrange(8)}" if rnd.random() < 0.95 else None
        row = (f"e{k}" if rnd.random() < 0.99 else None, session, f"u{rnd.randrange(4)}", rnd.choice(list(gold.STAGES)),
               f"2018-02-{day + 1:02d} {rnd.randrange(24):02d}:00:00", "tv")
        rows.append((*row, DAYS[day]))
        if rnd.random() < 0.04:
            rows.append((*row, DAYS[rnd.randrange(day, 12)]))
        if rnd.random() < 0.04:
            rows.append((row[0], f"d{rnd.randrange(12)}-{rnd.randrange(8)}", *row[2:], DAYS[rnd.randrange(day, 12)]))
        if rnd.random() < 0.03:
            rows.append((f"late{k}", *row[1:], DAYS[rnd.randrange(day, 12)]))
    return rows


@pytest.fixture
def lake(spark, tmp_path):
    clean = str(tmp_path / "clean")

    def store(rows):
        df = spark.createDataFrame(rows, DDL).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
        overwrite_partitions(df, files.join(clean, "events"), "ingest_dt")
        return files.join(clean, "events"), files.join(clean, sessions.INDEX)

    store.clean = clean
    return store


@pytest.mark.parametrize("seed", [1, 2])
def test_same_sessions_as_from_the_whole_history(spark, lake, seed):
    events, index = lake(late_events(seed))
    # Of the days in between no index is there: they are read from the events themselves.
    sessions.index_days(spark, events, index, [d for k, d in enumerate(DAYS) if k % 4 != 2])
    for dt in DAYS[::3] + DAYS[-1:]:
        whole = gold.build_sessions(read_events_upto(spark, lake.clean, dt), dt)
        some = gold.build_sessions(sessions.touched_of_clean(spark, lake.clean, dt), dt)
        assert collected(some) == collected(whole)
    assert sessions.touched_of_clean(spark, lake.clean, "2018-02-20") is None


def test_days_without_a_touched_session_are_not_read(spark, lake):
    rows = [(f"e{k}", f"s{k}", "u", "page_view", f"{d} 10:00:00", "tv", d) for k, d in enumerate(DAYS)]
    rows += [("x1", "s2", "u", "purchase", f"{DAYS[2]} 23:00:00", "tv", DAYS[9])]  # late by a week
    rows += [("e4", "s11", "u", "page_view", f"{DAYS[4]} 10:00:00", "tv", DAYS[9])]  # a copy under another session
    events, index = lake(rows)
    assert sessions.index_days(spark, events, index) == DAYS
    found = sessions.touched_of_clean(spark, lake.clean, DAYS[9])
    read = {f.split("ingest_dt=")[1][:10] for f in found.inputFiles() if sessions.INDEX not in f}
    assert read == {DAYS[2], DAYS[4], DAYS[9]}
    assert collected(gold.build_sessions(found, DAYS[9]), "session_id", "n_events", "purchased") == [
        ("s2", 2, True), ("s9", 1, False)
    ]


def test_replaced_day_without_its_index_yet(spark, lake):
    """A crash between the new events and their index: the marker is gone, the stale rows are not used."""
    events, index = lake(late_events(3))
    sessions.index_days(spark, events, index)
    sessions.forget_days(spark, index, [DAYS[4]])
    new = [("n1", "d11-1", "u", "purchase", f"{DAYS[4]} 10:00:00", "tv", DAYS[4])]
    df = spark.createDataFrame(new, DDL).withColumn("event_ts", F.col("event_ts").cast("timestamp")).drop("ingest_dt")
    write_partition(df, events, DAYS[4])
    whole = gold.build_sessions(read_events_upto(spark, lake.clean, DAYS[11]), DAYS[11])
    some = gold.build_sessions(sessions.touched_of_clean(spark, lake.clean, DAYS[11]), DAYS[11])
    assert collected(some) == collected(whole)
    # The day may vanish as well.
    sessions.forget_days(spark, index, [DAYS[4]])
    write_partition(df.limit(0), events, DAYS[4])
    assert sessions.index_days(spark, events, index, [DAYS[4]]) == []
    assert read_day(spark, lake.clean, "events", DAYS[4]) is None
    whole = gold.build_sessions(read_events_upto(spark, lake.clean, DAYS[11]), DAYS[11])
    assert collected(gold.build_sessions(sessions.touched_of_clean(spark, lake.clean, DAYS[11]), DAYS[11])) == collected(whole)
