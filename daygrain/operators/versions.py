"""Type-2 history: versions with half-open validity, and the version valid on a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.functions.values import distinct_from
from daygrain.operators.lookup import hot_keys

PERSON = "customer_unique_id"
ADDRESS = ("zip", "city", "state")
SURROGATE = "customer_sk"
# Groups over which the facts of a person with many are dealt.
LANES = 64


def surrogate_key(person: str = PERSON) -> Column:
    """Key of a version from what identifies it: the same in every replay, no global counter.

    128 bits as hex text: 64 would meet a collision at some 10^10 versions, and two versions with
    one key block every later publish.
    """
    return F.md5(F.concat_ws("|", F.col("valid_from").cast("string"), F.col(person)))


def history(
    feed: DataFrame, person: str = PERSON, attrs: Sequence[str] = ADDRESS
) -> DataFrame:
    """All versions of a complete feed of (person, attrs, effective_date), one row per day.

    Equals applying the feed's days in order. A person's group holds at most one row per
    calendar day, which bounds it however hot the person is in the orders.
    """
    by_day = Window.partitionBy(person).orderBy("effective_date")
    now, before = F.struct(*attrs), "_before"
    changes = (
        feed.withColumn(before, F.lag(now).over(by_day))
        .withColumn("_first", F.row_number().over(by_day) == 1)
        .where(
            F.col("_first")
            | distinct_from([F.col(a) for a in attrs], [F.col(f"{before}.{a}") for a in attrs])
        )
    )
    return _versions(
        changes.withColumn("valid_from", F.col("effective_date")).withColumn(
            "valid_to", F.lead("effective_date").over(by_day)
        ),
        person,
        attrs,
    )


def _versions(df: DataFrame, person: str, attrs: Sequence[str]) -> DataFrame:
    return df.select(
        surrogate_key(person).alias(SURROGATE),
        person,
        *attrs,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def apply_feed(
    dim: DataFrame, feed: DataFrame, person: str = PERSON, attrs: Sequence[str] = ADDRESS
) -> DataFrame:
    """The dimension after one staged day of at most one row per person.

    The current row is closed when an attribute differs and the day is later than its start;
    an older or a repeated snapshot changes nothing. People without a current row, new ones
    and those just closed, get an open one. Closed rows meet no staged row in the join, so one
    pass over the dimension yields old, closed and opened rows.
    """
    day = feed.select(person, *attrs, "effective_date").withColumn("is_current", F.lit(True))
    d, s = dim.alias("d"), day.alias("s")
    both = d.join(s, [person, "is_current"], "full_outer")

    stored = F.struct(*[F.col(f"d.{c}").alias(c) for c in (*attrs, "valid_from", "valid_to")])
    opened = F.struct(
        *[F.col(f"s.{a}").alias(a) for a in attrs],
        F.col("s.effective_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    closed = stored.withField("valid_to", F.col("s.effective_date"))
    moved = (F.col("s.effective_date") > F.col("d.valid_from")) & distinct_from(
        [F.col(f"d.{a}") for a in attrs], [F.col(f"s.{a}") for a in attrs]
    )
    rows = (
        F.when(F.col("d.valid_from").isNull(), F.array(opened))
        .when(moved, F.array(closed, opened))
        .otherwise(F.array(stored))
    )
    return _versions(both.select(person, F.inline(rows)), person, attrs)


def observed_history(
    log: DataFrame, seen: str, person: str = PERSON, attrs: Sequence[str] = ADDRESS
) -> DataFrame:
    """All versions of a log of snapshots, of which a day may be in it repeatedly.

    The snapshot with the smallest `seen` counts for its day, so a repeated load changes nothing.
    Whatever the order in which days arrived, the versions are those of the days in order.
    """
    first = F.min_by(F.struct(*attrs), seen).alias("_first")
    days = log.groupBy(person, "effective_date").agg(first)
    return history(days.select(person, "effective_date", "_first.*"), person, attrs)


def as_of(
    facts: DataFrame,
    dim: DataFrame,
    on_date: str,
    take: Sequence[str] = (SURROGATE,),
    person: str = PERSON,
) -> DataFrame:
    """`facts` with the `take` columns of the version valid on their date, NULL if none was.

    Joining on the person and filtering the range would compare all facts of a person with all
    their versions. Here facts and versions of a person stand in one group in date order, and a
    fact takes the last version before it: facts travel once and are joined with nothing. Facts of
    people with a large part of all rows are dealt over `LANES` groups, each with a copy of
    their versions; facts without a person stay where they are read. Versions of a person must not
    overlap, which the checks ensure.
    """
    counted = facts.groupBy(person).agg(F.count("*").alias("_n"))
    hot = F.broadcast(hot_keys(counted, "_n").withColumn("_hot", F.lit(True)))
    part = F.spark_partition_id()
    lane = (
        F.when(F.col(person).isNull(), -1 - part)
        .when(F.col("_hot"), F.pmod(part, F.lit(LANES)) + 1)
        .otherwise(0)
    )
    asked = facts.join(hot, person, "left").select(
        *facts.columns, F.col(on_date).alias("_at"), F.lit(True).alias("_asks"), lane.alias("_lane")
    )
    every = F.when(F.col("_hot"), F.sequence(F.lit(1), F.lit(LANES))).otherwise(F.array(F.lit(0)))
    known = dim.where(F.col(person).isNotNull()).join(hot, person, "left").select(
        person,
        F.col("valid_from").alias("_at"),
        F.lit(False).alias("_asks"),
        F.struct("valid_to", *take).alias("_version"),
        F.explode(every).alias("_lane"),
    )
    upto = (
        Window.partitionBy(person, "_lane")
        .orderBy("_at", "_asks")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    until = F.col("_version.valid_to")
    valid = F.col("_at").isNotNull() & (until.isNull() | (F.col("_at") < until))
    return (
        asked.unionByName(known, allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(upto))
        .where(F.col("_asks"))
        .select(*facts.columns, *[F.when(valid, F.col("_version")[c]).alias(c) for c in take])
    )
