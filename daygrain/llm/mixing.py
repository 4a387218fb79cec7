"""Mixing sources to target weights along a curriculum.

A source's weight is a function of training time, given as knots of a piecewise linear schedule.
Integrating it gives the source's demand over time: after a share U of the schedule's area, a share
U of the source's target has been consumed. Inverting that for a document's place in the source's
token stream gives the training time at which the document is read, and sorting all documents
by that time gives the training order.

Targets: sources share all words by the areas of their schedules; a target stops at `max_epochs`
times its source's words and the excess is shared again by weight until none is above. That is the
level `x` at which sum(min(cap, x * weight)) meets the total, found with running sums over
the sources in order of cap / weight.

The stream of a source is its documents in an order drawn from a digest of their ids, repeated as
often as the target needs; the last turn ends where the target is reached, so that the document
there counts with a part of its words. Running sums are taken per (source, slice of the
digest), so a source that holds a third of the corpus is spread over all tasks.

NULL or empty texts have size 0 and are never taken. A NULL source is a source of its own, sorted
last. A source with a size of 0 has target 0. Repeated rows count as often as they come. Empty
tables give empty results. Very long texts are only counted. Documents of one draw stand in the order of their ids, and of
one training time, too. Extra columns are not read, or carried as they are. Results depend on ids and texts only, so reruns agree.
All sources are ordered in one task, one row each: meant for up to millions of sources, not for one per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.common import WORD, Scratch

# Weights by the source's place in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Schedules by the same place, as (time, height); a schedule's area is stretched to its weight.
# Strong sources lead early, weak ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))
# Hexadecimal digits of the digest that make a slice: 4096 slices of every source.
SLICE_DIGITS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, place, weight, target)."""
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights) + 1)
    cap = F.col("source_size") * max_epochs
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = sources.select("source", "source_size", place.alias("place")).select(
        "*", weight.alias("weight"), cap.alias("cap")
    )
    # In level order: this source is below its cap if the level that all from here on share is.
    levelled = placed.select(
        "*",
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("level"),
    ).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    shared = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)
    return levelled.select(
        "source", "source_size", "place", "weight",
        F.coalesce(
            F.least(F.col("cap").cast("double"), shared["level"] * F.col("weight")), F.col("cap").cast("double")
        ).alias("target"),
    )


def _segments(schedule) -> list[tuple[float, float, float, float, float]]:
    """(share of the area before, time, height, slope, share of the area at the end) per segment."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))
    out, before = [], 0.0
    for (t0, h0), (t1, h1) in zip(schedule, schedule[1:]):
        part = (t1 - t0) * (h0 + h1) / 2 / area
        out.append((before, t0, h0 / area, (h1 - h0) / area / (t1 - t0), before + part))
        before += part
    return out


def when_consumed(share: Column, place: Column, schedules=SCHEDULES) -> Column:
    """The time at which a share of the schedule's area has passed: its integral, inverted."""
    out = F.lit(1.0)
    for k, schedule in enumerate(schedules):
        time = F.lit(1.0)
        for before, t0, height, slope, end in reversed(_segments(schedule)):
            rest = share - F.lit(before)
            root = F.sqrt(F.lit(height * height) + F.lit(2 * slope) * rest)
            # height * x + slope * x * x / 2 = rest, in the form that holds for slope 0, too.
            time = F.when(share < F.lit(end), F.lit(t0) + F.lit(2.0) * rest / (F.lit(height) + root)).otherwise(time)
        out = F.when(place % len(schedules) == k, time).otherwise(out)
    return out


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, schedules=SCHEDULES, max_epochs=MAX_EPOCHS, carry: bool = False,
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken, position.

    `taken` counts the words the mix takes of the document, repeats included. `position` is the
    training time, from 0 to 1, of its first turn (NULL if not taken); a turn `r` later it is
    `when_consumed((r * source_size + before) / target)`. With `carry` the frame's own columns
    come along in a struct called `row`.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        F.md5(F.col(doc_id).cast("string")).alias("draw"), *own,
    ).withColumn("slice", F.substring("draw", 1, SLICE_DIGITS))
    narrow = scratch.save(sized.drop("row"), "sized")
    slices = narrow.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    ahead = Window.partitionBy("source").orderBy(F.asc_nulls_last("slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.save(
        slices.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .join(scratch.save(targets(sources, weights, max_epochs), "targets").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s", "words"),
        "offsets",
    )
    within = (
        Window.partitionBy("source", "slice").orderBy("draw", F.asc("doc_id"), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sized if carry else narrow
    running = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    match = F.col("r.source").eqNullSafe(F.col("o.source")) & F.col("r.slice").eqNullSafe(F.col("o.slice"))
    joined = running.alias("r").join(offsets.alias("o"), match).select(
        "r.*", "o.source_size", "o.target", "o.place", (F.col("inside") + F.col("ahead")).alias("before")
    )
    # Whole words: `turns` full turns of the source, then a part of one.
    goal = F.floor(F.col("target") + 0.5)
    turns = F.when(F.col("source_size") > 0, F.floor(goal / F.nullif(F.col("source_size"), F.lit(0)))).otherwise(0)
    part = goal - F.col("turns") * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("before")))
    share = F.col("before") / F.nullif(F.col("target"), F.lit(0.0))
    return (
        joined.withColumn("turns", turns.cast("long"))
        .withColumn("part", part.cast("long"))
        .withColumn("taken", (F.col("turns") * F.col("size") + cut).cast("long"))
        .withColumn(
            "position",
            F.when(F.col("taken") > 0, when_consumed(share, F.col("place"), schedules)),
        )
        .select(
            "doc_id", "size", "source", "source_size", "target", "taken", "position",
            *(["row", "before", "place"] if carry else []),
        )
    )


def training_order(docs: DataFrame, **names) -> DataFrame:
    """The documents of the mix in training order, whole, once for each turn they are taken in.

    A document at the end of its source's target is read whole. Columns are those of `docs`.
    """
    mixed = mix(docs, carry=True, **names).where("taken > 0")
    turn = F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)).alias("turn")
    share = (F.col("turn") * F.col("source_size") + F.col("before")) / F.nullif(F.col("target"), F.lit(0.0))
    schedules = names.get("schedules", SCHEDULES)
    return (
        mixed.select("row", "doc_id", "source_size", "target", "before", "place", turn)
        .withColumn("time", when_consumed(share, F.col("place"), schedules))
        .orderBy("time", "doc_id", "turn")
        .select("row.*")
    )
