"""Connected components of a distributed list of edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch

MAX_ROUNDS = 60
# Edges that a task puts together before any shuffle.
_AT_ONCE = 1 << 18


def stars(edges: Iterator[tuple]) -> list[tuple]:
    """(node, smallest node of its component) of all nodes but those."""
    root: dict = {}

    def find(x):
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
    return [(x, find(x)) for x in root if find(x) != x]


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars that connect what the edges of a task connect, of at most `_AT_ONCE` edges and a batch."""
    held: list[pa.RecordBatch] = []

    def finish() -> pa.RecordBatch:
        found = stars(edge for batch in held for edge in zip(*(column.to_pylist() for column in batch.columns)))
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], held[0].schema.types[k]) for k in range(2)], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= _AT_ONCE:
            yield finish()
            held = []
    if held:
        yield finish()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(a, b) edges to (node, label): the smallest node each node is connected with.

    Every round lets each node hand its smallest neighbour to the larger ones and then to the
    smaller ones, which keeps the components and shortens paths; the number of rounds grows with
    the logarithm of the longest one. A node with many neighbours is met by map-side minima and
    by a join whose sides come straight from their shuffles, which Spark splits where skewed.
    Before the first one, each task puts its own edges together. A round shuffles its edges five
    times, the last one, which finds only stars, once. Each round is written to the shared folder;
    nothing is collected but whether it is the last one.
    """
    edges = edges.where("a <> b").select("a", "b")
    current = scratch.save(edges.mapInArrow(_put_together, edges.schema).distinct(), f"{name}-0")
    for k in range(1, MAX_ROUNDS + 1):
        # To all larger neighbours: link them to the smallest one, or to the node itself.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.save(
            both.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("far"))
            .select("a", F.least("a", "m").alias("m"), F.expr("m < a AND m < far").alias("between")),
            f"{name}-least-{k}",
        )
        # Where each node with a smaller neighbour has no other one, all is stars around the smallest nodes.
        if least.where("between").isEmpty():
            scratch.drop(f"{name}-least-{k}")
            break
        up = both.where("b > a").join(least.select("a", "m"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = scratch.save(up, f"{name}-up-{k}")
        # To all smaller neighbours, and from the node itself.
        lowest = scratch.save(up.groupBy("a").agg(F.min("b").alias("m")), f"{name}-low-{k}")
        down = (
            up.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        current = scratch.save(down, f"{name}-{k}")
        for old in (f"{name}-{k - 1}", f"{name}-least-{k}", f"{name}-up-{k}", f"{name}-low-{k}"):
            scratch.drop(old)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
