"""A Merkle manifest of a table: one digest per row, a tree per group, a root over the groups.

A leaf is the SHA-256 of a row's fields, each with its length. In every group the leaves stand in
the order of a key. On each level every `arity` consecutive nodes become their parent, the last
run also if it is short, until one node is left, the group's subroot. The subroots, in the order of
their groups, are the leaves of one more tree, whose top is the root.

Levels are built by sibling-shift self-joins: the node in slot zero of a run computes the indices of
its siblings (index XOR 1 in a binary tree, index plus slot otherwise), an equijoin on (tree, index)
fetches their digests, and the slot-zero row emits the parent. Each level has 1 / arity of the rows
of the level below, and no key of a join has more rows than a run, so a group with a third of
all rows is spread like any other. Proofs go the other way: a run hands the steps above it down to
its nodes, so each leaf meets one row with its whole path.

The place of a row in its group comes from a range sort over (group, key, digest), cut anywhere, and from one
count per group and partition of that sort: no window over a group's rows.

NULL fields are marked, not dropped; a NULL group is a group of its own, before all others; NULL
keys come first. Rows with one key are ordered by their digest, and repeated rows have equal
digests, so their order does not show in any node. Very long texts only meet row-level
functions, and only digests are shuffled. An empty table gives an empty result. Extra columns are not read;
working columns live in tables of their own, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Bytes of a digest.
_WIDE = 32


def digest_of(hexed: Column) -> Column:
    """SHA-256 of a text, as bytes."""
    return F.unhex(F.sha2(hexed, 256))


def _hexed(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row: `-` for NULL, else the value's UTF-8 length, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest_of(F.concat(*marked))


def _tree_key(group: Column) -> Column:
    """Orders like the group by bytes, with NULL first, and is never NULL."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """`rows` with `index`, their place within `tree` by `order` from 0, and `size`, the tree's rows."""
    keys = ["tree", *order]
    placed = scratch.save(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33).cast("int")),
        name,
    )
    # At most one row for each partition of the sort and each tree that begins in it.
    pieces = placed.groupBy("part", "tree").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    shifts = pieces.select(
        "part", "tree",
        (F.sum("n").over(tree.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("size"),
    )
    found = placed.join(shifts, ["part", "tree"]).withColumn("index", F.col("place") + F.col("shift"))
    return found.drop("part", "place", "shift")


@dataclass
class Trees:
    """`levels[k]` has the runs of level k: tree, run, joined (the digests of the run's nodes, one
    after the other). `tops` has the last node of each tree: tree, digest, height."""

    levels: list[DataFrame]
    tops: DataFrame
    arity: int


def _parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The runs of a level by self-join, with the digest and size of the level above."""
    heads = nodes.where(F.col("index") % arity == 0)
    slots = F.sequence(F.lit(0), (F.least(F.lit(arity), F.col("size") - F.col("index")) - 1).cast("int"))
    wanted = heads.select("tree", F.col("index").alias("head"), "size", F.explode(slots).alias("slot"))
    sibling = F.col("head").bitwiseXOR(F.col("slot").cast("long")) if arity == 2 else F.col("head") + F.col("slot")
    met = wanted.withColumn("index", sibling).join(nodes.select("tree", "index", "digest"), ["tree", "index"])
    ordered = F.array_sort(F.collect_list(F.struct("slot", _hexed(F.col("digest")).alias("text"))))
    runs = met.groupBy("tree", "head", "size").agg(F.array_join(F.transform(ordered, lambda x: x.text), "").alias("text"))
    return runs.select(
        "tree",
        F.floor(F.col("head") / arity).cast("long").alias("run"),
        F.unhex("text").alias("joined"),
        digest_of(F.col("text")).alias("digest"),
        F.ceil(F.col("size") / arity).cast("long").alias("size"),
    )


def grow(leaves: DataFrame, arity: int, scratch: Scratch, name: str) -> Trees:
    """All levels over `leaves` (tree, index, size, digest), a stored table."""
    nodes, levels, tops = leaves.select("tree", "index", "size", "digest"), [], []
    most = leaves.agg(F.max("size")).first()[0]
    while True:
        tops.append(nodes.where("size = 1").select("tree", "digest", F.lit(len(levels)).alias("height")))
        if most is None or most <= 1:
            break
        runs = scratch.save(_parents(nodes.where("size > 1"), arity), f"{name}-{len(levels)}")
        levels.append(runs.select("tree", "run", "joined"))
        nodes = runs.select("tree", F.col("run").alias("index"), "size", "digest")
        most = -(-most // arity)
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return Trees(levels, found, arity)


def _own_step(slot: Column) -> Column:
    """What stands left and right of a node in its run."""
    return F.struct(
        F.substring(F.col("joined"), F.lit(1), slot * _WIDE).alias("before"),
        F.substring(F.col("joined"), slot * _WIDE + _WIDE + 1, F.octet_length("joined")).alias("after"),
    )


def with_steps(leaves: DataFrame, trees: Trees, above: DataFrame) -> DataFrame:
    """`leaves` with `steps`, from their own run to the top, and the columns of `above`.

    `above` has one row per tree: tree, height, the steps above its top, and columns to hand down.
    """
    carried = [c for c in above.columns if c not in ("tree", "height")]
    others = [c for c in carried if c != "steps"]
    arity, coming, runs = trees.arity, None, None
    for height in range(len(trees.levels), 0, -1):
        parents = above.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("run"), *carried)
        if coming is not None:
            parents = parents.unionByName(coming)
        runs = trees.levels[height - 1].join(parents, ["tree", "run"])
        slots = F.sequence(F.lit(0), (F.octet_length("joined") / _WIDE - 1).cast("int"))
        slot = F.col("slot")
        coming = runs.select("*", F.explode(slots).alias("slot")).select(
            "tree", (F.col("run") * arity + slot).alias("run"),
            F.array_prepend("steps", _own_step(slot)).alias("steps"), *others,
        )
    lone = leaves.where("size = 1").join(above.drop("height"), "tree")
    if runs is None:
        return lone
    slot = (F.col("index") % arity).cast("int")
    many = leaves.where("size > 1").withColumn("run", F.floor(F.col("index") / arity).cast("long"))
    many = many.join(runs, ["tree", "run"]).withColumn("steps", F.array_prepend("steps", _own_step(slot)))
    return many.drop("run", "joined").unionByName(lone)


def fold(digest: Column, steps: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to, as hex text."""
    return F.aggregate(
        steps, _hexed(digest),
        lambda node, step: F.sha2(F.concat(_hexed(step.before), node, _hexed(step.after)), 256),
    )


def proof_digest(steps: Column) -> Column:
    """SHA-256 over all siblings, level by level, left to right."""
    texts = F.transform(steps, lambda step: F.concat(_hexed(step.before), _hexed(step.after)))
    return F.sha2(F.array_join(texts, ""), 256)


def manifest(
    docs: DataFrame,
    doc_id: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    arity: int = ARITY,
    presented: Mapping[str, Column] | None = None,
) -> DataFrame:
    """doc_id, leaf, subroot, root, steps and shown of every row.

    `leaf` and `shown` are digests as bytes, `steps` the siblings up to the root. `shown` is the leaf of
    the row as it is presented for verification, where `presented` replaces columns of it.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    presented = presented or {}
    columns = {f: F.col(f"`{f}`") for f in fields}
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        _tree_key(F.col(f"`{group}`")).alias("tree"),
        leaf(list(columns.values())).alias("digest"),
        leaf([presented.get(f, c) for f, c in columns.items()]).alias("shown"),
    )
    stored = scratch.save(rows, "rows")
    leaves = scratch.save(numbered(stored, ["doc_id", "digest"], scratch, "placed"), "leaves")
    groups = grow(leaves, arity, scratch, "group")
    # The subroots are few beside the rows, but as many as there are groups: the same code again.
    subroots = groups.tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest", "height")
    subroots = scratch.save(numbered(scratch.save(subroots, "tops"), ["of"], scratch, "placed-tops"), "subroots")
    whole = grow(subroots, arity, scratch, "whole")
    step = "array<struct<before: binary, after: binary>>"
    start = whole.tops.select("tree", "height", F.expr(f"cast(array() as {step})").alias("steps"), F.col("digest").alias("root"))
    above = with_steps(subroots.withColumnRenamed("height", "tall"), whole, start)
    above = scratch.save(
        above.select(F.col("of").alias("tree"), F.col("tall").alias("height"), "steps", F.col("digest").alias("subroot"), "root"), "above"
    )
    return with_steps(leaves, groups, above).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "steps", "shown")


def verified(found: DataFrame) -> DataFrame:
    """A manifest as hex digests, with what each presented row folds to."""
    return found.select(
        "doc_id",
        *[_hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        proof_digest(F.col("steps")).alias("proof_sha256"),
        fold(F.col("shown"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
