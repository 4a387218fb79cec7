"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document's set holds the 64-bit hashes of its runs of five words (fewer words: the whole
sequence as one; none: empty). Two documents are linked if 100 * intersection >= 85 * union.

1. Equal sets are one class, and only classes go on: a text that is copied a million times is
   counted by a map-side aggregate.
2. The sketch has `BINS` coordinates, filled in rounds: round i throws every element into one bin,
   each bin keeps its smallest value of the first round that hits it, and rounds BINS .. 2 BINS - 1
   serve the bins one by one, so every coordinate is filled. Coordinates agree with the Jaccard
   similarity as probability, with concentration like independent ones.
3. `BANDS` bands of `ROWS` coordinates are hashed to buckets. At a similarity of 0.85 two documents
   miss all common buckets with a probability of 4e-5, at 0.9 of 1e-8.
4. Buckets link their members into candidate clusters. Within a cluster all sets are compared
   exactly, by counting common elements over inverted lists. A cluster too large for one task
   is cut into blocks of bounded count and size, and each block is compared with itself and with the
   cluster's head: a step linear in the cluster, after which copies of one text are one component.
   Only buckets that still hold several components go on. There the members outside the cluster's largest
   component, in blocks of their own, meet all blocks of the bucket; two members of one component
   are not compared again. A task gives, for each component it finds, links to its smallest member, never all
   pairs. A cluster's head is its smallest node, so what the blocks give is stars, whose components take no round.
5. Components of the links give the result.

Documents without words are linked with nothing. A NULL doc_id takes part, and is the smallest id
of its component only if there is no other. Repeated rows are copies like any other; ties cannot
arise, since a component's smallest id names it. Very long texts are hashed whole, and a set larger than a block's
elements is a block of its own. Empty tables give empty results; extra columns are not read, and
`survivors` hands them on as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch, attach, hot_keys
from daygrain.llm.components import components
from daygrain.llm.textblocks import mix64, shingle_sets

SHINGLE = 5
MIN_PERCENT = 85
BINS = 256
ROWS = 8
BANDS = BINS // ROWS
# Members of a block of a cluster that one task holds with their sets, and elements of these.
BLOCK = 512
BLOCK_ELEMENTS = 1 << 21
# Entries of inverted lists that are read at once.
_ENTRIES = 1 << 22

_ROUND_STEP = np.uint64(0x9E3779B97F4A7C15)
_VALUE = np.uint64((1 << 54) - 1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# A round's work is done for several rounds at once where the set is small.
_CHUNK = 2048


def sketch(elements: np.ndarray) -> np.ndarray:
    """The coordinates of a set: (round, value) packed in 64 bits, smallest per bin."""
    bins = np.full(BINS, _EMPTY)
    done = 0
    while done < BINS:
        rounds = np.arange(done, min(BINS, done + max(1, _CHUNK // len(elements))), dtype=np.uint64)
        code = mix64(elements[None, :] + (rounds[:, None] + np.uint64(1)) * _ROUND_STEP)
        place = (code >> np.uint64(56)).astype(np.int64)
        value = (rounds[:, None] << np.uint64(54)) | (code & _VALUE)
        np.minimum.at(bins, place.ravel(), value.ravel())
        done += len(rounds)
        if (bins != _EMPTY).all():
            return bins
    late = np.arange(BINS + 1, 2 * BINS + 1, dtype=np.uint64) * _ROUND_STEP
    for k in np.flatnonzero(bins == _EMPTY):
        bins[k] = np.uint64(BINS << 54) | (mix64(elements + late[k]) & _VALUE).min()
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    code = np.zeros(BANDS, np.uint64)
    table = bins.reshape(BANDS, ROWS)
    for k in range(ROWS):
        code = mix64(code * np.uint64(31) + table[:, k])
    return mix64(code + np.arange(1, BANDS + 1, dtype=np.uint64) * _ROUND_STEP).view(np.int64)


def set_key(elements: np.ndarray) -> bytes:
    """128 bits that name a set."""
    a, b = mix64(elements), mix64(elements ^ _ROUND_STEP)
    return (
        int(a.sum(dtype=np.uint64) ^ np.uint64(len(elements))).to_bytes(8, "big")
        + int(b.sum(dtype=np.uint64)).to_bytes(8, "big")
    )


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for _, elements in shingle_sets(batch.column(1), SHINGLE):
            sizes.append(len(elements))
            keys.append(set_key(elements) if len(elements) else None)
            bands.append(band_keys(sketch(elements)) if len(elements) else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "node", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of the classes' chosen documents, as bytes."""
    for batch in batches:
        keep, sets = [], []
        nodes = batch.column(0).to_pylist()
        for row, elements in shingle_sets(batch.column(1), SHINGLE):
            # A repeated id may bring another text along.
            if len(elements) and set_key(elements) == nodes[row]:
                keep.append(row)
                sets.append(elements.tobytes())
        if keep:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array(sets, pa.binary())], ["node", "elements"]
            )


def _all_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of every text that has words."""
    for batch in batches:
        found = [e for _, e in shingle_sets(batch.column(0), SHINGLE) if len(e)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(set_key, found), pa.binary()), pa.array([e.tobytes() for e in found], pa.binary())],
            ["node", "elements"],
        )


def linked(sizes: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
    return 100 * common >= MIN_PERCENT * (sizes + size - common)


def common_elements(mine: np.ndarray, begins: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many of `mine` each of the `n` sets holds, over inverted lists read in bounded pieces."""
    starts, lengths = begins[mine], begins[mine + 1] - begins[mine]
    ends = np.cumsum(lengths)
    common = np.zeros(n, np.int64)
    k = 0
    while k < len(mine):
        done = ends[k - 1] if k else 0
        stop = max(k + 1, int(np.searchsorted(ends, done + _ENTRIES, side="right")))
        part = lengths[k:stop]
        shift = starts[k:stop] - (ends[k:stop] - part - done)
        common += np.bincount(owner[np.repeat(shift, part) + np.arange(part.sum())], minlength=n)
        k = stop
    return common


def forest(nodes: list[bytes], known: list[bytes], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Links that connect what is linked among these sets, beyond the components already `known`.

    They are between first members of known components: a star around the smallest component of those that hang
    together. Two sets of one known component are not compared: of any other pair at least one is outside the largest
    component, so only those are counted against all.
    """
    n = len(nodes)
    parts, member, part = np.unique(np.array(known, object), return_index=True, return_inverse=True)
    if len(parts) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    _, words = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(words, kind="stable")
    owner_sorted = owner[order]
    begins = np.concatenate([[0], np.cumsum(np.bincount(words))])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    outside = part != np.bincount(part).argmax()
    root = list(range(len(parts)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in np.flatnonzero(outside):
        mine = words[ends[x] : ends[x + 1]]
        if (begins[mine + 1] - begins[mine]).max() == 1:
            continue  # shares nothing with any other
        found = linked(sizes, common_elements(mine, begins, owner_sorted, n), sizes[x])
        found &= part != part[x]
        found[: x + 1] &= ~outside[: x + 1]  # those were counted against x before
        for y in np.flatnonzero(found):
            p, q = find(int(part[x])), find(int(part[y]))
            root[max(p, q)] = min(p, q)
    return [(nodes[member[find(k)]], nodes[member[k]]) for k in range(len(parts)) if find(k) != k]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group (cluster and two blocks): the links inside each group, of known components."""
    group, nodes, known, sets = None, [], [], []

    def finish():
        links = forest(nodes, known, sets) if len(nodes) > 1 else []
        if not links:
            return None
        name = dict(zip(nodes, known))
        links = [(name[p], name[q]) for p, q in links]
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in links], pa.binary()), pa.array([q for _, q in links], pa.binary())], ["a", "b"]
        )

    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
        own = batch.column(3).to_pylist()
        parts = batch.column(4).to_pylist()
        contents = batch.column(5)
        for row, key in enumerate(keys):
            if key != group:
                if (out := finish()) is not None:
                    yield out
                group, nodes, known, sets = key, [], [], []
            if nodes and nodes[-1] == own[row]:
                continue  # repeated rows of one document, or the head in its own block
            nodes.append(own[row])
            known.append(parts[row])
            sets.append(np.frombuffer(contents[row].as_py(), np.uint64))
    if (out := finish()) is not None:
        yield out


def _read_only(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rows = _read_only(docs, doc_id, text)
    sketched = scratch.save(
        rows.mapInArrow(_sketches, "doc_id long, n_shingles long, node binary, bands array<long>"), "sketches"
    )
    with_words = sketched.where("node IS NOT NULL")
    classes = scratch.save(
        with_words.groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.max("n_shingles").alias("n")
        ),
        "classes",
    )
    buckets = scratch.save(classes.select("node", F.explode("bands").alias("bucket")), "buckets")
    shared = scratch.save(
        buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head")).where("n > 1"),
        "shared",
    )
    members = scratch.save(buckets.join(shared, "bucket").select("node", "bucket", "head"), "members")
    scratch.drop("buckets")
    clusters = components(members.select(F.col("node").alias("a"), F.col("head").alias("b")), scratch, "cluster")
    joined = components(_links(rows, classes, members, clusters, scratch), scratch, "link")
    ids = classes.join(joined, "node", "left").select("node", "rep", F.coalesce("label", "node").alias("label"))
    ids = scratch.save(ids, "ids")
    least = ids.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = scratch.save(ids.join(least, "label").select("node", "component_id"), "named")
    slim = sketched.select("doc_id", "n_shingles", "node")
    found = attach(slim, named, "node", scratch.save(hot_keys(slim, "node"), "hot"))
    alone = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", alone.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _compared(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """The links in groups of rows (label, low, high, node, known)."""
    return (
        groups.join(sets, "node").select("label", "low", "high", "node", "known", "elements")
        .repartition("label", "low", "high")
        .sortWithinPartitions("label", "low", "high", "node")
        .mapInArrow(_verify, "a binary, b binary")
    )


def _links(rows: DataFrame, classes: DataFrame, members: DataFrame, clusters: DataFrame, scratch: Scratch) -> DataFrame:
    sized = scratch.save(clusters.join(classes.select("node", "rep", "n"), "node"), "sized")
    least = F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("n") / F.lit(BLOCK_ELEMENTS))
    cut = sized.groupBy("label").agg(F.ceil(least).cast("int").alias("blocks")).where("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = scratch.save(
        sized.join(scratch.save(cut, "cut"), "label", "left").select(
            "node", "rep", "n", "label", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), blocks.alias("blocks")
        ),
        "placed",
    )
    # The candidates grow with the corpus, so this is a shuffle at every size.
    kind = "node binary, elements binary"
    named = (
        rows.join(placed.select("node", "rep").hint("merge"), F.col("doc_id") == F.col("rep"))
        .select("node", "text").mapInArrow(_sets, kind)
    )
    if not placed.where("rep IS NULL").isEmpty():
        # A class without any id is found by its set. Copies are one row before they leave the map side.
        named = named.unionByName(
            rows.where("doc_id IS NULL").select("text").mapInArrow(_all_sets, kind)
            .groupBy("node").agg(F.first("elements").alias("elements"))
            .join(placed.where("rep IS NULL").select("node"), "node", "left_semi")
        )
    sets = scratch.save(named, "sets")
    # Each block with itself and with the head of its cluster, which is the label.
    own = placed.select("label", F.col("block").alias("low"), F.col("block").alias("high"), "node")
    heads = placed.where("blocks > 1").select(
        "label", F.col("block").alias("low"), F.col("block").alias("high"), F.col("label").alias("node")
    ).distinct()
    first = scratch.save(_compared(own.unionByName(heads).withColumn("known", F.col("node")), sets), "links-in-blocks")
    wide = placed.where("blocks > 1").select("node", "label", "block", "n")
    if wide.isEmpty():
        return first
    # What is one component by now; a node without links is its own.
    inner = first.join(wide.select(F.col("node").alias("a")), "a", "left_semi")
    joined = components(inner, scratch, "block").withColumnRenamed("label", "known")
    wide = wide.join(joined, "node", "left").withColumn("known", F.coalesce("known", "node"))
    held = scratch.save(members.select("node", "bucket").join(wide, "node"), "held")
    mixed = held.groupBy("bucket").agg(F.min("known").alias("low"), F.max("known").alias("high"))
    mixed = scratch.save(mixed.where("low <> high").select("bucket"), "mixed")
    live = scratch.save(held.join(mixed, "bucket", "left_semi"), "live")
    # Nodes outside their cluster's largest component get blocks of their own, numbered below 0.
    nodes = scratch.save(live.select("node", "label", "block", "n", "known").distinct(), "nodes")
    largest = F.struct("members", "known")
    shares = (
        nodes.groupBy("label", "known").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("elements"))
        .groupBy("label").agg(
            F.max_by("known", largest).alias("main"),
            (F.sum("members") - F.max("members")).alias("members"),
            (F.sum("elements") - F.max_by("elements", largest)).alias("elements"),
        )
        .select("label", "main", F.ceil(F.greatest(
            F.col("members") / F.lit(BLOCK), F.col("elements") / F.lit(BLOCK_ELEMENTS), F.lit(1.0)
        )).alias("apart"))
    )
    apart = (-1 - F.pmod(F.xxhash64("node"), F.col("apart"))).cast("int")
    numbered = scratch.save(
        nodes.join(scratch.save(shares, "shares"), "label").select(
            "node", "label", F.when(F.col("known") == F.col("main"), F.col("block")).otherwise(apart).alias("block"), "known"
        ),
        "numbered",
    )
    met = live.select("node", "bucket").join(numbered.select("node", "label", "block"), "node")
    met = scratch.save(met.select("bucket", "label", "block").distinct(), "blocks-in-buckets")
    pairs = (
        met.where("block < 0").withColumnRenamed("block", "one")
        .join(met.select("bucket", F.col("block").alias("two")), "bucket")
        .select("label", F.least("one", "two").alias("low"), F.greatest("one", "two").alias("high")).distinct()
    )
    sides = scratch.save(pairs, "pairs").select("*", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    across = numbered.join(sides, ["label", "block"]).select("label", "low", "high", "node", "known")
    return first.unionByName(scratch.save(_compared(across, sets), "links-across"))


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay: of each component the one with the smallest doc_id, all columns kept.

    Rows that repeat that doc_id stay with it; exact dedup is there for them.
    """
    keep = near_groups(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("keep")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").alias("id"))
    return rows.join(keep, F.col("id").eqNullSafe(F.col("keep")), "left_semi").select("row.*")
