"""The mix on odd rows, its targets against repeated sharing, its positions against integration."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrain.llm import mixing


def shared_again(sizes, weights):
    """Targets by sharing the excess again until none is above."""
    total, open_, out = sum(sizes), set(range(len(sizes))), {}
    while True:
        left = total - sum(out.values())
        whole = sum(weights[k] for k in open_)
        found = {k: left * weights[k] / whole for k in open_}
        above = [k for k in open_ if found[k] > 3 * sizes[k]]
        if not above:
            return [{**out, **found}[k] for k in range(len(sizes))]
        for k in above:
            out[k] = 3.0 * sizes[k]
            open_.discard(k)


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 300, 5000]) + rng.randrange(20) for _ in range(9)]
    frame = spark.createDataFrame([(f"s{k}", n) for k, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = shared_again(sizes, [5, 2, 1] * 3)
    for k, target in enumerate(want):
        assert abs(got[f"s{k}"] - target) < 1e-6 * max(1, target)


def test_positions_invert_the_schedule(spark):
    shares = [k / 97 for k in range(97)]
    frame = spark.createDataFrame([(s, p) for s in shares for p in range(3)], "share double, place int")
    rows = frame.select("share", "place", mixing.when_consumed(F.col("share"), F.col("place")).alias("t")).collect()
    for r in rows:
        knots = mixing.SCHEDULES[r.place]
        grid = np.linspace(0, 1, 20001)
        heights = np.interp(grid, [t for t, _ in knots], [h for _, h in knots])
        area = np.concatenate([[0], np.cumsum((heights[1:] + heights[:-1]) / 2)])
        assert abs(np.interp(r.t, grid, area / area[-1]) - r.share) < 1e-6


ROWS = [
    (1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, "w " * 40_000, "z"), (5, "a\tb", None), (6, "q", None),
    (None, "n n", "x"), (7, "r s t", "y"), (7, "r s t", "y"), (8, " ", "w"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, s, 0, 1.0) for i, t, s in ROWS], "doc_id long, text string, source string, slice int, target double")
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: r.size for r in got} == {1: 3, 2: 0, 3: 0, 4: 40_000, 5: 2, 6: 1, None: 2, 7: 3, 8: 0}
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    for source in "xyzw", None:
        for name in source or [None]:
            own = [r for r in got if r.source == name]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
    ordered = mixing.training_order(docs)
    assert ordered.columns == docs.columns
    turns = sorted(str(r.doc_id) for r in ordered.collect())
    assert turns == sorted(str(r.doc_id) for r in got for _ in range(-(-r.taken // r.size) if r.size else 0))
    assert mixing.mix(docs.limit(0)).collect() == [] == mixing.training_order(docs.limit(0)).collect()
