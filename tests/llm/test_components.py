"""Components against a loop, and the rounds they take."""

import random

from daygrain.llm import components
from daygrain.llm.common import Scratch


def saved(monkeypatch):
    names, save = [], Scratch.save

    def noted(self, df, name):
        names.append(name)
        return save(self, df, name)

    monkeypatch.setattr(Scratch, "save", noted)
    return names


def labels(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}").repartition(5)
    got = components.components(df, Scratch(spark, "test"), "x").collect()
    assert len(got) == len({r.node for r in got})
    return {r.node: r.label for r in got}


def by_loop(edges):
    label = {x: x for e in edges for x in e}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_chains_rings_and_stars(spark, monkeypatch):
    monkeypatch.setattr(components, "_AT_ONCE", 7)
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(40)] + [(100 + k, 100 + (k + 1) % 30) for k in range(30)]
    edges += [(200, k) for k in range(201, 260)] + [(300 + rng.randrange(60), 300 + rng.randrange(60)) for _ in range(50)]
    rng.shuffle(edges)
    edges += edges[:20]
    apart = [e for e in edges if e[0] != e[1]]
    assert labels(spark, [*edges, (None, 5), (500, 500)]) == by_loop(apart)
    assert labels(spark, [(f"{a:04}".encode(), f"{b:04}".encode()) for a, b in edges], "binary") == {
        f"{a:04}".encode(): f"{b:04}".encode() for a, b in by_loop(apart).items()
    }
    assert labels(spark, []) == {}


def test_stars_take_no_round(spark, monkeypatch):
    names = saved(monkeypatch)
    assert labels(spark, [(k, 0) for k in range(1, 400)] + [(500, k) for k in range(501, 600)]) == {
        **dict.fromkeys(range(400), 0), **dict.fromkeys(range(500, 600), 500)
    }
    assert names == ["x-0", "x-least-1"]
