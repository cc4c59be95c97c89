"""Connected components against a union-find, with hubs that are looked up by broadcast and without."""

import random

import pytest

from wordmill.llm import common


def slow(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("hub_edges", [3, 10 ** 9])
def test_components(spark, monkeypatch, hub_edges):
    monkeypatch.setattr(common, "HUB_EDGES", hub_edges)
    rng = random.Random(hub_edges)
    ids = rng.sample(range(-10 ** 12, 10 ** 12), 900)
    edges = [(ids[0], x) for x in ids[1:200]] + [(x, ids[250]) for x in ids[200:300] if x != ids[250]]  # a hub that is no root, and another
    edges += list(zip(ids[300:340], ids[301:341]))  # a chain
    edges += [(rng.choice(ids[400:]), rng.choice(ids[400:])) for _ in range(350)] + [(ids[5], ids[210])]
    edges += edges[:50] + [(b, a) for a, b in edges[50:90]]
    rng.shuffle(edges)
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {x: r for x, r in slow([e for e in edges if e[0] != e[1]]).items()}
    assert len(got) == len(want) and {r.node: r.root for r in got} == want


def test_no_edges(spark):
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert common.components(spark.createDataFrame([(3, 3)], "a bigint, b bigint")).count() == 0
