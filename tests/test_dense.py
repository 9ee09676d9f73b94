"""Peeling against the exact densest subgraph of small graphs."""

import itertools
import random

from reviewlib.operators import dense
from reviewlib.plans.queries import QUERIES


def exact(edges, nodes):
    best = 0.0
    for size in range(1, len(nodes) + 1):
        for chosen in itertools.combinations(nodes, size):
            s = set(chosen)
            best = max(best, sum(1 for a, b in edges if a in s and b in s) / size)
    return best


def test_within_the_stated_factor(spark):
    draw = random.Random(4)
    for trial in range(3):
        nodes = [f"n{i}" for i in range(11)]
        edges = {tuple(sorted(draw.sample(nodes, 2))) for _ in range(18)}
        core = nodes[:5]
        edges |= {(a, b) for a, b in itertools.combinations(core, 2) if draw.random() < 0.9}
        edges.add(("n2", "n3"))
        rows = list(edges) + [("n1", "n1"), ("n3", "n2"), (None, "n4")]
        df = spark.createDataFrame(rows, "src string, dst string")
        found, density = dense.peel(df, eps=0.1)
        got = {r["node"] for r in found.collect() if r["dense"]}
        inside = sum(1 for a, b in edges if a in got and b in got)
        assert abs(inside / len(got) - density) < 1e-12
        assert density >= exact(list(edges), sorted({n for e in edges for n in e})) / (2 * 1.1)


def test_no_edges(spark):
    df = spark.createDataFrame([("a", "a")], "src string, dst string")
    found, density = dense.peel(df)
    assert found.count() == 0 and density == 0.0


def test_query(spark):
    got = QUERIES["spam_authors"](spark, "/root/testdata/sf0.01").collect()
    assert got and any(r["dense"] for r in got) and all(r["density"] > 0 for r in got)
