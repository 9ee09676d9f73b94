"""Communities by modularity moves: planted groups, and modularity against a plain version."""

import random
from collections import defaultdict

from reviewlib.operators import communities


def plain_modularity(edges, part):
    adj = defaultdict(float)
    for a, b, w in edges:
        adj[(a, b)] += w
        adj[(b, a)] += w
    total = sum(adj.values())
    inside = sum(w for (a, b), w in adj.items() if part[a] == part[b])
    tot = defaultdict(float)
    for (a, _), w in adj.items():
        tot[part[a]] += w
    return inside / total - sum(t * t for t in tot.values()) / total**2


def planted(groups=6, size=8, seed=2):
    draw = random.Random(seed)
    edges = []
    for g in range(groups):
        members = [g * size + i for i in range(size)]
        edges += [(a, b, 1.0) for a in members for b in members if a < b and draw.random() < 0.8]
    for _ in range(groups):
        a, b = draw.randrange(groups * size), draw.randrange(groups * size)
        if a // size != b // size:
            edges.append((a, b, 0.2))
    return edges


def test_planted_groups_are_found(spark):
    edges = planted()
    df = spark.createDataFrame(edges + [(None, 3, 1.0), (4, 5, 0.0)], "src long, dst long, w double")
    found = dict(communities.louvain(df).collect())
    assert set(found) == {n for a, b, _ in edges for n in (a, b)}
    assert {found[n] for n in found} == {g * 8 for g in range(6)}
    assert all(found[n] == (n // 8) * 8 for n in found)


def test_modularity_equals_the_plain_version(spark):
    edges = planted(groups=4, size=6, seed=5) + [(1, 1, 0.5), (30, 31, 2.0)]
    df = spark.createDataFrame(edges, "src long, dst long, w double")
    found = dict(communities.louvain(df).collect())
    nodes = spark.createDataFrame(list(found.items()), "node long, comm long")
    got = communities.modularity(communities.adjacency(df), nodes)
    assert abs(got - plain_modularity(edges, found)) < 1e-12
    singles = {n: n for n in found}
    single = spark.createDataFrame(list(singles.items()), "node long, comm long")
    assert got > communities.modularity(communities.adjacency(df), single)


def test_no_edges(spark):
    df = spark.createDataFrame([], "src long, dst long, w double")
    assert communities.louvain(df).count() == 0


def test_classes_move_as_all_their_members_would(spark):
    draw = random.Random(4)
    sizes = {c * 10: draw.choice([1, 1, 2, 5]) for c in range(8)}
    members = [(c + i, c) for c, m in sizes.items() for i in range(m)]
    between = [(a, b, draw.choice([0.25, 0.5])) for a in sizes for b in sizes if a < b and draw.random() < 0.4]
    whole = [(x, y, w) for a, b, w in between for x, cx in members for y, cy in members if (cx, cy) == (a, b)]
    whole += [(x, y, 1.0) for x, cx in members for y, cy in members if cx == cy and x < y]
    schema = "src long, dst long, w double"
    plain = communities.louvain(spark.createDataFrame(whole, schema))
    classes = communities.louvain(
        spark.createDataFrame(between, schema), members=spark.createDataFrame(members, "node long, cls long")
    )
    assert sorted(classes.collect()) == sorted(plain.collect())


def test_rows_of_a_node_lie_together(spark):
    # sums by node and community are then whole in their task, and only these are shuffled each round
    adj = communities.adjacency(spark.createDataFrame([(1, 2, 1.0), (2, 1, 0.5), (3, 3, 1.0)], "src long, dst long, w double"))
    assert sorted(adj.collect()) == [(1, 2, 1.5), (2, 1, 1.5), (3, 3, 2.0)]
    dealt = [line for line in adj._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning(" in line]
    assert dealt and all("dst" not in line.split("hashpartitioning(")[1].split("),")[0] for line in dealt)
