import random

from lavra.llm.graph import connected_components


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500 - i, 499 - i) for i in range(30)]
    edges += [(rng.randrange(600, 800), rng.randrange(600, 800)) for _ in range(120)] + [(900, 900), (None, 3), (4, None)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0
