import random

from textloom.operators.components import connected_components


def smallest(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def check(spark, edges, **options):
    df = spark.createDataFrame(edges or [(None, None)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, **options).collect()}
    assert got == smallest([(a, b) for a, b in edges if a is not None and b is not None and a != b])


def test_random_graphs_by_both_ways(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    check(spark, edges)
    check(spark, edges, one_task=0)


def test_chain_hub_and_nulls(spark):
    check(spark, [(i, i + 1) for i in range(0, -60, -1)] + [(500, i) for i in range(501, 600)], one_task=0)
    check(spark, [(None, 3), (4, None), (5, 5)])
    check(spark, [])
