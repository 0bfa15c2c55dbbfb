import random

from dimstar.llm.components import components
from dimstar.llm.filters import filter_of, hits


def brute(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_least_node_of_each_component(spark):
    rng = random.Random(2)
    cases = [
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 80)] + [(100, 101)],
        [(rng.randrange(90), rng.randrange(90)) for _ in range(60)],
        [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(45)] + [(7, 7)],
    ]
    for edges in cases:
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == brute([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_keeps_all_it_was_made_of(spark):
    rows = spark.range(1000).selectExpr("xxhash64(id) AS h", "id")
    told = filter_of(rows.where("id < 100"))
    kept = {r["id"] for r in hits(rows, told).collect()}
    rest = {r["id"] for r in hits(rows, told, inverted=True).collect()}
    assert set(range(100)) <= kept and len(kept) < 110
    assert kept | rest == set(range(1000)) and not kept & rest
