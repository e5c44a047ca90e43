import random

import pytest

from leadpanel.llm.components import components


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def run(spark, links):
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["component"] for r in rows}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(2, 1)], [(1, 2), (2, 1), (1, 2)], [(3, 2), (2, 1), (9, 8)], [(-5, 7), (7, 9)],
    [(i, i + 1) for i in range(100)], [(0, i) for i in range(1, 200)], [(500, i) for i in range(1, 200)],
], ids=str)
def test_shapes(spark, links):
    assert run(spark, links) == brute(links)


def test_random(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    assert run(spark, links) == brute(links)
