import random

import numpy as np
import pytest

from callops.llm.graph import components, stars


def roots(links):
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


def some_links():
    random.seed(3)
    yield "random", [(random.randrange(-60, 200), random.randrange(-60, 200)) for _ in range(150)]
    path = list(range(60))
    random.shuffle(path)
    yield "path", list(zip(path, path[1:]))
    yield "star", [(7, k) for k in range(100)] + [(7, 7), (3, 3), (7, 5), (5, 7)]
    yield "two", [(1, 2), (3, 4), (2**62, -2**62)]


@pytest.mark.parametrize("name, links", list(some_links()))
def test_components(spark, name, links):
    found = {r.u: r.v for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == roots(links)
    node, root = stars(*map(np.array, zip(*links)))
    assert dict(zip(node.tolist(), root.tolist())) == roots(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
