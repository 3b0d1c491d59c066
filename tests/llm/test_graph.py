"""Connected components against a plain union-find."""

import random

import pytest

from setsim.llm.graph import components


@pytest.mark.parametrize("kind", ["path", "star", "random", "empty"])
def test_components(spark, kind):
    r = random.Random(4)
    names = r.sample(range(-10 ** 12, 10 ** 12), 60)
    edges = {"path": list(zip(names, names[1:], strict=False)), "star": [(names[0], n) for n in names[1:]], "empty": [],
             "random": [tuple(r.sample(names, 2)) for _ in range(45)] + [(names[5], names[5])]}[kind]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = components(spark.createDataFrame(edges + edges[:3], "a long, b long")).collect()
    assert {x["node"]: x["comp"] for x in got} == {n: find(n) for n in root} and len(got) == len(root)
