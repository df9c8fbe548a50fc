"""Connected components: the steps taken, and the result against union-find."""

import random

import pytest

from labelgraph.llm import components as C


def brute(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in list(parent)}


def counted(monkeypatch):
    calls, real = [], C.stored
    monkeypatch.setattr(C, "stored", lambda df, name: calls.append(name) or real(df, name))
    return calls


@pytest.mark.parametrize("links, most", [([(1, i) for i in range(2, 40)], 2), ([], 1), ([(3, 3), (None, 2)], 1)])
def test_stars_take_one_step_and_nothing_takes_none(spark, monkeypatch, links, most):
    calls = counted(monkeypatch)
    found = C.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == brute(links)
    assert len(calls) <= most


def test_any_links_give_their_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)]
    links += [(999, i) for i in range(400, 430)] + links[:20] + [(None, 5), (7, None), (8, 8)]
    found = [tuple(r) for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(links)
