"""Components against plain Python, and how many tables they write."""

import random

import pytest

from tracewell.llm import components


@pytest.fixture
def written(monkeypatch):
    """The purposes of the tables that components write."""
    purposes, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, purpose: purposes.append(purpose) or stored(df, purpose))
    return purposes


def _found(spark, edges):
    return sorted(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))


def _by_force(edges):
    least = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in least:
        for a, b in edges:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    return sorted(least.items())


def test_stars_take_no_round(spark, written):
    edges = [(k, 0) for k in range(1, 50)] + [(100, k) for k in range(101, 120)] + [(7, 0), (0, 7), (3, 3), (None, 5), (4, None)]
    assert _found(spark, edges) == _by_force(edges)
    assert len(written) == 1


def test_components_of_what_was_found_take_no_round(spark, written):
    edges = [(k, k + 1) for k in range(40)]
    reached = components.components(spark.createDataFrame(edges, "a long, b long"))
    rounds = len(written)
    again = components.components(components.as_edges(reached))
    assert sorted(map(tuple, again.collect())) == _by_force(edges)
    assert rounds > 1 and len(written) == rounds + 1


def test_components_by_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + k, 1001 + k) for k in range(60)]
    edges += [(2000, 2001 + k) for k in range(30)] + [(2001 + k, 1500 + k) for k in range(30)] + [(-5, 2010), (None, 1), (3, None)]
    assert _found(spark, edges) == _by_force(edges)
