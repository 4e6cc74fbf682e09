"""Connected components against union-find."""

import random

import pytest

from tamper.llm import _forest


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(3)
    order = rng.sample(range(300), 300)
    yield "none", []
    yield "loops and repeats", [(5, 5), (7, 3), (3, 7), (7, 3), (-2, 7), (9, 8)]
    yield "path", list(zip(order, order[1:]))
    yield "hubs", [(1000, i) for i in range(400)] + [(-1, i) for i in range(500, 900)] + [(1000, 2000)]
    yield "random", [(rng.randrange(600), rng.randrange(600)) for _ in range(400)]
    yield "wide", [(rng.randrange(-2 ** 62, 2 ** 62), rng.choice([1, 2 ** 61, -5])) for _ in range(60)]


@pytest.mark.parametrize("name, edges", list(graphs()))
@pytest.mark.parametrize("chunk, rows", [(1 << 19, 1 << 16), (2, 0)])
def test_roots_equal_union_find(spark, monkeypatch, name, edges, chunk, rows):
    """Also with chunks of two edges and jumps that are not broadcast."""
    monkeypatch.setattr(_forest, "BROADCAST_ROWS", rows)
    stars = _forest._star_batches

    def cut(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, chunk):
                yield from stars([batch.slice(i, chunk)])

    monkeypatch.setattr(_forest, "_star_batches", cut)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = [tuple(r) for r in _forest.forest_roots(df, "test-forest").collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute(edges)


def test_a_round_writes_once(spark, monkeypatch):
    """A star needs no round; a long path few."""
    names = []
    store = _forest.written
    monkeypatch.setattr(_forest, "written", lambda df, name: names.append(name) or store(df, name))
    _forest.forest_roots(spark.createDataFrame([(i, 0) for i in range(1, 200)], "a long, b long"), "star")
    assert names == ["star-0"]
    names.clear()
    path = spark.createDataFrame([(i + 1, i) for i in range(200)], "a long, b long").repartition(4)
    _forest.forest_roots(path, "path")
    assert len(names) <= 9
