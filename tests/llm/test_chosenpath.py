"""Operator 13 against brute force over all pairs of shingle sets."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tamper.llm import chosenpath

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n long, x long, cls string, root int, kept boolean"


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in where[x] if j < i)
        for j, k in both.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, len(sets[i]), least.get(find(i)), doc == least.get(find(i)))
                   for i, (doc, _) in enumerate(rows))


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, None) for r in rows], SCHEMA).repartition(4)
    return Counter(tuple(r) for r in chosenpath.near_duplicates(df).collect())


def prose(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return words


def rows_of(seed):
    rng = random.Random(seed)
    passage = prose(rng, 40)
    texts = [None, "", " \n\t", "one", "One", "one two three", "a b c d", "a b c d e"]
    for size in (8, 30, 120, 600):
        base = prose(rng, size)
        texts += [" ".join(base)] * 3 + [" ".join(base).upper()]
        texts += [" ".join(edited(rng, base, k)) for k in range(0, 8) for _ in range(4)]
    texts += [" ".join(prose(rng, 30) + passage) for _ in range(60)]
    texts += [" ".join(prose(rng, rng.randrange(1, 60))) for _ in range(60)]
    texts.append(" ".join(prose(rng, 20000)))
    rows = list(enumerate(texts))
    return rows + [(None, texts[10]), (None, None), (None, "only without id"), (None, "only without id"),
                   (7, texts[12]), (13, texts[13]), (13, texts[13])]


def test_components_equal_brute_force(spark):
    rows = rows_of(1)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("ask", [0, 3])
def test_blocks_and_deep_nodes(spark, monkeypatch, ask):
    """Every node over 4 classes branches, groups over 8 sets are dealt to blocks."""
    monkeypatch.setattr(chosenpath, "LEAF", 4)
    monkeypatch.setattr(chosenpath, "DEPTH", 3)
    monkeypatch.setattr(chosenpath, "BLOCK", 8)
    monkeypatch.setattr(chosenpath, "ASK", ask)
    monkeypatch.setattr(chosenpath, "ASK_BLOCK", 6)
    rows = rows_of(2)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, " "), (2, "alone in the world today")]])
def test_small_tables(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_pairs_at_the_threshold_are_found(spark):
    """Two hundred pairs of similarity 0.8 exactly: 24 shared shingles of 30."""
    rng = random.Random(4)
    rows = []
    for i in range(200):
        base = prose(rng, 30)  # 27 shingles, 24 of them without the last word's three
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:-3], "x", f"y{i}", "z"]))]
    expected = brute(rows)
    assert sum(n for (_, _, _, kept), n in expected.items() if kept) == 200
    assert run(spark, rows) == expected


def test_a_cluster_costs_a_star_not_all_pairs(spark):
    """3,000 different copies of one text: three blocks, links in proportion to the copies."""
    rng = random.Random(5)
    base = prose(rng, 200)
    df = spark.createDataFrame([(i, " ".join(edited(rng, base, 1)), ) for i in range(3000)], "doc_id long, text string")
    got = chosenpath.near_duplicates(df).groupBy("component_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 3000)]


def test_nodes_that_are_cheap_to_compare_do_not_branch(spark, monkeypatch):
    """A passage in some sixty documents among three thousand: its nodes are over LEAF, but all
    their pairs are fewer than LEAF for each document."""
    monkeypatch.setattr(chosenpath, "LEAF", 32)
    monkeypatch.setattr(chosenpath, "ASK", 3)
    names = []
    store = chosenpath.written
    monkeypatch.setattr(chosenpath, "written", lambda df, name: names.append(name) or store(df, name))
    rng = random.Random(6)
    passage = prose(rng, 40)
    texts = [" ".join(prose(rng, 30) + passage) for _ in range(60)] + [" ".join(prose(rng, 12)) for _ in range(3000)]
    texts += texts[5:8] + [" ".join(edited(rng, texts[i].split(), 1)) for i in range(20)]
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)
    assert "paths-trees-1" in names and "paths-trees-2" not in names


def test_forest_labels():
    root = chosenpath.forest(np.array([5, 4, 9, 3]), np.array([4, 2, 8, 9]), 10)
    assert root.tolist() == [0, 1, 2, 3, 2, 2, 6, 7, 3, 3]


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in chosenpath.op13_chosen_path(spark, SF).collect())
    assert got == brute(rows)
