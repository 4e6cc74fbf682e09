"""Operator 12 against brute force over all pairs of words."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from tamper.llm import spelling

SF = "/root/testdata/sf0.01"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word string, n long, letters int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def counted(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = counted(rows)
    gone = collections.defaultdict(set)  # neighbours share a word with one letter removed
    for w in n:
        gone[w].add(w)
        for i in range(len(w)):
            gone[w[:i] + w[i + 1:]].add(w)
    links = collections.defaultdict(set)
    for ws in gone.values():
        for a in ws:
            links[a].update(b for b in ws if near(a, b))
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], len(links[w]), form[w], n.get(form[w]), root))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in spelling.spelling_forms(df).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(got) == len(set(got))
    return set(got)


def rows_of(seed, docs=60):
    rng = random.Random(seed)
    letters = "abcdeÀéÿ÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(80)]

    def word():
        w = rng.choice(base[:1 + int(80 * rng.random() ** 2)])
        k = rng.randrange(len(w))
        return rng.choice([w, w, w, w.upper() if "ÿ" not in w else w, w[:k] + rng.choice(letters) + w[k:],
                           w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k + 1:]])

    rows = [(i, rng.choice([" ", "1", "ß ", "Ā"]).join(word() for _ in range(300))) for i in range(docs)]
    long = "ab" * 30
    return rows + [(None, f"{long} {long}x {long} {long}x {long} {long} {long}x " * 3), (None, None), (3, ""),
                   (3, rows[5][1]), (3, rows[5][1]), (70, "abcde " * 900 + "z" * 3000 + " 12 ½ 中文")]


def test_forms_equal_brute_force(spark):
    rows = rows_of(1)
    expected = brute(rows)
    assert sum(r[3] is not None for r in expected) > 100
    assert run(spark, rows) == expected


def test_many_cells_and_parts(spark, monkeypatch):
    """Cells of a few words, queries in several groups a cell: the same rows. The pickled
    functions carry the sizes that they use on the driver only, so parts are set there."""
    rows = rows_of(2, 30)
    monkeypatch.setattr(spelling, "CELL", 3)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (2, "few words here")]])
def test_empty(spark, rows):
    assert run(spark, rows) == set()


def test_tree_finds_every_point_in_reach():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(3000)]
    v = spelling.vectors(spelling.codes(words, 7))
    tree = spelling.KdTree(v, 16, tight=True)
    for distance in (1, 2):
        got = {(int(a), int(b)) for i, j in tree.within(v, v[:200], distance) for a, b in zip(i, j, strict=True)}
        l1 = np.abs(v[:200, None].astype(int) - v[None].astype(int)).sum(2)
        assert got == set(zip(*map(list, (x.tolist() for x in np.nonzero(l1 == distance))), strict=True))
    region = spelling.KdTree(v[:500], 16, tight=False)
    q, own = region.leaves(v, 0)
    assert sorted(q.tolist()) == list(range(3000))


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in spelling.op12_spelling_variants(spark, SF).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == brute(rows)
