"""Operator 11 against a trie built in Python."""

import hashlib
import random
import re
import zlib

import pytest

from tamper.llm import _skew, conversations

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, c string, pos int, depth int"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    own = {c: [t for _, _, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        stack, leaves, saved = [node], 0, 0
        while stack:
            x = stack.pop()
            stack += children.get(x, [])
            leaves += x not in children
            saved += (len(members[x]) - 1) * len(WORD.findall(x[-1][1])) if x else 0
        return leaves, saved

    out = set()
    for node, convs in members.items():
        leaves, saved = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if made[c] == node)
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                 len(children.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in conversations.prefix_trie(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed, convs, deep=()):
    rng = random.Random(seed)
    says = [("user", "a b c"), ("assistant", "d  e\tf"), ("user", "\xa0 g"), (None, None), ("", "x"),
            ("user", "word " * 200)]
    rows = []
    for c in range(convs):
        for turn in range(rng.randrange(0, 6)):
            rows.append((c, turn if rng.random() > .1 else None, *rng.choice(says[:3] if turn < 2 else says)))
    for c, n in deep:
        rows += [(c, i, "user", f"t{i % 7}") for i in range(n)]
    return rows


def test_trie_equals_brute_force(spark):
    rows = random_rows(1, 120) + [(None, 1, "user", "no id"), (400, 1, "user", "a b c"), (400, 1, "user", "a b c"),
                                  (7, 3, "user", "again"), (7, 3, "user", "again")]
    assert run(spark, rows) == brute(rows)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    """A third of all turns in one conversation, and hot keys by the split path."""
    monkeypatch.setattr(_skew, "HOT_ROWS", 8)
    monkeypatch.setattr(_skew, "HOT_KEYS", 100)
    monkeypatch.setattr(conversations, "BLOB", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = random_rows(2, 150, deep=[(200, 300), (201, 280), (203, 300)])
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_empty(spark, rows):
    assert run(spark, rows) == set()


def test_turnless_conversations_end_in_the_root(spark):
    """Conversations 41 to 59 have one turn of their own and no base: where h > 0 nothing is left."""
    rows = [(c, 0, "user", f"{c}") for c in range(41, 60)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert next(r for r in got if r[1] == 0)[3] == 19


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in conversations.op11_prefix_trie(spark, SF).collect()}
    assert got == brute(rows)
