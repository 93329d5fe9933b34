"""The trie against a dictionary of prefixes, and the ternary search tree by itself."""

import hashlib
import random
import zlib

import pytest

from filetally.llm import prefix_trie as module
from filetally.llm.prefix_trie import COLUMNS, Tree, median_order, prefix_trie

TURNS = "conv_id long, turn long, role string, text string, depth long, n string"


def rebuild(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            said = (role or "", text or "")
            digest = hashlib.sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, said))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    members = {}
    built = rebuild(rows)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    own = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in members.items()}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in m if len(built[c]) == len(p))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m),
            sum(len(q) == len(p) + 1 for q in below),
            sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below),
            sum(own[q] for q in below), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie(frame).collect()), key=str)


@pytest.mark.parametrize("seed, parts", [(1, "2"), (2, "9"), (3, "40")])
def test_equals_brute_force(spark, monkeypatch, seed, parts):
    """Few different turns, so that prefixes are shared across many shards and pieces."""
    monkeypatch.setattr(module, "PIECE", 7)
    monkeypatch.setattr(module, "ROWS", 3)
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-150, 450), 150):
        same = draw.random() < 0.3  # a large group of equal conversations
        for k in range(7 if same else draw.randint(1, 9)):
            said = ("user", "hello") if same else (draw.choice(["user", None]), draw.choice("abé"))
            rows.append((c, k if draw.random() < 0.95 else None, *said, 1, "x"))
    rows += rows[:5]
    rows += [(None, 1, "user", "lost", 1, "x"), (1000, 0, "user", "w " * 50_000, 1, "x")]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(spark.createDataFrame(rows, TURNS).repartition(3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)


def test_odd_rows(spark):
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(turnless, 0, "user", "gone", 1, "x"), (7, None, None, None, 1, "x"),
            (7, None, "", "", 1, "x"), (7, 5, "user", "", 1, "x")]
    assert found(spark.createDataFrame(rows, TURNS)) == brute(rows)
    assert prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 1, "x")], TURNS)).collect() == []


def test_median_insertion_balances_every_level():
    assert sorted(median_order(100)) == list(range(100))
    tree = Tree()
    for k in median_order(1000):
        tree.insert([k], [b"%d" % k], [1], 1, k, "")
    assert sorted(tree.turn[v] for v in tree.children(0)) == list(range(1000))

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.next[0]) <= 11
