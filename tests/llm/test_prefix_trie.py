"""Prefix tries against a plain dictionary of beginnings."""

import collections
import hashlib
import math
import random
import zlib

import pytest

from haulmetrics.llm import prefix_trie
from haulmetrics.llm.queries import rebuilt_paths

from .helpers import rows

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [c.split()[0] for c in prefix_trie.NODE.split(", ")]


def slow_rebuilt(data):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in data:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    first = lambda c: c - int(math.fmod(c, 100))
    return {c: own.get(first(c), [])[:h[c]] + own[c][h[c]:] for c in own}


def slow_trie(conversations):
    members = collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node in members:
        below = [m for m in members if m[:len(node)] == node]
        parents = {m[:-1] for m in members if m}
        ends = sorted(c for c in members[node] if len(conversations[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    sum(len(m) == len(node) + 1 for m in below), sum(m not in parents for m in below),
                    sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def talk(seed, n):
    """Conversations that share openings of many lengths, copies, one very common opening and chain."""
    rng = random.Random(seed)
    data = []
    for c in range(n):
        kind = rng.random()
        if kind < 0.3:
            texts = [f"common {k}" for k in range(12)]
        elif kind < 0.5:
            texts = [f"common {k}" for k in range(rng.randrange(12))] + [f"own {c}"]
        else:
            texts = [rng.choice(("hi", "ho", "hé \U0001f600")) for _ in range(rng.randrange(7))]
        data += [(c, k, ("user", "bot")[k % 2], t) for k, t in enumerate(texts)]
    rng.shuffle(data)
    return data


AWKWARD = [(None, 0, "user", "lost"), (7, None, None, None), (7, 0, "user", ""), (7, 1, None, "x"), (8, 3, "user", None), (8, None, "", ""),
           (9, 0, "a", "bc"), (10, 0, "ab", "c"), (-5, 0, "user", "x"), (200, 0, "user", "long " * 30_000), (201, 0, "user", "long " * 30_000),
           (300, 0, "user", "x"), (300, 0, "user", "x")]


@pytest.mark.parametrize("container_bytes", [prefix_trie.CONTAINER_BYTES, 300, 1])
def test_trie_equals_plain_dictionary(spark, container_bytes):
    data = talk(1, 150)
    turns = spark.createDataFrame(data, SCHEMA).repartition(6)
    found = prefix_trie.prefix_trie(prefix_trie.turn_paths(turns), container_bytes)
    own = collections.defaultdict(list)
    for c, _, role, text in sorted(data):
        own[c].append((role, text))
    assert rows(found, *COLUMNS) == slow_trie(own)


def test_rebuilt_conversations(spark):
    data = [(c + 400, *rest) for c, *rest in talk(2, 230)] + AWKWARD
    wide = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as path", "2 as key", "3 as depth", "4 as line", "5 as n")
    assert rows(prefix_trie.prefix_trie(rebuilt_paths(wide), 2000), *COLUMNS) == slow_trie(slow_rebuilt(data))


def test_nobody_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.turn_paths(none)).count() == 0
    bare = spark.createDataFrame([(3, b""), (2, b"")], "conv_id long, path binary")
    assert rows(prefix_trie.prefix_trie(bare, 1), *COLUMNS) == [(2, 0, None, 2, 0, 1, 0, hashlib.sha256(b"2,3").hexdigest())]


def test_ends_of_a_hot_path_are_joined_in_order(spark):
    """Ids over many pieces, of different numbers of digits."""
    ids = list(range(1, 20_000, 3))
    paths = spark.createDataFrame([(i, b"x" * 24) for i in ids], "conv_id long, path binary").repartition(7)
    record = prefix_trie.path_records(paths).collect()
    assert [(r["conv"], r["n"], r["ends"]) for r in record] == [(1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]
