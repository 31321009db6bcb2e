"""Spelling variants against all pairs of a small vocabulary."""

import collections
import random
import re
import zlib

import numpy as np

from haulmetrics.llm import spelling
from haulmetrics.llm.spelling import Edits, Shards

from .helpers import awkward, awkward_rows, clashing, empty, rows

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def slow_vocabulary(data, least=3):
    counts = collections.Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def slow_groups(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= 2 * counts[w] else None for w, b in best.items()}
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def crowd(seed, size):
    """Words that are edits of each other, several steps deep, with ties of n."""
    rng = random.Random(seed)
    words = {"abcdefgh": 64, "aaaaa": 8, "ÿÿÿÿÿÿ": 5, "zzzzzz": 5}
    while len(words) < size:
        w, at, c = rng.choice(list(words)), rng.randrange(6), rng.choice("abzÀÿ")
        w = (w[:at] + c + w[at + 1:], w[:at] + c + w[at:], w[:at] + w[at + 1:])[rng.randrange(3)]
        if len(w) > 3:
            words.setdefault(w, rng.choice((1, 2, 2, 4, 8, 16, 33)))
    return words


def test_words_and_groups_of_awkward_texts(spark):
    data = [(r[0], r[1]) for r in awkward_rows()] + [(k, "Café cafés CAFES Straße strasse ×÷× naïve naive " * 40) for k in range(100, 160)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    words = spelling.vocabulary(clashing(docs))
    expected = slow_vocabulary(data)
    assert {r["word"]: r["n"] for r in words.collect()} == expected
    frequent = {w: n for w, n in expected.items() if n > 3}
    assert rows(spelling.spelling_groups(words.filter("n > 3")), *COLUMNS) == slow_groups(frequent)


def test_groups_equal_all_pairs_in_one_pass_and_in_many(spark):
    counts = crowd(3, 400)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    expected = slow_groups(counts)
    assert any(r[5] not in (r[0], r[3]) for r in expected)
    for limit in (spelling.MAX_FILTER_BYTES, 1):
        assert rows(spelling.spelling_groups(words, max_filter_bytes=limit), *COLUMNS) == expected


def test_very_long_words_share_a_shard(spark):
    long = "ab" * 4000
    counts = {long: 9, long[:-1]: 3, long[:100] + "z" + long[101:]: 4, long + "y": 1}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(spelling.spelling_groups(words), *COLUMNS) == slow_groups(counts)


def test_edits_hash_like_the_words_they_make():
    edits = Edits("abcdÿ")
    for word in ("aabbc", "dddd", "abcdÿ"):
        matrix = edits.matrix([word])
        hashed = lambda w: edits.hashes(edits.matrix([w]))[0]
        made = {word[:p] + word[p + 1:]: h for _, ps, hs in edits.deletions(matrix) for p, h in zip(ps, hs)}
        assert made == {w: hashed(w) for w in {word[:i] + word[i + 1:] for i in range(len(word))}}
        for _, places, put, hashes in edits.replacements(matrix):
            assert all(h == hashed(word[:p] + edits.letters[c] + word[p + 1:]) for p, c, h in zip(places, put, hashes))
    assert Shards({5: 10}, 24).places(np.array([1], np.uint64), 6, 0, 1)[0].size == 0


def test_empty_and_wordless(spark):
    assert spelling.spelling_groups(spelling.vocabulary(empty(spark))).count() == 0
    assert spelling.spelling_groups(spelling.vocabulary(awkward(spark).filter("text is null"))).columns == list(
        ("word", "n", "n_near", "form", "form_n", "root"))
