"""Exact, near and substring duplicates against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash

from haulmetrics.llm import exact_dedup, simhash, suffix_blocks, suffix_dedup
from haulmetrics.llm.components import star_forest

from .helpers import awkward, awkward_rows, clashing, empty, prose, rows


def test_exact_groups_and_repeated_rows(spark):
    got = exact_dedup.exact_duplicates(clashing(awkward(spark)))
    groups = collections.defaultdict(list)
    for r in awkward_rows():
        groups[r[1] or ""].append(r[0])
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        expected += [(i, max(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(
        expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    kept = collections.Counter(r["text_sha256"] for r in got.filter("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


def test_full_filter_only_lets_more_rows_through(spark):
    docs = spark.createDataFrame([(i, prose(i % 150, 5)) for i in range(400)], "doc_id long, text string")
    whole = rows(exact_dedup.exact_duplicates(docs), "doc_id", "keep_id", "group_size", "kept")
    tight = exact_dedup.exact_duplicates(docs, bits_per_row=1, max_filter_bytes=1)
    assert rows(tight, "doc_id", "keep_id", "group_size", "kept") == whole
    assert exact_dedup.keep_one(docs).count() == 150


def slow_fingerprint(text, words):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, radius):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_simhash_on_awkward_rows(spark):
    data = awkward_rows() + [(100 + k, prose(50, 300) + f" tail{k}", "en", "s", 0) for k in range(20)]
    docs = spark.createDataFrame(data, awkward(spark).schema)
    prints = [slow_fingerprint(r[1], 3) for r in data]
    labels = slow_components(prints, 3)
    first = {}
    for r, label in zip(data, labels):
        if r[0] is not None:
            first[label] = min(first.get(label, r[0]), r[0])
    expected = sorted([(r[0], f"{p:016x}", first.get(x)) for r, p, x in zip(data, prints, labels)],
                      key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(simhash.near_duplicates(clashing(docs)), "doc_id", "fingerprint", "component_id") == expected
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [1024, 7])
def test_links_of_crowded_fingerprints(spark, block):
    """Hundreds of fingerprints around a few centres, negative ones too; blocks of any size give the same classes."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(4)] + [1 << 63]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(60)}
    values = sorted(v - (v >> 63 << 64) for v in values)
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    forest = {r["child"]: r["parent"] for r in star_forest(simhash.near_links(distinct, 3, block)).collect()}
    found = collections.defaultdict(set)
    for v in values:
        found[forest.get(v, v)].add(v)
    labels = slow_components([v & (1 << 64) - 1 for v in values], 3)
    classes = collections.defaultdict(set)
    for v, x in zip(values, labels):
        classes[x].add(v)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, classes.values()))
    assert all(v == min(s) for v, s in found.items())


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair(radius):
    rng = random.Random(radius)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(2000):
        difference = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(m & difference == 0 for m in masks)


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 999)], "child long, parent long")
    forest = rows(star_forest(edges), "child", "parent")
    assert forest == sorted([(i, 0) for i in range(1, 301)] + [(1000, 999)], key=lambda r: tuple((False, str(v)) for v in r))


@pytest.mark.parametrize("v", [8, 10, 20, 80])
def test_difference_cover(v):
    cover = suffix_blocks.difference_cover(v)
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    shift = suffix_blocks.common_shift(v)
    assert all((i + shift[i, j]) % v in cover and (j + shift[i, j]) % v in cover for i in range(v) for j in range(v))


@pytest.mark.parametrize("letters", [1, 2, 26])
def test_block_sort_is_a_suffix_sort(letters):
    rng = random.Random(letters)
    for length in (40, 51, 400):
        text = bytearray(rng.randrange(97, 97 + letters) for _ in range(3000))
        text[1500:2200] = text[100:800]
        starts = np.array(sorted(rng.sample(range(len(text) - length + 1), 1500)))
        order, shared = suffix_blocks.sort_suffixes(np.frombuffer(bytes(text), np.uint8), starts, length)
        keys = [bytes(text[i:i + length]) for i in order]
        counts = collections.Counter(keys)
        assert keys == sorted(keys) and shared.tolist() == [counts[k] > 1 for k in keys]


def slow_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    result = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        result.append((len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return result


@pytest.mark.parametrize("options", [{}, {"bucket_pieces": 1}, {"max_filter_bytes": 1}])
def test_suffix_dedup_equals_brute_force(spark, options):
    shared = [prose(900 + k, 90) for k in range(4)]
    rng = random.Random(5)
    data = [(i, prose(i, rng.randint(1, 120)) + " " + rng.choice(shared) + " " + prose(i + 500, 60), "en", "s", 0) for i in range(40)]
    data += [r for r in awkward_rows() if r[0] != 9]
    docs = clashing(spark.createDataFrame(data, awkward(spark).schema))
    got = suffix_dedup.remove_repeats(docs, **options)
    expected = sorted([(r[0], *x) for r, x in zip(data, slow_removal([r[1] for r in data], 400))],
                      key=lambda r: tuple((v is None, str(v)) for v in r))
    found = [(a, b, c, d, bytes(e)) for a, b, c, d, e in rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")]
    assert sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r)) == expected


def test_suffix_dedup_of_long_texts_and_nothing(spark, monkeypatch):
    """A text of many buffers that holds a passage twice, far apart."""
    passage, filler = prose(7, 200), prose(8, 150_000, 10_000)
    docs = spark.createDataFrame([(1, filler[:700_000] + passage + filler[700_000:] + passage)], "doc_id long, text string")
    row = suffix_dedup.remove_repeats(docs).first()
    assert row["n_spans"] == 2 and 2 * len(passage) <= row["n_removed"] <= 2 * len(passage) + 8
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
