"""Sorting of suffixes by a difference cover, one bounded block at a time.

The cover is a set of residues modulo v such that any two positions have a common distance
below v to two covered positions. Covered positions get the rank of the 4v bytes there, by
sorting v bytes and doubling twice, since position + v and position + 2v are covered as well.
Two suffixes are compared by their first v bytes, then by the ranks at their common distance,
then by what is left of the wanted length: a tie of any length costs one look at two ranks.
"""

from __future__ import annotations

from functools import cache

import numpy as np

WORD = 8


@cache
def difference_cover(v: int) -> tuple[int, ...]:
    """Residues whose differences are all residues modulo ``v``, chosen greedily."""
    cover, open_ = [0], set(range(1, v))
    while open_:
        def gain(c: int) -> int:
            return len({(c - d) % v for d in cover} & open_ | {(d - c) % v for d in cover} & open_)
        best = max((c for c in range(v) if c not in cover), key=gain)
        open_ -= {(best - d) % v for d in cover} | {(d - best) % v for d in cover}
        cover.append(best)
    return tuple(sorted(cover))


@cache
def common_shift(v: int) -> np.ndarray:
    """For residues i and j the least distance that brings both onto the cover."""
    covered = np.zeros(2 * v, bool)
    covered[[*difference_cover(v), *(c + v for c in difference_cover(v))]] = True
    shifts = np.zeros((v, v), np.int64)
    for i in range(v):
        for j in range(v):
            shifts[i, j] = np.flatnonzero(covered[i:i + v] & covered[j:j + v])[0]
    return shifts


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as a number that sorts like them."""
    words = np.zeros(len(text) - WORD + 1, np.uint64)
    for k in range(WORD):
        words = (words << np.uint64(8)) | text[k:k + len(words)]
    return words


def _offsets(begin: int, end: int) -> list[int]:
    """Where to read whole words that cover the bytes from ``begin`` to ``end``."""
    return [*range(begin, end - WORD, WORD), end - WORD]


def _dense(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows that ``order`` sorts; equal keys, equal ranks."""
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def cover_ranks(words: np.ndarray, size: int, v: int) -> np.ndarray:
    """At covered positions the rank of the 4v bytes there among all of them, elsewhere -1."""
    places = np.arange(max(0, size - 4 * v + 1))
    covered = np.zeros(v, bool)
    covered[list(difference_cover(v))] = True
    reach = np.arange(max(0, size - v + 1))
    reach = reach[covered[reach % v]]
    keys = [words[reach + o] for o in _offsets(0, v)]
    ranks = np.full(size + 1, -1, np.int64)
    ranks[reach] = _dense(np.lexsort(keys[::-1]), keys)
    for span in (v, 2 * v):
        reach = reach[reach + 2 * span <= size]
        keys = [ranks[reach], ranks[reach + span]]
        doubled = np.full(size + 1, -1, np.int64)
        doubled[reach] = _dense(np.lexsort(keys[::-1]), keys)
        ranks = doubled
    assert len(reach) == int(covered[places % v].sum())
    return ranks


def _compare(words: np.ndarray, ranks: np.ndarray, one: np.ndarray, two: np.ndarray, v: int, length: int) -> np.ndarray:
    """-1, 0 or 1 for each pair of suffixes, by their first ``length`` bytes."""
    sign = np.zeros(len(one), np.int8)
    tied = np.arange(len(one))

    def settle(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sign[tied] = (left > right).astype(np.int8) - (left < right).astype(np.int8)
        return tied[left == right]
    for o in _offsets(0, v):
        tied = settle(words[one[tied] + o], words[two[tied] + o])
    shift = common_shift(v)[one[tied] % v, two[tied] % v]
    tied = settle(ranks[one[tied] + shift], ranks[two[tied] + shift])
    for o in _offsets(4 * v, length):
        tied = settle(words[one[tied] + o], words[two[tied] + o])
    return sign


def sort_suffixes(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of the ``length`` bytes there, and which of them share those with another.

    Every start has ``length`` bytes of text. Equal first words make a bucket; buckets are split
    in three around a pivot, all buckets at once, until what is left in one is equal.
    """
    v = length // 5
    if v < WORD:
        raise ValueError("the length must be at least 40")
    size = len(text)
    words = _words(np.concatenate((text, np.zeros(WORD, np.uint8))))
    ranks = cover_ranks(words, size, v)
    found = starts[np.argsort(words[starts], kind="stable")]
    shared = np.zeros(len(found), bool)
    if not len(found):
        return found, shared
    head = words[found]
    bucket = np.cumsum(np.concatenate(([0], head[1:] != head[:-1])))
    active = np.arange(len(found))
    while True:
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        sizes = np.diff(np.append(first, len(bucket)))
        big = np.repeat(sizes > 1, sizes)
        if not big.any():
            return found, shared
        active, sizes = active[big], sizes[sizes > 1]
        first = np.cumsum(sizes) - sizes
        pivots = np.repeat(found[active[first + sizes // 2]], sizes)
        mine = found[active]
        part = np.repeat(np.arange(len(sizes)), sizes) * 3 + 1 + _compare(words, ranks, mine, pivots, v, length)
        order = np.argsort(part, kind="stable")
        found[active], bucket = mine[order], part[order]
        equal = bucket % 3 == 1
        counts = np.bincount(bucket)
        shared[active[equal]] = counts[bucket[equal]] > 1
        active, bucket = active[~equal], bucket[~equal]
        if not len(active):
            return found, shared
