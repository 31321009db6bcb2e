"""Spelling variants: words one edit apart, found through Bloom filters of the vocabulary.

Every word generates its edits, and each edit is looked up in a blocked Bloom filter that holds
the words of the edit's length. Only edits that the filter knows leave the task; a join with the
vocabulary removes its false alarms. An insertion is the deletion seen from the longer word, and
of two words that differ in one letter the one with the smaller letter generates the other, so
each near pair is generated once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.exact_dedup import merge_bits
from haulmetrics.llm.shared import BLOCK_BITS, BLOCK_BYTES, has_bits, probe_positions, set_bits, written

# Letters of words: a to z and U+00C0 to U+00FF, of which only A to Z were lower-cased.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
MIN_LETTERS = 5
MIN_COUNT = 3
# A word's form occurs at least so many times as often.
DOMINANCE = 2
SLIP_EVERY = 97
BITS_PER_WORD = 24
# Bits looked up in one pass over the vocabulary; a larger vocabulary takes more passes.
MAX_FILTER_BYTES = 64 << 20
# Words of this length and longer share one filter.
LONGEST_SHARD = 64
# Edits held at once, and different words counted by a task before it hands them on.
EDITS_AT_ONCE = 1 << 20
WORDS_AT_ONCE = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15
_BACK = pow(_FACTOR, -1, 1 << 64)


# --- vocabulary -----------------------------------------------------------------

def slip(run: bytes, prefix: int, every: int) -> bytes:
    """The run without one code point if its checksum, begun with ``prefix``, says so."""
    h = zlib.crc32(run, prefix)
    if h % every:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _counted(every: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch
        crc = zlib.crc32
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                runs = RUNS.findall((text.as_py() or "").encode().lower())
                prefix = crc(key.as_py().encode())
                counts.update(runs)
                for run in [r for r in runs if not crc(r, prefix) % every]:
                    counts[run] -= 1
                    counts[slip(run, prefix, every)] += 1
                if len(counts) > WORDS_AT_ONCE:
                    yield flush()
        yield flush()
    return count


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slip_every: int = SLIP_EVERY,
               text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``word, n`` of the runs of letters that are long and frequent enough.

    Only A to Z are lower-cased. A run whose crc32 of ``<id>:<run>`` is divisible by
    ``slip_every`` loses the code point at that number modulo its length. A null text has no
    runs, a null id is written as nothing; rows repeated with one id count every time.
    """
    keyed = docs.select(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("key"),
                        F.col(text_col).alias("text"))
    counts = keyed.mapInArrow(_counted(slip_every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter((F.length("word") >= min_letters) & (F.col("n") >= min_count))


# --- hashes of words and of their edits -----------------------------------------

class Edits:
    """Hashes of words and edits over an alphabet; a word's hash sums its letters' values times powers."""

    def __init__(self, letters: str):
        self.letters = "".join(sorted(set(letters)))
        self.codes = np.full(max(map(ord, self.letters)) + 1, -1, np.int64)
        self.codes[[ord(c) for c in self.letters]] = np.arange(len(self.letters))
        self.values = np.random.default_rng(11).integers(1, 1 << 63, len(self.letters), dtype=np.uint64)

    def matrix(self, words: list[str]) -> np.ndarray:
        """Letter numbers of words of one length, a row each."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        if len(points) and (points.max() >= len(self.codes) or (self.codes[points] < 0).any()):
            raise ValueError("a word has a letter outside the alphabet")
        return self.codes[points].reshape(len(words), -1)

    @staticmethod
    def _powers(count: int) -> np.ndarray:
        powers = np.full(count, _FACTOR, np.uint64)
        powers[:1] = 1
        return np.multiply.accumulate(powers)

    @staticmethod
    def mixed(sums: np.ndarray) -> np.ndarray:
        h = (sums ^ sums >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(29)

    def hashes(self, matrix: np.ndarray) -> np.ndarray:
        return self.mixed((self.values[matrix] * self._powers(matrix.shape[1])).sum(axis=1, dtype=np.uint64))

    def deletions(self, matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, places and hashes; of equal neighbouring letters only the first is deleted."""
        terms = self.values[matrix] * self._powers(matrix.shape[1])
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        rest = (before[:, -1:] - before) * np.uint64(_BACK)
        first = np.ones(matrix.shape, bool)
        first[:, 1:] = matrix[:, 1:] != matrix[:, :-1]
        rows, places = np.nonzero(first)
        yield rows, places, self.mixed((before - terms + rest)[rows, places])

    def replacements(self, matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, places, larger letters put there, and hashes; some places at a time."""
        powers = self._powers(matrix.shape[1])
        whole = (self.values[matrix] * powers).sum(axis=1, dtype=np.uint64)
        step = max(1, EDITS_AT_ONCE // (max(1, len(matrix)) * len(self.letters)))
        for at in range(0, matrix.shape[1], step):
            part = matrix[:, at:at + step, None]
            rows, places, put = np.nonzero(np.arange(len(self.letters)) > part)
            old = matrix[rows, places + at]
            change = (self.values[put] - self.values[old]) * powers[places + at]
            yield rows, places + at, put, self.mixed(whole[rows] + change)


def by_length(words: list[str], letters: int) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths with the places of some words of that length, few enough for their edits to be held at once."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        step = max(1, EDITS_AT_ONCE // (length * letters))
        for at in range(0, len(places), step):
            yield length, places[at:at + step]


class Shards:
    """Which block of bits a word of some length belongs to."""

    def __init__(self, counts: dict[int, int], bits_per_word: int):
        self.sizes, self.begins, total = {}, {}, 0
        for length in sorted(counts):
            self.begins[length], self.sizes[length] = total, -(-counts[length] * bits_per_word // BLOCK_BITS)
            total += self.sizes[length]
        self.blocks = total

    def places(self, hashes: np.ndarray, length: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes have their block in ``low`` to ``high``, and the bits of those from ``low`` on."""
        shard = min(length, LONGEST_SHARD)
        if shard not in self.sizes:
            return np.zeros(0, np.int64), np.zeros((0, 1), np.int64)
        block = self.begins[shard] + (hashes % np.uint64(self.sizes[shard])).astype(np.int64)
        use = np.flatnonzero((block >= low) & (block < high))
        inner = (hashes[use] ^ hashes[use] >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
        # The number of the block stands for its hash, so the shared helper places the bits in that block.
        words = np.stack(((block[use] - low).astype(np.uint64), inner), axis=1)
        return use, probe_positions(words, high - low)


def _filter(words: DataFrame, edits: Edits, shards: Shards, low: int, high: int) -> bytes:
    """The blocks ``low`` to ``high`` of the filters, merged by block."""
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros((high - low) * BLOCK_BYTES, np.uint8)
        for batch in batches:
            text = batch["word"].tolist()
            for length, chosen in by_length(text, len(edits.letters)):
                hashes = edits.hashes(edits.matrix([text[i] for i in chosen]))
                set_bits(bits, shards.places(hashes, length, low, high)[1].ravel())
        table = bits.reshape(high - low, BLOCK_BYTES)
        used = np.flatnonzero(table.any(axis=1))
        for part in np.array_split(used, max(1, len(used) // 256)):
            data = [table[b].tobytes() for b in part]
            yield pd.DataFrame({"block": part, "once": data, "twice": data})
    return merge_bits(words.select("word").mapInPandas(fold, "block long, once binary, twice binary"), high - low)


def _known_edits(edits: Edits, shards: Shards, low: int, high: int, shared):
    """Per task: ``edit, word, n`` of the edits that the filter knows."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)

        def known(hashes: np.ndarray, length: int) -> np.ndarray:
            use, places = shards.places(hashes, length, low, high)
            return use[has_bits(bits, places).all(axis=1)]
        for batch in batches:
            text, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            found, origin = [], []
            for length, chosen in by_length(text, len(edits.letters)):
                matrix = edits.matrix([text[i] for i in chosen])
                for rows, places, hashes in edits.deletions(matrix):
                    for k in known(hashes, length - 1).tolist():
                        i, at = int(chosen[rows[k]]), int(places[k])
                        found.append(text[i][:at] + text[i][at + 1:])
                        origin.append(i)
                for rows, places, put, hashes in edits.replacements(matrix):
                    for k in known(hashes, length).tolist():
                        i, at = int(chosen[rows[k]]), int(places[k])
                        found.append(text[i][:at] + edits.letters[put[k]] + text[i][at + 1:])
                        origin.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([text[i] for i in origin], pa.string()),
                                              pa.array(n[np.array(origin, np.int64)], pa.int64())], ["edit", "word", "n"])
    return probe


def near_words(words: DataFrame, letters: str = LETTERS, bits_per_word: int = BITS_PER_WORD,
               max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``word, n, near, near_n``: both directions of every pair of ``words`` exactly one edit apart.

    ``words`` has distinct ``word`` over ``letters`` (another letter is an error) and their
    ``n``. The filters of one pass have ``max_filter_bytes`` at most, on the driver as well; a
    vocabulary with more of them is probed in as many passes as they need.
    """
    edits = Edits(letters)
    length = F.least(F.length("word"), F.lit(LONGEST_SHARD))
    counts = {r["length"]: r["count"] for r in words.groupBy(length.alias("length")).count().collect()}
    shards = Shards(counts, bits_per_word)
    step = max(1, max_filter_bytes // BLOCK_BYTES)
    found = None
    for low in range(0, max(1, shards.blocks), step):
        high = max(low + 1, min(low + step, shards.blocks))
        shared = words.sparkSession.sparkContext.broadcast(_filter(words, edits, shards, low, high))
        part = words.select("word", "n").mapInArrow(_known_edits(edits, shards, low, high, shared), "edit string, word string, n long")
        found = part if found is None else found.unionByName(part)
    exact = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = written(found, "spelling-edits").join(exact, "edit")
    one = F.struct("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
    two = F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.select(F.explode(F.array(one, two)).alias("p")).select("p.*")


# --- forms ----------------------------------------------------------------------

def last_forms(links: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: each round every word takes over where its form has got to.

    A form is several times as frequent as its word, so chains are as long as the logarithm of
    the largest count and the rounds as its logarithm.
    """
    at = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = written(at.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if not moved.filter("moved").take(1):
            return at


def spelling_groups(words: DataFrame, dominance: float = DOMINANCE, letters: str = LETTERS, **options) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``words`` (distinct ``word``, ``n``).

    A word's form is its near word of largest n, the smallest in code-point order of several,
    if that n is at least ``dominance`` times the word's own; else null. ``root`` is where the
    forms lead, the word itself without one. An empty table gives an empty result.
    """
    words = written(words.select("word", "n"), "vocabulary")
    best = near_words(words, letters, **options).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    strong = -F.col("best.less") >= dominance * F.col("n")
    formed = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")),
                     "spelling-forms")
    roots = last_forms(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
