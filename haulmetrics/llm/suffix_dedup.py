"""Removal of every byte covered by a long string that occurs more than once.

Suffixes are sorted in blocks by a difference cover (``suffix_blocks``). What goes to which block
depends on content only: a start belongs to the bucket of the least hash among the 64-byte
strings inside its ``length`` bytes, so equal strings always share a bucket. Neighbouring starts
of one bucket form a piece. A bit filter first finds the buckets that occur twice at all; pieces
that occur twice as they are need no sorting; the different pieces of a bucket are sorted block
by block. A bucket with too many different pieces is split by more content: all its strings
contain the 64 bytes, so each contains at least half of the other bytes to the left of them or to
the right, and every piece becomes two, by those bytes on the left or on the right. That is
repeated while a part has too many, and each part is sorted in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.exact_dedup import merge_bits
from haulmetrics.llm.shared import (
    BLOCK_BYTES,
    filter_blocks,
    has_bits,
    probe_positions,
    set_bits,
    written,
)
from haulmetrics.llm.suffix_blocks import sort_suffixes

LENGTH = 400
GRAM = 64
# Bytes worked on at once when pieces are cut, at most 2 ** 20 since a place must fit its bits.
BUFFER = 1 << 19
PLACE_BITS = np.uint64(20)
# Starts of one piece, bytes of pieces sorted at once, and different pieces of a bucket sorted together.
PIECE_STARTS = 2_048
BLOCK_TEXT = 1 << 20
BUCKET_PIECES = 2_048
BITS_PER_PIECE = 16
MAX_FILTER_BYTES = 64 << 20
ROWS_AT_ONCE = 500
_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _powers(factor: int, count: int) -> np.ndarray:
    powers = np.full(count, factor, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class Cutter:
    """Cuts texts into pieces; one for each task, as it holds tables."""

    def __init__(self, length: int):
        self.length, self.span = length, length - GRAM + 1
        seed = np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:8] for b in range(256)), np.uint64)
        self.letters = seed
        self.up = _powers(_FACTOR, BUFFER + length)
        self.down = _powers(pow(_FACTOR, -1, 1 << 64), BUFFER + length)

    def _gram_hashes(self, text: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.letters[text] * self.up[:len(text)], dtype=np.uint64)))
        count = len(text) - GRAM + 1
        mixed = (sums[GRAM:] - sums[:count]) * self.down[:count]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ mixed >> np.uint64(29)

    def _least_places(self, hashes: np.ndarray) -> np.ndarray:
        """For every start the place of the least hash in its string, the first of equals."""
        starts, span = len(hashes) - self.span + 1, self.span
        keyed = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        rows = -(-len(keyed) // span)
        padded = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(keyed)] = keyed
        padded = padded.reshape(rows, span)
        left = np.minimum.accumulate(padded, axis=1).ravel()
        right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(right[:starts], left[span - 1:span - 1 + starts])
        return (least & np.uint64((1 << 20) - 1)).astype(np.int64)

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Buffers of bytes with the place of every start's least hash, and their pieces: text, start in the text, start in the buffer,
        starts, bucket, repeats inside."""
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for at in range(0, max(0, len(text) - self.length + 1), BUFFER):
                part = text[at:at + BUFFER + self.length - 1]
                if size + len(part) > BUFFER + self.length and held:
                    yield self._cut(held)
                    held, size = [], 0
                held.append((i, at, part))
                size += len(part)
        if held:
            yield self._cut(held)

    def _cut(self, held: list[tuple[int, int, bytes]]):
        buffer = b"".join(part for _, _, part in held)
        sizes = np.array([len(part) for _, _, part in held])
        ends = np.cumsum(sizes)
        hashes = self._gram_hashes(np.frombuffer(buffer, np.uint8))
        places = self._least_places(hashes)
        owner = np.repeat(np.arange(len(held)), sizes)[:len(places)]
        valid = np.arange(len(places)) + self.length <= ends[owner]
        buckets = hashes[places]
        new = np.ones(len(places), bool)
        new[1:] = (buckets[1:] != buckets[:-1]) | (owner[1:] != owner[:-1])
        run_at = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
        new |= (np.arange(len(places)) - run_at) % PIECE_STARTS == 0
        first = np.flatnonzero(new & valid)
        run = np.cumsum(new & valid) - 1
        counts = np.bincount(run[valid], minlength=len(first))
        moved = np.zeros(len(places), bool)
        moved[1:] = (places[1:] != places[:-1]) & ~new[1:] & valid[1:]
        several = np.bincount(run[moved], minlength=len(first)) > 0 if len(first) else np.zeros(0, bool)
        texts, bases = (np.array(x, np.int64) for x in zip(*((i, at) for i, at, _ in held), strict=True))
        who = owner[first]
        return (buffer, places, texts[who], first - (ends - sizes)[who] + bases[who], first, counts, buckets[first], several)


def _words(buckets: np.ndarray) -> np.ndarray:
    return np.stack((buckets, (buckets ^ buckets >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)), axis=1)


def _blocks_of(*bits: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    tables = [b.reshape(blocks, BLOCK_BYTES) for b in bits]
    used = np.flatnonzero(tables[0].any(axis=1))
    for part in np.array_split(used, max(1, len(used) // 256)):
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), *(pa.array([t[b].tobytes() for b in part], pa.binary()) for t in tables)],
                ["block", "once", "twice"][:1 + len(bits)])


def _repeated_buckets(texts: DataFrame, length: int, blocks: int) -> bytes:
    """Bits of the buckets that occur twice, or once with a string that repeats inside its piece."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(length)
        once, twice = (np.zeros(blocks * BLOCK_BYTES, np.uint8) for _ in range(2))
        for batch in batches:
            for *_, buckets, several in cutter.pieces(batch.column(2).to_pylist()):
                values, counts = np.unique(np.concatenate((buckets, buckets[several])), return_counts=True)
                spots, hits = np.unique(probe_positions(_words(values), blocks), return_counts=True)
                again = probe_positions(_words(values[counts > 1]), blocks).ravel()
                set_bits(twice, np.concatenate((spots[(hits > 1) | has_bits(once, spots)], again)))
                set_bits(once, spots)
        yield from _blocks_of(once, twice, blocks=blocks)
    return merge_bits(texts.mapInArrow(fold, "block long, once binary, twice binary"), blocks)


def _bucket_filter(buckets: DataFrame, rows: int, max_bytes: int) -> bytes:
    """Bits of all values of column ``bucket``."""
    blocks = filter_blocks(rows, BITS_PER_PIECE, max_bytes)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(blocks * BLOCK_BYTES, np.uint8)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            set_bits(bits, probe_positions(_words(values), blocks).ravel())
        yield from _blocks_of(bits, bits, blocks=blocks)
    return merge_bits(buckets.select("bucket").mapInArrow(fold, "block long, once binary, twice binary"), blocks)


def _passes(bits: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return has_bits(bits, probe_positions(_words(buckets), len(bits) // BLOCK_BYTES)).all(axis=1)


def _found_pieces(texts: DataFrame, length: int, bits: bytes) -> DataFrame:
    """``bucket, piece, several, k1, k2, at, starts``: every occurrence of a piece whose bucket passes the filter."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = Cutter(length), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for buffer, _, who, at, first, counts, buckets, several in cutter.pieces(batch.column(2).to_pylist()):
                use = np.flatnonzero(_passes(known, buckets))
                spans = zip(first[use].tolist(), (first + counts + length - 1)[use].tolist(), strict=True)
                names = np.array([xxhash.xxh3_64_intdigest(buffer[a:b]) for a, b in spans], np.uint64)
                columns = (buckets[use].view(np.int64), names.view(np.int64), several[use], k1[who[use]], k2[who[use]],
                           at[use], counts[use])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                                 ["bucket", "piece", "several", "k1", "k2", "at", "starts"])
    return texts.mapInArrow(find, "bucket long, piece long, several boolean, k1 long, k2 long, at long, starts long")


def _signed(value: int) -> int:
    return value - (value >> 63 << 64)


_OPEN = "bucket long, piece long, start long, core long, size long, bytes binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
                                      [name for name, _ in fields])


def _open_texts(texts: DataFrame, length: int, sorted_bits: bytes, crowded_bits: bytes) -> DataFrame:
    """``bucket, piece, start, core, size, bytes`` of pieces to compare, once for each batch of documents.

    In a crowded bucket a piece comes in runs of starts with one place of the least hash, from
    ``start`` on, with that place in the bytes as ``core`` and its ``size``; else whole, with ``core`` -1.
    """
    context = texts.sparkSession.sparkContext
    shared = context.broadcast((sorted_bits, crowded_bits))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(length)
        filters = [np.frombuffer(b, np.uint8) for b in shared.value]
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for buffer, places, _, _, first, counts, buckets, _ in cutter.pieces(batch.column(2).to_pylist()):
                rows: list[tuple] = []
                crowded = _passes(filters[1], buckets)
                for i in np.flatnonzero(crowded | _passes(filters[0], buckets)).tolist():
                    a, n, bucket = int(first[i]), int(counts[i]), int(buckets[i:i + 1].view(np.int64)[0])
                    data = buffer[a:a + n + length - 1]
                    piece = _signed(xxhash.xxh3_64_intdigest(data))
                    if (bucket, piece) in seen:
                        continue
                    seen.add((bucket, piece))
                    if not crowded[i]:
                        rows.append((bucket, piece, 0, -1, 0, data))
                        continue
                    own = places[a:a + n]
                    begins = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))).tolist()
                    for k, end in zip(begins, [*begins[1:], n], strict=True):
                        rows.append((bucket, piece, k, int(own[k]) - a - k, GRAM, data[k:end + length - 1]))
                if rows:
                    yield _batch(rows, _OPEN)
    return texts.mapInArrow(cut, _OPEN)


def halves(start: int, core: int, size: int, data: bytes, length: int) -> list[tuple[int, int, int, bytes, int]]:
    """A run of starts in two: those with half of the open bytes before the core, and the others.

    All strings contain the core. ``start, core, size, bytes, side`` have the longer core that
    the strings of a half have in common with it: bytes before it on side 0, after it on side 1.
    """
    free, n = length - size, len(data) - length + 1
    before = (free + 1) // 2
    border = min(max(core - before + 1, 0), n)
    parts = []
    if border:
        parts.append((start, core - before, size + before, data[:border + length - 1], 0))
    if border < n:
        parts.append((start + border, core - border, size + free - before + 1, data[border:], 1))
    return parts


def _split(length: int):
    """Per task: ``bucket, piece, start, core, size, bytes`` in halves, with the ``part`` of the bucket by their core."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bucket, piece, first, core, size, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start, at, common, part, side in halves(first, core, size, data, length):
                    key = xxhash.xxh3_64_intdigest(part[at:at + common], seed=common << 1 | side)
                    rows.append((_signed(key), bucket, piece, start, at, common, part, _signed(xxhash.xxh3_64_intdigest(part))))
            yield _batch(rows, _PARTS)
    return split


_PARTS = "part long, bucket long, piece long, start long, core long, size long, bytes binary, same long"


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of successive numbers."""
    breaks = np.flatnonzero(np.diff(starts) != 1) + 1
    return [(int(r[0]), int(r[-1])) for r in np.split(starts, breaks)] if len(starts) else []


def sorted_block(pieces: list[tuple], length: int) -> list[tuple]:
    """Of whole buckets, ``name, first, last`` for each run of starts whose string is there twice; ``pieces`` are names and bytes."""
    text = np.frombuffer(b"".join(p for *_, p in pieces), np.uint8)
    sizes = np.array([len(p) for *_, p in pieces])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    starts = begins[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    order, shared = sort_suffixes(text, starts, length)
    hit = np.zeros(len(text), bool)
    hit[order[shared]] = True
    found = []
    for i in np.unique(owner[hit[starts]]).tolist():
        own = np.flatnonzero(hit[begins[i]:begins[i] + counts[i]])
        found += [(pieces[i][0], a, b) for a, b in _runs(own)]
    return found


_SPANS = "bucket long, piece long, first long, last long"


def _sort_blocks(length: int):
    """Per task: rows ``part, bucket, piece, start, bytes`` of one part come together; sort as many whole parts at once as a block holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        part: list[tuple] = []
        size, last = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            found = sorted_block(block, length) if block else []
            if found:
                yield _batch([(bucket, piece, start + a, start + b) for (bucket, piece, start), a, b in found], _SPANS)
        for batch in batches:
            for name, bucket, piece, start, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if part and name == last and part[-1][0] == (bucket, piece, start):
                    continue
                if name != last:
                    block += part
                    part, last = [], name
                    if size > BLOCK_TEXT:
                        yield from flush()
                        block, size = [], 0
                part.append(((bucket, piece, start), data))
                size += len(data)
        block += part
        yield from flush()
    return run


def _sorted_parts(rows: DataFrame, length: int) -> DataFrame:
    return rows.select("part", "bucket", "piece", "start", "bytes").repartition("part").sortWithinPartitions(
        "part", "bucket", "piece", "start").mapInArrow(_sort_blocks(length), _SPANS)


def crowded_spans(rows: DataFrame, length: int, bucket_pieces: int) -> DataFrame | None:
    """``bucket, piece, first, last``: runs of starts whose string is repeated, for runs of starts of crowded buckets.

    ``rows`` has ``bucket, piece, start, core, size, bytes``. Each round splits every run in
    two. Runs with equal bytes are repeated whole, and one of them stands for all in what
    follows; a part with few enough different runs is sorted, one with more is split again.
    After at most the logarithm of the length a part's core is the whole string.
    """
    found = None
    rows = written(rows.dropDuplicates(["bucket", "piece", "start"]), "crowded-runs")
    while rows.take(1):
        parts = written(rows.mapInArrow(_split(length), _PARTS), "crowded-parts")
        first = F.min(F.struct("bucket", "piece", "start")).alias("first")
        classes = written(parts.groupBy("part", "same").agg(F.count("*").alias("n"), first), "crowded-classes")
        kinds = written(classes.groupBy("part").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "crowded-kinds")
        whole = parts.join(classes.filter("n > 1").select("part", "same"), ["part", "same"]).select(
            "bucket", "piece", F.col("start").alias("first"), (F.col("start") + F.octet_length("bytes") - length).alias("last"))
        lone = classes.join(kinds, "part").select("part", "kinds", "first.*")
        left = written(parts.join(lone, ["part", "bucket", "piece", "start"]), "crowded-left")
        sorted_runs = _sorted_parts(left.filter(F.col("kinds") <= bucket_pieces), length)
        now = written(whole.unionByName(sorted_runs), "crowded-spans")
        found = now if found is None else found.unionByName(now)
        rows = left.filter(F.col("kinds") > bucket_pieces).select("bucket", "piece", "start", "core", "size", "bytes")
    return found


def repeated_spans(texts: DataFrame, length: int = LENGTH, max_filter_bytes: int = MAX_FILTER_BYTES,
                   bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """``k1, k2, begin, end``: byte ranges covered by strings of ``length`` bytes that occur elsewhere.

    ``texts`` has ``k1, k2`` (two hash words of the text) and ``data``; equal texts are two
    occurrences but have one set of ranges. Ranges may touch or overlap.
    """
    volume = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    bits = _repeated_buckets(texts, length, filter_blocks(volume // 128, BITS_PER_PIECE, max_filter_bytes))
    found = written(_found_pieces(texts, length, bits), "pieces")
    pieces = written(found.groupBy("bucket", "piece").agg(F.count("*").alias("n"), F.max("several").alias("several")),
                     "distinct-pieces")
    buckets = pieces.groupBy("bucket").agg(F.count("*").alias("kinds"), F.max("several").alias("several"))
    unequal = written(buckets.filter("kinds > 1 or several"), "buckets")
    crowded = unequal.filter(F.col("kinds") > bucket_pieces)
    ordinary = unequal.filter(F.col("kinds") <= bucket_pieces)
    texts_open = written(_open_texts(texts, length, _bucket_filter(ordinary, ordinary.count(), max_filter_bytes),
                                     _bucket_filter(crowded, crowded.count(), max_filter_bytes)), "open-pieces")
    runs = _sorted_parts(texts_open.filter("core < 0").withColumn("part", F.col("bucket")), length)
    split = crowded_spans(texts_open.filter("core >= 0"), length, bucket_pieces)
    partial = written((runs if split is None else runs.unionByName(split)).groupBy("bucket", "piece").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")), "piece-runs")
    once = written(pieces.filter("n > 1").select("bucket", "piece"), "whole-pieces")
    whole = found.join(once, ["bucket", "piece"]).select(
        "k1", "k2", F.col("at").alias("begin"), (F.col("at") + F.col("starts") - 1 + length).alias("end"))
    parts = found.join(partial, ["bucket", "piece"]).select("k1", "k2", "at", F.explode("runs").alias("r")).select(
        "k1", "k2", (F.col("at") + F.col("r.first")).alias("begin"), (F.col("at") + F.col("r.last") + length).alias("end"))
    return whole.unionByName(parts).distinct()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``doc_id, n_bytes, data, ranges`` without the ranges, some hundred at once."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(at, ROWS_AT_ONCE)
            rows = []
            for data, ranges in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                merged: list[list[int]] = []
                for begin, end in sorted((r["begin"], r["end"]) for r in ranges or []):
                    if merged and begin <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([begin, end])
                edges = [0, *(e for span in merged for e in span), len(data)]
                rows.append((sum(b - a for a, b in merged), len(merged),
                             b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))))
            removed, spans, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text", id_col: str = "doc_id",
                   **options) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left, in order).

    A byte goes if a string of ``length`` bytes that covers it also starts elsewhere, in this or
    another document; strings never cross documents and are judged on the input. A null text
    is empty; a text shorter than ``length`` stays whole; texts that occur twice go whole if
    they are long enough. Repeated rows are repeated texts, an empty table gives an empty
    result, other columns aren't read. ``kept`` can begin or end inside a character.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2"), whole.cast("binary").alias("data"))
    ranges = written(repeated_spans(texts, length, **options).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges")), "ranges")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2"),
                       F.octet_length(whole).cast("long").alias("n_bytes"), whole.cast("binary").alias("data"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.join(ranges, ["k1", "k2"], "left").select("doc_id", "n_bytes", "data", "ranges").mapInArrow(
        _cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
