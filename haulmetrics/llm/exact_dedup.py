"""Exact duplicates by two passes over a bit filter.

Pass 1 folds the hash of every text into a Bloom filter that remembers which bits were set
once and which twice. All bits of a repeated hash were set at least twice, so pass 2 keeps
every row with a bit set only once out of the shuffle: it has no equal. The few others are
grouped by their whole hash, which removes false alarms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.shared import (
    BLOCK_BYTES,
    filter_blocks,
    has_bits,
    probe_positions,
    set_bits,
    written,
)

BITS_PER_ROW = 16
MAX_FILTER_BYTES = 64 << 20


def _words(hashes: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 4)[:, :2]


def _fold(blocks: int):
    """Per task: the blocks of bits that its hashes set, once and twice."""
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = (np.zeros(blocks * BLOCK_BYTES, np.uint8) for _ in range(2))
        for batch in batches:
            if len(batch):
                places, counts = np.unique(probe_positions(_words(batch["hash"]), blocks), return_counts=True)
                set_bits(twice, places[(counts > 1) | has_bits(once, places)])
                set_bits(once, places)
        used = np.flatnonzero(once.reshape(blocks, -1).any(axis=1))
        for part in np.array_split(used, max(1, len(used) // 256)):
            yield pd.DataFrame({"block": part, "once": [once.reshape(blocks, -1)[b].tobytes() for b in part],
                                "twice": [twice.reshape(blocks, -1)[b].tobytes() for b in part]})
    return fold


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: one row for each of its blocks, with the bits that were set twice by anyone."""
    merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, once, twice in zip(batch["block"], batch["once"], batch["twice"], strict=True):
            new_once, new_twice = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
            if block in merged:
                old_once, old_twice = merged[block]
                merged[block] = old_once | new_once, old_twice | new_twice | (old_once & new_once)
            else:
                merged[block] = new_once, new_twice
    yield pd.DataFrame({"block": list(merged), "bits": [t.tobytes() for _, t in merged.values()]})


def merge_bits(parts: DataFrame, blocks: int) -> bytes:
    """The bits set twice of all tasks' ``block, once, twice``; the driver gets ``blocks`` blocks at most."""
    merged = parts.repartition("block").mapInPandas(_merge, "block long, bits binary")
    bits = np.zeros((blocks, BLOCK_BYTES), np.uint8)
    for row in merged.collect():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def repeated_bits(hashes: DataFrame, rows: int, bits_per_row: int = BITS_PER_ROW,
                  max_bytes: int = MAX_FILTER_BYTES) -> bytes:
    """The bits that at least two of the 32-byte values of column ``hash`` set; ``max_bytes`` at most."""
    blocks = filter_blocks(rows, bits_per_row, max_bytes)
    parts = hashes.select("hash").mapInPandas(_fold(blocks), "block long, once binary, twice binary")
    return merge_bits(parts, blocks)


def maybe_repeated(hashes: DataFrame, bits: bytes) -> DataFrame:
    """Add ``maybe``: false only where no other row can have this hash."""
    shared = hashes.sparkSession.sparkContext.broadcast(bits)
    blocks = len(bits) // BLOCK_BYTES

    @F.pandas_udf("boolean")
    def maybe(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype=bool)
        places = probe_positions(_words(column), blocks)
        return pd.Series(has_bits(np.frombuffer(shared.value, np.uint8), places).all(axis=1))
    return hashes.withColumn("maybe", maybe("hash"))


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     bits_per_row: int = BITS_PER_ROW, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; a null text is an empty one, and all empty ones are
    one group. Of a group the row with the largest id stays; a null id is smaller than any
    other, and of rows repeated with one id exactly one stays. ``keep_id`` is null if no row
    of the group has an id. An empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("hash"),
                               F.monotonically_increasing_id().alias("row")), "text-hashes")
    bits = repeated_bits(rows, rows.count(), bits_per_row, max_filter_bytes)
    flagged = maybe_repeated(rows, bits)
    repeats = flagged.filter("maybe")
    groups = written(repeats.groupBy("hash").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                                 F.count("*").alias("group_size")), "text-groups")
    grouped = repeats.join(groups, "hash").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("keep.row") == F.col("row")).alias("kept"), "hash")
    single = flagged.filter("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "hash")
    return grouped.unionByName(single).withColumn("text_sha256", F.lower(F.hex("hash"))).drop("hash")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without rows that repeat a text; ids are taken as unique here, as in a corpus table."""
    gone = exact_duplicates(docs, text_col, id_col).filter("not kept").select(F.col("doc_id").alias("gone"))
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
