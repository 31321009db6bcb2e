"""Helpers of the training-data operators: written intermediate tables and bit filters."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from haulmetrics.session import ensure_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it again.

    The result survives lost executors and is computed once. A join between two written
    tables also has a plain shuffle on both sides, which adaptive execution can split when
    a key is hot; it can't do so above an aggregation.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# A bit filter is split into blocks of this many bits, so that it can be merged in parallel.
BLOCK_BITS = 1 << 16
BLOCK_BYTES = BLOCK_BITS // 8
PROBES = 4


def filter_blocks(rows: int, bits_per_row: int, max_bytes: int) -> int:
    """Blocks for so many rows. Past ``max_bytes`` a filter lets more rows through, it never loses one."""
    wanted = -(-rows * bits_per_row // BLOCK_BITS)
    return int(min(max(64, wanted), max(64, max_bytes // BLOCK_BYTES)))


def probe_positions(words: np.ndarray, blocks: int) -> np.ndarray:
    """Four bit positions inside one block for each row of two 64-bit hash words."""
    block = (words[:, 0] % np.uint64(blocks)).astype(np.int64) * BLOCK_BITS
    shifts = np.arange(PROBES, dtype=np.uint64) * np.uint64(16)
    inside = (words[:, 1:2] >> shifts) & np.uint64(0xFFFF)
    return block[:, None] + inside.astype(np.int64)


def set_bits(bits: np.ndarray, positions: np.ndarray) -> None:
    np.bitwise_or.at(bits, positions >> 3, (1 << (positions & 7)).astype(np.uint8))


def has_bits(bits: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (bits[positions >> 3] >> (positions & 7).astype(np.uint8)) & 1 == 1
