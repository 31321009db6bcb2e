"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table. Shards take
turns claiming the first slot of their order that is free, so shares differ by one slot at most
and a change of the shard count moves little else. A document looks up the slot of its hash.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def lookup_table(shards: int, size: int = TABLE_SIZE, seed: str = "shards") -> list[int]:
    """The shard of every slot. ``size`` is prime, so each stride visits all slots."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime number")
    if not 1 <= shards <= size:
        raise ValueError("there must be at least one shard and at most one for each slot")
    place = [_number(f"{seed}/{s}/start") % size for s in range(shards)]
    stride = [_number(f"{seed}/{s}/stride") % (size - 1) + 1 for s in range(shards)]
    table, free, turn = [-1] * size, size, 0
    while free:
        while table[place[turn]] >= 0:
            place[turn] = (place[turn] + stride[turn]) % size
        table[place[turn]] = turn
        free -= 1
        turn = (turn + 1) % shards
    return table


def placement_key(id_col: str, text_col: str) -> Column:
    """What is hashed: the id, or the text of a row without one."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def assign_shards(docs: DataFrame, shards: int = 64, size: int = TABLE_SIZE, seed: str = "shards",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``slot``, ``shard`` and ``order_key``, a seeded order inside the shard.

    No row moves: the table of ``size`` rows is broadcast. Equal ids share a slot, a row
    without an id is placed by its text (null like empty), an empty table stays empty, and
    columns of ``docs`` that have these three names are replaced.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame(pd.DataFrame({"slot": range(size), "shard": lookup_table(shards, size, seed)}),
                                  "slot long, shard int")
    kept = docs.select(*[c for c in docs.columns if c not in ("slot", "shard", "order_key")])
    keyed = kept.withColumn("order_key", F.md5(F.concat(F.lit(f"{seed}/"), placement_key(id_col, text_col))))
    slots = keyed.withColumn("slot", F.conv(F.substring("order_key", 1, 12), 16, 10).cast("long") % size)
    # size rows of 12 bytes, whatever the input
    return slots.join(F.broadcast(table), "slot").select(*kept.columns, "slot", "shard", "order_key")


def write_shards(docs: DataFrame, path: str, shards: int = 64, files_per_shard: int = 16, **options) -> None:
    """One folder ``shard=n`` for each shard, its documents in seeded order over ``files_per_shard`` files."""
    placed = assign_shards(docs, shards, **options)
    part = F.conv(F.substring("order_key", 17, 8), 16, 10).cast("long") % files_per_shard
    (placed.withColumn("_part", part).repartition("shard", "_part").sortWithinPartitions("shard", "_part", "order_key")
     .drop("_part").write.partitionBy("shard").parquet(path))
