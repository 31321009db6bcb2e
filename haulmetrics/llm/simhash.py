"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Every fingerprint bit belongs to one of the non-zero vectors of ``radius + 1`` bits; a table
exists for each non-zero vector v and masks the fingerprint to the bits whose vector has an odd
inner product with v. Up to ``radius`` differing bits span less than the whole space, so some v
is orthogonal to all of them and its table doesn't see the difference: the pair collides there.
Equal fingerprints are collapsed first, so copies never meet as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.components import star_forest
from haulmetrics.llm.shared import written

BITS = 64
SEED = 42
# Members of a colliding group that one task compares; larger groups are compared in pairs of blocks.
BLOCK_MEMBERS = 1024
# Groups up to this size emit their links one by one, larger ones a spanning forest.
SMALL_GROUP = 12
# Shingles hashed before their bits are added up, which bounds the memory for a very long text.
CHUNK = 1 << 16


def text_fingerprint(text: str | None, words: int) -> int:
    """The 64-bit SimHash of ``words``-word shingles; 0 for a text without words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    count = max(1, len(tokens) - words + 1)
    starts = np.concatenate(([0], ends[:count - 1] + 1))
    stops = ends[min(words, len(tokens)) - 1:]
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, CHUNK):
        spans = zip(starts[at:at + CHUNK].tolist(), stops[at:at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, fp`` for every row; a null text counts as empty."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array((text_fingerprint(t.as_py(), words) for t in batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "fp"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        compute, f"doc_id {kind}, fp long")


def covering_masks(radius: int) -> list[int]:
    """Signed 64-bit masks, ``2 ** (radius + 1) - 1`` of them."""
    vectors = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << bit for bit in range(BITS) if ((bit % vectors + 1) & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _pairs(values: np.ndarray, groups: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside small groups, which lie one after the other."""
    found = []
    for step in range(1, SMALL_GROUP):
        near = (groups[step:] == groups[:-step]) & (np.bitwise_count(values[step:] ^ values[:-step]) <= radius)
        if near.any():
            found.append((values[step:][near], values[:-step][near]))
    return found


def _forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect exactly what the links inside one large group connect."""
    rest, heads, tails = np.unique(values), [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= radius
            if near.any():
                reached, rest = rest[near], rest[~near]
                front.extend(reached)
                heads.append(reached)
                tails.append(np.full(len(reached), root))
    none = np.array([], np.uint64)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (none, none)


def _links(radius: int):
    """Per task: the links of its groups, which come sorted; a group is at most two blocks."""
    def within(frame: pd.DataFrame) -> pd.DataFrame:
        values = frame["fp"].to_numpy().view(np.uint64)
        keys = frame[["mask", "key", "low", "high"]].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(values)))
        groups = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= SMALL_GROUP, sizes)
        found = _pairs(values[small], groups[small], radius)
        found += [_forest(values[a:a + n], radius) for a, n in zip(starts, sizes, strict=True) if n > SMALL_GROUP]
        if not found:
            return pd.DataFrame({"child": [], "parent": []}, dtype="int64")
        one, two = (np.concatenate(x) for x in zip(*found, strict=True))
        one, two = one.view(np.int64), two.view(np.int64)
        return pd.DataFrame({"child": np.maximum(one, two), "parent": np.minimum(one, two)}).drop_duplicates()

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(frame):
                continue
            last = (frame[["mask", "key", "low", "high"]] == frame[["mask", "key", "low", "high"]].iloc[-1]).all(axis=1)
            rest = frame[last]
            yield within(frame[~last]) if not last.all() else pd.DataFrame({"child": [], "parent": []}, dtype="int64")
        if rest is not None:
            yield within(rest)
    return links


def near_links(distinct: DataFrame, radius: int = 3, block: int = BLOCK_MEMBERS) -> DataFrame:
    """``child, parent`` that connect the distinct fingerprints ``fp`` as all links within ``radius`` do.

    A group that collides in a table and outgrows a block is cut into blocks by a hash; each
    pair of its blocks is compared in a task of its own, so no link is lost and no task holds
    more than two blocks.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(m).bitwiseAND(F.col("fp")).alias("key"))
                       for i, m in enumerate(covering_masks(radius))])
    placed = distinct.select("fp", F.explode(tables).alias("t")).select("fp", "t.mask", "t.key")
    crowded = written(placed.groupBy("mask", "key").count().filter("count > 1"), "collisions")
    blocks = F.ceil(F.col("count") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", "key"), F.col("blocks")).cast("int")
    members = placed.join(crowded, ["mask", "key"]).withColumn("blocks", blocks).withColumn("own", own).select(
        "fp", "mask", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "fp", "mask", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return members.repartition("mask", "key", "low", "high").sortWithinPartitions(
        "mask", "key", "low", "high").mapInPandas(_links(radius), "child long, parent long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Words are runs of non-blank ASCII-lowered bytes, shingles keep repeats. A null, empty or
    blank text has fingerprint zero and links like any other. Fingerprints within ``radius``
    bits link, and ``component_id`` is the smallest id that links reach; null ids count for
    nothing, so it is null only if no document of the component has an id. Rows repeated with
    one id give repeated rows. An empty table gives an empty result; other columns aren't read.
    """
    rows = written(fingerprints(docs, words, text_col, id_col), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    forest = star_forest(near_links(distinct, radius))
    roots = forest.select(F.col("parent").alias("fp"), F.col("parent").alias("root")).distinct()
    members = written(forest.select(F.col("child").alias("fp"), F.col("parent").alias("root")).unionByName(roots),
                      "members")
    firsts = written(members.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component_id")), "firsts")
    placed = written(members.join(firsts, "root").select("fp", "component_id"), "placed")
    classes = written(distinct.join(placed, "fp", "left").select(
        "fp", F.when(F.col("component_id").isNull(), F.col("first")).otherwise(F.col("component_id"))
        .alias("component_id")), "classes")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, words: int = 3, radius: int = 3, text_col: str = "text",
                           id_col: str = "doc_id") -> DataFrame:
    """The documents of ``docs`` that are the first of their component.

    Of rows repeated with one id all or none stay; rows without an id stay. Texts without a
    word are near each other, so one of them stays; an empty table gives an empty result.
    """
    firsts = near_duplicates(docs, words, radius, text_col, id_col).filter(
        "doc_id is not null and doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    gone = written(firsts, "near-copies")
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
