"""Prefix trie of conversations, built like a burst trie.

A conversation is the string of its turn ids, its path; equal paths are one record. All records
start in the container of the root. A container that holds too many bytes is burst: what its
records have in common becomes nodes of the upper trie, and every record moves to the container
of its next turn id. The containers left are spread over shards, sorted and swept into nodes.
Sums of the upper trie follow from one row for each container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.shared import written

# A turn id has 16 bytes of digest and the number of code points of its text in 8 more.
TURN = 24
# A container with more bytes of paths is burst.
CONTAINER_BYTES = 256 << 10
# Ends of one path are joined in pieces of so many neighbouring ids.
IDS_AT_ONCE = 4096
# Rows of a container get one of so many salts where they meet the row of their container.
SALTS = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


def turn_id(role: Column, text: Column) -> Column:
    """The binary id of a turn; a null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text)), 16, "0")))


def first_turns(path: Column, count: Column | int) -> Column:
    return F.substring(path, F.lit(1), F.lit(count) * TURN if isinstance(count, int) else (count * TURN).cast("int"))


def later_turns(path: Column, count: Column) -> Column:
    """The path after its first ``count`` turns."""
    return F.substring(path, (count * TURN + 1).cast("int"), F.octet_length(path))


def n_turns(path: Column) -> Column:
    return (F.octet_length(path) / TURN).cast("int")


def turn_paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """``conv_id, path``: the turn ids of every conversation in the order of turn, null first.

    Turns of one number follow their ids. Rows without a conversation id belong to no
    conversation and go; repeated rows are repeated turns. Texts stay in the scan.
    """
    ids = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), turn_id(F.col(role_col), F.col(text_col)).alias("id"))
        .alias("t"))
    turns_of = F.sort_array(F.collect_list("t"))
    return ids.groupBy("conv_id").agg(turns_of.alias("turns")).select(
        "conv_id", F.aggregate("turns.id", F.lit(b""), lambda path, t: F.concat(path, t)).alias("path"))


# --- records of equal paths -----------------------------------------------------

def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: one row for each path, whose pieces of ids come in order; only a digest is held."""
    found: list[tuple[bytes, int, int, str]] = []
    last, path, conv, n, digest = None, b"", 0, 0, hashlib.sha256()

    def taken() -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)],
                                           ["path", "conv", "n", "ends"])
        found.clear()
        return batch
    for batch in batches:
        for key, first, ids, count, whole in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if key != last:
                if last is not None:
                    found.append((path, conv, n, digest.hexdigest()))
                last, path, conv, n, digest = key, whole, first, 0, hashlib.sha256()
            digest.update((("," if n else "") + ids).encode())
            n += count
        yield taken()
    if last is not None:
        found.append((path, conv, n, digest.hexdigest()))
    yield taken()


def path_records(paths: DataFrame) -> DataFrame:
    """``path, conv, n, ends``: different paths, their smallest conversation, how many, and the digest of all.

    The ids of a path that very many conversations share are joined in pieces by neighbouring
    ids; the pieces pass through one digest in order and are never held together.
    """
    pieces = paths.groupBy(F.unhex(F.substring(F.sha2("path", 256), 1, 32)).alias("key"),
                           F.expr(f"conv_id div {IDS_AT_ONCE}").alias("piece")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"), F.first("path").alias("path"))
    rows = pieces.select("key", F.col("ids")[0].alias("first"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
                         F.size("ids").cast("long").alias("n"), "path")
    return rows.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        _joined_ends, "path binary, conv long, n long, ends string")


# --- bursting -------------------------------------------------------------------

def common_turns(one: Column, two: Column) -> Column:
    """How many whole turns two paths begin with alike."""
    places = F.sequence(F.lit(1), F.least(n_turns(one), n_turns(two)))
    same = F.transform(places, lambda i: F.substring(one, (i - 1) * TURN + 1, F.lit(TURN)) == F.substring(two, (i - 1) * TURN + 1, F.lit(TURN)))
    shorter = F.least(n_turns(one), n_turns(two))
    differs = F.array_position(F.when(shorter > 0, same).otherwise(F.array().cast("array<boolean>")), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(shorter).cast("int")


def burst(records: DataFrame, container_bytes: int = CONTAINER_BYTES) -> tuple[DataFrame, DataFrame]:
    """Records placed in containers, and the heads of the containers that were burst.

    A record has beside ``path, conv, n, ends`` the ``depth`` of its container's head, the
    ``key`` of the head, the smallest conversation of the node above (``above``) and the keys
    of all burst heads on the way (``line``, nearest last); ``ends_here`` tells a path that
    ends where its container was burst. A head has ``key, line, above``, the depths ``low`` to
    ``high`` of the nodes in common, their ``path``, ``conv`` and ``n``.
    """
    opened = written(records.select("*", F.lit(0).alias("depth"), F.lit(b"").alias("key"), F.lit(None).cast("long").alias("above"),
                                    F.array().cast("array<binary>").alias("line")), "trie-open")
    closed, heads = [], []
    while True:
        held = opened.groupBy("key").agg(
            F.sum(F.octet_length("path") - F.col("depth") * TURN).alias("bytes"), F.count("*").alias("size"), F.min("path").alias("least"),
            F.max("path").alias("most"), F.sum("n").alias("head_n"), F.min("conv").alias("head_conv"), F.first("depth").alias("low"),
            F.first("above").alias("above"), F.first("line").alias("line"))
        full = written(held.filter((F.col("bytes") > container_bytes) & (F.col("size") > 1)).withColumn(
            "high", common_turns(F.col("least"), F.col("most"))), "trie-full")
        heads.append(full.select("key", "line", "above", "low", "high", first_turns(F.col("least"), F.col("high")).alias("path"),
                                 F.col("head_conv").alias("conv"), F.col("head_n").alias("n")))
        if not full.take(1):
            closed.append(opened.withColumn("ends_here", F.lit(False)))
            break
        # A container may hold very many records, so its row meets them under several salts.
        salted = written(opened.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")), "trie-salted")
        rows = full.select("key", "high", "head_conv", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        met = written(salted.join(rows, ["key", "salt"], "left").drop("salt"), "trie-met")
        closed.append(met.filter("high is null").drop("high", "head_conv").withColumn("ends_here", F.lit(False)))
        moving = met.filter("high is not null")
        deeper = F.col("high") + 1
        ends = n_turns(F.col("path")) == F.col("high")
        closed.append(moving.filter(ends).withColumn("ends_here", F.lit(True)).drop("high", "head_conv"))
        head = F.unhex(F.substring(F.sha2(first_turns(F.col("path"), deeper), 256), 1, 32))
        opened = written(moving.filter(~ends).select(
            "path", "conv", "n", "ends", deeper.alias("depth"), head.alias("key"), F.col("head_conv").alias("above"),
            F.concat("line", F.array("key")).alias("line")), "trie-open")
    placed, upper = closed[0], heads[0]
    for part in closed[1:]:
        placed = placed.unionByName(part)
    for part in heads[1:]:
        upper = upper.unionByName(part)
    return placed, upper


# --- sweeping containers --------------------------------------------------------

@dataclass(slots=True)
class Node:
    conv: int
    depth: int
    parent: int
    size: int
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str = NO_ENDS


def container_nodes(rows: list[tuple[bytes, int, int, str]], depth: int) -> list[Node]:
    """Nodes of one container from its sorted ``path, conv, n, ends``, the head at ``depth`` first, parents before children."""
    nodes: list[Node] = []
    line: list[int] = []
    before = b""
    for path, conv, n, ends in rows:
        turns, common = len(path) // TURN, depth if nodes else depth - 1
        while nodes and common < turns and path[common * TURN:(common + 1) * TURN] == before[common * TURN:(common + 1) * TURN]:
            common += 1
        del line[common + 1 - depth:]
        for d in range(common + 1, turns + 1):
            nodes.append(Node(conv, d, line[-1] if line else -1, int.from_bytes(path[d * TURN - 8:d * TURN]) if d else 0))
            line.append(len(nodes) - 1)
        last = nodes[line[-1]]
        last.conv, last.n, last.ends = min(last.conv, conv), n, ends
        before = path
    for node in reversed(nodes):
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.size
        if node.parent >= 0:
            above = nodes[node.parent]
            above.conv = min(above.conv, node.conv)
            above.n += node.n
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
    return nodes


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: containers come whole and sorted; each becomes nodes, its head with the line above it."""
    def nodes(rows: list[tuple], depth: int, above: int | None, line: list[bytes]) -> pa.RecordBatch:
        found = container_nodes(rows, depth)
        numbers = zip(*((f.conv, f.depth, above if f.parent < 0 else found[f.parent].conv, f.n, f.children, f.leaves, f.saved)
                        for f in found), strict=True)
        lines = [line] + [None] * (len(found) - 1)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array([f.ends for f in found]),
                                           pa.array(lines, pa.list_(pa.binary()))],
                                          [c.split()[0] for c in NODE.split(", ")] + ["line"])
    last, rows, about = None, [], None
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(8))
        for key, path, conv, n, ends, depth, above, line in zip(*columns, strict=True):
            if key != last:
                if rows:
                    yield nodes(rows, *about)
                last, rows, about = key, [], (depth, above, line)
            rows.append((path, conv, n, ends))
    if rows:
        yield nodes(rows, *about)


def prefix_trie(paths: DataFrame, container_bytes: int = CONTAINER_BYTES) -> DataFrame:
    """One row for each distinct beginning of the paths in ``conv_id, path``, the empty one included.

    ``conv_id`` is the smallest conversation that begins so, ``parent_conv_id`` that of the
    beginning one turn shorter, null at the root. ``saved_tokens`` sums over the subtree the
    code points of a node's last text times its conversations but one. ``ends_sha256`` is the
    digest of the ids, ascending and joined by commas, of the conversations that end there. An
    empty table gives an empty result. A conversation's path is one value of 24 bytes a turn.
    """
    records = written(path_records(paths), "trie-records")
    placed, upper = burst(records, container_bytes)
    contained = placed.filter(~F.col("ends_here")).select("key", "path", "conv", "n", "ends", "depth", "above", "line")
    swept = written(contained.repartition("key").sortWithinPartitions("key", "path").mapInArrow(
        _swept, NODE + ", line array<binary>"), "trie-nodes")
    heads = written(upper, "trie-heads")
    # What a burst head gets from below: leaves and sums of all containers, its own children and ends.
    lengths = F.transform(F.sequence(F.col("low"), F.col("high")), lambda d: F.when(d > 0, F.conv(F.hex(F.substring(
        F.col("path"), (d * TURN - 7).cast("int"), F.lit(8))), 16, 10).cast("long")).otherwise(F.lit(0).cast("long")))
    chains = heads.select("*", F.transform(lengths, lambda n: n * (F.col("n") - 1)).alias("shares"))
    total = F.aggregate("shares", F.lit(0).cast("long"), lambda a, b: a + b)
    below = swept.filter("line is not null").select("line", "n_leaves", "saved_tokens").unionByName(
        chains.select("line", F.lit(0).cast("long").alias("n_leaves"), total.alias("saved_tokens")))
    nearest = F.size("line") - 1
    sums = below.select(F.posexplode("line").alias("at", "key"), nearest.alias("last"), "n_leaves", "saved_tokens").select(
        "key", "n_leaves", "saved_tokens", (F.col("at") == F.col("last")).cast("long").alias("children"), F.lit(None).cast("string").alias("ends"))
    enders = placed.filter("ends_here").select("key", *[F.lit(0).cast("long").alias(c) for c in ("n_leaves", "saved_tokens", "children")], "ends")
    gained = written(sums.unionByName(enders).groupBy("key").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"), F.sum("children").alias("children"),
        F.max("ends").alias("ends")), "trie-sums")
    joined = chains.join(gained, "key").select("conv", "above", "low", "high", "n", "shares", "n_leaves", "below", "children", "ends",
                                               F.posexplode("shares").alias("at", "share"))
    last = F.col("low") + F.col("at") == F.col("high")
    rest = F.aggregate(F.slice("shares", F.col("at") + 1, F.size("shares")), F.lit(0).cast("long"), lambda a, b: a + b)
    shared = joined.select(
        F.col("conv").alias("conv_id"), (F.col("low") + F.col("at")).cast("long").alias("depth"),
        F.when(F.col("at") == 0, F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), "n_leaves", (F.col("below") + rest).alias("saved_tokens"),
        F.when(last & F.col("ends").isNotNull(), F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"))
    return swept.drop("line").unionByName(shared)
