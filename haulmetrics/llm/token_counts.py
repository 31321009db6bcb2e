"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of arrays.

The different pre-tokens of a batch lie one after the other in one array of symbols. A round
looks up the rank of every neighbouring pair, finds the lowest rank of each pre-token, and
merges that pair wherever the pre-token has it, all pre-tokens at once. A pre-token without a
known pair leaves the array; the symbols it has then are its tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how this kind of tokenizer splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Counts of pre-tokens that a task remembers, pre-tokens no longer than this, and characters split at once.
REMEMBERED = 200_000
SHORT = 40
CHUNK = 1 << 20
_NONE = np.int64(1 << 40)


@dataclass(frozen=True)
class MergeTable:
    """Sorted pair keys with their rank and result; symbol of each byte; special strings."""

    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    bytes_to_symbol: np.ndarray
    special: tuple[str, ...]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _unsupported(spec: dict) -> list[str]:
    """Settings of a tokenizer file that would change its counts and that this module doesn't have."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    found = [] if model.get("type") == "BPE" else ["model type"]
    found += [k for k in ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    found += ["normalizer"] if spec.get("normalizer") else []
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        found.append("pre_tokenizer")
    flags = ("single_word", "lstrip", "rstrip")
    return found + [f"added token {t['content']!r}" for t in spec.get("added_tokens", []) if any(t.get(k) for k in flags)]


def load_merges(path: str) -> MergeTable:
    """Read a tokenizer file of the byte-level BPE kind; a few MB, as large as its vocabulary.

    A file that splits, normalises or merges in another way is an error that names the settings.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if wrong := _unsupported(spec):
        raise ValueError(f"only plain byte-level BPE files are supported, not with {', '.join(wrong)}")
    model = spec["model"]
    ids = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left, right, result = (np.array(x, np.int64) for x in zip(*[(ids[a], ids[b], ids[a + b]) for a, b in pairs],
                                                              strict=True))
    keys = left << 32 | right
    order = np.argsort(keys, kind="stable")
    # The longest of several special strings at one place counts.
    special = tuple(sorted((t["content"] for t in spec.get("added_tokens", [])), key=lambda t: (-len(t), t)))
    return MergeTable(keys[order], np.arange(len(keys))[order], result[order],
                      np.array([ids[c] for c in byte_letters()], np.int64), special)


def count_symbols(table: MergeTable, words: list[bytes]) -> np.ndarray:
    """Symbols left of each non-empty byte string when no pair can be merged any more."""
    sizes = np.array([len(w) for w in words], np.int64)
    left = sizes.copy()
    active = np.flatnonzero(sizes > 1)
    owner = np.repeat(active, sizes[active])
    symbols = table.bytes_to_symbol[np.frombuffer(b"".join(words[i] for i in active), np.uint8)]
    while len(symbols):
        keys = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(table.keys, keys), len(table.keys) - 1)
        known = (table.keys[at] == keys) & (owner[:-1] == owner[1:])
        ranks = np.append(np.where(known, table.ranks[at], _NONE), _NONE)
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        lengths = np.diff(np.append(starts, len(owner)))
        lowest = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
        left[owner[starts]] = lengths
        hit = (ranks == lowest) & (lowest < _NONE)
        # In a run of one symbol every second pair is merged, from the left.
        places = np.flatnonzero(hit)
        heads = np.concatenate(([True], np.diff(places) != 1))
        first = places[heads][np.cumsum(heads) - 1] if len(places) else places
        places = places[(places - first) % 2 == 0]
        symbols[places] = table.results[at[places]]
        keep = lowest < _NONE
        keep[places + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return left


class Counter:
    """Counts tokens of texts; remembers the counts of short pre-tokens."""

    def __init__(self, table: MergeTable):
        self.table, self.known = table, {}
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None

    def _pretokens(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """Runs of pre-tokens, each with the number of special strings before it."""
        parts = self.special.split(text) if self.special else [text]
        for i, part in enumerate(parts):
            run, extra = [], int(i > 0)
            if len(part) <= CHUNK:
                run = self.split.findall(part)
            else:
                for match in self.split.finditer(part):
                    run.append(match.group())
                    if len(run) >= CHUNK // 8:
                        yield extra, run
                        run, extra = [], 0
            yield extra, run

    def _learn(self, fresh: list[str]) -> dict[str, int]:
        counts = count_symbols(self.table, [w.encode() for w in fresh]).tolist()
        return dict(zip(fresh, counts, strict=True))

    def count(self, texts: list[str | None]) -> list[int]:
        totals, waiting, held = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            for extra, run in self._pretokens(text or ""):
                totals[i] += extra
                waiting.append((i, run))
                held += len(run)
                if held > CHUNK:
                    self._flush(waiting, totals)
                    waiting, held = [], 0
        self._flush(waiting, totals)
        return totals

    def _flush(self, waiting: list[tuple[int, list[str]]], totals: list[int]) -> None:
        fresh = {w for _, run in waiting for w in run if w not in self.known}
        new = self._learn(list(fresh)) if fresh else {}
        if len(self.known) + len(new) > REMEMBERED:
            lookup, self.known = self.known | new, {}
        else:
            lookup = self.known | new if any(len(w) > SHORT for w in new) else None
            self.known.update((w, n) for w, n in new.items() if len(w) <= SHORT)
        get = (lookup or self.known).__getitem__
        for i, run in waiting:
            totals[i] += sum(map(get, run))


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id",
                 limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, whole texts.

    Special strings in a text are one token each, nothing is added around it. A null text is
    an empty one with 0 bytes and tokens. Equal rows give equal rows, an empty table gives an
    empty result, other columns are not read. The file is read once, by the driver.
    """
    table = docs.sparkSession.sparkContext.broadcast(load_merges(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counter.count(batch.column(2).to_pylist()), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
