"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
ORDERS = 3
SMOOTHING = 0.5
# The model is broadcast: BUCKETS doubles for each language. More labels than this are an error.
MAX_LANGUAGES = 512
# Characters worked on at once, also inside a long text.
CHUNK = 1 << 19
# Buckets of one row of the count table.
BLOCK = 1 << 10
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray], list[int]]]:
    """Texts as code points in runs of about CHUNK: document, code points, how many of them start n-grams."""
    which, codes, counted, total = [], [], [], 0
    for i, text in enumerate(texts):
        points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        for at in range(0, len(points), CHUNK):
            part = points[at:at + CHUNK + ORDERS - 1]
            which.append(i)
            codes.append(part)
            counted.append(min(CHUNK, len(points) - at))
            total += len(part)
            if total >= CHUNK:
                yield which, codes, counted
                which, codes, counted, total = [], [], [], 0
    if which:
        yield which, codes, counted


def _hashed(codes: list[np.ndarray], counted: list[int]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams at every place for each order, which places count, where pieces start.

    Two marks end every piece, so that no n-gram spans two of them.
    """
    marks = np.zeros(ORDERS - 1, np.uint32)
    flat = np.concatenate([x for c in codes for x in (c, marks)] + [marks]).astype(np.uint64)
    sizes = np.array([len(c) + len(marks) for c in codes])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    places = int(sizes.sum())
    counts = np.repeat(np.array(counted), sizes) > np.arange(places) - np.repeat(starts, sizes)
    mixed, buckets = np.zeros(places, np.uint64), []
    for n in range(ORDERS):
        mixed = (mixed + flat[n:n + places] + np.uint64(n + 1)) * _FACTORS[n]
        mixed ^= mixed >> np.uint64(29)
        buckets.append(((mixed * _FACTORS[0]) >> np.uint64(64 - 15)).astype(np.int64))
    return buckets, counts, starts


def _table(lang: list[str], block: list[int], counts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(block, pa.int32()), pa.array(counts, pa.binary())],
                                      ["lang", "block", "counts"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: n-gram counts of each language in blocks of buckets; block -1 holds its documents."""
    totals: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            counts = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            documents[lang] = documents.get(lang, 0) + len(own)
            for _, codes, counted in _pieces(own):
                buckets, counts_here, _ = _hashed(codes, counted)
                for order in buckets:
                    counts += np.bincount(order[counts_here], minlength=BUCKETS)
    for lang, counts in totals.items():
        blocks = [np.array([documents[lang]]).tobytes(), *(b.tobytes() for b in counts.reshape(-1, BLOCK))]
        yield _table([lang] * len(blocks), list(range(-1, len(blocks) - 1)), blocks)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        for lang, block, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            totals[lang, block] = totals.get((lang, block), 0) + np.frombuffer(counts, np.int64)
    if totals:
        yield _table([k[0] for k in totals], [k[1] for k in totals], [v.tobytes() for v in totals.values()])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row with a language; null texts count as empty.

    Each task adds up its own counts, tasks meet in blocks of buckets, and the driver gets
    BUCKETS sums for each language. Without a labelled row the model knows no language.
    """
    schema = "lang string, block int, counts binary"
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # The model has a fixed size for each language, so their number is known before anything is counted.
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    summed = rows.mapInArrow(_count, schema).repartition("lang", "block").mapInArrow(_add, schema)
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for row in summed.collect():  # BUCKETS numbers for each language
        values = np.frombuffer(row["counts"], np.int64)
        if row["block"] < 0:
            documents[row["lang"]] = int(values[0])
        else:
            counts.setdefault(row["lang"], np.zeros(BUCKETS))[row["block"] * BLOCK:][:BLOCK] = values
    languages = sorted(documents)
    table = np.array([counts[x] for x in languages]).reshape(-1, BUCKETS) + SMOOTHING
    sizes = np.array([documents[x] for x in languages], float)
    return LanguageModel(languages, np.log(sizes / max(1, sizes.sum())),
                         np.log(table / table.sum(axis=1, keepdims=True)))


def score_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    sums = np.tile(model.log_prior, (len(texts), 1))
    for which, codes, counted in _pieces(texts):
        buckets, counts, starts = _hashed(codes, counted)
        for k, table in enumerate(model.log_prob):
            places = sum(table[order] for order in buckets)
            places[~counts] = 0
            np.add.at(sums[:, k], which, np.add.reduceat(places, starts))
    known = np.array([bool(model.languages) and t is not None and any(c.isalpha() for c in t) for t in texts], bool)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = sums.argmax(axis=1)
    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    return ([model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
            np.where(known, share, 0.0))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of that language.

    Only the text is looked at. A null text, one without a letter, or any text under a model
    that knows no language is ``und`` with score 0; of equally likely languages the first by
    name wins. Columns of ``docs`` that have these two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = score_texts(shared.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents with a predicted language, however sure, with the columns that ``docs`` has.

    Null texts and texts without a letter go; a long text is read whole, repeated rows stay or
    go together, and of an empty table, or under a model without a language, nothing is left.
    Columns of ``docs`` named like those that ``predict`` adds keep their own values.
    """
    own = [c for c in ("lang_pred", "score") if c in docs.columns]
    spare = max(docs.columns, key=len) + "_"
    scored = predict(docs.withColumn(spare, F.struct(*own)) if own else docs, model, text_col)
    known = scored.filter(F.col("lang_pred") != UNKNOWN)
    return known.select(*[F.col(f"{spare}.{c}").alias(c) if c in own else F.col(c) for c in docs.columns])
