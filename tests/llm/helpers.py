"""Small corpora with the awkward rows that every operator must take."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# Names of columns that operators use or add themselves.
CLASHING = ("k1", "k2", "_k1", "_k2", "hash", "shard", "slot", "n_copies", "n_tokens", "lang_pred", "score", "host", "n_items", "fp", "gone",
            "_gone", "epochs", "cut", "rest", "digits", "piece", "place", "row", "_key", "_level0", "budget", "tokens", "_path", "_day",
            "lists", "n_active", "blocked", "contaminated", "item_id", "order_key", "component_id", "fingerprint", "keep_id", "kept",
            "group_size", "bits", "word", "n", "form", "root", "spans", "labels", "n_base", "copy", "own", "_own", "_n1", "_l1", "h", "pos", "at")


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfghklmnprst')}{rng.choice('aeiou')}{rng.choice('lnrst')}{rng.randrange(vocabulary)}x"
                    for _ in range(words))


def awkward_rows() -> list[tuple]:
    """Nulls everywhere, empty and blank texts, repeats and ties, a long text, letters of several scripts."""
    base = prose(1, 120)
    return [
        (None, None, None, None, None), (1, None, "en", "src1", 0), (2, "", "en", "src1", 0), (3, " \t\n ", None, "src2", 4),
        (4, base, "en", "src0", len(base)), (5, base, "en", None, len(base)), (5, base, "en", None, len(base)),
        (None, base, "de", "src3", len(base)), (6, base + " und so weiter", "de", "src3", 0), (7, "12345 !!! 678", "fr", "x", 13),
        (8, "Ünïcödé ß 漢字 😀 żółć", "de", "src4", 20), (9, prose(2, 60_000), "en", "src0", 0),
        (10, "a", "en", "src5", 1), (11, "a", "en", "src5", 1), (12, "aaaa " * 900, "en", "src6", 4500),
        (13, "HELLO Hello hello\x00\x1c\x85", "en", "src0", 19), (14, "ab" * 700, "en", "src0", 1400),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs):
    for name in CLASHING:
        if name not in docs.columns:
            docs = docs.selectExpr("*", f"cast(null as string) as `{name}`")
    return docs


def rows(df, *names):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
