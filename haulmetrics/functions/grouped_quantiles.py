"""Exact quantiles per key, for keys with any number of rows and of different values.

A sketch for each key brackets every wanted rank in one grouped aggregate. A second grouped
pass counts, for each bracket, the rows below it and the different values inside; running sums
over parts of a bracket's range then give the value at the rank. The sketch's error decides how
many values are counted, never the result: a rank that turns out to lie outside its bracket is
looked for again among all values of its key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmetrics.functions.exprs import dbl
from haulmetrics.functions.ranks import prefix_sums
from haulmetrics.session import cut_lineage

SKETCH_ACCURACY = 10_000
MARGIN = 2.0 / SKETCH_ACCURACY
# Brackets of a key with fewer rows than this hold all its values.
SMALL_KEY = 10_000


def _counted(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """``key, q, value, n, before_n``: the different values inside every bracket, their rows, and the key's rows below them."""
    v = F.col("value")
    # The rows below a bracket count as one value, null, which comes first.
    seen = F.transform(F.filter("brackets", lambda b: v <= b["high"]), lambda b: F.struct(
        b["q"].alias("q"), F.when(v >= b["low"], v).alias("value")))
    of_key = brackets.groupBy("hash", F.col("key").alias("of")).agg(F.collect_set(F.struct("q", "low", "high")).alias("brackets"))
    met = values.join(of_key, "hash").where(F.col("key") == F.col("of"))
    counts = met.select("hash", "key", F.explode(seen).alias("e")).groupBy("hash", "key", "e.q", "e.value").agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.withColumn("inside", F.col("value").isNotNull())
    return prefix_sums(ordered, ["hash", "key", "q"], ["inside", "value"], ["n"]).where("inside")


def _read(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, q, rank, value`` of the ``wanted`` ranks that lie in their brackets."""
    ranks = wanted.select(F.col("hash").alias("h"), F.col("key").alias("of"), F.col("q").alias("at"), "rank")
    same = (F.col("hash") == F.col("h")) & (F.col("key") == F.col("of")) & (F.col("q") == F.col("at"))
    inside = F.col("rank").between(F.col("before_n"), F.col("before_n") + F.col("n") - 1)
    return _counted(values, wanted.select("hash", "key", "q", "low", "high").distinct()).join(ranks, same).where(inside).select(
        "key", "q", "rank", "value")


def _between(a: Column, b: Column, part: Column) -> Column:
    """``quantiles.between`` for ``a <= b``; null for nulls."""
    fused = F.java_method(F.lit("java.lang.Math"), F.lit("fma"), a, 1 - part, b * part).cast("double")
    return F.when(a < b, fused).otherwise(a)


def grouped_quantiles(df: DataFrame, by: Sequence[str], column: str | Column, probabilities: Mapping[str, float]) -> DataFrame:
    """(``by``, ``n``, one column for each named probability): linear interpolation between neighbouring ranks.

    ``n`` counts the rows with a value, which a null or NaN is not; a key without any has null
    quantiles, and a null key is a key. An empty table gives an empty result.
    """
    number = dbl(column)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)])
    values = df.select(key.alias("key"), F.when(~F.isnan(number), number).alias("value")).withColumn("hash", F.xxhash64("key"))
    grid = [min(1.0, max(0.0, p + d)) for p in probabilities.values() for d in (-MARGIN, MARGIN)]
    sketch = cut_lineage(values.groupBy("hash", "key").agg(
        F.count("value").alias("n"), F.percentile_approx("value", grid, SKETCH_ACCURACY).alias("edges")))
    positions = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probabilities.items()}
    few = F.col("n") < SMALL_KEY

    def ranks(q: int, position: Column) -> Column:
        low = F.when(few, -math.inf).otherwise(F.col("edges")[2 * q])
        high = F.when(few, math.inf).otherwise(F.col("edges")[2 * q + 1])
        both = F.array_distinct(F.array(F.floor(position).cast("long"), F.ceil(position).cast("long")))
        return F.transform(both, lambda rank: F.struct(F.lit(q).alias("q"), rank.alias("rank"), low.alias("low"), high.alias("high")))
    wanted = sketch.where("n > 0").select("hash", "key", F.explode(F.concat(*[
        ranks(q, position) for q, position in enumerate(positions.values())])).alias("w")).select("hash", "key", "w.*")
    found = cut_lineage(_read(values, wanted))
    done = found.select(F.col("key").alias("of"), F.col("q").alias("at"), F.col("rank").alias("seen"))
    lost = cut_lineage(wanted.join(done, (F.col("key") == F.col("of")) & (F.col("q") == F.col("at")) & (F.col("rank") == F.col("seen")),
                                   "left_anti").withColumns({"low": F.lit(-math.inf), "high": F.lit(math.inf)}))
    if lost.take(1):
        found = found.unionByName(_read(values, lost))
    ends = [F.when(F.col("q") == q, F.col("value")) for q in range(len(positions))]
    read = found.groupBy(F.col("key").alias("of")).agg(*[F.min(e).alias(f"a{q}") for q, e in enumerate(ends)],
                                                      *[F.max(e).alias(f"b{q}") for q, e in enumerate(ends)])
    out = []
    for q, (name, position) in enumerate(positions.items()):
        out.append(_between(F.col(f"a{q}"), F.col(f"b{q}"), position - F.floor(position)).alias(name))
    return sketch.join(read, F.col("key") == F.col("of"), "left").select(
        *[F.col(f"key.k{i}").alias(c) for i, c in enumerate(by)], "n", *out)
