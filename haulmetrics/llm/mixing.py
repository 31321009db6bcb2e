"""Mixing of sources to target weights by hierarchical budgeting.

A token budget flows down a tree such as domain, language, source by the weights of siblings. A
child that can't use its share, all its tokens in all its epochs, gets what it has; the rest goes
to its siblings by weight. Since a node's need is the sum of its leaves' needs, a shortage reaches
other branches only when all siblings are full. A leaf takes whole epochs and then a prefix of the
next epoch's seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.shared import written

# Documents of a leaf in one piece of its order; only the piece with the cut is sorted.
PIECE_ROWS = 1_000


def word_tokens(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0)).cast("long")


def _pour(children: DataFrame, parent: list[str], node: str) -> DataFrame:
    """Share ``budget`` of the parent among the children by ``weight``, none above ``capacity``.

    In the order of capacity per weight the children that fill up come first, so running sums
    give the level that the others reach.
    """
    by = Window.partitionBy(*parent).orderBy(F.col("ratio").asc_nulls_last(), node)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.try_divide(F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), F.sum("weight").over(after))
    ranked = children.withColumn("ratio", F.try_divide("capacity", "weight")).withColumn("level", level)
    full = ranked.withColumn("full", F.coalesce(F.col("ratio") <= F.col("level"), F.lit(False)))
    reached = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(whole)
    return full.withColumn("budget", F.when(F.col("full"), F.col("capacity").cast("double")).otherwise(
        F.coalesce(reached * F.col("weight"), F.lit(0.0)))).drop("ratio", "level", "full")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[Column], budget: Column,
                 max_epochs: int) -> DataFrame:
    """``leaves`` (the level columns, ``tokens``, ``n_rows``) with ``budget`` in tokens.

    ``budget`` is an aggregate over the leaves. A weight is an expression over its level's
    column and those above; null and negative ones count as zero and get nothing.
    """
    sized = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    whole = sized.agg(budget.cast("double")).first()[0]
    shares = None
    for depth, (level, weight) in enumerate(zip(levels, weights, strict=True)):
        above = levels[:depth]
        nodes = sized.groupBy(*above, level).agg(F.sum("capacity").alias("capacity"))
        weighed = nodes.withColumn("weight", F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0)))
        funded = weighed.withColumn("budget", F.lit(whole)) if shares is None else weighed.join(shares, above)
        shares = written(_pour(funded, above, level).select(*above, level, "budget"), "budgets")
    return sized.join(shares, levels).drop("capacity").withColumn(
        "budget", F.floor(F.col("budget") + F.lit(1e-6)).cast("long"))


def mix(docs: DataFrame, levels: list[str], weights: list[Column], budget: Column | None = None, max_epochs: int = 4,
        seed: str = "mix", tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``n_copies``, how often the mixture takes the document.

    The order of epoch e is the MD5 of seed, e and id (the text's MD5 without an id); a leaf
    takes the longest prefix that fits. Rows with equal ids stand at one place and are taken
    together or not at all. A null in a level column is the level ''. Null, empty and blank
    texts have no tokens and follow their place in the order; a leaf without tokens takes
    nothing, an empty table gives an empty result. Columns of ``docs`` with the two names are
    replaced. The cut of each leaf is one value, so no document is shuffled for it; to find
    it, leaves are cut into pieces by the first digits of the order, and only the piece that
    holds the cut is sorted.
    """
    kept = docs.select(*[c for c in docs.columns if c not in ("n_tokens", "n_copies")])
    node = {f"_level{i}": F.coalesce(F.col(c).cast("string"), F.lit("")) for i, c in enumerate(levels)}
    # The row travels as one value, so its names can't meet those of the joins.
    row = F.struct(*kept.columns).alias("row")
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    counted = kept.select(row, *[c.alias(n) for n, c in node.items()], key.alias("_key"),
                          (word_tokens(text_col) if tokens is None else tokens).alias("n_tokens"))
    names = list(node)
    rows = written(counted.select(*names, "_key", "n_tokens"), "mix-rows")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows"))
    leaves = written(leaves.withColumnsRenamed(dict(zip(names, levels, strict=True))), "mix-leaves")
    budgets = leaf_budgets(leaves, levels, weights, F.sum("tokens") if budget is None else budget, max_epochs)
    plan = written(budgets.select(
        *[F.col(c).alias(n) for c, n in zip(levels, names, strict=True)],
        F.coalesce(F.expr("try_divide(budget - budget % tokens, tokens)"), F.lit(0)).cast("long").alias("epochs"),
        F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END").alias("rest"),
        F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n_rows") / PIECE_ROWS))).cast("int").alias("digits")), "mix-plan")
    order = F.md5(F.concat(F.lit(f"{seed}-"), (F.col("epochs") + 1).cast("string"), F.lit("-"), F.col("_key")))
    ordered = rows.join(plan.filter("rest > 0"), names).withColumn("place", order).withColumn(
        "piece", F.expr("substr(place, 1, digits)"))
    pieces = ordered.groupBy(*names, "piece", "rest").agg(F.sum("n_tokens").alias("tokens"), F.max("place").alias("last"))
    run = Window.partitionBy(*names).orderBy("piece")
    upto = written(pieces.withColumn("upto", F.sum("tokens").over(run)), "mix-pieces")
    split = upto.filter("upto > rest and upto - tokens <= rest").select(*names, "piece", (F.col("upto") - F.col("tokens")).alias("start"))
    inside = ordered.join(split, [*names, "piece"]).withColumn(
        "sum", F.col("start") + F.sum("n_tokens").over(Window.partitionBy(*names, "piece").orderBy("place")))
    cuts = inside.filter("sum <= rest").select(*names, F.col("place").alias("last")).unionByName(
        upto.filter("upto <= rest").select(*names, "last")).groupBy(*names).agg(F.max("last").alias("cut"))
    table = written(plan.join(cuts, names, "left").select(*names, "epochs", "cut"), "mix-cuts")
    copies = F.col("epochs") + F.coalesce((order <= F.col("cut")).cast("long"), F.lit(0))
    return counted.join(table, names, "left").select("row.*", "n_tokens", copies.alias("n_copies"))


def draw(docs: DataFrame, *args, **options) -> DataFrame:
    """The mixture itself: every document as often as ``mix`` takes it, with the columns of ``docs``.

    Nulls, empty texts, repeated rows and empty tables are treated as there; columns of
    ``docs`` named like those that ``mix`` adds keep their own values.
    """
    own = [c for c in ("n_tokens", "n_copies") if c in docs.columns]
    spare = max(docs.columns, key=len) + "_"
    mixed = mix(docs.withColumn(spare, F.struct(*own)) if own else docs, *args, **options)
    taken = mixed.filter("n_copies > 0").withColumn("n_copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    return taken.select(*[F.col(f"{spare}.{c}").alias(c) if c in own else F.col(c) for c in docs.columns])
