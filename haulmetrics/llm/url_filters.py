"""URL filters by a temporal join: every capture meets the list entries active on its day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.shared import written

HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[^/?#]*//[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port or final dot; '' where there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))), r"\.$", "")


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, rule, valid_from, valid_to`` from dated entries ``list, kind, rule, day, action``.

    An ``add`` holds until the next entry of the same rule; of entries on one day a removal
    wins; other actions, null rules and null days are ignored.
    """
    dated = entries.filter("rule is not null and day is not null and action in ('add', 'remove')")
    daily = dated.groupBy("list", "kind", "rule", "day").agg(F.max("action").alias("action"))
    following = F.lead("day").over(Window.partitionBy("list", "kind", "rule").orderBy("day"))
    return daily.withColumn("valid_to", following).filter("action = 'add'").select(
        "list", "kind", "rule", F.col("day").alias("valid_from"), "valid_to")


def _active(keyed: DataFrame, intervals: DataFrame, by: list[str]) -> DataFrame:
    """As-of join of ``kind, rule, day`` with the intervals; the lists that match, once per ``by``."""
    hits = keyed.join(intervals, ["kind", "rule"]).filter(
        (F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    return hits.groupBy(*by).agg(F.count("*").alias("n"), F.collect_set("list").alias("lists"))


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "day") -> DataFrame:
    """``captures`` with ``host, n_active, lists, blocked``.

    Rules are of kind ``domain`` (the host or one of its parents), ``word`` (a part of the
    host between dots and dashes) or ``path`` (host with a leading part of the path, ends at
    a slash or the end). ``n_active`` counts the matching entries active on the capture's day,
    ``lists`` names their lists in order, joined by commas. A null url, one without a host,
    or a null day matches nothing. Repeated captures give repeated rows, empty tables work,
    and columns of ``captures`` with these names are replaced. Captures of one host and day,
    or one page and day, are judged once: a busy site is aggregated before the join.
    """
    intervals = written(validity_intervals(entries), "list-intervals")
    added = ("host", "n_active", "lists", "blocked")
    kept = captures.select(*[c for c in captures.columns if c not in added])
    # The row travels as one value, so its names can't meet those of the joins.
    rows = kept.select(F.struct(*kept.columns).alias("row"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("_path"),
                       F.col(day_col).alias("_day"))
    sites = rows.filter("host <> '' and _day is not null").groupBy("host", F.col("_day").alias("day")).count()
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("rule")))
    words = F.transform(F.array_distinct(F.split("host", "[.-]")), lambda w: F.struct(F.lit("word").alias("kind"), w.alias("rule")))
    keyed = sites.select("host", "day", F.explode(F.concat(parents, words)).alias("k")).select("host", "day", "k.*")
    by_site = written(_active(keyed, intervals, ["host", "day"]), "site-hits")
    pages = rows.filter("host <> '' and _day is not null").groupBy("host", "_path", F.col("_day").alias("day")).count()
    steps = F.split("_path", "/")
    prefixes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.struct(
        F.lit("path").alias("kind"), F.concat("host", F.array_join(F.slice(steps, F.lit(1), i), "/")).alias("rule"))))
    by_page = written(_active(pages.select("host", "_path", "day", F.explode(prefixes).alias("k")).select(
        "host", "_path", "day", "k.*"), intervals, ["host", "_path", "day"]), "page-hits")
    none = F.array().cast("array<string>")
    joined = rows.join(by_site.select("host", F.col("day").alias("_day"), F.col("n").alias("_n1"), F.col("lists").alias("_l1")),
                       ["host", "_day"], "left").join(
        by_page.select("host", "_path", F.col("day").alias("_day"), F.col("n").alias("_n2"), F.col("lists").alias("_l2")),
        ["host", "_path", "_day"], "left")
    total = F.coalesce("_n1", F.lit(0)) + F.coalesce("_n2", F.lit(0))
    lists = F.array_union(F.coalesce("_l1", none), F.coalesce("_l2", none))
    return joined.select("row.*", "host", total.alias("n_active"), F.array_join(F.array_sort(lists), ",").alias("lists"),
                         (total > 0).alias("blocked"))
