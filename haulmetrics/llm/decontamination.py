"""Benchmark decontamination by template windows.

Numbers, names and units of a text become typed placeholders, so a question asked again with
other values gives the same template. Windows of five tokens of the templates are joined by
hash. Matches on one diagonal of a document and an item are a segment; those of its windows
count whose slots are consistent, which means that one value of the item stands for one value
of the document on the whole diagonal, or for itself. Windows in lower case with the values
in place are joined in the same way, so copies in another case and items of few plain words
are found too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.shared import written

WINDOW = 5
# A window needs this many tokens that aren't placeholders.
LITERALS = 3
SIMILARITY = 0.8
# Windows in a row on one diagonal that are evidence whatever share of the item they are: 13 words.
RUN = 9
# Benchmark windows up to this number (about 60 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_WINDOWS = 200_000
# Unit words and signs, singular and plural.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg ton tons lb lbs pound pounds ounce ounces l ml liter "
    "liters litre litres gallon gallons s sec second seconds minute minutes h hour hours day days week weeks month months "
    "year years dollar dollars euro euros cent cents percent degree degrees watt watts volt volts meter meters metre metres"
).split()
MARKS = (".", "!", "?")
TOKEN = r"\p{L}[\p{L}\p{M}\p{N}]*|\p{N}+(?:[.,]\p{N}+)*|[.!?]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a value to a lambda variable, so that it's computed once and not for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _number(token: Column) -> Column:
    """Whether a token begins with a number of any script; only a token beyond ASCII is looked at twice."""
    return token.between("0", "9\uffff") | ((token > "\x7f") & token.rlike(r"^\p{N}"))


def _slot(token: Column, low: Column, before: Callable[[], Column], i: Column) -> Column:
    """``<num>``, ``<unit>`` after a number, ``<name>`` for a capitalised word inside a sentence, else null.

    Words all in capitals are no names. The commonest case, a plain word, fails every test early.
    """
    return (F.when(_number(token), "<num>")
            .when(low.isin(UNITS) & _number(before()), "<unit>")
            .when((token != low) & (i > 0) & ~before().isin(*MARKS)
                  & ((token != F.upper(token)) | (F.length(token) == 1)), "<name>"))


def _typed(text: Column) -> Column:
    """Template tokens of a text as ``c``, the placeholder or lower-cased word, with ``low``, the lower-cased token itself."""
    def typed(tokens: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            return _let(F.lower(token), lambda low: F.struct(
                F.coalesce(_slot(token, low, lambda: F.get(tokens, i - 1), i), low).alias("c"), low.alias("low")))
        return F.filter(F.transform(tokens, one), lambda t: ~t["low"].isin(*MARKS))
    return _let(_tokens(text), typed)


def template(text: Column) -> Column:
    """Template tokens of a text: placeholders, and lower-cased words as they are."""
    return _typed(text)["c"]


def _hashes(tokens: Column, field: str, width: int) -> Column:
    """Hash of every window of the given field, in text order; of fewer tokens the hash of the whole, if any."""
    return F.when(F.size(tokens) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(tokens) - width + 1, F.lit(1))),
        lambda start: F.xxhash64(F.slice(tokens, start, width)[field])))


def window_hashes(text: Column, width: int = WINDOW) -> Column:
    """Hash of every window of the template, in text order; of a shorter text the hash of the whole, if any."""
    return _let(_typed(text), lambda tokens: _hashes(tokens, "c", width))


def _slots(tokens: Column, start: Column, width: int = WINDOW) -> Column:
    """Values that the placeholders of one window stand for, in order; null if it has none."""
    own = F.filter(F.slice(tokens, start, width), lambda t: t["c"].startswith("<"))["low"]
    return F.when(F.size(own) > 0, own)


def benchmark_windows(benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id") -> DataFrame:
    """``kind, width, h, item_id, at, slots, n_used, n_all`` of all windows that are evidence.

    Kind 0 are template windows with LITERALS plain words, or half their tokens if the text is
    shorter than a window, with the values of their placeholders; kind 1 are all windows in
    lower case with the values in place. An item shorter than a window is one window of its
    own ``width``. Items with equal windows and values are one, with the smallest id.
    """
    typed = benchmark.select(F.col(id_col).alias("item_id"), _typed(F.col(text_col)).alias("tokens")).filter(F.size("tokens") > 0)
    items = typed.groupBy("tokens").agg(F.min("item_id").alias("item_id")).filter("item_id is not null")
    size = F.least(F.size("tokens"), F.lit(WINDOW))
    cut = items.select("item_id", "tokens", size.alias("width"), F.posexplode(
        F.arrays_zip(_hashes(F.col("tokens"), "c", WINDOW).alias("c"), _hashes(F.col("tokens"), "low", WINDOW).alias("low"))).alias("at", "h"))
    cut = cut.withColumn("slots", _slots(F.col("tokens"), F.col("at") + 1))
    plain = F.col("width") - F.coalesce(F.size("slots"), F.lit(0))
    used = plain >= F.least(F.lit(LITERALS), F.ceil(F.col("width") / 2))
    of_item = Window.partitionBy("item_id")
    counted = cut.select("item_id", "width", "at", "slots", "h", used.alias("used"), F.count_if(used).over(of_item).alias("n_used"),
                         F.count("*").over(of_item).alias("n_all"))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("h.c").alias("h"), F.col("used").alias("keep")),
                    F.struct(F.lit(1).alias("kind"), F.col("h.low").alias("h"), F.lit(True).alias("keep")))
    return counted.select("*", F.explode(kinds).alias("k")).filter("k.keep").select(
        "k.kind", "width", "k.h", "item_id", "at", F.when(F.col("k.kind") == 0, F.col("slots")).alias("slots"), "n_used", "n_all", "used")


def text_key(text: Column) -> list[Column]:
    """Two hash words that stand for a text; rows with one text share all results."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2")]


def _document_windows(text: Column, widths: list[int]) -> Column:
    """``kind, width, pos, h`` of the template windows of a text and of its lower-cased windows of every width."""
    none = F.array().cast("array<struct<kind:int,width:int,pos:int,h:bigint>>")

    def entries(names: Column, kind: int, width: int, many: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), many - 1), lambda pos: F.struct(
            F.lit(kind).alias("kind"), F.lit(width).alias("width"), pos.alias("pos"), F.xxhash64(F.slice(names, pos + 1, width)).alias("h")))

    def cut(tokens: Column) -> Column:
        size = F.size(tokens)
        # The names are taken out of the tokens once, not for every window.
        typed = F.when(size > 0, _let(tokens["c"], lambda c: entries(c, 0, WINDOW, F.greatest(size - WINDOW + 1, F.lit(1))))).otherwise(none)
        return F.concat(typed, _let(tokens["low"], lambda low: F.concat(
            *[F.when(size >= w, entries(low, 1, w, size - w + 1)).otherwise(none) for w in widths])))
    return _let(_typed(text), cut)


def _hits(keyed: DataFrame, table: DataFrame) -> DataFrame:
    """``k1, k2, item_id, kind, diagonal, at, used, n_used, n_all, pairs`` of equal windows; ``pairs`` of the values, null without slots."""
    widths = sorted(r["width"] for r in table.select("width").distinct().collect())  # WINDOW at most
    if not widths:
        widths = [WINDOW]
    evidence = table.withColumn("width", F.when(F.col("kind") == 0, WINDOW).otherwise(F.col("width")))
    if evidence.count() <= BROADCAST_WINDOWS:
        evidence = F.broadcast(evidence)
    exploded = keyed.select("k1", "k2", F.explode(_document_windows(F.col("text"), widths)).alias("w")).select("k1", "k2", "w.*")
    hits = written(exploded.join(evidence, ["kind", "width", "h"]).select(
        "k1", "k2", "item_id", "kind", "pos", (F.col("pos") - F.col("at")).alias("diagonal"), "at", "used", "n_used", "n_all", "slots").distinct(), "hits")
    # Values are looked up in the texts only where a window with slots matched.
    slotted = hits.filter("slots is not null")
    wanted = written(slotted.select("k1", "k2").distinct(), "texts-with-slots")
    texts = keyed.join(wanted, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text")).select(
        "k1", "k2", _typed(F.col("text")).alias("tokens"))
    filled = slotted.join(written(texts, "slot-values"), ["k1", "k2"]).withColumn("pairs", F.arrays_zip(
        F.col("slots").alias("item"), _slots(F.col("tokens"), F.col("pos") + 1).alias("doc"))).drop("tokens")
    plain = hits.filter("slots is null").withColumn("pairs", F.lit(None).cast(filled.schema["pairs"].dataType))
    return plain.unionByName(filled)


def _uncontradicted(windows: Column) -> Column:
    """``at`` of the windows of a diagonal, without those in which an item's value stands for one of several values of the document.

    Windows without slots and slots with the item's own value always count.
    """
    def kept(pairs: Column) -> Column:
        # In the order of item and value, several values of one item stand side by side.
        sides = F.array_sort(pairs)
        torn = F.array_distinct(F.transform(F.filter(F.zip_with(sides, F.slice(sides, 2, F.size(sides)), lambda a, b: F.struct(
            a["item"].alias("one"), b["item"].alias("two"))), lambda p: p["one"] == p["two"]), lambda p: p["one"]))
        return _let(torn, lambda t: F.filter(windows, lambda w: w["pairs"].isNull() | F.forall(
            w["pairs"], lambda p: (p["item"] == p["doc"]) | ~F.array_contains(t, p["item"])))["at"])
    return _let(F.array_distinct(F.flatten(F.filter(windows["pairs"], lambda p: p.isNotNull()))), kept)


def passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", similarity: float = SIMILARITY,
             item_text_col: str = "text", item_id_col: str = "item_id") -> DataFrame:
    """``k1, k2, item_id, similarity, run`` for every text and item with matching windows that reach a bound.

    Of a diagonal only the windows that contradict each other are lost. Windows equal but for
    case count beside the template windows, whatever they consist of. ``similarity`` is the
    larger of two shares: of the item's template windows those found either way, and of all its
    windows those found literally; ``run`` the windows of the fullest diagonal. A pair counts
    from ``similarity`` on, or RUN windows. An item shorter than a window matches wherever its
    words stand in a row.
    """
    keyed = docs.select(*text_key(F.col(text_col)), F.col(text_col).alias("text"))
    table = written(benchmark_windows(benchmark, item_text_col, item_id_col), "benchmark-windows")
    facts = F.struct("used", "n_used", "n_all").alias("facts")
    hits = _hits(keyed, table).select("k1", "k2", "item_id", "kind", "diagonal", "at", "pairs", facts)
    segments = hits.filter("kind = 0").groupBy("k1", "k2", "item_id", "diagonal").agg(
        F.collect_set(F.struct("at", "pairs")).alias("windows"), F.first("facts").alias("facts"))
    typed = segments.select("k1", "k2", "item_id", "diagonal", F.explode(_uncontradicted(F.col("windows"))).alias("at"),
                            F.lit(True).alias("used"), F.lit(False).alias("as_is"), "facts.n_used", "facts.n_all")
    same = hits.filter("kind = 1").select("k1", "k2", "item_id", "diagonal", "at", "facts.used", F.lit(True).alias("as_is"), "facts.n_used", "facts.n_all")
    spots = typed.unionByName(same).groupBy("k1", "k2", "item_id", "diagonal", "at", "n_used", "n_all").agg(
        F.max("used").alias("used"), F.max("as_is").alias("as_is"))
    diagonals = written(spots.groupBy("k1", "k2", "item_id", "diagonal", "n_used", "n_all").agg(
        F.collect_set(F.struct("at", "used", "as_is")).alias("spots")), "diagonals")
    found = diagonals.groupBy("k1", "k2", "item_id", "n_used", "n_all").agg(
        F.array_distinct(F.flatten(F.collect_list("spots"))).alias("spots"), F.max(F.size("spots")).alias("run"))
    share = lambda field, n: F.try_divide(F.size(F.array_distinct(F.filter("spots", lambda s: s[field])["at"])), F.col(n))
    return found.withColumn("similarity", F.greatest(share("used", "n_used"), share("as_is", "n_all"))).filter(
        (F.col("similarity") >= similarity) | (F.col("run") >= RUN)).select("k1", "k2", "item_id", "similarity", "run")


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``contaminated``, ``n_items`` and ``item_id``, the most similar item (the smallest of equals).

    Null and empty texts match nothing, null items and items without an id are left out,
    equal texts get equal results, empty tables work on either side, and columns of ``docs``
    with these names are replaced. Long texts are cut into windows whole.
    """
    found = passages(docs, benchmark, text_col, **options)
    best = found.groupBy("k1", "k2").agg(F.countDistinct("item_id").alias("n_items"),
                                         F.min(F.struct(-F.col("similarity"), "item_id"))["item_id"].alias("item_id"))
    added = ("contaminated", "n_items", "item_id")
    kept = docs.select(*[c for c in docs.columns if c not in added])
    # The row travels as one value, so its names can't meet those of the join.
    keyed = kept.select(F.struct(*kept.columns).alias("row"), *text_key(F.col(text_col)))
    flagged = written(best, "contaminated")
    return keyed.join(flagged, ["k1", "k2"], "left").select(
        "row.*", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without a passage of the benchmark, with the columns that ``docs`` has.

    Null and empty texts hold no passage and stay, long ones are looked through whole, equal
    texts stay or go together. Null items and items without an id are left out; with an empty
    benchmark everything stays, of an empty table nothing.
    """
    found = written(passages(docs, benchmark, text_col, **options).select("k1", "k2").distinct(), "leaks")
    one, two = text_key(docs[text_col])
    return docs.join(found, (one == found["k1"]) & (two == found["k2"]), "left_anti")
