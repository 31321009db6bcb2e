"""URL filters, decontamination, mixing and sharding."""

import collections
import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import decontamination, mixing, sharding, url_filters

from .helpers import awkward, awkward_rows, clashing, empty, prose, rows
from .plain import plain_leaks

DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def url_table(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, day date")


ENTRIES = [
    ("ads", "domain", "bad.example", day(10), "add"), ("ads", "domain", "bad.example", day(20), "remove"),
    ("ads", "domain", "bad.example", day(30), "add"), ("ads", "domain", "bad.example", day(30), "add"),
    ("phish", "domain", "www.bad.example", day(15), "add"), ("both", "domain", "tie.example", day(5), "add"),
    ("both", "domain", "tie.example", day(5), "remove"), ("words", "word", "casino", day(0), "add"),
    ("paths", "path", "ok.example/x", day(0), "add"), (None, "domain", None, None, None), ("odd", "domain", "q.example", day(1), "noop"),
]


def test_url_filters_follow_the_dates(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, rule string, day date, action string")
    data = [(1, "http://a.WWW.bad.example./p?q", day(9)), (2, "https://u@www.bad.example:80/", day(10)), (3, "http://www.bad.example", day(16)),
            (4, "http://bad.example#f", day(20)), (5, "//bad.example/x", day(30)), (6, "http://tie.example", day(6)),
            (7, "http://my-casino.example/a", day(1)), (8, "http://ok.example/x/y?z", day(1)), (9, "http://ok.example/xy", day(1)),
            (10, None, day(1)), (11, "no url", day(1)), (12, "http://bad.example", None), (5, "//bad.example/x", day(30)), (13, "http://notbad.example", day(12))]
    got = rows(url_filters.filter_urls(clashing(url_table(spark, data)), entries), "page_id", "n_active", "lists")
    expected = {1: (0, ""), 2: (1, "ads"), 3: (2, "ads,phish"), 4: (0, ""), 5: (1, "ads"), 6: (0, ""), 7: (1, "words"),
                8: (1, "paths"), 9: (0, ""), 10: (0, ""), 11: (0, ""), 12: (0, ""), 13: (0, "")}
    assert sorted(got) == sorted((p, *expected[p]) for p, _, _ in data)
    assert url_filters.filter_urls(url_table(spark, data), entries.limit(0)).filter("blocked").count() == 0
    assert url_filters.filter_urls(url_table(spark, []), entries).count() == 0


ITEM = "Nora buys 12 apples for 3 dollars each and sells 12 pears to the neighbour next door for 40 dollars before noon"


@pytest.fixture(scope="module")
def bench(spark):
    data = [(1, ITEM), (2, prose(70, 30)), (3, ITEM), (4, None), (5, ""), (None, prose(71, 30)), (6, "1 2 3 4 5 6 7 8 9")]
    return spark.createDataFrame(data, "item_id long, text string")


def flagged(spark, bench, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["item_id"] for r in decontamination.contaminated(docs, bench).collect()}


def test_leaks_copied_reset_and_with_new_values(spark, bench):
    again = ITEM.replace("12", "57").replace("3 ", "8 ").replace("40", "95").replace("Nora", "Edda")
    broken = ITEM.replace("12 apples", "57 apples")  # one value of the item stands for two: only windows with the other are lost
    texts = [prose(1, 50) + ". " + ITEM + ". " + prose(2, 50), ITEM.upper(), ITEM.replace(" ", "\n"), again, broken,
             prose(70, 30).title(), prose(3, 200), " ".join(ITEM.split()[:8]) + " " + prose(4, 30), "9 8 7 6 5 4 3 2 1",
             "x " + " ".join(prose(70, 30).split()[5:25])]
    assert flagged(spark, bench, texts) == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: None, 7: None, 8: None, 9: 2}


def test_windows_equal_a_plain_version(spark):
    texts = [ITEM, "Then Nora walked 5 km. Then 7,5 days of rain! A NATO talk", "one", "", None, "a b c d e f"]
    got = [r["c"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
        decontamination.template(F.col("t")).alias("c")).collect()]
    assert got[1] == "then <name> walked <num> <unit> then <num> <unit> of rain a nato talk".split()
    assert got[0][:6] == ["nora", "buys", "<num>", "apples", "for", "<num>"] and got[3] == got[4] == []
    sizes = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.size(decontamination.window_hashes(F.col("t")))).collect()]
    assert sizes == [len(got[0]) - 4, len(got[1]) - 4, 1, -1, -1, 2] or sizes == [len(got[0]) - 4, len(got[1]) - 4, 1, None, None, 2]


def test_decontamination_of_awkward_rows(spark, bench):
    got = decontamination.contaminated(clashing(awkward(spark)), bench)
    assert got.count() == len(awkward_rows()) and got.filter("contaminated").count() == 0
    assert decontamination.keep_clean(awkward(spark), bench).count() == len(awkward_rows())
    assert decontamination.contaminated(empty(spark), bench).count() == 0
    assert decontamination.contaminated(awkward(spark), bench.limit(0)).filter("contaminated").count() == 0


def left(spark, items, texts):
    """Which of the texts the pipeline's stage keeps; the query's operator and a plain version flag the others."""
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in decontamination.keep_clean(docs, table).collect())
    flags = {r["doc_id"]: r["contaminated"] for r in decontamination.contaminated(docs, table).collect()}
    assert kept == [i for i in range(len(texts)) if not flags[i]]
    assert [flags[i] for i in range(len(texts))] == plain_leaks(texts, list(enumerate(items)))
    return kept


def test_one_edited_value_does_not_hide_a_passage(spark):
    """The value 5 stands twice in 38 words, and the copy changes the second; numbers of any script are numbers."""
    item = prose(80, 16) + " 5 " + prose(81, 12) + " 5 " + prose(82, 8)
    copy = prose(80, 16) + " 5 " + prose(81, 12) + " 6 " + prose(82, 8)
    arabic = copy.replace("5", "\u0661\u0662")
    assert left(spark, [item], [copy, prose(83, 60), arabic]) == [1]


def test_passages_in_another_case(spark):
    """Names that turn into words and words that turn into names."""
    item = "In spring Anna met Ben near Ulm and Carla wrote to Dora about the old bridge while Emil slept by the river"
    assert left(spark, [item], [item.lower(), item.title(), prose(84, 60) + " " + item.lower(), prose(83, 60)]) == [3]


def test_items_poor_in_words_and_short_items(spark):
    """No window has three plain words; less than a window inside a longer text."""
    paid = "Anna, Ben, Carl, Dora and Emil paid 12, 14, 16, 18 and 20 euros to Hans, Ida and Jan"
    texts = [prose(85, 30) + ". " + paid, prose(86, 30) + " what is 12 + 7? " + prose(87, 30), "what is 12 and 7", prose(83, 60)]
    assert left(spark, [paid, "What is 12 + 7?"], texts) == [2, 3]


def test_large_benchmarks_are_joined_by_a_shuffle(spark, bench, monkeypatch):
    texts = [prose(1, 50) + ". " + ITEM, prose(3, 200)]
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert flagged(spark, bench, texts) == {0: 1, 1: None}


def slow_table(shards, size, seed):
    orders = []
    for s in range(shards):
        start, stride = sharding._number(f"{seed}/{s}/start") % size, sharding._number(f"{seed}/{s}/stride") % (size - 1) + 1
        orders.append([(start + k * stride) % size for k in range(size)])
    owner = {}
    while len(owner) < size:
        for s in range(shards):
            if len(owner) < size:
                owner[next(p for p in orders[s] if p not in owner)] = s
    return [owner[p] for p in range(size)]


def test_lookup_table():
    for shards, size in ((1, 2), (3, 7), (5, 101), (7, 211)):
        table = sharding.lookup_table(shards, size)
        assert table == slow_table(shards, size, "shards")
        counts = collections.Counter(table)
        assert max(counts.values()) - min(counts.values()) <= 1
    before, after = sharding.lookup_table(20, 2003), sharding.lookup_table(21, 2003)
    assert sum(a != b for a, b in zip(before, after)) < 0.25 * 2003
    with pytest.raises(ValueError):
        sharding.lookup_table(3, 100)
    with pytest.raises(ValueError):
        sharding.lookup_table(8, 7)


def test_shards_of_awkward_rows_and_files(spark, tmp_path):
    got = sharding.assign_shards(clashing(awkward(spark)), 4, 101)
    assert got.count() == len(awkward_rows()) and got.filter("shard is null or not shard between 0 and 3").count() == 0
    assert len({(r["doc_id"], r["shard"]) for r in got.filter("doc_id = 5").collect()}) == 1
    assert sharding.assign_shards(empty(spark), 4, 101).count() == 0
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    sharding.write_shards(docs, f"{tmp_path}/out", 4, 3, size=101)
    again = spark.read.parquet(f"{tmp_path}/out")
    assert again.count() == 500 and again.select("shard").distinct().count() == 4
    assert rows(again, "doc_id", "shard") == rows(sharding.assign_shards(docs, 4, 101), "doc_id", "shard")


def slow_pour(budget, nodes):
    """Hand out by weight again and again until nobody is over capacity."""
    got, open_ = dict.fromkeys(nodes, 0.0), {n for n, (c, w) in nodes.items() if w > 0}
    while open_:
        share = {n: budget * nodes[n][1] / sum(nodes[m][1] for m in open_) for n in open_}
        full = {n for n in open_ if nodes[n][0] <= share[n]}
        if not full:
            return got | share
        got |= {n: float(nodes[n][0]) for n in full}
        budget -= sum(nodes[n][0] for n in full)
        open_ -= full
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", 10), ("a", "y", 1000), ("b", "x", 30), ("b", "y", 20), ("c", "z", 500)]
    table = spark.createDataFrame([(d, s, t, 1) for d, s, t in leaves], "d string, s string, tokens long, n_rows long")
    weights = [F.when(F.col("d") == "a", 2).otherwise(1), F.lit(1)]
    got = {(r["d"], r["s"]): r["budget"] for r in mixing.leaf_budgets(table, ["d", "s"], weights, F.lit(600), 1).collect()}
    top = slow_pour(600, {"a": (1010, 2), "b": (50, 1), "c": (500, 1)})
    expected = {}
    for d in "abc":
        inner = slow_pour(top[d], {s: (t, 1) for dd, s, t in leaves if dd == d})
        expected |= {(d, s): int(v + 1e-6) for s, v in inner.items()}
    assert got == expected and got["b", "x"] == 30 and got["a", "x"] == 10


@pytest.mark.parametrize("piece", [1_000, 3])
def test_mix_takes_prefixes_of_seeded_epochs(spark, monkeypatch, piece):
    monkeypatch.setattr(mixing, "PIECE_ROWS", piece)
    data = [(i, prose(i, 1 + i % 7), "ab"[i % 3 == 0]) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix(docs, ["source"], [F.when(F.col("source") == "b", 3).otherwise(1)], F.lit(1600), 3).toPandas()
    totals = got.groupby("source").n_tokens.sum().to_dict()
    budgets = slow_pour(1600, {"a": (3 * totals["a"], 1), "b": (3 * totals["b"], 3)})
    for source, budget in budgets.items():
        own = got[got.source == source]
        epochs, rest = divmod(int(budget + 1e-6), int(totals[source]))
        expected, left = {}, rest
        order = sorted(own.itertuples(), key=lambda r: hashlib.md5(f"mix-{epochs + 1}-{r.doc_id}".encode()).hexdigest())
        for r in order:
            left = left - r.n_tokens if left >= r.n_tokens else -1
            expected[r.doc_id] = epochs + (left >= 0)
        assert dict(zip(own.doc_id, own.n_copies)) == expected


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    got = mixing.mix(clashing(docs), ["lang", "source"], [F.lit(1), F.lit(None)], max_epochs=2)
    assert got.count() == len(awkward_rows()) and got.agg(F.sum("n_copies")).first()[0] == 0
    fair = mixing.mix(docs, ["lang", "source"], [F.lit(1), F.lit(1)], max_epochs=2)
    assert fair.filter("n_copies < 0 or n_copies > 2 or n_copies is null").count() == 0
    assert len({r["n_copies"] for r in fair.filter("doc_id = 5").collect()}) == 1
    drawn = mixing.draw(docs, ["lang", "source"], [F.lit(1), F.lit(1)])
    assert drawn.columns == docs.columns
    assert mixing.mix(empty(spark), ["lang", "source"], [F.lit(1), F.lit(1)]).count() == 0
