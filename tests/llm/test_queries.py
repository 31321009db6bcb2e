"""Registered queries against their SQL, and the pipeline against a plain version of its stages."""

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from haulmetrics.llm import decontamination, exact_dedup, language_id, mixing, sharding, simhash, url_filters
from haulmetrics.llm.queries import ORACLES, QUERIES
from haulmetrics.llm.shared import written
from tools.check_queries import compare, connect

from .helpers import CLASHING, awkward, empty
from .plain import plain_leaks
from .test_dedup import slow_components, slow_fingerprint


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert compare(QUERIES[name](spark, small).toArrow(), connect(small).execute(ORACLES[name]).to_arrow_table()) is None


def test_pipeline_equals_plain_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = corpus_pipeline.run(spark, small).collect()
    data = {r["doc_id"]: r for r in docs.collect()}
    languages, _ = language_id.score_texts(language_id.train(docs), [r["text"] for r in data.values()])
    kept = [r for r, lang in zip(data.values(), languages) if lang != "und"]
    labels = slow_components([slow_fingerprint(r["text"], 3) for r in kept], 3)
    groups = collections.defaultdict(list)
    for r, x in zip(kept, labels):
        groups[x].append(r["doc_id"])
    single = [data[min(g)] for g in groups.values()]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r["doc_id"] for r, leak in zip(single, plain_leaks([r["text"] for r in single], benchmark)) if not leak]
    assert len(clean) < len(single) < len(kept)
    left = written(docs.filter(docs.doc_id.isin(clean)), "clean")
    con = connect(small)
    con.register("documents_left", left.toArrow())
    taken = con.execute(ORACLES["op10_mixing"].replace("FROM documents", "FROM documents_left")).fetchall()
    copies = {r[0]: r[5] for r in taken if r[5]}
    assert collections.Counter(r["doc_id"] for r in got) == copies
    table = sharding.lookup_table(64)
    assert all(r["shard"] == table[r["slot"]] and r["slot"] == int(r["order_key"][:12], 16) % sharding.TABLE_SIZE for r in got)


STAGE_OPERATORS = {
    "keep_one": lambda spark, docs, small: exact_dedup.keep_one(docs),
    "keep_one_per_component": lambda spark, docs, small: simhash.keep_one_per_component(docs),
    "predict": lambda spark, docs, small: language_id.predict(docs, language_id.train(docs)),
    "mix": lambda spark, docs, small: mixing.mix(docs, ["lang", "source"], [F.lit(1), F.lit(2)]),
    "contaminated": lambda spark, docs, small: decontamination.contaminated(docs, spark.read.parquet(f"{small}/benchmark.parquet")),
    "filter_urls": lambda spark, docs, small: url_filters.filter_urls(
        docs.withColumns({"url": F.lit("http://a.example/x"), "day": F.lit("2024-05-05").cast("date")}),
        spark.createDataFrame([("ads", "domain", "a.example", "add")], "list string, kind string, rule string, action string").withColumn(
            "day", F.lit("2024-01-01").cast("date"))),
    "assign_shards": lambda spark, docs, small: sharding.assign_shards(docs),
    **{name: stage for name, stage in corpus_pipeline.STAGES},
}
ADDED = {"predict": ("lang_pred", "score"), "mix": ("n_tokens", "n_copies"), "contaminated": ("contaminated", "n_items", "item_id"),
         "filter_urls": ("host", "n_active", "lists", "blocked"), "assign_shards": ("slot", "shard", "order_key"),
         "sharding": ("slot", "shard", "order_key")}


@pytest.mark.parametrize("name", STAGE_OPERATORS)
def test_columns_named_like_internal_ones_keep_their_values(spark, small, name):
    docs = spark.read.parquet(f"{small}/documents.parquet").filter("doc_id < 40")
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id")).alias(c) for c in CLASHING])
    plain = STAGE_OPERATORS[name](spark, docs, small).select("doc_id", *ADDED.get(name, ())).collect()
    found = STAGE_OPERATORS[name](spark, wide, small)
    assert len(set(found.columns)) == len(found.columns) and set(wide.columns) <= set(found.columns)
    assert sorted(map(str, found.select("doc_id", *ADDED.get(name, ())).collect())) == sorted(map(str, plain))
    own = [c for c in CLASHING if c not in ADDED.get(name, ())]
    assert all(r[c] == f"{c} {r['doc_id']}" for r in found.collect() for c in own)


@pytest.mark.parametrize("make", [awkward, empty])
def test_every_stage_takes_awkward_rows(spark, small, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.columns == docs.columns, name
        assert after.count() <= 4 * docs.count()
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert placed.count() == docs.count()
