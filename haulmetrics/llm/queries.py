"""Registered queries of the training-data operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.llm import (
    decontamination,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    spelling,
    sql,
    suffix_dedup,
    token_counts,
    url_filters,
)
from haulmetrics.llm.shared import documents, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


@query("op1_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


HOST_SQL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
# Dated entries derived from the hosts of the pages, about one list entry for every second host.
ENTRIES = """
WITH hosts AS (SELECT DISTINCT host, regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) AS site FROM captured WHERE host <> ''),
marks AS (SELECT host, site, ascii(substring(md5(host), 1, 1)) + 16 * ascii(substring(md5(host), 2, 1)) AS a,
                 ascii(substring(md5(site), 1, 1)) + 16 * ascii(substring(md5(site), 2, 1)) AS b FROM hosts)
SELECT DISTINCT 'ads' AS list, 'domain' AS kind, site AS rule, DATE '2024-01-01' + CAST(b % 200 AS INT) AS day, 'add' AS action
FROM marks WHERE b % 3 = 0 AND site <> ''
UNION ALL SELECT DISTINCT 'ads', 'domain', site, DATE '2024-01-01' + CAST(b % 200 + 60 AS INT), 'remove' FROM marks WHERE b % 3 = 0 AND site <> ''
UNION ALL SELECT DISTINCT 'ads', 'domain', site, DATE '2024-01-01' + CAST(b % 200 + 120 AS INT), 'add' FROM marks WHERE b % 3 = 0 AND site <> ''
UNION ALL SELECT 'phish', 'domain', host, DATE '2024-01-01' + CAST(a % 300 AS INT), 'add' FROM marks WHERE a % 5 = 1
UNION ALL SELECT 'paths', 'path', concat(host, '/de'), DATE '2024-01-01' + CAST(a % 100 AS INT), 'add' FROM marks WHERE a % 2 = 0
UNION ALL SELECT 'paths', 'path', concat(host, '/de'), DATE '2024-01-01' + CAST(a % 100 + 150 AS INT), 'remove' FROM marks WHERE a % 2 = 0
UNION ALL SELECT DISTINCT 'terms', 'word', word, DATE '2024-02-01' + CAST(length(word) * 7 AS INT), 'add'
FROM (SELECT unnest_words AS word FROM words) w WHERE word IN ('casino', 'bets', 'pills', 'blog')
UNION ALL SELECT DISTINCT 'terms', 'word', word, DATE '2024-02-01' + CAST(length(word) * 30 AS INT), 'remove'
FROM (SELECT unnest_words AS word FROM words) w WHERE word IN ('casino', 'bets', 'pills', 'blog')"""


@query("op2_url_filters", sql.url_filters(ENTRIES, HOST_SQL))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, captured on a day that follows from their id, against lists made from their hosts."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.expr("date_add(DATE '2024-01-01', CAST(page_id % 366 AS INT))").alias("day"))
    hosts = pages.select(url_filters.url_host(F.col("url")).alias("host")).distinct()
    words = hosts.select(F.explode(F.split("host", "[.-]")).alias("unnest_words")).distinct()
    entries = spark.sql(ENTRIES.replace("FROM captured", "FROM {captured}").replace("FROM words", "FROM {words}"),
                        captured=hosts, words=words)
    return url_filters.filter_urls(pages, entries).drop("url")


def held_out() -> F.Column:
    """The fold that language identification must not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4, F.lit(0)) == 2


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return language_id.predict(rows, model).drop("text")


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op5_quality_classifier", sql.QUALITY)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no address: the source is the host, its language sections are the paths."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(documents(spark, sf_dir), labels, F.col("source"), F.col("lang"))
    return scored.withColumns({c: F.round(c, 6) for c in ("evidence", "site_prior", "score")})


@query("op6_benchmark_decontamination", sql.DECONTAMINATION)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contaminated(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    return found.drop("text")


@query("op7_sharding", sql.sharding(sharding.TABLE_SIZE, 64, "shards"))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(documents(spark, sf_dir).select("doc_id", "text"))
    return placed.select("doc_id", "slot", "shard", "order_key")


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return cut.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


LEVELS = ["domain", "lang", "source"]


def domain() -> F.Column:
    """A source's number decides the domain; the tables have none."""
    return F.concat(F.lit("domain"), (F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int"), F.lit(0)) % 4).cast("string"))


def target_weights() -> list[F.Column]:
    """Domains 4:3:2:1, English 3 to 2 for other languages, sources alike but for number 0, 8 and 9."""
    return [4 - F.substring("domain", 7, 1).cast("int"), F.when(F.col("lang") == "en", 3).otherwise(2),
            F.when(F.col("source").isin("src0", "src8", "src9"), 2).otherwise(1)]


@query("op10_mixing", sql.MIXING)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("domain", domain())
    mixed = mixing.mix(docs, LEVELS, target_weights())
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "n_copies")


@query("op11_spelling_variants", sql.SPELLING)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.vocabulary(documents(spark, sf_dir)))


# Conversations of one hundred begin like the first of them, with up to five of its turns.
FAMILY, OPENINGS = 100, 6


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path`` of every conversation: the first h turns of its family's first one, then its own after its first h."""
    paths = written(prefix_trie.turn_paths(turns), "turn-paths")
    first = paths.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), prefix_trie.first_turns(F.col("path"), OPENINGS - 1).alias("opening"))
    h = F.crc32(F.col("conv_id").cast("string")) % OPENINGS
    opening = F.coalesce(prefix_trie.first_turns(F.col("opening"), h), F.lit(b""))
    return paths.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(first, "family", "left").select(
        "conv_id", F.concat(opening, prefix_trie.later_turns(F.col("path"), h)).alias("path"))


@query("op12_prefix_trie", sql.PREFIX_TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_trie(rebuilt_paths(turns))


@query("op13_license_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")
