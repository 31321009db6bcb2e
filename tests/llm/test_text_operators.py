"""Language identification, token counts and quality."""

import json
import random

import numpy as np
import pytest

from haulmetrics.llm import language_id, quality, token_counts
from pyspark.sql import functions as F

from .helpers import awkward, awkward_rows, clashing, empty, prose, rows

public_tokenizers = pytest.importorskip("public_tokenizers")


def slow_log_scores(labelled, texts):
    """Naive Bayes with one Python number for each n-gram."""
    def grams(text):
        points = [ord(c) for c in text.lower()] + [0, 0]
        for i in range(len(text.lower())):
            mixed = 0
            for n in range(3):
                mixed = (mixed + points[i + n] + n + 1) * int(language_id._FACTORS[n]) % 2 ** 64
                mixed ^= mixed >> 29
                yield mixed * int(language_id._FACTORS[0]) % 2 ** 64 >> 49
    counts, docs = {}, {}
    for text, lang in labelled:
        table = counts.setdefault(lang, np.zeros(language_id.BUCKETS))
        docs[lang] = docs.get(lang, 0) + 1
        for g in grams(text or ""):
            table[g] += 1
    names = sorted(docs)
    logs = [np.log((counts[n] + 0.5) / (counts[n] + 0.5).sum()) for n in names]
    return names, [[np.log(docs[n] / sum(docs.values())) + sum(x[g] for g in grams(t or "")) for n, x in zip(names, logs)] for t in texts]


def test_language_equals_brute_force(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    data = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    labelled, texts = data[:60], [t for t, _ in data[60:90]] + [None, "", "123 !?", "a"]
    names, logs = slow_log_scores(labelled, texts)
    model = language_id.train(spark.createDataFrame(labelled, "text string, lang string").repartition(5))
    assert model.languages == names
    for chunk in (1 << 19, 700):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        languages, scores = language_id.score_texts(model, texts)
        for text, lang, score, log in zip(texts, languages, scores, logs):
            if not text or not any(map(str.isalpha, text)):
                assert (lang, score) == ("und", 0)
            else:
                log = np.array(log)
                assert lang == names[log.argmax()]
                assert score == pytest.approx(1 / np.exp(log - log.max()).sum(), abs=1e-6)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    learn, test = docs.filter(~fold), docs.filter(fold)
    right = language_id.predict(test, language_id.train(learn)).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_of_awkward_rows(spark):
    model = language_id.train(awkward(spark))
    got = language_id.predict(clashing(awkward(spark)), model)
    assert got.count() == len(awkward_rows())
    assert {r["doc_id"] for r in got.filter("lang_pred = 'und'").collect()} == {None, 1, 2, 3, 7}
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0
    assert language_id.keep_identified(awkward(spark), model).columns == awkward(spark).columns
    nothing = language_id.train(empty(spark))
    assert nothing.languages == [] and language_id.predict(empty(spark), nothing).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(awkward(spark), nothing).collect()} == {"und"}


def hf_counts(texts):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(e.ids) for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts():
    rng = random.Random(9)
    alphabet = ["a", "b", "th", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "'s", "'ll", "é", "漢", "😀", "1", "½", "_", "<|endoftext|>", "<|endof", "\x00", "ǅ", "ः"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [
        "a" * 3000, " " * 2000, "ab" * 1500, "aaab" * 700, "<|endoftext|>" * 5, "x<|endoftext|> y", prose(4, 5000)]


def test_token_counts_equal_the_library(monkeypatch):
    table = token_counts.load_merges(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd_texts()
    expected = hf_counts(texts)
    assert token_counts.Counter(table).count(texts) == expected
    monkeypatch.setattr(token_counts, "CHUNK", 80)
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    assert token_counts.Counter(table).count(texts) == expected


@pytest.mark.parametrize("part, key, value, named", [
    ("model", "dropout", 0.1, "dropout"), ("model", "end_of_word_suffix", "</w>", "end_of_word_suffix"),
    ("pre_tokenizer", "add_prefix_space", True, "pre_tokenizer"), ("pre_tokenizer", "use_regex", False, "pre_tokenizer"),
    ("pre_tokenizer", "type", "Whitespace", "pre_tokenizer"), ("added_tokens", "lstrip", True, "added token"),
    ("model", "type", "Unigram", "model type")])
def test_other_tokenizer_files_are_refused(tmp_path, part, key, value, named):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = json.load(file)
    changed = spec[part][0] if part == "added_tokens" else spec[part]
    changed[key] = value
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match=named):
        token_counts.load_merges(str(path))


def test_longest_special_string_wins(tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.add_special_tokens(["<|a", "<|a|>", "a|>b"])
    path = str(tmp_path / "more.json")
    library.save(path)
    texts = ["x<|a|>b", "<|a <|a|>", "a|>b<|a|>b", "<|endoftext|><|a"]
    got = token_counts.Counter(token_counts.load_merges(path)).count(texts)
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_of_awkward_rows(spark):
    data = awkward_rows()
    got = token_counts.count_tokens(clashing(awkward(spark)), public_tokenizers.path("byte_bpe_50k.json"))
    sizes = [len((r[1] or "").encode()) for r in data]
    expected = [(r[0], n, c, c > 512) for r, n, c in zip(data, sizes, hf_counts([r[1] for r in data]))]
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(
        expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert token_counts.count_tokens(empty(spark), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_quality_separates_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learn, test = labels.filter("crc32(cast(doc_id as string)) % 4 <> 2"), labels.filter("crc32(cast(doc_id as string)) % 4 = 2")
    scored = quality.score_quality(docs, learn, F.col("source"), F.col("lang")).join(test, "doc_id").toPandas()
    good, bad = scored[scored.quality == 1].score.to_numpy(), scored[scored.quality == 0].score.to_numpy()
    auc = (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2
    assert auc > 0.9, auc


def test_quality_shrinks_sparse_sites(spark):
    data = [(i, "plain text here", "big", "a") for i in range(200)] + [(i, "plain text here", "tiny", "a") for i in (1000, 1001)]
    docs = spark.createDataFrame(data, "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)] + [(1000, 0)], "doc_id long, quality int")
    rates = {r["doc_id"]: r["site_prior"] for r in quality.score_quality(docs, labels, F.col("host"), F.col("path")).collect()}
    assert abs(rates[0] - 0.75) < 0.02 and 0.3 < rates[1001] < rates[0]


def test_quality_leaves_a_document_out_of_its_own_score(spark):
    words = ["plain text here", "BUY NOW!!! $$$ 100% ###", "two lines\nand 12 digits"]
    data = [(i, words[i % 3], f"h{i % 7}", f"p{i % 2}") for i in range(80)] + [(80, words[1], "alone", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, host string, path string").coalesce(1)

    def scores(own):
        known = [(i, int(i % 3 != 1 or i % 5 == 0)) for i in range(0, 80, 2)] + [(80, own)]
        labels = spark.createDataFrame(known, "doc_id long, quality int")
        return {r["doc_id"]: r for r in quality.score_quality(docs, labels, F.col("host"), F.col("path")).collect()}
    good, bad = scores(1), scores(0)
    # Its own label changes no sum that it meets, but those of the others.
    assert good[80]["evidence"] == pytest.approx(bad[80]["evidence"], abs=1e-9)
    assert good[1]["evidence"] != bad[1]["evidence"]


def test_prior_of_rest_equals_plain_sums(spark):
    rng = random.Random(3)
    data = [(f"h{rng.randrange(5)}", f"p{rng.randrange(3)}", rng.randrange(1_000_001)) for _ in range(120)] + [("one", "p", 0)]
    rows_ = spark.createDataFrame(data, "host string, path string, mass long")
    sites, pooling = quality.pool_sites(rows_, 0.5)
    got = [(r["host"], r["path"], r["mass"], r["p"]) for r in rows_.join(sites, ["host", "path"]).withColumn("p", pooling.prior_of_rest()).collect()]
    for host, path, mass, prior in got:
        left = list(data)
        left.remove((host, path, mass))
        value = sum(m for _, _, m in left) / 1e6 / len(left)
        for strength, some in ((pooling.host_strength, [m for h, _, m in left if h == host]),
                               (pooling.path_strength, [m for h, p, m in left if (h, p) == (host, path)])):
            value = (sum(some) / 1e6 + strength * value) / (len(some) + strength)
        assert prior == pytest.approx(min(max(value, 1e-6), 1 - 1e-6), abs=1e-9)
    assert len(got) == len(data)


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (None, 1), (5, None), (99, 1)], "doc_id long, quality int")
    got = quality.score_quality(clashing(awkward(spark)), labels, F.col("source"), F.col("lang"))
    assert got.count() == len(awkward_rows()) and got.filter("score is null or not score between 0 and 1").count() == 0
    none = quality.score_quality(awkward(spark), labels.limit(0), F.col("source"), F.col("lang")).collect()
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in none)
    assert quality.score_quality(empty(spark), labels, F.col("source"), F.col("lang")).count() == 0
