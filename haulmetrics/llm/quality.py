"""Document quality by hierarchical empirical Bayes.

A naive Bayes classifier over binned text measures gives every document its evidence, a log
likelihood ratio. Sites are summarised by grouped sums of labels, or of the classifier's
probability where there is none: a path's rate is shrunk toward its host's, a host's toward the
global one, with strengths estimated from how much the rates vary beyond chance. The score
combines the evidence with the path's posterior as prior. Every sum that a document meets leaves
that document out, so neither its evidence counts twice nor its label for itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.shared import written

SMOOTHING = 1.0
# Measures of one text overlap in what they say, so their sum is halved.
EVIDENCE_WEIGHT = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6
BINS = 33
SYMBOLS = "#$%&*+=<>|~^@_{}[]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_measures(text: Column) -> dict[str, Column]:
    """Small integers below BINS: binary lengths of the size and of shares in thousandths."""
    whole = F.coalesce(text, F.lit(""))
    size = F.length(whole).cast("long")

    def share(letters: str) -> Column:
        count = size - F.length(F.translate(whole, letters, ""))
        return F.length(F.bin(F.floor(count * 1000 / F.greatest(size, F.lit(1))).cast("long")))
    words = F.split(whole, " ")
    return {"size": F.length(F.bin(size)), "symbols": share(SYMBOLS), "shouts": share("!?"), "capitals": share(CAPITALS),
            "digits": share("0123456789"), "blanks": share(" "), "lines": share("\n"),
            "variety": F.floor(F.size(F.array_distinct(words)) * 16 / F.size(words)).cast("int")}


MEASURES = ("size", "symbols", "shouts", "capitals", "digits", "blanks", "lines", "variety")


@dataclass(frozen=True)
class Evidence:
    """Share of good labels, and log likelihood ratios of the bins of every measure, three times:

    as an unlabelled document meets them, one with label 0 and one with label 1, which leave its own count out.
    """

    prior: float
    ratios: dict[str, list[float]]

    def column(self) -> Column:
        own = (F.coalesce(F.col("label"), F.lit(-1)) + 1) * BINS
        total = sum((F.get(F.lit(self.ratios[m]), F.col(m) + own) for m in MEASURES), F.lit(0.0))
        return F.lit(EVIDENCE_WEIGHT) * total


def fit_evidence(measured: DataFrame) -> Evidence:
    """Class counts of every bin over all labelled rows; the driver gets MEASURES x BINS sums at most."""
    labelled = measured.filter("label is not null")
    pairs = labelled.select("label", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("int").alias("bin")) for m in MEASURES])).alias("b"))
    counts = {(r["measure"], r["bin"], r["label"]): r["count"] for r in
              pairs.groupBy("b.measure", "b.bin", "label").count().collect()}
    total = [sum(n for (m, _, k), n in counts.items() if m == MEASURES[0] and k == c) for c in (0, 1)]

    def log_rate(m: str, b: int, label: int, own: int, used: int) -> float:
        out = int(own == label)
        return math.log((max(counts.get((m, b, label), 0) - out, 0) + SMOOTHING) / (max(total[label] - out, 0) + SMOOTHING * used))
    ratios = {}
    for m in MEASURES:
        used = len({b for mm, b, _ in counts if mm == m}) + 1
        ratios[m] = [log_rate(m, b, 1, own, used) - log_rate(m, b, 0, own, used) for own in (-1, 0, 1) for b in range(BINS)]
    return Evidence((total[1] + 1) / (sum(total) + 2), ratios)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(chance: float | None, seen: float | None, expected: float | None, rows: int | None) -> float:
    """Prior strength in documents: binomial variance over the variance between sites beyond chance."""
    between = ((seen or 0.0) - (expected or 0.0)) / rows if rows else 0.0
    return min(max((chance or 0.0) / between - 1, MIN_STRENGTH), MAX_STRENGTH) if between > 0 else MAX_STRENGTH


@dataclass(frozen=True)
class Pooling:
    """Sums over all documents and the strengths of the global rate for hosts and of a host's rate for its paths."""

    n: int
    mass: int
    rate_without: float
    host_strength: float
    path_strength: float

    def prior_of_rest(self) -> Column:
        """The path's posterior rate from all documents but the row's own, of a row with its ``mass`` and its sites' sums."""
        rest = lambda n, mass: ((mass - F.col("mass")) / 1e6, n - 1)
        good, others = rest(F.lit(self.n), F.lit(self.mass))
        rate = F.when(others > 0, F.least(F.greatest(F.try_divide(good, others), F.lit(1e-6)), F.lit(1 - 1e-6))).otherwise(self.rate_without)
        good, others = rest(F.col("host_n"), F.col("host_mass"))
        host = (good + self.host_strength * rate) / (others + self.host_strength)
        good, others = rest(F.col("path_n"), F.col("path_mass"))
        return F.least(F.greatest((good + self.path_strength * host) / (others + self.path_strength), F.lit(1e-6)), F.lit(1 - 1e-6))


def pool_sites(measured: DataFrame, prior: float) -> tuple[DataFrame, Pooling]:
    """``host, path, path_n, path_mass, host_n, host_mass`` for every path, and what all of them share.

    ``measured`` has ``host, path, mass``: successes in millionths, whole numbers, so sums
    don't depend on their order and a document can be taken out exactly. Hosts are sums of
    their paths. ``prior`` is the rate where no other document is left.
    """
    paths = written(measured.groupBy("host", "path").agg(F.count("*").alias("path_n"), F.sum("mass").alias("path_mass")), "paths")
    hosts = written(paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_mass").alias("host_mass")), "hosts")
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_mass").alias("mass")).first()
    n, mass = whole["n"] or 0, whole["mass"] or 0
    rate = min(max(mass / 1e6 / n if n else prior, 1e-6), 1 - 1e-6)
    own = F.col("host_mass") / 1e6 / F.col("host_n")
    spread = hosts.agg(F.sum(F.col("host_n") * (own - rate) ** 2).alias("seen"), F.count("*").alias("sites")).first()
    outer = _strength(rate * (1 - rate), spread["seen"], rate * (1 - rate) * spread["sites"], n)
    sites = written(paths.join(hosts, "host"), "sites")
    host = (F.col("host_mass") / 1e6 + outer * rate) / (F.col("host_n") + outer)
    rated = sites.select("path_n", (F.col("path_mass") / 1e6 / F.col("path_n")).alias("own"), host.alias("host"))
    chance = F.col("host") * (1 - F.col("host"))
    spread = rated.agg(F.sum(F.col("path_n") * (F.col("own") - F.col("host")) ** 2).alias("seen"), F.sum(chance).alias("expected"),
                       (F.sum(chance * F.col("path_n")) / F.sum("path_n")).alias("chance")).first()
    return sites, Pooling(n, mass, prior, outer, _strength(spread["chance"], spread["seen"], spread["expected"], n))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = 0.5,
                  text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """One row per document: ``doc_id, host, path, evidence, site_prior, score, good``.

    ``labels`` has the id and 1 or 0; several labels of one id count by their largest, null
    ones and those of unknown ids don't count. A null text is measured as an empty one, a null
    host or path is the site ''. Without any label the prior is one half and all evidence is
    zero. ``site_prior`` and ``evidence`` come from all rows but the document's own, so that of
    a document alone on its site is the prior of the site above; only the two strengths and the
    number of bins in use are those of all rows. Repeated documents count and come out as often as they occur; an empty table gives
    an empty result; further columns aren't read.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    measures = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                           F.coalesce(path.cast("string"), F.lit("")).alias("path"), *[
        c.cast("int").alias(m) for m, c in text_measures(F.col(text_col)).items()])
    measured = written(measures.join(known, F.col("doc_id") == F.col("_id"), "left").drop("_id"), "measures")
    evidence = fit_evidence(measured)
    likely = 1 / (1 + F.exp(-(F.lit(math.log(evidence.prior / (1 - evidence.prior))) + F.col("evidence"))))
    rows = measured.withColumn("evidence", evidence.column()).withColumn(
        "mass", F.coalesce(F.col("label") * 1_000_000, F.round(likely * 1_000_000)).cast("long")).select(
        "doc_id", "host", "path", "evidence", "mass")
    sites, pooling = pool_sites(rows, evidence.prior)
    score = 1 / (1 + F.exp(-(_logit(F.col("site_prior")) + F.col("evidence"))))
    return rows.join(sites, ["host", "path"]).withColumn("site_prior", pooling.prior_of_rest()).withColumn("score", score).withColumn(
        "good", F.col("score") >= threshold).select("doc_id", "host", "path", "evidence", "site_prior", "score", "good")
