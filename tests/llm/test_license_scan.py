"""Licence scans against brute force over words."""

import random
import re

from haulmetrics.llm import license_scan
from haulmetrics.llm.license_scan import PHRASES, TEMPLATES, Automaton, Scanner, words_of

from .helpers import awkward, awkward_rows, clashing, empty

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_base(text):
    words = slow_words(text)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def slow_runs(words, templates):
    """Longest run ending at every word that stands in some template."""
    inside = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((k for k in range(1, i + 2) if tuple(words[i + 1 - k:i + 1]) in inside), default=0) for i in range(len(words))]


def test_words_and_phrases(spark):
    texts = ["Released under the MIT License.", "mit LICENSE apache-license, general\npublic license mit mit license", "general public", "MITlicense",
             "gnu général public license ÀB×c", "mit\x00license mit license", "license mit " * 3000]
    data = [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, t) for i, t in enumerate(texts)]
    found = license_scan.scan_licenses(clashing(spark.createDataFrame(data, "doc_id long, text string"))).collect()
    got = sorted(((str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found), key=str)
    assert got == sorted(((str(i), *slow_base(t)) for i, t in data), key=str)
    assert all(set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1 for r in found)
    assert license_scan.scan_licenses(empty(spark)).count() == 0
    assert license_scan.scan_licenses(awkward(spark)).count() == len(awkward_rows())


def test_matching_statistics_equal_brute_force(monkeypatch):
    """Random words over a small vocabulary; chunks cut between any two words."""
    rng = random.Random(4)
    for _ in range(40):
        templates = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 9))] for _ in range(3)]
        phrases = [[rng.choice([b"a", b"b"]) for _ in range(2)]]
        words = [rng.choice([b"a", b"b", b"c", b"x"]) for _ in range(30)]
        automaton = Automaton(templates, phrases)
        cuts = sorted(rng.sample(range(31), 4))
        chunks = [words[i:j] for i, j in zip([0, *cuts], [*cuts, 30])]
        runs = {place: (state, run) for _, found in automaton.runs(iter(chunks)) for place, state, run in found}
        slow = slow_runs(words, [*templates, *phrases])
        assert [runs.get(i, (0, 0))[1] for i in range(30)] == slow
        for i, (state, run) in runs.items():
            ends = {(t, e) for t, seq in enumerate(templates) for e in range(run - 1, len(seq)) if seq[e - run + 1:e + 1] == words[i - run + 1:i + 1]}
            assert ends == automaton.ends[state]


def test_every_template_is_found_whole_edited_and_between_chunks(monkeypatch):
    monkeypatch.setattr(license_scan, "CHUNK", 16)
    scanner = Scanner()
    for label, text in TEMPLATES:
        whole = scanner.scan(f"some words {text.upper()} and more")
        assert any(s["label"] == label and s["coverage"] == 1.0 for s in whole[5]), label
        size = len(words_of(text.encode()))
        assert any(s["first_word"] == 2 and s["last_word"] == size + 1 for s in whole[5])
        words = text.split()
        if len(words) >= 20:
            edited = " ".join([*words[:8], "(see", "there)", *words[8:14], "changed", *words[15:]])
            assert any(s["label"] == label and s["coverage"] < 1 for s in scanner.scan(edited)[5]), label
            assert not any(s["label"] == label for s in Scanner(templates=[(label, text)]).scan(" ".join(reversed(words)))[5])


def test_many_licences_in_one_text():
    text = "\n".join(f"{t} line {i}" for i in range(300) for _, t in (TEMPLATES[5], TEMPLATES[10]))
    spans = Scanner().scan(text)[5]
    assert sum(s["template"] == 5 for s in spans) == sum(s["template"] == 10 for s in spans) == 300
    for t in {s["template"] for s in spans}:
        own = [s for s in spans if s["template"] == t]
        assert all(a["last_word"] < b["first_word"] for a, b in zip(own, own[1:]))


def test_planted_lines_are_labelled(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for r in license_scan.scan_licenses(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert ("Licensed under CC BY-NC 4.0." in r["text"]) == ("cc-by-nc" in r["labels"])
        assert (tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))) == slow_base(r["text"])
