"""Patterns looked up in a dictionary find what trying each on every term finds."""

from __future__ import annotations

import random
import re

import pytest

from litscope.functions.text import Analysis
from litscope.operators import vocabulary as V
from litscope.operators.matching import answer_clauses
from litscope.operators.patterns import Pattern, edit_distance, pattern_clauses
from litscope.plans.search import ranked
from litscope.sources.store import build_index


@pytest.fixture(scope="module")
def terms():
    rng = random.Random(3)
    found = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(700)}
    return sorted(found | {"naïve", "straße", "café", "日本語", "x" * 300, "a", "_b_", "123456"})


@pytest.fixture(scope="module")
def index(spark, terms, tmp_path_factory):
    corpus = spark.createDataFrame([(i, t, i % 5 + 2000, f"k{i % 7}") for i, t in enumerate(terms)], "doc_id bigint, title string, year int, key string")
    path = str(tmp_path_factory.mktemp("words") / "index")
    return build_index(corpus, path, fields=("title", "key"), analysis=Analysis().plain(), buckets=4, keep_corpus=False)


@pytest.fixture(scope="module", params=[True, False], ids=["stored", "made"])
def vocabulary(index, tmp_path_factory, request):
    return V.write_vocabulary(index, str(tmp_path_factory.mktemp("words") / "vocabulary"), part_terms=50, stored=request.param)


def matched(spark, function, vocabulary, patterns):
    found = function(vocabulary, pattern_clauses(spark, patterns))
    return sorted((r["clause_id"], r["term"]) for r in found.select("clause_id", "term").collect())


def kept(index):
    return [r["term"] for r in index.term_stats.where("field = 'title'").collect()]


def test_fuzzy(spark, index, vocabulary, terms):
    asked = [*terms[::23], "", "zz", "cab", "abcabcabcab", "bacbacbac", "straße", "naive", "cafe"]
    patterns = [Pattern("fuzzy", t, edits=i % 3) for i, t in enumerate(asked)]
    expected = sorted((i, t) for i, p in enumerate(patterns) for t in kept(index) if edit_distance(t, p.text) <= p.edits)
    assert matched(spark, V.fuzzy_terms, vocabulary, patterns) == expected
    with pytest.raises(Exception, match="up to 2 edits"):
        matched(spark, V.fuzzy_terms, vocabulary, [Pattern("fuzzy", "abc", edits=3)])


def test_wildcards_and_regexes(spark, index, vocabulary):
    wild = ["*abc*", "a*c", "?b?", "*", "", "abc", "*bca", "ab*ca*b", "c??*", "*é", "zzz*", "??"]
    regexes = ["abc.*", ".*(ab|ba)c", "a+b+c*", "[ab]{3}", "abca?b.*", "ab|ba", "(abc)+", r"\w+abc", r"abc\d*.*", "(?i)ABC", r"\x61bc", "caf.", "", "b.*abca"]
    patterns = [Pattern("wildcard", t) for t in wild] + [Pattern("regex", t) for t in regexes]
    rules = [".*".join(".".join(map(re.escape, p.split("?"))) for p in t.split("*")) for t in wild] + regexes
    expected = sorted((i, t) for i, r in enumerate(rules) for t in kept(index) if re.fullmatch(r, t, re.S))
    assert matched(spark, V.shaped_terms, vocabulary, patterns) == expected


def test_ranges_and_prefixes(spark, index, vocabulary):
    ranges = [("a", "b"), ("abc", "abc"), ("b", "a"), ("", "zzzz"), ("cab", "cb"), ("日", "本")]
    patterns = [Pattern("range", a, upper=b) for a, b in ranges] + [Pattern("prefix", t) for t in ("ab", "", "q", "stra", "abcabcabcabcabc")]

    def fits(p, t):
        return t.startswith(p.text) if p.kind == "prefix" else p.text.encode() <= t.encode() <= p.upper.encode()

    expected = sorted((i, t) for i, p in enumerate(patterns) for t in kept(index) if fits(p, t))
    assert matched(spark, V.ranged_terms, vocabulary, patterns) == expected


def test_parts_are_read_as_needed(spark, vocabulary):
    assert vocabulary.points.count() > 10
    found = V.ranged_terms(vocabulary, pattern_clauses(spark, [Pattern("range", "abc", upper="abd")]))
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line and "part" in line]
    assert scans


def test_searches_are_equal(spark, index, vocabulary):
    patterns = [
        Pattern("fuzzy", "abca", query_id="a"), Pattern("prefix", "ab", query_id="a", occur="should"), Pattern("wildcard", "*ca", query_id="b", boost=2.0),
        Pattern("regex", "(ab)+c?", query_id="c"), Pattern("range", "ca", upper="cb", query_id="d"), Pattern("fuzzy", "qqqqq", query_id="e"),
        Pattern("prefix", "k", field="key", query_id="f"), Pattern("fuzzy", "k9", field="key", query_id="g", edits=1),
    ]
    clauses = pattern_clauses(spark, patterns)
    both = [ranked(answer_clauses(index, clauses, vocabulary=v), None) for v in (vocabulary, None)]
    ours, theirs = (sorted(map(tuple, df.collect())) for df in both)
    assert ours == theirs and ours


def test_distances_in_step():
    rng = random.Random(1)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(9))) for _ in range(400)] + ["", "a" * 70]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(3000)]
    assert V.osa_distances([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [edit_distance(a, b) for a, b in pairs]


def test_required_runs():
    assert V.required_runs("abc") == ["\x02abc\x03"]
    assert V.required_runs("abc.*de") == ["\x02abc", "de\x03"]
    assert V.required_runs("ab?c") == ["\x02a", "c\x03"]
    assert V.required_runs("a|b") == [] and V.required_runs("(?i)abc") == [] and V.required_runs(r"\x41bc") == []
    assert V.required_runs("xa+b") == ["\x02xa", "b\x03"]
    assert V.required_runs("a(b|c)d") == ["\x02a", "d\x03"]
    assert V.required_runs("a{2}bc") == ["\x02", "bc\x03"]


def test_shaped_terms_are_not_gathered(spark, index, terms, tmp_path):
    """Candidates are tried where they are met: no row for each gram and term travels to be counted."""
    kept = V.write_vocabulary(index, str(tmp_path / "kept"))
    patterns = [Pattern("wildcard", "*abc*ca*", "title", "w"), Pattern("regex", "ab.*cab", "title", "r"), Pattern("wildcard", "*abcxyz*", "title", "n")]
    found = V.shaped_terms(kept, pattern_clauses(spark, patterns))
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    expected = {("w", t) for t in terms if re.fullmatch(".*abc.*ca.*", t)} | {("r", t) for t in terms if re.fullmatch("ab.*cab", t)}
    assert {(r["query_id"], r["term"]) for r in found.collect()} == expected and expected
