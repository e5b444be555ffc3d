"""Clauses that ask for one pattern share its lookup, and score as if each were tried on every document."""

from __future__ import annotations

import random

import pytest

from litscope.functions.text import Analysis
from litscope.operators import matching as M
from litscope.operators import vocabulary as V
from litscope.operators.patterns import Pattern, edit_distance, pattern_clauses
from litscope.sources.store import build_index

KINDS = {
    "prefix": lambda p, t: t.startswith(p.text),
    "range": lambda p, t: p.text <= t <= p.upper,
    "fuzzy": lambda p, t: edit_distance(t, p.text) <= p.edits,
}


@pytest.fixture(scope="module")
def titles():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
    return [(i % 110, " ".join(word() for _ in range(rng.randrange(1, 9))), 2000 + i % 110 % 4) for i in range(120)]


@pytest.fixture(scope="module")
def index(spark, titles, tmp_path_factory):
    corpus = spark.createDataFrame(titles, "doc_id bigint, title string, year int")
    path = str(tmp_path_factory.mktemp("sets") / "index")
    return build_index(corpus, path, fields=("title",), analysis=Analysis(stop_words=(), stem=False), buckets=3, keep_corpus=False)


def expected(titles, patterns, spans):
    words, years = {}, {}
    for doc, title, year in titles:
        words.setdefault(doc, set()).update(title.split())
        years[doc] = year
    out = set()
    for query in {p.query_id for p in patterns}:
        own = [p for p in patterns if p.query_id == query]
        span = spans.get(query)
        for doc, held in words.items():
            if span and not span[0] <= years[doc] <= span[1]:
                continue
            score, met, optional, barred = 0.0, 0, 0, False
            for p in own:
                hits = [t for t in held if KINDS[p.kind](p, t)]
                if not hits:
                    continue
                weight = lambda t: 1 - edit_distance(t, p.text) / max(1, min(len(t), len(p.text))) if p.kind == "fuzzy" else 1.0
                met, optional, barred = met + (p.occur == "must"), optional + (p.occur == "should"), barred or p.occur == "must_not"
                score += 0.0 if p.occur == "must_not" else max(p.boost * max(0.0, weight(t)) for t in hits)
            musts = sum(p.occur == "must" for p in own)
            if not barred and met == musts and (musts or optional):
                out.add((query, doc, round(score + (1.0 if span else 0.0), 6)))
    return out


@pytest.fixture(scope="module")
def patterns():
    return [
        Pattern("prefix", "ab", query_id="a", occur="should"), Pattern("prefix", "ab", query_id="a", occur="should", clause_id=7, boost=2.5),
        Pattern("fuzzy", "abca", query_id="a", occur="should"), Pattern("prefix", "ab", query_id="b"), Pattern("prefix", "ab", query_id="b", clause_id=9),
        Pattern("fuzzy", "abca", query_id="b", occur="should", boost=-2.0), Pattern("range", "ca", upper="cb", query_id="c"),
        Pattern("prefix", "ab", query_id="c", occur="must_not"), Pattern("fuzzy", "abca", query_id="d", edits=1), Pattern("prefix", "zz", query_id="e"),
        Pattern("prefix", "ab", query_id="e", occur="should"), Pattern("prefix", "ab", query_id="y"), Pattern("fuzzy", "abca", query_id="y", occur="should"),
    ]


@pytest.mark.parametrize("limit", [200_000, 0], ids=["handed out", "joined"])
def test_scores(spark, index, titles, patterns, monkeypatch, limit):
    from pyspark.sql import functions as F

    monkeypatch.setattr(M, "HANDED_OUT", limit)
    dated = F.col("query_id") == "y"
    clauses = pattern_clauses(spark, patterns).withColumns({"year_from": F.when(dated, 2001), "year_to": F.when(dated, 2002)})
    rows = M.answer_clauses(index, clauses).collect()
    assert {(r["query_id"], r["doc_id"], round(r["score"], 6)) for r in rows} == expected(titles, patterns, {"y": (2001, 2002)})
    assert len(rows) == len({(r["query_id"], r["doc_id"]) for r in rows})


def test_each_pattern_is_looked_up_once(spark, index, tmp_path, monkeypatch):
    vocabulary = V.write_vocabulary(index, str(tmp_path / "words"), part_terms=50, stored=False)
    looked_up = V.dictionary_terms
    asked = []

    def counted(vocabulary, patterns):
        asked.extend((r["kind"], r["text"]) for r in patterns.collect())
        return looked_up(vocabulary, patterns)

    monkeypatch.setattr(M, "dictionary_terms", counted)
    many = [Pattern(kind, "ab", query_id=f"q{i}", occur="should") for i in range(30) for kind in ("prefix", "fuzzy")]
    found = M.answer_clauses(index, pattern_clauses(spark, many), vocabulary=vocabulary).groupBy("query_id").count().collect()
    assert sorted(asked) == [("fuzzy", "ab"), ("prefix", "ab")]
    assert len(found) == 30 and len({r["count"] for r in found}) == 1
