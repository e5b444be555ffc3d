"""Phrases looked up in the texts score as searches for each of them do."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from litscope.functions.text import Analysis
from litscope.operators import clauses as C
from litscope.operators.phrase_batch import phrase_batch
from litscope.plans.search import ranked, search_clauses
from litscope.session import local_table
from litscope.sources.store import build_index


@pytest.mark.parametrize("analysis", [Analysis(), Analysis().plain()], ids=["english", "plain"])
def test_same_hits_as_searches(spark, tmp_path, analysis):
    rng = random.Random(11)
    words = ["graph", "graphs", "of", "the", "deep", "learning", "learned", "search", "and", "index"]
    titles = [" ".join(rng.choices(words, k=rng.randrange(1, 25))) for _ in range(150)] + ["", "deep"]
    corpus = spark.createDataFrame([(i, t, 2000) for i, t in enumerate(titles)] + [(500, None, 2000)], "doc_id bigint, title string, year int")
    phrases = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(120)} | {"nowhere to be seen", "the", "", "deep, learning"})
    queries = local_table(spark, [(p, p) for p in phrases], "query_id string, text string")
    ours = ranked(phrase_batch(corpus, queries.unionByName(queries), analysis), None).collect()
    index = build_index(corpus, str(tmp_path / "index"), fields=("title",), analysis=analysis, buckets=2)
    clauses = C.clause_table(queries.withColumns({"field": F.lit("title"), "kind": F.lit("text")}))
    theirs = search_clauses(index, clauses, None).collect()

    def rows(found):
        return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in found)

    assert rows(ours) == rows(theirs) and ours


def test_nothing_asked_and_nothing_there(spark):
    corpus = spark.createDataFrame([(1, "deep learning", 2000)], "doc_id bigint, title string, year int")
    queries = local_table(spark, [("q", "deep learning")], "query_id string, text string")
    assert phrase_batch(corpus, queries.limit(0), Analysis()).count() == 0
    assert phrase_batch(corpus.limit(0), queries, Analysis()).count() == 0
    assert [tuple(r)[:2] for r in phrase_batch(corpus, queries, Analysis()).collect()] == [("q", 1)]


def test_best_of_phrases(spark, monkeypatch):
    """The best k are those of all hits, with rows that share an id, and whatever the bits let through."""
    from litscope.operators import phrase_batch as module

    rng = random.Random(3)
    words = ["graph", "deep", "learning", "the", "index"]
    titles = [(i % 50, " ".join(rng.choices(words, k=rng.randrange(1, 12))), 2000) for i in range(80)]
    corpus = spark.createDataFrame(titles + titles[:9], "doc_id bigint, title string, year int")
    asked = ["deep", "deep.", "graph the index", "deep learning", "learning deep graph", "the", "none such"]
    queries = local_table(spark, [(p, p) for p in asked] + [(None, "deep")], "query_id string, text string")

    def rows(found):
        return sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect())

    every = rows(ranked(phrase_batch(corpus, queries, Analysis()), 4))
    assert rows(phrase_batch(corpus, queries, Analysis(), k=4)) == every and every
    monkeypatch.setattr(module, "BITS", 64)
    assert rows(phrase_batch(corpus, queries, Analysis(), k=4)) == every


def test_what_travels_is_what_phrases_ask_for(spark):
    """Equal runs of a text are one row, and runs that no phrase can be do not leave their task."""
    from litscope.operators.phrase_batch import _possible, _text_runs, _word_hashes

    texts = spark.createDataFrame(
        [(1, [("x", 0), ("y", 2), ("x", 3), ("y", 5)]), (2, []), (3, [("z", 0)])], "doc_id bigint, terms array<struct<term string, pos int>>"
    )
    found = _text_runs([[0], [0, 2]])(*_word_hashes(F.col("terms")), F.col("terms.pos"))
    runs = texts.select("doc_id", F.inline(found))
    assert sorted((r["doc_id"], r["tf"]) for r in runs.collect()) == [(1, 2), (1, 2), (1, 2), (3, 1)]
    keys = runs.where("doc_id = 3").select("key_a", "key_b")
    assert [(r["doc_id"], r["tf"]) for r in _possible(runs, keys).collect()] == [(3, 1)]
