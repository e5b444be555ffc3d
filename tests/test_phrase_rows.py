"""Postings of a phrase's common words are left out where they are read, and a build's shuffles do not add up."""

from __future__ import annotations

import pathlib

import pytest

from litscope.functions.text import Analysis
from litscope.operators import clauses as C
from litscope.operators import matching as M
from litscope.session import local_table
from litscope.sources import store


def build(spark, titles, path):
    corpus = spark.createDataFrame(titles, "doc_id bigint, title string, year int")
    return store.build_index(corpus, str(path), fields=("title",), analysis=Analysis().plain(), keep_corpus=False)


def weighted(index, queries):
    clauses = C.keyword_clauses(local_table(index.spark, queries, "query_id string, text string"))
    return M.weighted_terms(index, C.clause_terms(clauses, index.analysis, index.buckets))


@pytest.fixture(scope="module")
def titles():
    rare = [(i, "deep graph learning rare" if i % 40 == 0 else f"deep graph w{i} learning", 2000) for i in range(400)]
    return [*rare, (400, "graph deep rare", 2000), (None, "deep graph learning rare", 2000)]


@pytest.mark.parametrize("bits", [1 << 27, 64], ids=["many bits", "few bits"])
def test_phrases(spark, titles, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(M, "BITS", bits)
    index = build(spark, titles, tmp_path / "index")
    terms = weighted(index, [("q", "deep graph learning rare"), ("r", "graph deep"), ("s", "learning rare, deep graph")])
    found = {(r["query_id"], r["doc_id"], r["occur"]) for r in M.phrase_hits(index, terms).collect()}
    every = {i for i in range(400)}
    some = {i for i in every if i % 40 == 0}
    expected = {("q", i, "must") for i in some} | {("r", 400, "must")} | {("s", i, "must") for i in some} | {("s", i, "should") for i in every}
    assert found == expected


def test_common_words_do_not_travel(spark, titles, tmp_path):
    index = build(spark, titles, tmp_path / "index")
    terms = weighted(index, [("q", "deep graph learning rare")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = M._maybe(M.term_matches(index, terms), M.term_matches(index, terms.where("lead")), ["query_id", "doc_id"])
        assert rows.count() < 60 and M.term_matches(index, terms).count() > 1200
        plan = M.phrase_hits(index, terms)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The bits are met before the pairs are told for certain.
    assert "LeftSemi" not in plan and plan.index("bits") > plan.index("Join Inner")


def test_passes(spark, titles, tmp_path, monkeypatch):
    """An index laid out in passes is the index laid out at once, and passes leave no shuffle files."""
    whole = build(spark, titles, tmp_path / "whole")
    monkeypatch.setattr(store, "PASS_TOKENS", 100)
    written = []
    kept = store.shuffles_dropped

    def counted(session):
        written.append(session)
        return kept(session)

    monkeypatch.setattr(store, "shuffles_dropped", counted)
    parts = build(spark, titles, tmp_path / "parts")
    assert written and parts.buckets == whole.buckets

    def rows(table):
        return sorted(map(str, table.select(*sorted(table.columns)).collect()))

    for name in ("postings", "term_stats", "field_stats"):
        assert rows(getattr(parts, name)) == rows(getattr(whole, name))
    folders = {p.parent.name for p in pathlib.Path(tmp_path / "parts").rglob("postings/*/*/*.parquet")}
    assert folders == {f"bucket={r['bucket']}" for r in whole.postings.select("bucket").distinct().collect()}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") != "true"
