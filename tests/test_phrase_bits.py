"""Runs that no phrase can be are left out where they are hashed, and a phrase is analysed within its row."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from litscope.functions.text import Analysis
from litscope.operators import phrase_batch as M
from litscope.session import local_table


def test_bits_hold_every_phrase(spark, monkeypatch):
    monkeypatch.setattr(M, "BITS", 64)
    monkeypatch.setattr(M, "AT_ONCE", 3)
    rng = random.Random(2)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(500)]
    bits = M.phrase_bits(local_table(spark, [(k,) for k in keys], "key_a bigint"))
    assert 64 * len(bits) == 8192
    every = np.array(keys, np.int64).view(np.uint64)
    assert M._held(every, bits).tolist() == list(range(500))
    others = np.array([rng.randrange(2**64) for _ in range(5000)], np.uint64)
    assert len(M._held(others, bits)) < 200
    monkeypatch.setattr(M, "MOST_BITS", 256)
    assert 64 * len(M.phrase_bits(local_table(spark, [(k,) for k in keys], "key_a bigint"))) == 256


def test_runs_of_no_phrase_are_not_listed(spark):
    queries = local_table(spark, [("q", "deep graph"), ("r", "Graph of learning")], "query_id string, text string")
    asked = M.asked_phrases(queries, Analysis(), "title")
    assert sorted((r["query_id"], r["shape"]) for r in asked.collect()) == [("q", [0, 1]), ("r", [0, 2])]
    bits = spark.sparkContext.broadcast(M.phrase_bits(asked))
    terms = [[(w, i) for i, w in enumerate(t)] for t in (["deep", "graph", "x", "deep", "graph"], ["graph", "y", "learn"], ["graph", "deep", "z"])]
    texts = spark.createDataFrame(list(enumerate(terms)), "doc_id bigint, terms array<struct<term string, pos int>>")
    runs = M._text_runs([[0, 1], [0, 2]], bits)(*M._word_hashes(F.col("terms")), F.col("terms.pos"))
    found = texts.select("doc_id", F.inline(runs)).join(asked, M.HASHES)
    assert sorted((r["doc_id"], r["query_id"], r["tf"]) for r in found.collect()) == [(0, "q", 2), (1, "r", 1)]
    assert texts.select(F.inline(runs)).count() == 2


@pytest.mark.parametrize("analysis", [Analysis(), Analysis().plain()], ids=["english", "plain"])
def test_phrases_stay_in_their_row(spark, analysis):
    queries = local_table(spark, [("q", "deep the graph"), ("n", None), ("e", "the"), (None, "deep")], "query_id string, text string")
    asked = M.asked_phrases(queries, analysis, "title")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert sorted((r["query_id"] or "", r["words"], r["shape"]) for r in asked.collect()) == [("", ["deep"], [0]), ("q", ["deep", "graph"], [0, 2])]
