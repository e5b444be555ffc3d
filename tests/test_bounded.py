"""Top k by bounds and conjunctions by bitmaps give what scoring everything gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from litscope.functions.text import Analysis
from litscope.operators import bitmaps as M
from litscope.operators import bounds as U
from litscope.operators.clauses import clause_table, clause_terms
from litscope.operators.matching import answer_clauses, term_matches, weighted_terms
from litscope.operators.patterns import Pattern, pattern_clauses
from litscope.plans.search import ranked, search_best, search_clauses, search_conjunctions
from litscope.session import local_table
from litscope.sources.store import build_index

WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(7)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    rows = []
    for i in range(900):
        title = " ".join(rng.choices(WORDS, weights, k=rng.randrange(3, 40)))
        rows.append((i * 3 - 40, title, 2000 + i % 9))
    corpus = spark.createDataFrame(rows, "doc_id bigint, title string, year int")
    path = str(tmp_path_factory.mktemp("bounded") / "index")
    return build_index(corpus, path, fields=("title",), analysis=Analysis().plain(), buckets=4, keep_corpus=False, positions=False)


@pytest.fixture(scope="module")
def bounds(index, tmp_path_factory):
    return U.write_bounds(index, str(tmp_path_factory.mktemp("bounded") / "bounds"), bits=3, least_df=60)


@pytest.fixture(scope="module")
def bitmaps(index, tmp_path_factory):
    return M.write_bitmaps(index, str(tmp_path_factory.mktemp("bounded") / "bitmaps"), least_df=60)


def random_clauses(spark, seed, musts=False):
    rng = random.Random(seed)
    rows = []
    for q in range(25):
        years = (2002, 2006) if q % 5 == 0 else (None, None)
        for c, word in enumerate(rng.sample([*WORDS, "nowhere"], rng.randrange(1, 7))):
            occur = "must" if musts and c == 0 else rng.choice(["should", "should", "must", "must_not"] if q % 2 else ["should"])
            rows.append((f"q{q}", c % 2 if q % 7 == 0 else 0, c, "title", occur, "exact", word, rng.choice([1.0, 2.5]), *years))
    names = "query_id string, grp int, clause_id int, field string, occur string, kind string, text string, boost double, year_from int, year_to int"
    return clause_table(local_table(spark, rows, names))


def rows(df):
    return sorted(map(tuple, df.select("query_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize("k", [1, 5, 40])
def test_bounds_keep_the_first_k(spark, index, bounds, k, monkeypatch):
    monkeypatch.setattr(U, "FIRST", 4)
    clauses = random_clauses(spark, k)
    assert rows(search_best(index, bounds, clauses, k)) == rows(search_clauses(index, clauses, k))


def test_fewer_postings_are_scored(spark, index, bounds, monkeypatch):
    monkeypatch.setattr(U, "FIRST", 8)
    listed = [("q", i, "title", "should", "exact", w) for i, w in enumerate(["w0", "w1", "w2", "w55"])]
    clauses = clause_table(local_table(spark, listed, "query_id string, clause_id int, field string, occur string, kind string, text string"))
    terms = clause_terms(clauses, index.analysis, index.buckets)
    weighted = weighted_terms(index, terms)
    every = term_matches(index, weighted)
    chosen = U.candidates(index, bounds, terms, weighted, 5)
    scored = every.join(chosen, ["query_id", "doc_id"], "left_semi").count()
    assert 5 <= chosen.count() and scored < every.count() / 5


def test_bounds_hold(index, bounds):
    table = bounds.table.collect()
    assert table and all(0 < r["bound"] <= 1 and r["docs"] >= 1 for r in table)
    assert {r["term"] for r in index.term_stats.where("df >= 60").collect()} == {r["term"] for r in table}


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_find_all_conjunctions(spark, index, bitmaps, seed):
    clauses = random_clauses(spark, seed, musts=True)
    everything = rows(ranked(answer_clauses(index, clauses), None))
    assert rows(ranked(M.conjunction_hits(index, bitmaps, clauses), None)) == everything
    # Whether bitmaps are stored or made from postings changes nothing.
    none_stored = M.Bitmaps(M.term_bitmaps(index, 10**9), 10**9)
    assert rows(search_conjunctions(index, none_stored, clauses, 3)) == rows(search_clauses(index, clauses, 3))


def test_bits_become_ids(spark):
    ids = [-32769, -32768, -5, -1, 0, 1, 2, 32768, 32769, 10**12]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    held = frame.groupBy(F.bitmap_bucket_number("doc_id").alias("run")).agg(M._bitmap())
    assert sorted(r[0] for r in held.select(F.explode(M.documents_in("run", "bits"))).collect()) == ids


def test_what_is_not_taken(spark, index, bounds, bitmaps):
    phrase = clause_table(local_table(spark, [("q", "title", "w0 w1")], "query_id string, field string, text string")).withColumn("kind", F.lit("text"))
    pattern = pattern_clauses(spark, [Pattern("prefix", "w")])
    optional = clause_table(local_table(spark, [("q", "title", "w0", "exact", "should")], "query_id string, field string, text string, kind string, occur string"))
    for wrong in (phrase, pattern):
        with pytest.raises(ValueError):
            search_best(index, bounds, wrong)
    for wrong in (phrase, pattern, optional):
        with pytest.raises(ValueError):
            search_conjunctions(index, bitmaps, wrong)
    twice = optional.unionByName(optional)
    with pytest.raises(ValueError):
        search_best(index, bounds, twice)


def test_no_queries(spark, index, bounds, bitmaps):
    none = random_clauses(spark, 1).limit(0)
    assert search_best(index, bounds, none).count() == 0
    assert search_conjunctions(index, bitmaps, none).count() == 0
