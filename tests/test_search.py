from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from litscope.operators import clauses as C
from litscope.operators.matching import search, sloppy_sum
from litscope.operators.patterns import Pattern, edit_distance, pattern_clauses, pattern_terms
from litscope.operators.ranking import rank_all, top_k
from litscope.plans.search import ranked, search_clauses, year_hits_batch
from litscope.sources.store import open_index


def keys(frame):
    return [r["key"] for r in frame.collect()]


def clause_frame(spark, *rows):
    names = "query_id string, grp int, clause_id int, field string, occur string, kind string, text string"
    return C.clause_table(spark.createDataFrame(list(rows), names))


def titles_of(library, hits):
    joined = hits.join(library.index.corpus, "doc_id").select("title")
    return {r["title"] for r in joined.collect()}


def test_one_word_is_a_term_and_several_are_a_phrase(library):
    assert len(keys(library.by_keyword("things"))) == 4
    assert keys(library.by_keyword("neural network")) == ["conf/icse/Old15"]
    assert keys(library.by_keyword("network neural")) == []


def test_phrase_over_a_stop_word(spark, library):
    assert keys(library.by_keyword("internet of things")) == ["conf/aaai/LeeB15"]
    clauses = C.keyword_clauses(spark.createDataFrame([("q", "internet of things")], "query_id string, text string"))
    assert search_clauses(library.index, clauses, strict_gaps=False).count() == 0


def test_score_is_the_published_formula(library):
    row = library.by_keyword("neural").first()
    stats = {r.field: r for r in library.index.field_stats.collect()}["title"]
    length = library.index.postings.where((F.col("doc_id") == row.doc_id) & (F.col("field") == "title")).first().length
    idf = math.log(1 + (stats.docs - 1 + 0.5) / (1 + 0.5))
    expected = idf * 1 / (1 + 1.2 * (1 - 0.75 + 0.75 * length / stats.mean_length))
    assert row.score == pytest.approx(expected, abs=1e-8)
    assert row["rank"] == 1


@pytest.mark.parametrize(
    "text, roles",
    [
        ("a1 OR b1", ["must", "should"]),
        ("a1 and b1", ["must", "must"]),
        ("a1 NOT b1, c1", ["must", "must_not", "should"]),
        ("a1 AND NOT b1", ["must", "must"]),
    ],
)
def test_role_of_a_clause_is_the_link_before_it(spark, text, roles):
    frame = C.keyword_clauses(spark.createDataFrame([("q", text)], "query_id string, text string"))
    assert [r.occur for r in frame.orderBy("clause_id").collect()] == roles


def test_roles(library):
    assert set(keys(library.by_keyword("things AND internet"))) == {"conf/aaai/LeeB15"}
    assert "conf/aaai/LeeB15" not in keys(library.by_keyword("things NOT internet"))
    optional = library.by_keyword("things OR internet").collect()
    assert optional[0]["key"] == "conf/aaai/LeeB15" and len(optional) == 4


def test_roles_as_sets(spark, library):
    both = [("q", 0, 0, "title", "must", "text", "things"), ("q", 0, 1, "title", "should", "text", "graph")]
    either = [("q", 0, i, "title", "should", "text", t) for i, t in enumerate(["things", "graph"])]
    barred = [("q", 0, 0, "title", "must", "text", "things"), ("q", 0, 1, "title", "must_not", "text", "book")]
    found = [
        titles_of(library, search_clauses(library.index, clause_frame(spark, *rows))) for rows in (both, either, barred)
    ]
    assert found[0] < found[1]
    assert found[2] == found[0] - {"A book of things"}


def test_only_excluding_clauses_find_nothing(spark, library):
    rows = clause_frame(spark, ("q", 0, 0, "title", "must_not", "text", "things"))
    assert search_clauses(library.index, rows).count() == 0


def test_clause_of_stop_words_is_ignored_and_reported(spark, library):
    rows = clause_frame(
        spark, ("q", 0, 0, "title", "must", "text", "things"), ("q", 0, 1, "title", "must", "text", "of the")
    )
    assert search_clauses(library.index, rows).count() == 4
    assert C.empty_clauses(rows, library.index.analysis).select("text").collect() == [("of the",)]


def test_required_term_that_is_nowhere(library):
    assert keys(library.by_keyword("things AND zebra")) == []
    assert len(keys(library.by_keyword("things OR zebra"))) == 4


def test_any_author_name_matches(library):
    found = keys(library.by_author("Ann Dove"))
    assert found[0] == "conf/aaai/LeeB15" and len(found) == 5


def test_phrase_may_cross_two_authors(spark, library):
    rows = clause_frame(spark, ("q", 1, 0, "author", "must", "text", "brown cid"))
    assert titles_of(library, search_clauses(library.index, rows)) == {"Internet of things"}


def test_venue_by_raw_key_or_analysed_name(library):
    assert set(keys(library.by_venue("AAAI"))) == {"conf/aaai/LeeB15", "conf/aaai/2015"}
    lower = library.by_venue("aaai").collect()
    assert {r["key"] for r in lower} == {"conf/aaai/LeeB15", "conf/aaai/2015"}
    assert lower[0]["score"] > library.by_venue("AAAI").first()["score"]
    # The name's stem differs from the name, so the key cannot match it.
    by_key = library.by_venue("icse").first()["score"]
    assert by_key == library.by_venue("ICSE").first()["score"]
    assert keys(library.by_venue("tests")) == ["journals/x/A1"]


def test_years_include_both_ends(library):
    assert len(keys(library.by_year(2013, 2015))) == 5
    assert keys(library.by_year(2013)) == ["phd/P1"]
    assert [r["score"] for r in library.by_year(2015).collect()] == [1.0, 1.0]


def test_all_criteria_must_hold(library):
    assert keys(library.multi_field(start=2015, end=2016, keyword="things", author="brown")) == ["conf/aaai/LeeB15"]
    assert keys(library.multi_field(start=2016, keyword="things", author="brown")) == []
    alone = library.by_keyword("internet").first()["score"]
    dated = library.multi_field(start=2015, keyword="internet").first()["score"]
    assert dated == pytest.approx(alone + 1, abs=1e-8)
    assert keys(library.multi_field(venue="AAAI", author="cid")) == ["conf/aaai/LeeB15"]


def test_end_alone_is_ignored_and_nothing_finds_nothing(library):
    assert keys(library.multi_field(end=2015)) == []
    assert len(keys(library.multi_field(end=2000, keyword="things"))) == 4
    assert len(keys(library.multi_field(start=2014, end=2016))) == 6


def test_top_k_and_all(library):
    assert len(keys(library.by_keyword("things", top_k=2))) == 2
    everything = library.by_keyword("things", return_all=True).collect()
    assert [r["rank"] for r in everything] == [1, 2, 3, 4]
    scores = [(-r["score"], r["doc_id"]) for r in everything]
    assert scores == sorted(scores)


def test_a_batch_answers_each_query_as_if_alone(spark, library):
    texts = ["things", "neural network", "things NOT book", "graph OR deep, thesis", "zebra"]
    queries = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "query_id string, text string")
    batch = search_clauses(library.index, C.keyword_clauses(queries.repartition(3))).collect()
    for i, text in enumerate(texts):
        alone = library.by_keyword(text).select("rank", "doc_id", "score").collect()
        assert sorted((r["rank"], r.doc_id, r.score) for r in batch if r.query_id == str(i)) == sorted(map(tuple, alone))


@pytest.mark.parametrize(
    "pattern, count",
    [
        (Pattern("prefix", "net"), 1),
        (Pattern("wildcard", "t*n?"), 4),
        (Pattern("regex", "thes(is|es)|graph"), 3),
        (Pattern("fuzzy", "nueral", edits=1), 1),
        (Pattern("fuzzy", "nrual", edits=1), 0),
        (Pattern("range", "neu", upper="nev"), 1),
        (Pattern("prefix", "zz"), 0),
    ],
)
def test_patterns(library, pattern, count):
    hits = search(library.index, pattern_terms(library.index, [pattern])).collect()
    assert len(hits) == count and all(h.score == 1.0 or pattern.kind == "fuzzy" for h in hits)


def test_nearer_words_come_first(spark, library):
    rows = library.by_pattern("fuzzy", "networks").select("score", "title").collect()
    assert rows and rows[0]["score"] == max(r["score"] for r in rows)
    exact, apart = (library.by_pattern("fuzzy", t).first()["score"] for t in ("thing", "thong"))
    assert exact == 1.0 and apart == pytest.approx(0.8)


def test_patterns_join_other_clauses(spark, library):
    rows = clause_frame(spark, ("q", 0, 0, "title", "must", "text", "things"))

    def found(*patterns):
        return titles_of(library, search_clauses(library.index, rows.unionByName(pattern_clauses(spark, list(patterns)))))

    assert found(Pattern("prefix", "inter"), Pattern("prefix", "zz")) == set()
    assert found(Pattern("prefix", "inter", boost=3.0)) == {"Internet of things"}
    # The keyword has the same id; what kind of clause it is tells them apart.
    assert found(Pattern("prefix", "inter", clause_id=0)) == {"Internet of things"}


def test_clauses_of_one_group_over_two_fields(spark, library):
    query = spark.createDataFrame([("q", "brown aaai")], "query_id string, text string")
    parts = [C.any_clauses(query, f, C.AUTHOR) for f in ("author", "booktitle")]
    alone = [titles_of(library, search_clauses(library.index, p)) for p in parts]
    both = titles_of(library, search_clauses(library.index, parts[0].unionByName(parts[1])))
    assert all(alone) and both == alone[0] | alone[1]


def test_clauses_that_cannot_be_told_apart(spark, library):
    rows = clause_frame(spark, ("q", 0, 0, "title", "must", "text", "things"), ("q", 0, 0, "title", "must", "text", "graph"))
    with pytest.raises(ValueError, match="clause_id"):
        search_clauses(library.index, rows)
    with pytest.raises(Exception, match="groups are numbered 0 to 63"):
        search_clauses(library.index, clause_frame(spark, ("q", 64, 0, "title", "must", "text", "things"))).collect()


def test_long_keyword_text_meets_no_other_clause(spark, library):
    many = ", ".join(["things"] * 2100)
    assert len(keys(library.multi_field(keyword=many, author="brown", top_k=50))) == 1


def test_edit_distance():
    cases = [("abc", "abc", 0), ("abc", "acb", 1), ("abc", "ab", 1), ("abcd", "badc", 2), ("", "ab", 2)]
    assert all(edit_distance(a, b) == n for a, b, n in cases)


def test_slop(spark, library):
    rows = clause_frame(spark, ("q", 0, 0, "title", "must", "text", "neural learning"))
    counts = [
        search_clauses(library.index, rows.withColumn("slop", F.lit(s)), sloppy=True).count() for s in (0, 1, 2)
    ]
    assert counts == [0, 1, 1]
    exact = clause_frame(spark, ("q", 0, 0, "title", "must", "text", "deep networks"))
    plain = search_clauses(library.index, exact).collect()
    assert search_clauses(library.index, exact, sloppy=True).collect() == plain


def test_slop_adds_up_all_windows():
    def freq(*places, size=2, slop=3):
        return sloppy_sum([{"start": s, "off": o} for s, o in sorted(places)], size, slop)

    assert freq((4, 0), (4, 1)) == 1
    assert freq((4, 0), (4, 1), (9, 0), (9, 1)) == 2
    assert freq((4, 0), (6, 1)) == pytest.approx(1 / 3)
    assert freq((4, 0), (9, 1)) == 0
    # 4-6, 6-7 and 7-8: each begins later than the one before.
    assert freq((4, 0), (6, 1), (7, 0), (8, 1)) == pytest.approx(1 / 3 + 1 / 2 + 1 / 2)
    assert freq((1, 0), (1, 1), (1, 2), (3, 0), size=3) == pytest.approx(1)


def test_index_opens_again_with_its_analysis(spark, library):
    path = library.index.postings.inputFiles()[0].split("/postings/")[0]
    index = open_index(spark, path)
    assert index.analysis == library.index.analysis and index.buckets == 4
    assert index.corpus.count() == 12


def test_search_reads_only_the_asked_buckets(spark, library):
    clauses = C.keyword_clauses(spark.createDataFrame([("q", "neural")], "query_id string, text string"))
    terms = C.clause_terms(clauses, library.index.analysis, library.index.buckets)
    plan = search(library.index, terms)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line and "postings" in line]
    filters = [line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scan]
    assert filters and all("field" in f and "bucket" in f for f in filters)
    assert all("GreaterThanOrEqual(term,neural)" in line and "LessThanOrEqual(term,neural)" in line for line in scan)
    assert all("positions" not in line.split("ReadSchema")[1] for line in scan)
    assert "SortMergeJoin" not in plan


def test_year_batch(spark, library):
    spans = spark.createDataFrame(
        [("a", 2014, 2015), ("b", 2016, None), ("c", 0, 2_000_000), ("d", 2016, 2012)],
        "query_id string, year_from int, year_to int",
    )
    best = ranked(year_hits_batch(library.index.corpus, spans), 2).collect()
    assert sorted(best) == sorted(ranked(year_hits_batch(library.index.corpus, spans, 2), 2).collect())
    counts = {r["query_id"]: r["count"] for r in year_hits_batch(library.index.corpus, spans).groupBy("query_id").count().collect()}
    assert counts == {"a": 4, "b": 2, "c": 9}


def test_rank_all_equals_a_window(spark):
    rows = [(f"g{i % 3 if i % 7 else 0}", float(i * 37 % 11), i) for i in range(500)] + [(None, 1.0, 500)]
    frame = spark.createDataFrame(rows, "query_id string, score double, doc_id long").repartition(7)
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    window = top_k(frame, ["query_id"], order, 1000).collect()
    assert sorted(map(str, rank_all(frame, ["query_id"], order).collect())) == sorted(map(str, window))
    cut = ranked(frame, 3).collect()
    assert sorted(map(str, top_k(frame, ["query_id"], order, 20_000).where("rank <= 3").collect())) == sorted(map(str, cut))


@pytest.mark.parametrize("k", [1000, 1001, 10_000])
def test_no_group_is_sorted_whole_in_one_task(spark, k):
    frame = spark.range(3000).selectExpr("'q' AS query_id", "id AS doc_id", "double(id % 7) AS score")
    plan = ranked(frame, k)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "rowsBetween" in plan or "Sort [query_id" not in plan
    assert [r["rank"] for r in ranked(frame, k).orderBy("rank").collect()] == list(range(1, min(k, 3000) + 1))
