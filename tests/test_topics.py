from __future__ import annotations

import random

import pytest

from litscope.functions.similarity import _common_subsequence, token_set_ratio
from litscope.operators.topics import by_rank, pivot_authors
from litscope.plans.trends import leading_authors, searched_titles


@pytest.mark.parametrize(
    "left, right, score",
    [
        ("computer vision", "Computer Vision", 100),
        ("computer vision systems", "computer vision", 100),
        ("neural network", "neural networks", 97),
        ("aaa", "bbb", 0),
        ("", "abc", 0),
        (None, "abc", 0),
        ("--", "abc", 0),
        ("vision computer", "computer vision", 100),
        ("fuzzy was a bear", "fuzzy fuzzy was a bear", 100),
        ("abcd", "abce", 75),
        ("abcde", "abcdf", 80),
        ("café table", "caf table", 100),
    ],
)
def test_token_set_ratio(left, right, score):
    assert token_set_ratio(left, right) == score
    assert token_set_ratio(right, left) == score


def slow_subsequence(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc ", k=rng.randint(0, 90))) for _ in range(2))
        assert _common_subsequence(a, b) == slow_subsequence(a, b)


def papers(spark):
    rows = [
        (1, 2014, "Graph learning, and graph learnings", ["ann", "bob"]),
        (2, 2015, "Deep graph learning", ["ann"]),
        (3, 2016, "Graph learning", None),
        (4, 2016, "Something else entirely", ["cid"]),
        (5, 2019, "Graph learning", ["dan"]),
        (6, 2015, None, ["eve"]),
    ]
    return spark.createDataFrame(rows, "doc_id long, year int, title string, author array<string>")


def test_authors_count_matching_phrases_or_papers(spark):
    rows = by_rank(pivot_authors(papers(spark), ["graph learning"], 2014, 2018)).collect()
    assert [(r.author, r.n) for r in rows] == [("ann", 3), ("bob", 2)]
    rows = leading_authors(papers(spark), "graph learning", 2014, 2018, count="papers").collect()
    assert [(r.author, r.n) for r in rows] == [("ann", 2), ("bob", 1)]


def test_many_topics_and_a_narrowed_corpus(spark):
    topics = ["graph learning", "something else", "nothing here"]
    rows = pivot_authors(papers(spark), topics).collect()
    assert {(r.topic, r.author, r.n) for r in rows} == {
        ("graph learning", "ann", 3), ("graph learning", "bob", 2), ("graph learning", "dan", 1),
        ("something else", "cid", 1),
    }
    hits = spark.createDataFrame([(2,)], "doc_id long")
    assert leading_authors(papers(spark), "graph learning", 2014, venue_hits=hits).collect() == [("graph learning", "ann", 1, 1)]


def test_titles_of_a_venue_search(library):
    rows = searched_titles(library, "AAAI", 2014).collect()
    assert [(r.venue, r.year, r.title) for r in rows] == [("AAAI", 2015, "Internet of things")]


def test_topics_are_normalised_once(monkeypatch):
    """A phrase is cut into words once for all topics, a topic once for all phrases."""
    import pyarrow as pa

    from litscope.functions import similarity

    seen = []
    plain = similarity.normalised
    monkeypatch.setattr(similarity, "normalised", lambda text: seen.append(text) or plain(text))
    topics = ["graph learning", "deep nets", "é", "a"]
    phrases = ["graph learning", "learned graphs", "é", "deep net", "something of quite another length", "graph", "learnin graphs", None]
    for least in (0, 1, 50, 80, 100):
        match = similarity.topic_matcher(topics, least)
        seen.clear()
        found = match.func(pa.array([phrases, None, phrases[::-1]])).to_pylist()
        assert sorted(seen) == sorted(p for p in phrases if p)
        expected = [[i for i, t in enumerate(topics) if token_set_ratio(p, t) >= least] for p in phrases]
        assert found == [expected, None, expected[::-1]]
