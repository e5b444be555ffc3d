"""The topic join finds what comparing every phrase with every topic finds."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from litscope.functions.similarity import token_set_ratio
from litscope.operators import topic_join as J
from litscope.operators.topics import pivot_authors


def words(seed, n):
    rng = random.Random(seed)
    stems = ["neural", "network", "graph", "graphs", "learning", "learnt", "deep", "search", "indexing", "index", "parallel", "sparse", "spare", "a", "bb"]
    out = []
    for _ in range(n):
        chosen = [rng.choice(stems) for _ in range(rng.randrange(1, 5))]
        if rng.random() < 0.4:
            # A letter or two go wrong, so that no word is shared.
            chosen = ["".join(ch for ch in w if rng.random() > 0.12) or "x" for w in chosen]
        out.append(" ".join(chosen))
    return out


@pytest.mark.parametrize("threshold", [51, 75, 80, 95, 100])
def test_all_pairs(spark, threshold):
    phrases, topics = words(1, 220), words(2, 60)
    phrases += ["Naïve Müller", "--", "", "Graph, SEARCH!", "z" * 90 + " q", "deep  deep learning", "日本 語"]
    topics += ["naive muller", "...", "search graph", "z" * 89 + "y q", "日本", "learning deep"]
    found = J.topic_pairs(
        spark.createDataFrame([(p,) for p in phrases] + [(None,)], "phrase string"),
        spark.createDataFrame([(t,) for t in topics] + [(None,)], "topic string"),
        threshold,
    ).collect()
    expected = {(p, t): r for p in phrases for t in topics if (r := token_set_ratio(p, t)) >= threshold}
    assert {(r["phrase"], r["topic"]): r["ratio"] for r in found} == expected and len(found) == len(expected)


def test_blocks_and_groups(spark, monkeypatch):
    for name, value in (("PHRASES", 7), ("TOPICS", 3), ("PAIRS", 1)):
        monkeypatch.setattr(J, name, value)
    phrases, topics = sorted(set(words(3, 80))), sorted(set(words(4, 20)))
    found = J.topic_pairs(spark.createDataFrame([(p,) for p in phrases], "phrase string"), spark.createDataFrame([(t,) for t in topics], "topic string"))
    expected = {(p, t) for p in phrases for t in topics if token_set_ratio(p, t) >= 80}
    assert {(r["phrase"], r["topic"]) for r in found.collect()} == expected


def test_common_subsequences():
    rng = random.Random(9)
    a = ["".join(rng.choice("abcé") for _ in range(rng.randrange(0, 64))) for _ in range(60)]
    b = ["".join(rng.choice("abcé") for _ in range(rng.randrange(0, 90))) for _ in range(40)]
    pairs = [(rng.randrange(60), rng.randrange(40)) for _ in range(400)]

    def plain(x, y):
        row = [0] * (len(y) + 1)
        for p in x:
            last = row[:]
            for j, q in enumerate(y, 1):
                row[j] = last[j - 1] + 1 if p == q else max(last[j], row[j - 1])
        return row[-1]

    import numpy as np

    left, right = (np.array(x) for x in zip(*pairs))
    assert J.common_subsequences(a, b, left, right).tolist() == [plain(a[i], b[j]) for i, j in pairs]


def test_authors_are_those_of_the_list(spark):
    rng = random.Random(5)
    rows = [(f"{p}, {q}. {p}", [f"a{rng.randrange(6)}", f"b{rng.randrange(4)}"], 2000 + i % 4) for i, (p, q) in enumerate(zip(words(6, 60), words(7, 60)))]
    rows += [(None, ["a1"], 2001), ("deep learning", None, 2001), ("deep learning", [], 2001)]
    records = spark.createDataFrame(rows, "title string, author array<string>, year int")
    topics = ["deep learning", "graph search", "sparse index", "nothing like it at all"]
    table = spark.createDataFrame([(t,) for t in topics], "topic string")
    ours = J.topic_authors(records, table, 2001, 2002).collect()
    theirs = pivot_authors(records, topics, 2001, 2002).collect()
    assert Counter(map(tuple, ours)) == Counter(map(tuple, theirs)) and ours


def test_edges(spark):
    none = spark.createDataFrame([], "phrase string")
    one = spark.createDataFrame([("deep learning",)], "topic string")
    assert J.topic_pairs(none, one).count() == 0
    assert J.topic_pairs(one.withColumnRenamed("topic", "phrase"), none.withColumnRenamed("phrase", "topic")).count() == 0
    with pytest.raises(ValueError):
        J.topic_pairs(none, one, 50)
