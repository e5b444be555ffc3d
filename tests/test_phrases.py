from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from litscope.functions.words import TREND_BLOCK_LIST
from litscope.operators import phrases as K
from litscope.operators import trends
from litscope.plans.trends import conference_hotspots


def brute_force(phrases: list[str]) -> list[tuple[str, int, float]]:
    """Counts and scores by listing all word pairs of every phrase."""
    degree, freq = Counter(), Counter()
    for p in phrases:
        for word in p.split():
            freq[word] += 1
            for _ in p.split():
                degree[word] += 1
    score = {p: sum(degree[w] / freq[w] for w in p.split()) for p in phrases}
    counts = Counter(p for p in phrases if not any(b in p for b in TREND_BLOCK_LIST))
    return sorted(((p, n, score[p]) for p, n in counts.items()), key=lambda x: (x[1], x[2], x[0]), reverse=True)


def corpus_rows(seed: int = 7):
    rng = random.Random(seed)
    vocabulary = ["deep", "graph", "net", "study", "node", "sparse"]
    rows = []
    for i in range(300):
        venue = "big" if rng.random() < 0.6 else rng.choice(["x", "y"])
        runs = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 5))) for _ in range(3)]
        rows.append((i, ", ".join(runs), venue if i % 2 else None, None if i % 2 else venue, rng.choice([2014, 2015, 2017])))
    return rows


SCHEMA = "doc_id long, title string, booktitle string, journal string, year int"


def runs_of(title: str) -> list[str]:
    return [r for r in title.split(", ") if 2 <= len(r.split()) <= 4]


def test_hotspots_match_brute_force(spark):
    rows = corpus_rows()
    corpus = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {}
    for r in conference_hotspots(corpus, 2014, 2017).orderBy("venue", "year", "rank").collect():
        got.setdefault((r.venue, r.year), []).append((r.phrase, r.n, round(r.score, 9)))
    for (venue, year), ranked in got.items():
        phrases = [p for _, t, b, j, y in rows if (b or j) == venue and y == year for p in runs_of(t)]
        assert ranked == [(p, n, round(s, 9)) for p, n, s in brute_force(phrases)[:5]]
    assert len(got) == 9


def test_one_venue_and_filled_years(spark):
    corpus = spark.createDataFrame(corpus_rows(), SCHEMA)
    rows = conference_hotspots(corpus, 2014, 2017, "big", top_k=1, fill=True).orderBy("year").collect()
    assert [(r.year, r.phrase is None) for r in rows] == [(2014, False), (2015, False), (2016, True), (2017, False)]


def test_evolution_and_series(spark):
    rows = corpus_rows(3)
    corpus = spark.createDataFrame(rows, SCHEMA)
    titles = trends.venue_titles(corpus, 2014, 2017, "big")
    everything = [p for _, t, b, j, _ in rows if (b or j) == "big" for p in runs_of(t)]
    leaders = [p for p, _, _ in brute_force(everything)[:5]]
    got = {}
    for r in trends.hotspot_evolution(titles).orderBy("year", "rank").collect():
        got.setdefault(r.year, []).append((r.phrase, r.n))
    for year, ranked in got.items():
        phrases = [p for _, t, b, j, y in rows if (b or j) == "big" and y == year for p in runs_of(t)]
        assert ranked == [(p, n) for p, n, _ in brute_force(phrases) if p in leaders]
    series = trends.hotspot_series(titles, 2014, 2017)
    table = trends.series_table(series, 2014, 2017).collect()
    assert {r.phrase for r in table} == set(leaders)
    assert all(r["2016"] == 0 for r in table)
    assert sum(r["2014"] for r in table) == sum(n for _, n in got[2014])


def test_hotspots_shuffle_only_small_tables_after_counting(spark):
    """Text is counted once; what follows joins by broadcast, not by venue."""
    corpus = spark.createDataFrame(corpus_rows(), SCHEMA)
    frame = conference_hotspots(corpus, 2014, 2017)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_blocked_phrases_still_shape_word_scores(spark):
    titles = spark.createDataFrame([("v", 2014, "deep net, deep net study")], "venue string, year int, title string")
    counts = K.phrase_counts(titles, ["venue", "year"])
    top = K.top_phrases(counts, ["venue", "year"], 5).collect()
    assert [(r.phrase, r.score) for r in top] == [("deep net", 5.0)]
    assert counts.where(K.allowed()).count() == 1


def test_null_titles_and_venues_are_left_out(spark):
    corpus = spark.createDataFrame(
        [(1, None, "v", None, 2014), (2, "deep net", None, None, 2014), (3, "deep net", "v", "w", 2014)], SCHEMA
    )
    titles = trends.venue_titles(corpus, 2014, 2014)
    assert titles.collect() == [("v", 2014, "deep net")]
    assert K.phrase_counts(titles, ["venue"]).agg(F.sum("n")).first()[0] == 1
