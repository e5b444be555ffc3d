"""Leading authors of a topic, by fuzzy match of its key phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litscope.functions.similarity import MATCH_THRESHOLD, topic_matcher
from litscope.functions.text import candidate_phrases, held
from litscope.operators.ranking import rank_all


def topic_matches(records: DataFrame, topics: list[str], threshold: int = MATCH_THRESHOLD) -> DataFrame:
    """(records..., topic, matches): how many phrases of a title match a topic.

    Each row's phrases are compared where they are: no pairing of tables, no
    shuffle. A title without a match yields no row.
    """
    rows = records.where(F.col("title").isNotNull())
    rows = held(rows, "phrases", candidate_phrases(F.col("title")))
    rows = held(rows, "hits", topic_matcher(topics, threshold)("phrases"))
    rows = rows.withColumn("topic_id", F.explode_outer(F.array_distinct(F.flatten("hits"))))
    rows = rows.where(F.col("topic_id").isNotNull())
    matching = F.filter("hits", lambda h: F.array_contains(h, F.col("topic_id")))
    names = F.array(*[F.lit(t) for t in topics])
    rows = rows.withColumn("matches", F.size(matching)).withColumn("topic", F.get(names, F.col("topic_id")))
    return rows.drop("phrases", "hits", "topic_id")


def pivot_authors(
    records: DataFrame,
    topics: list[str],
    start: int | None = None,
    end: int | None = None,
    count: str = "phrases",
    threshold: int = MATCH_THRESHOLD,
) -> DataFrame:
    """(topic, author, n), counting matching phrases or, on request, papers.

    Counts add up within each task first, so a prolific author is no hot spot.
    """
    if start is not None:
        records = records.where(F.col("year").between(start, end or start))
    matched = topic_matches(records.select("title", "author"), topics, threshold)
    weight = F.sum("matches") if count == "phrases" else F.count("*")
    authors = matched.select("topic", "matches", F.explode("author").alias("author"))
    return authors.groupBy("topic", "author").agg(weight.cast("long").alias("n"))


def by_rank(authors: DataFrame) -> DataFrame:
    """Add each author's rank within a topic, and sort by it."""
    return rank_all(authors, ["topic"], [F.col("n").desc(), F.col("author").asc()]).orderBy("topic", "rank")
