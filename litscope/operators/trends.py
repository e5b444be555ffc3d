"""Yearly hotspots of venues, their evolution, and zero-filled series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.operators.phrases import phrase_counts, phrase_order, scored_within, top_phrases
from litscope.operators.ranking import top_k
from litscope.session import durable


def venue_name() -> Column:
    """Where a record appeared: its book title, else its journal."""
    return F.coalesce("booktitle", "journal")


def venue_titles(corpus: DataFrame, start: int, end: int, venue: str | None = None) -> DataFrame:
    """(venue, year, title) of a span, both ends included."""
    rows = corpus.where(F.col("year").between(start, end) & F.col("title").isNotNull())
    rows = rows.select(venue_name().alias("venue"), "year", "title")
    rows = rows.where(F.col("venue").isNotNull())
    return rows.where(F.col("venue") == venue) if venue is not None else rows


def hotspots_by_year(titles: DataFrame, k: int = 5) -> DataFrame:
    """Leading phrases of every (venue, year) in one job."""
    scope = ["venue", "year"]
    return top_phrases(durable(phrase_counts(titles, scope)), scope, k)


def fill_years(ranked: DataFrame, corpus: DataFrame, start: int, end: int, venue: str | None = None) -> DataFrame:
    """Add a row without phrase for each year of the span a venue has none in."""
    venues = corpus.where(F.col("year").between(start, end)).select(venue_name().alias("venue"))
    venues = venues.where(F.col("venue").isNotNull() if venue is None else F.col("venue") == venue).distinct()
    years = venues.select("venue", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("year"))
    return years.join(ranked, ["venue", "year"], "left")


def span_leaders(yearly: DataFrame, k: int) -> DataFrame:
    """The leading phrases of each venue over all years of ``yearly``."""
    overall = yearly.groupBy("venue", "phrase").agg(F.sum("n").alias("n"))
    return top_phrases(durable(overall), ["venue"], k)


def hotspot_evolution(titles: DataFrame, k: int = 5) -> DataFrame:
    """Each year's counts of the phrases that lead their venue over the span."""
    scope = ["venue", "year"]
    yearly = durable(phrase_counts(titles, scope))
    leaders = durable(span_leaders(yearly, k).select("venue", "phrase"))
    kept = durable(yearly.join(leaders, ["venue", "phrase"], "left_semi"))
    # At most k phrases per venue are left, so no group is large.
    return top_k(scored_within(kept, yearly, scope), scope, phrase_order(), k)


def phrase_series(yearly: DataFrame, leaders: DataFrame, start: int, end: int) -> DataFrame:
    """(venue, phrase, year, n) for every leading phrase and year, 0 where unseen."""
    years = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("year")
    grid = leaders.select("venue", "phrase", years)
    known = yearly.select("venue", "phrase", "year", "n")
    joined = grid.join(known, ["venue", "phrase", "year"], "left")
    return joined.select("venue", "phrase", "year", F.coalesce("n", F.lit(0)).alias("n"))


def hotspot_series(titles: DataFrame, start: int, end: int, k: int = 5) -> DataFrame:
    yearly = durable(phrase_counts(titles, ["venue", "year"]))
    return phrase_series(yearly, durable(span_leaders(yearly, k)), start, end)


def series_table(series: DataFrame, start: int, end: int) -> DataFrame:
    """The series with one column per year."""
    years = list(range(start, end + 1))
    return series.groupBy("venue", "phrase").pivot("year", years).agg(F.sum("n"))
