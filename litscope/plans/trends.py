"""Trend reports over a corpus: hotspots, their evolution, leading authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litscope.operators import topics as T
from litscope.operators import trends as R
from litscope.plans.search import Library

DEFAULT_END = 2023
DEFAULT_TOP_K = 5


def _titles(records: DataFrame | Library, start: int, end: int, venue: str | None) -> DataFrame:
    """Titles of a span. With a library a venue is what a venue search finds, in any
    letter case; with a corpus it is the very name."""
    if not isinstance(records, Library):
        return R.venue_titles(records, start, end, venue)
    return R.venue_titles(records.index.corpus, start, end) if venue is None else searched_titles(records, venue, start, end)


def _filled(ranked: DataFrame, records: DataFrame | Library, start: int, end: int, venue: str | None) -> DataFrame:
    """Add a row without phrase for each year that has none."""
    if not isinstance(records, Library):
        return R.fill_years(ranked, records, start, end, venue)
    if venue is None:
        return R.fill_years(ranked, records.index.corpus, start, end)
    years = records.index.spark.range(start, end + 1).select(F.lit(venue).alias("venue"), F.col("id").cast("int").alias("year"))
    return years.join(ranked, ["venue", "year"], "left")


def conference_hotspots(
    records: DataFrame | Library,
    start: int,
    end: int = DEFAULT_END,
    venue: str | None = None,
    top_k: int = DEFAULT_TOP_K,
    fill: bool = False,
) -> DataFrame:
    """(venue, year, phrase, n, score, rank): top phrases of each year; all venues
    in one job unless one is named. ``fill`` adds years without any."""
    ranked = R.hotspots_by_year(_titles(records, start, end, venue), top_k)
    return _filled(ranked, records, start, end, venue) if fill else ranked


def hotspot_evolution(
    records: DataFrame | Library,
    start: int,
    end: int = DEFAULT_END,
    venue: str | None = None,
    top_k: int = DEFAULT_TOP_K,
    fill: bool = False,
) -> DataFrame:
    """Each year's counts of the phrases that lead over the whole span."""
    ranked = R.hotspot_evolution(_titles(records, start, end, venue), top_k)
    return _filled(ranked, records, start, end, venue) if fill else ranked


def hotspot_series(
    records: DataFrame | Library, start: int, end: int = DEFAULT_END, venue: str | None = None, top_k: int = DEFAULT_TOP_K
) -> DataFrame:
    """Year by phrase counts for plotting, with zeros."""
    return R.hotspot_series(_titles(records, start, end, venue), start, end, top_k)


def searched_titles(library: Library, venue: str, start: int, end: int = DEFAULT_END) -> DataFrame:
    """Titles of all records a venue search finds, as (venue, year, title).

    Unlike ``venue_titles`` this follows the search: any token of the name, in
    book title or journal, or the raw name in the key.
    """
    hits = library.hits(start, end, venue=venue).select("doc_id")
    records = library.index.corpus.join(hits, "doc_id", "left_semi")
    return records.where(F.col("title").isNotNull()).select(F.lit(venue).alias("venue"), "year", "title")


def leading_authors(
    records: DataFrame | Library,
    topic: str,
    start: int,
    end: int = DEFAULT_END,
    venue: str | None = None,
    venue_hits: DataFrame | None = None,
    count: str = "phrases",
) -> DataFrame:
    """(topic, author, n, rank), most first. With a library, ``venue`` narrows the
    records to what a venue search finds; ``venue_hits`` (doc_id) to any hits."""
    corpus = records.index.corpus if isinstance(records, Library) else records
    if venue is not None:
        if isinstance(records, Library):
            venue_hits = records.hits(start, end, venue=venue)
        else:
            corpus = corpus.where(R.venue_name() == venue)
    if venue_hits is not None:
        corpus = corpus.join(venue_hits.select("doc_id"), "doc_id", "left_semi")
    return T.by_rank(T.pivot_authors(corpus, [topic], start, end, count))
