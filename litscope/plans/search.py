"""Searches by year, venue, title keywords and author, alone or together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscope.operators import clauses as C
from litscope.operators.bitmaps import Bitmaps, conjunction_hits
from litscope.operators.bounds import Bounds, best_hits
from litscope.operators.matching import answer_clauses
from litscope.operators.patterns import Pattern, pattern_clauses
from litscope.operators.ranking import rank_all, top_k
from litscope.operators.vocabulary import Vocabulary
from litscope.session import durable, local_table
from litscope.sources.store import Index

DEFAULT_TOP_K = 20


def ranked(hits: DataFrame, k: int | None = DEFAULT_TOP_K) -> DataFrame:
    """Number the hits of each query, best first; ``k=None`` keeps them all."""
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    if k is None:
        return rank_all(hits, ["query_id"], order)
    return top_k(hits, ["query_id"], order, k)


def with_records(hits: DataFrame, corpus: DataFrame) -> DataFrame:
    """Add the stored fields. The hits' true size decides how they are joined."""
    return durable(hits).join(corpus, "doc_id")


def one_query(spark: SparkSession, text: str) -> DataFrame:
    return local_table(spark, [("q", text)], "query_id string, text string")


def search_clauses(
    index: Index,
    clauses: DataFrame,
    k: int | None = DEFAULT_TOP_K,
    strict_gaps: bool = True,
    sloppy: bool = False,
    vocabulary: Vocabulary | None = None,
) -> DataFrame:
    """Answer a whole table of queries in one job: (query_id, rank, doc_id, score).

    ``sloppy`` honours the ``slop`` column of phrase clauses. Patterns are looked up
    in ``vocabulary`` if there is one.
    """
    return ranked(answer_clauses(index, clauses, strict_gaps, sloppy, vocabulary), k)


def search_best(index: Index, bounds: Bounds, clauses: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The first k hits of queries of single words, without scoring what cannot be among them."""
    return ranked(best_hits(index, bounds, clauses, k), k)


def search_conjunctions(index: Index, bitmaps: Bitmaps, clauses: DataFrame, k: int | None = DEFAULT_TOP_K) -> DataFrame:
    """Queries that require words: documents that hold them all are found before any is scored."""
    return ranked(conjunction_hits(index, bitmaps, clauses), k)


def year_hits(corpus: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Records of a span of years, both ends included; one year if no end."""
    rows = corpus.where(F.col("year").between(start, end or start))
    return rows.select(F.lit("q").alias("query_id"), "doc_id", F.lit(1.0).alias("score"))


def exact_hits(corpus: DataFrame, field: str, value: str) -> DataFrame:
    """Records whose type, isbn or volume is this very string."""
    rows = corpus.where(F.col(field) == value)
    return rows.select(F.lit("q").alias("query_id"), "doc_id", F.lit(1.0).alias("score"))


def year_hits_batch(corpus: DataFrame, spans: DataFrame, k: int | None = None) -> DataFrame:
    """(query_id, year_from, year_to) -> hits, as an equality join on the year.

    Spans are clipped to the years there are, then listed year by year. All scores
    are equal and ties go by doc_id, so the k best of a span are among the k least
    ids of its years: with ``k``, only those are joined.
    """
    known = corpus.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
    if known["lo"] is None:
        known = {"lo": 0, "hi": 0}
    first = F.greatest("year_from", F.lit(known["lo"]))
    last = F.least(F.coalesce("year_to", "year_from"), F.lit(known["hi"]))
    listed = spans.withColumns({"first": first, "last": last}).where("first <= last")
    listed = listed.select("query_id", F.explode(F.sequence("first", "last")).alias("year"))
    records = corpus.select("doc_id", "year")
    if k is not None:
        records = top_k(records, ["year"], [F.col("doc_id").asc()], k).drop("rank")
    return records.join(listed, "year").select("query_id", "doc_id", F.lit(1.0).alias("score"))


class Library:
    """Searches over one index; each answer is (rank, score, record fields...)."""

    def __init__(self, index: Index, top_k: int = DEFAULT_TOP_K):
        self.index = index
        self.top_k = top_k

    def _finish(self, hits: DataFrame, top_k: int | None, return_all: bool) -> DataFrame:
        answer = ranked(hits, None if return_all else (top_k or self.top_k))
        return with_records(answer.drop("query_id"), self.index.corpus).orderBy("rank")

    def _search(self, clauses: DataFrame, top_k: int | None, return_all: bool) -> DataFrame:
        return self._finish(answer_clauses(self.index, clauses), top_k, return_all)

    def by_year(self, start: int, end: int | None = None, top_k: int | None = None, return_all: bool = False) -> DataFrame:
        return self._finish(year_hits(self.index.corpus, start, end), top_k, return_all)

    def by_venue(self, venue: str, top_k: int | None = None, return_all: bool = False) -> DataFrame:
        return self._search(C.venue_clauses(one_query(self.index.spark, venue)), top_k, return_all)

    def by_keyword(self, keyword: str, top_k: int | None = None, return_all: bool = False) -> DataFrame:
        """Keywords linked by AND, OR, NOT or commas; several words form a phrase."""
        return self._search(C.keyword_clauses(one_query(self.index.spark, keyword)), top_k, return_all)

    def by_pattern(self, kind: str, text: str, top_k: int | None = None, return_all: bool = False, **options) -> DataFrame:
        """A prefix, wildcard, regex, fuzzy or range search (see ``Pattern``)."""
        return self._search(pattern_clauses(self.index.spark, [Pattern(kind, text, **options)]), top_k, return_all)

    def by_author(self, author: str, top_k: int | None = None, return_all: bool = False) -> DataFrame:
        return self._search(C.author_clauses(one_query(self.index.spark, author)), top_k, return_all)

    def hits(
        self,
        start: int | None = None,
        end: int | None = None,
        venue: str | None = None,
        keyword: str | None = None,
        author: str | None = None,
    ) -> DataFrame:
        """Unranked hits that meet every given criterion. ``end`` without ``start``
        is ignored, and no criterion at all finds nothing."""
        spark, groups = self.index.spark, []
        if keyword:
            groups.append(C.keyword_clauses(one_query(spark, keyword)))
        if author:
            groups.append(C.author_clauses(one_query(spark, author)))
        if venue:
            groups.append(C.venue_clauses(one_query(spark, venue)))
        if not groups:
            rows = year_hits(self.index.corpus, start or 0, end if start else None)
            return rows if start else rows.where(F.lit(False))
        clauses = groups[0]
        for more in groups[1:]:
            clauses = clauses.unionByName(more)
        if start:
            clauses = clauses.withColumns({"year_from": F.lit(start), "year_to": F.lit(end or start)})
        return answer_clauses(self.index, clauses)

    def multi_field(
        self,
        start: int | None = None,
        end: int | None = None,
        venue: str | None = None,
        keyword: str | None = None,
        author: str | None = None,
        top_k: int | None = None,
        return_all: bool = False,
    ) -> DataFrame:
        return self._finish(self.hits(start, end, venue, keyword, author), top_k, return_all)
