"""From records to term tables: document terms, occurrences, postings, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.functions.grouping import group_terms
from litscope.functions.text import Analysis, analyse, held


def field_texts(corpus: DataFrame, fields: list[str]) -> DataFrame:
    """One row per (document, field) that has text: (doc_id, year, field, text).

    All fields come from one scan. Values of a list field follow each other
    without a position gap, so a phrase may run across two values.
    """

    def text(name: str) -> Column:
        is_list = isinstance(corpus.schema[name].dataType, T.ArrayType)
        return F.array_join(name, "\n") if is_list else F.col(name).cast("string")

    if len(fields) == 1:
        rows = corpus.select("doc_id", "year", F.lit(fields[0]).alias("field"), text(fields[0]).alias("text"))
    else:
        stacked = F.array(*[F.struct(F.lit(f).alias("field"), text(f).alias("text")) for f in fields])
        rows = corpus.select("doc_id", "year", F.inline(stacked))
    return rows.where(F.col("text") != "")


def document_terms(corpus: DataFrame, fields: list[str], analysis: Analysis) -> DataFrame:
    """(doc_id, year, field, length, terms): analysed text, still one row per field.

    ``length`` counts terms after stop words are gone. Narrow: no shuffle.
    """
    rows = analyse(field_texts(corpus, fields), "text", analysis).drop("text")
    return rows.withColumn("length", F.size("terms")).where(F.col("length") > 0)


def document_postings(doc_terms: DataFrame) -> DataFrame:
    """(doc_id, year, field, length, postings): terms grouped inside their row."""
    return held(doc_terms, "postings", group_terms("terms")).drop("terms")


def term_bucket(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def occurrences(doc_terms: DataFrame) -> DataFrame:
    """One row per term occurrence: (field, doc_id, year, length, term, pos)."""
    return doc_terms.select("field", "doc_id", "year", "length", F.inline_outer("terms"))


def postings(doc_postings: DataFrame) -> DataFrame:
    """One row per (field, term, document) with frequency and positions.

    Year and field length travel along, so a search never has to join a
    per-document table of the whole corpus.
    """
    return doc_postings.select("field", "doc_id", "year", "length", F.inline_outer("postings"))


def document_lengths(doc_terms: DataFrame) -> DataFrame:
    return doc_terms.select("field", "doc_id", "length")


def term_stats(doc_postings: DataFrame) -> DataFrame:
    """Documents per (field, term), added up within each task before the shuffle."""
    terms = doc_postings.select("field", F.explode_outer("postings.term").alias("term"))
    return terms.groupBy("field", "term").agg(F.count("*").alias("df"))


def field_stats(doc_terms: DataFrame) -> DataFrame:
    """Documents with the field and its mean length: one row per field."""
    return doc_terms.groupBy("field").agg(
        F.count("*").alias("docs"),
        F.sum("length").alias("tokens"),
        F.avg("length").alias("mean_length"),
    )
