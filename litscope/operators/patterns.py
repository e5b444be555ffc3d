"""Clauses that stand for many terms: prefix, wildcard, regex, fuzzy, range."""

from __future__ import annotations

from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.operators.clauses import IDENTITY, PATTERNS, clause_table
from litscope.session import local_table
from litscope.sources.store import Index

# First letters by which patterns meet terms.
SHARED = 4


@dataclass(frozen=True)
class Pattern:
    """One pattern clause by hand. Without an id it is numbered by its place in the list."""

    kind: str  # prefix, wildcard, regex, fuzzy or range
    text: str  # for a range: the lower bound
    field: str = "title"
    query_id: str = "q"
    clause_id: int | None = None
    group: int = 0
    occur: str = "must"
    boost: float = 1.0
    upper: str | None = None  # upper bound of a range
    edits: int = 2


def pattern_clauses(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    """Patterns as rows of a clause table."""
    for p in patterns:
        if p.kind not in PATTERNS:
            raise ValueError(f"unknown pattern kind {p.kind!r}")
    rows = [astuple(p)[:4] + (i if p.clause_id is None else p.clause_id,) + astuple(p)[5:] for i, p in enumerate(patterns)]
    names = "kind string, text string, field string, query_id string, clause_id int, grp int, occur string, boost double, upper string, edits int"
    return clause_table(local_table(spark, rows, names))


def _literal_start(kind: Column, text: Column) -> Column:
    """What every term of a pattern starts with."""
    return F.when(kind == "prefix", text).when(kind == "wildcard", F.regexp_extract(text, "^[^*?]*", 0)).otherwise("")


def _wildcard(text: Column) -> Column:
    escaped = F.regexp_replace(text, r"([^\p{L}\p{N}_*?])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def _meets(term: Column) -> Column:
    """Whether a term is one of its row's pattern; for fuzzy ones, whether it may be."""
    kind, text, edits = F.col("kind"), F.col("text"), F.col("edits")
    near = F.abs(F.length(term) - F.length(text)) <= edits
    # A swap of neighbours is one edit but two by plain distance.
    near = near & (F.levenshtein(term, text) <= 2 * edits)
    return (
        F.when(kind == "prefix", term.startswith(text))
        .when(kind == "wildcard", F.rlike(term, _wildcard(text)))
        .when(kind == "regex", F.rlike(term, F.concat(F.lit("^(?:"), text, F.lit(")$"))))
        .when(kind == "range", term.between(text, F.col("upper")))
        .otherwise(near)
    )


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours; no letter is edited twice."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return last[-1]


@F.pandas_udf(T.IntegerType())
def _distance(terms, texts):
    return pd.Series([None if a is None or b is None else edit_distance(a, b) for a, b in zip(terms, texts)], dtype="Int32")


def pattern_terms(index: Index, patterns: DataFrame | list[Pattern]) -> DataFrame:
    """The vocabulary terms of each pattern clause, as clause terms of constant score.

    Patterns meet the terms that start with the same letters, up to SHARED of
    them; only those without a fixed start meet a field's whole vocabulary, and the
    patterns are what is copied then. A fuzzy clause's terms weigh less by their edits: its boost
    times one minus the share of edits in the shorter word. A pattern no term meets
    still yields one row, without a term, so that a required clause stays required.
    """
    if isinstance(patterns, list):
        patterns = pattern_clauses(index.spark, patterns)
    start = F.substring(_literal_start(F.col("kind"), F.col("text")), 1, SHARED)
    patterns = patterns.where(F.col("kind").isin(*PATTERNS)).withColumn("start", start)
    lengths = sorted(r["n"] for r in patterns.select(F.length("start").alias("n")).distinct().collect())
    described = [*IDENTITY, "occur", "boost", "text", "upper", "edits", "year_from", "year_to"]
    starts = F.array(*(F.substring("term", 1, n) for n in lengths)) if lengths else F.array().cast("array<string>")
    vocabulary = index.term_stats.select("field", "bucket", "term", F.explode(F.array_distinct(starts)).alias("start"))
    rows = vocabulary.join(patterns.select(*described, "start"), ["field", "start"]).where(_meets(F.col("term")))
    fuzzy = F.col("kind") == "fuzzy"
    # Python gets the fuzzy rows' words, and nulls for the others.
    rows = rows.withColumn("apart", _distance(F.when(fuzzy, F.col("term")), F.when(fuzzy, F.col("text"))))
    rows = rows.where(~fuzzy | (F.col("apart") <= F.col("edits")))
    close = 1 - F.col("apart") / F.greatest(F.lit(1), F.least(F.length("term"), F.length("text")))
    rows = rows.withColumn("weight", F.when(fuzzy, F.col("boost") * F.greatest(close, F.lit(0.0))).otherwise(F.col("boost")))
    found = rows.select(*IDENTITY, "bucket", "term", "weight")
    joined = patterns.select(*IDENTITY, "occur", "boost", "year_from", "year_to").join(found, IDENTITY, "left")
    return joined.select(
        *IDENTITY, F.lit(0).alias("sub"), "occur",
        F.coalesce("bucket", F.lit(0)).alias("bucket"), "term",
        F.lit(0).alias("off"), F.lit(1).alias("size"), F.coalesce("weight", "boost").alias("boost"), F.lit(0).alias("slop"),
        "year_from", "year_to",
        F.lit(True).alias("constant"),
    )
