"""Queries as rows: each search is a set of clauses in a table.

A clause has a role (``occur``: must, should, must_not) inside a group; the
groups of a query (title, author, venue) must all hold. Kinds:

``text``   analysed; one term, or an exact phrase if there are several
``any``    analysed; every term becomes a clause of its own
``exact``  the text as it stands is the term

and, over the terms of the index (see ``operators/patterns.py``), ``prefix``,
``wildcard``, ``regex``, ``range`` (up to ``upper``) and ``fuzzy`` (``edits``).

A clause is known by query, group, field, kind and clause_id; two rows must not
share all five.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.functions.text import Analysis, analyse
from litscope.operators.postings import term_bucket

TITLE, AUTHOR, VENUE = 0, 1, 2

CLAUSE_COLUMNS = (
    "query_id string, grp int, field string, occur string, clause_id int, kind string, "
    "text string, boost double, slop int, year_from int, year_to int, upper string, edits int"
)

# What a clause is known by; ``sub`` tells the words of an ``any`` clause apart.
IDENTITY = ["query_id", "grp", "field", "kind", "clause_id"]
CLAUSE = [*IDENTITY, "sub"]

# Groups are bits of one number.
MAX_GROUP = 63

PATTERNS = ("prefix", "wildcard", "regex", "range", "fuzzy")

# The words that link keyword clauses, in any letter case.
CONNECTORS = "(?i)( AND | OR | NOT |, )"


def _with_defaults(df: DataFrame) -> DataFrame:
    defaults = {
        "boost": F.lit(1.0), "slop": F.lit(0), "occur": F.lit("must"), "grp": F.lit(0), "clause_id": F.lit(0), "edits": F.lit(2),
    }
    columns = []
    for item in CLAUSE_COLUMNS.split(", "):
        name, kind = item.split(" ")
        default = defaults.get(name, F.lit(None))
        column = F.coalesce(F.col(name), default) if name in df.columns else default
        columns.append(column.cast(kind).alias(name))
    fitting = F.col("grp").between(0, MAX_GROUP)
    wrong = F.raise_error(F.concat(F.lit(f"groups are numbered 0 to {MAX_GROUP}, not "), F.col("grp").cast("string")))
    return df.select(*columns).withColumn("grp", F.when(fitting, F.col("grp")).otherwise(wrong.cast("int")))


def repeated(clauses: DataFrame) -> DataFrame:
    """Identities that more than one clause has."""
    return clauses.groupBy(*IDENTITY).agg(F.count("*").alias("n")).where("n > 1")


def clause_table(df: DataFrame) -> DataFrame:
    """A hand-made clause table with missing columns filled in."""
    return _with_defaults(df)


def keyword_clauses(queries: DataFrame, field: str = "title") -> DataFrame:
    """(query_id, text) -> clauses between AND / OR / NOT / commas.

    The link before a clause gives its role; the first clause is a must. A link
    eats its blanks, so in "a AND NOT b" the second clause is the must "NOT b",
    whose "not" is a stop word.
    """
    links = F.regexp_extract_all("text", F.lit(CONNECTORS), F.lit(1))
    split = queries.withColumn("_links", links).select(
        "*", F.posexplode(F.split("text", CONNECTORS, -1)).alias("clause_id", "_part")
    )
    link = F.upper(F.trim(F.get("_links", F.col("clause_id") - 1)))
    occur = (
        F.when(link.isin("OR", ","), "should").when(link == "NOT", "must_not").otherwise("must")
    )
    rows = split.withColumn("occur", occur).withColumn("text", F.col("_part"))
    return _with_defaults(
        rows.withColumns({"field": F.lit(field), "grp": F.lit(TITLE), "kind": F.lit("text")})
    )


def any_clauses(queries: DataFrame, field: str, group: int) -> DataFrame:
    """(query_id, text) -> any token may match."""
    return _with_defaults(
        queries.withColumns(
            {
                "field": F.lit(field),
                "grp": F.lit(group),
                "kind": F.lit("any"),
                "occur": F.lit("should"),
            }
        )
    )


def author_clauses(queries: DataFrame) -> DataFrame:
    return any_clauses(queries, "author", AUTHOR)


def venue_clauses(queries: DataFrame) -> DataFrame:
    """(query_id, text) -> raw key term, or any token of book title or journal.

    The key is compared with the text as it stands, without analysis.
    """
    places = F.array(
        F.struct(F.lit("key").alias("field"), F.lit("exact").alias("kind")),
        F.struct(F.lit("booktitle").alias("field"), F.lit("any").alias("kind")),
        F.struct(F.lit("journal").alias("field"), F.lit("any").alias("kind")),
    )
    rows = queries.select("*", F.inline(places))
    return _with_defaults(rows.withColumns({"grp": F.lit(VENUE), "occur": F.lit("should")}))


def clause_terms(clauses: DataFrame, analysis: Analysis, buckets: int, strict_gaps: bool = True) -> DataFrame:
    """One row per (clause, term): the term, its offset and the clause size.

    ``strict_gaps`` keeps the gap a stop word leaves inside a phrase; without it
    the terms close up, so "internet of things" asks for adjacent words.
    A clause left without terms yields no row (see ``empty_clauses``). Pattern
    clauses are not looked at.
    """
    analysed = analyse(clauses.where(~F.col("kind").isin(*PATTERNS)), "text", analysis)
    exact = F.array(F.struct(F.col("text").alias("term"), F.lit(0).alias("pos")))
    terms = F.when(F.col("kind") == "exact", exact).otherwise(F.col("terms"))
    rows = analysed.withColumn("terms", terms).select(
        "query_id", "grp", "clause_id", "occur", "kind", "field", "boost", "slop", "year_from", "year_to",
        F.size("terms").alias("size"),
        F.get("terms", F.lit(0)).pos.alias("first"),
        F.posexplode("terms").alias("at", "t"),
    )
    alone = F.col("kind") == "any"
    offset = F.col("t.pos") - F.col("first") if strict_gaps else F.col("at")
    return rows.select(
        *IDENTITY,
        F.when(alone, F.col("at")).otherwise(0).alias("sub"),
        "occur",
        term_bucket(F.col("t.term"), buckets).alias("bucket"),
        F.col("t.term").alias("term"),
        F.when(alone, 0).otherwise(offset).alias("off"),
        F.when(alone, 1).otherwise(F.col("size")).alias("size"),
        "boost", "slop", "year_from", "year_to",
        F.lit(False).alias("constant"),
    )


def pattern_rows(clauses: DataFrame) -> DataFrame:
    """Pattern clauses among the clause terms: one row each, without a term, so that a required one stays required."""
    return clauses.where(F.col("kind").isin(*PATTERNS)).select(
        *IDENTITY, F.lit(0).alias("sub"), "occur",
        F.lit(0).alias("bucket"), F.lit(None).cast("string").alias("term"),
        F.lit(0).alias("off"), F.lit(1).alias("size"), "boost", F.lit(0).alias("slop"),
        "year_from", "year_to",
        F.lit(True).alias("constant"),
    )


def empty_clauses(clauses: DataFrame, analysis: Analysis) -> DataFrame:
    """Clauses that analysis leaves without any term; searches ignore them."""
    rows = analyse(clauses, "text", analysis)
    return rows.where(~F.col("kind").isin("exact", *PATTERNS) & (F.size("terms") == 0)).drop("terms")


def requirements(rows: DataFrame) -> DataFrame:
    """What a document must meet per query: (query_id, musts, groups, year bounds).

    ``groups`` has one bit for each group that has no must clause of its own; such
    a group needs at least one of its optional clauses.
    """
    distinct = rows.select(*CLAUSE, "occur", "year_from", "year_to").distinct()
    per_group = distinct.groupBy("query_id", "grp").agg(
        F.count_if(F.col("occur") == "must").alias("musts"),
        F.max("year_from").alias("year_from"),
        F.max("year_to").alias("year_to"),
    )
    bit = F.when(F.col("musts") == 0, group_bit(F.col("grp"))).otherwise(F.lit(0).cast("long"))
    return per_group.groupBy("query_id").agg(
        F.sum("musts").alias("musts"),
        F.bit_or(bit).alias("groups"),
        F.max("year_from").alias("year_from"),
        F.max("year_to").alias("year_to"),
    )


def group_bit(group: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), group)
