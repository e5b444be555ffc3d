"""Top k of ranked searches without scoring every posting.

A bound of a term in a block of neighbouring documents is the most that one posting
of the block adds per unit of weight. Bounds of frequent terms are a table of the
index; rare terms have few postings, so theirs are taken from these. A search then

1. adds up, for each query and block, what its terms add at most,
2. scores the most promising blocks, which gives each query a k-th score,
3. drops the blocks that cannot reach it,
4. lists documents only by the terms without which it cannot be reached, and
5. scores what is left.

Nothing that could be among the first k is dropped, so the result is that of scoring
all. A query of fewer than k documents in its promising blocks keeps all blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litscope.operators.clauses import CLAUSE, PATTERNS, clause_terms, repeated, requirements
from litscope.operators.matching import K1, B, _part, document_scores, pruned, term_matches, weighted_terms
from litscope.operators.ranking import top_k
from litscope.session import durable, handed_out
from litscope.sources.store import Index

# Documents of a block, as a power of two. Stored bounds are for terms that are in two
# documents of a block or more on average, and in so many at least: others have hardly
# more postings than blocks.
BITS = 4
LEAST_DF = 128
# Frequent terms, each of some 50 bytes, up to which all tasks get them.
HANDED_OUT = 200_000
# Blocks scored first, for each query.
FIRST = 128
# Scores are rounded to 9 digits, and added up in any order.
SLACK = 1e-6


@dataclass(frozen=True)
class Bounds:
    """Bounds of frequent terms, and what they were made with."""

    table: DataFrame
    bits: int
    least_df: int


def block_of(doc_id: Column, bits: int) -> Column:
    return F.shiftright(doc_id, bits)


def least_frequency(index: Index, bits: int = BITS) -> int:
    docs = index.field_stats.agg(F.max("docs")).first()[0] or 0
    return max(LEAST_DF, (2 * docs) >> bits)


def term_bounds(index: Index, bits: int, least_df: int) -> DataFrame:
    """(field, bucket, term, block, docs, bound) of terms in ``least_df`` documents or more.

    Postings lie in order of term and document, so a task adds up a block before
    anything moves.
    """
    frequent = index.term_stats.where(F.col("df") >= least_df).select("field", "bucket", "term")
    rows = index.postings.join(handed_out(frequent, HANDED_OUT), ["field", "bucket", "term"], "left_semi").join(F.broadcast(index.field_stats), "field")
    norm = K1 * (1 - B + B * F.col("length") / F.col("mean_length"))
    rows = rows.withColumn("part", F.col("tf") / (F.col("tf") + norm)).withColumn("block", block_of(F.col("doc_id"), bits))
    return rows.groupBy("field", "bucket", "term", "block").agg(F.count("*").alias("docs"), F.max("part").alias("bound"))


def write_bounds(index: Index, path: str, bits: int = BITS, least_df: int | None = None) -> Bounds:
    """Store the bounds like postings: by field and bucket, sorted by term."""
    least_df = least_frequency(index, bits) if least_df is None else least_df
    rows = term_bounds(index, bits, least_df).hint("rebalance", "field", "bucket").sortWithinPartitions("field", "bucket", "term", "block")
    rows.write.mode("overwrite").partitionBy("field", "bucket").parquet(path)
    return open_bounds(index.spark, path, rows.schema, bits, least_df)


def open_bounds(spark: SparkSession, path: str, schema, bits: int, least_df: int) -> Bounds:
    """``schema`` tells the columns of a table without rows."""
    return Bounds(spark.read.schema(schema).parquet(path), bits, least_df)


def clause_blocks(index: Index, bounds: Bounds, weighted: DataFrame) -> DataFrame:
    """(CLAUSE, block, most): what each clause adds at most to a document of a block."""
    asked = weighted.where(F.col("occur") != "must_not")
    terms = ["field", "bucket", "term"]
    stats = pruned(index.term_stats, asked).select(*terms, "df")
    asked = durable(asked.join(stats, terms).withColumn("stored", F.col("df") >= bounds.least_df).drop("df"))
    stored, rare = asked.where("stored").drop("stored"), asked.where("NOT stored").drop("stored")
    known = pruned(bounds.table, stored).join(stored, terms).select(*CLAUSE, "block", (F.col("weight") * F.col("bound")).alias("most"))
    rows = term_matches(index, rare).withColumn("block", block_of(F.col("doc_id"), bounds.bits))
    found = rows.groupBy(*CLAUSE, "block").agg(F.max(_part(F.col("tf"))).alias("most"))
    return known.unionByName(found)


def _scored(rows: DataFrame, terms: DataFrame) -> DataFrame:
    return document_scores(rows.select("query_id", "doc_id", "grp", "occur", _part(F.col("tf")).alias("part")), requirements(terms))


def candidates(index: Index, bounds: Bounds, terms: DataFrame, weighted: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id) of all documents that may be among a query's first k."""
    by_clause = durable(clause_blocks(index, bounds, weighted))
    # A year range adds 1 to every hit of its query.
    fixed = terms.groupBy("query_id").agg(F.max(F.when(F.col("year_from").isNotNull(), 1.0).otherwise(0.0)).alias("fixed"))
    by_block = by_clause.groupBy("query_id", "block").agg(F.sum("most").alias("most")).join(fixed, "query_id")
    by_block = durable(by_block.select("query_id", "block", (F.col("most") + F.col("fixed")).alias("most"), "fixed"))

    first = durable(top_k(by_block, ["query_id"], [F.col("most").desc(), F.col("block").asc()], FIRST).select("query_id", "block"))
    rows = term_matches(index, weighted).withColumn("block", block_of(F.col("doc_id"), bounds.bits))
    best = top_k(_scored(rows.join(first, ["query_id", "block"], "left_semi"), terms), ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], k)
    reached = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = durable(reached.where(F.col("n") == k).select("query_id", (F.col("least") - SLACK).alias("least")))

    # Without k documents yet, nothing is ruled out.
    least = F.coalesce("least", F.lit(float("-inf")))
    open_blocks = durable(by_block.join(reached, "query_id", "left").where(F.col("most") >= least).select("query_id", "block", "fixed", least.alias("least")))
    left = by_clause.join(open_blocks, ["query_id", "block"])
    # The weakest clauses that together stay under the k-th score list nothing by themselves.
    by_most = Window.partitionBy("query_id").orderBy("best", *CLAUSE[1:])
    leading = left.groupBy(*CLAUSE).agg(F.max("most").alias("best"), F.first("fixed").alias("fixed"), F.first("least").alias("least"))
    leading = leading.withColumn("upto", F.sum("best").over(by_most) + F.col("fixed"))
    leading = durable(leading.select(*CLAUSE, (F.col("upto") >= F.col("least")).alias("lists")))
    rest = left.join(leading.where("NOT lists"), CLAUSE).groupBy("query_id", "block").agg(F.sum("most").alias("rest"))
    open_blocks = durable(open_blocks.join(rest, ["query_id", "block"], "left").fillna(0.0, ["rest"]))

    listing = durable(weighted.join(leading.where("lists"), CLAUSE, "left_semi"))
    rows = term_matches(index, listing).withColumn("block", block_of(F.col("doc_id"), bounds.bits))
    rows = rows.withColumn("part", _part(F.col("tf"))).select("query_id", "doc_id", "block", "part").join(open_blocks, ["query_id", "block"])
    listed = rows.groupBy("query_id", "doc_id").agg(
        F.sum("part").alias("part"), F.first("rest").alias("rest"), F.first("fixed").alias("fixed"), F.first("least").alias("least")
    )
    return durable(listed.where(F.col("part") + F.col("rest") + F.col("fixed") >= F.col("least")).select("query_id", "doc_id"))


def best_hits(index: Index, bounds: Bounds, clauses: DataFrame, k: int, strict_gaps: bool = True) -> DataFrame:
    """Hits of clauses of single words: (query_id, doc_id, score), the first k of each query among them.

    Clauses may be required, optional or excluding, in groups, with years and
    boosts. Phrases and patterns are for ``answer_clauses``; here they are an error.
    """
    clauses = durable(clauses)
    twice = repeated(clauses).limit(1).collect()
    if twice:
        raise ValueError(f"two clauses share {twice[0].asDict()}: give them clause_ids of their own")
    if not clauses.where(F.col("kind").isin(*PATTERNS)).isEmpty():
        raise ValueError("bounded search takes no patterns")
    terms = durable(clause_terms(clauses, index.analysis, index.buckets, strict_gaps))
    if not terms.where("size > 1").isEmpty():
        raise ValueError("bounded search takes clauses of single words, no phrases")
    weighted = durable(weighted_terms(index, terms))
    chosen = candidates(index, bounds, terms, weighted, k)
    return _scored(term_matches(index, weighted).join(chosen, ["query_id", "doc_id"], "left_semi"), terms)
