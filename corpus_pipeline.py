"""The training corpus, from documents to shards, in five stages.

Each stage works on all that the one before has kept and returns the columns of
``documents``; the last returns the shards. Stages are written as Parquet to the
cluster's shared folder and read again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscope.llm import language, minhash_forest, queries, tiling
from litscope.session import durable, ship_package
from litscope.sources.tables import read_table

# Least share of the best language in the answers of all languages.
LEAST_SCORE = 0.3


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, and those like no language in particular.

    Without a labelled document nothing can be told apart, so all texts go.
    """
    model = language.train(language.known_rows(docs))
    judged = language.classify(docs, model)
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(kept).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the least id, of each group of near-duplicates.

    Shingles of five words, similarity of 0.8. Rows that share an id stay or go
    together; rows without an id stay.
    """
    found = minhash_forest.near_duplicates(docs, size=5, percent=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose tiles cover half of a benchmark item or more."""
    named = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    hits = tiling.benchmark_hits(named, read_table(spark, sf_dir, "benchmark"))
    gone = durable(hits.select(F.col("id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"].cast("bigint").eqNullSafe(F.col("_gone")), "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents by the probabilities that meet the tempered marginals."""
    return queries.mixture(docs).where("m_sampled").select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) in eight shards of near-equal bytes."""
    return queries.sharded(docs, 8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_languages),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mix", mix),
    ("shard", shard),
]

# Kernels, MinHash and tiling have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracles() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
