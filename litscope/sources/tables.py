"""Table views: present the given parquet tables as a corpus of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# A table of fewer splits than this is small enough to be dealt out anew.
FEW_SPLITS = 8


def spread(df: DataFrame, key: str) -> DataFrame:
    """Share a table of a few file splits over the cores before text work.

    A table of more splits is read as it is, however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < min(FEW_SPLITS, cores) else df


def documents_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as records: the whole text is the title, the source the venue.

    The table has no year and no authors, so both are derived from ``doc_id``.
    """
    doc_id = F.col("doc_id")
    authors = [F.concat(F.lit(p), (doc_id % m).cast("string")) for p, m in (("a", 37), ("b", 101))]
    return read_table(spark, folder, "documents").select(
        "doc_id",
        F.lit("article").alias("type"),
        F.concat(F.lit("conf/"), "source", F.lit("/D"), doc_id.cast("string")).alias("key"),
        F.col("text").alias("title"),
        F.col("source").alias("booktitle"),
        F.lit(None).cast("string").alias("journal"),
        (F.floor(doc_id / 20) % 5 + 2014).cast("int").alias("year"),
        F.array(*authors).alias("author"),
    )
