"""The stored index: write it, open it, write hits.

Each build writes a folder of its own. A pointer, an empty file whose name has the
build's number and folder, is made last, so that an index is seen whole or not at
all: a build that fails leaves the one before it in use, and who has opened an index
goes on reading its folder while another is built. Old folders go when asked.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscope.functions.text import Analysis
from litscope.operators import postings as P
from litscope.schema import DEFAULT_FIELDS, LIST_FIELDS
from litscope.session import durable, scratch, shuffles_dropped

# A term bucket holds the terms of about this many words.
BUCKET_TOKENS = 20_000_000
MIN_BUCKETS = 8
# Postings of more than so many words are laid out in passes of some buckets each, up to
# so many: the shuffle of a pass goes before the next, which is most of a build's disk.
PASS_TOKENS, MAX_PASSES = 5_000_000, 4

POINTERS = "_versions"


@dataclass(frozen=True)
class Index:
    """Tables of one index, and how its text was analysed."""

    corpus: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    analysis: Analysis
    buckets: int

    @property
    def spark(self) -> SparkSession:
        return self.corpus.sparkSession


def build_index(
    corpus: DataFrame,
    path: str,
    fields: tuple[str, ...] = DEFAULT_FIELDS,
    analysis: Analysis = Analysis(),
    buckets: int | None = None,
    keep_corpus: bool = True,
    positions: bool = True,
) -> Index:
    """Write all tables into a new folder under ``path``, make it the current one, and open it.

    Text is analysed once, into an intermediate table; the others derive from it.
    Postings are laid out by (field, term bucket) and sorted by term, so a
    search reads a few partitions and row groups. The rebalance splits a term
    that fills far more than its share over several files. ``keep_corpus=False``
    goes on reading the records from where they are. Without ``positions`` postings
    are smaller, and there are no phrases.
    """
    spark = corpus.sparkSession
    # A name that is taken is an error of the first write.
    version = f"v-{uuid.uuid4().hex[:6]}"
    folder = f"{path}/{version}"
    if keep_corpus:
        # Year order inside each file lets a year range skip row groups.
        corpus.sortWithinPartitions("year", "doc_id").write.parquet(f"{folder}/corpus")
        corpus = spark.read.parquet(f"{folder}/corpus")
    doc_postings = P.document_postings(P.document_terms(corpus, list(fields), analysis))
    if not positions:
        slim = F.transform("postings", lambda p: F.struct(p.term.alias("term"), p.tf.alias("tf")))
        doc_postings = doc_postings.withColumn("postings", slim)
    with scratch(spark):
        buckets = _write_tables(spark, durable(doc_postings), folder, buckets)
    meta = {"analysis": asdict(analysis), "buckets": buckets}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{folder}/meta")
    _point_to(spark, path, version)
    return open_index(spark, path, None if keep_corpus else corpus, version)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, path: str) -> list[str]:
    """The folders of finished builds, the current one last."""
    files, place = _place(spark, f"{path}/{POINTERS}")
    found = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return [name.split(".", 1)[1] for name in sorted(n for n in found if n[:1].isdigit())]


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Of two builds that end at once, either is the current one, whole."""
    files, place = _place(spark, f"{path}/{POINTERS}")
    found = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    number = max((int(n.split(".", 1)[0]) for n in found if n[:1].isdigit()), default=0) + 1
    files, place = _place(spark, f"{path}/{POINTERS}/{number:012d}.{version}")
    files.create(place, False).close()


def drop_versions(spark: SparkSession, path: str, keep: int = 2, abandoned_hours: float = 24) -> None:
    """Remove all but the last ``keep`` builds, and what failed builds left that long ago.

    Readers of a build that goes must have ended.
    """
    kept = set(versions(spark, path)[-max(1, keep) :])
    files, place = _place(spark, f"{path}/{POINTERS}")
    for status in files.listStatus(place) if files.exists(place) else []:
        name = status.getPath().getName()
        if name[:1].isdigit() and name.split(".", 1)[1] not in kept:
            # The pointer goes first, so that nobody opens what is being removed.
            files.delete(status.getPath(), False)
            files.delete(_place(spark, f"{path}/{name.split('.', 1)[1]}")[1], True)
    pointed, oldest = set(versions(spark, path)), (time.time() - 3600 * abandoned_hours) * 1000
    for status in files.listStatus(_place(spark, path)[1]):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in pointed and status.getModificationTime() < oldest:
            files.delete(status.getPath(), True)


def _write_tables(spark: SparkSession, doc_postings: DataFrame, path: str, buckets: int | None) -> int:
    """Write statistics and postings; returns the number of term buckets."""
    P.field_stats(doc_postings).coalesce(1).write.parquet(f"{path}/field_stats")
    # One row per field.
    tokens = spark.read.parquet(f"{path}/field_stats").agg(F.sum("tokens")).first()[0] or 0
    if buckets is None:
        buckets = max(MIN_BUCKETS, tokens // BUCKET_TOKENS)
    passes = min(buckets, MAX_PASSES, 1 + tokens // PASS_TOKENS)
    tables = (
        ("postings", P.postings(doc_postings), ["field", "bucket", "term", "doc_id"], passes),
        ("term_stats", P.term_stats(doc_postings), ["field", "bucket", "term"], 1),
    )
    with shuffles_dropped(spark):
        for name, rows, order, times in tables:
            rows = rows.withColumn("bucket", P.term_bucket("term", buckets))
            for i in range(times):
                part = rows if times == 1 else rows.where(F.col("bucket") % times == i)
                part = part.hint("rebalance", "field", "bucket").sortWithinPartitions(*order)
                writer = part.write.option("compression", "zstd").mode("append" if i else "error")
                writer.partitionBy("field", "bucket").parquet(f"{path}/{name}")
    return buckets


def open_index(spark: SparkSession, path: str, corpus: DataFrame | None = None, version: str | None = None) -> Index:
    """The current build of an index, or the given one; ``path`` may also be a build's own folder.

    Later builds do not change what is open.
    """
    found = versions(spark, path)
    if version is None and found:
        version = found[-1]
    path = f"{path}/{version}" if version else path
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    settings = {k: tuple(v) if isinstance(v, list) else v for k, v in meta["analysis"].items()}
    return Index(
        corpus=corpus if corpus is not None else spark.read.parquet(f"{path}/corpus"),
        postings=spark.read.parquet(f"{path}/postings"),
        term_stats=spark.read.parquet(f"{path}/term_stats"),
        field_stats=spark.read.parquet(f"{path}/field_stats"),
        analysis=Analysis(**settings),
        buckets=meta["buckets"],
    )


def flat_records(records: DataFrame) -> DataFrame:
    """One value per field: of several, the last one. Authors stay a list."""
    lists = [f for f in LIST_FIELDS if f != "author" and f in records.columns]
    return records.withColumns({f: F.get(f, F.size(f) - 1) for f in lists})


def write_hits(hits: DataFrame, path: str) -> None:
    """One JSON object per line; a missing value leaves its key out."""
    hits.write.mode("overwrite").json(path)
