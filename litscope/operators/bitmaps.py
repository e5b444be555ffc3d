"""Documents that hold all required words, by bitmaps of documents.

A frequent term's documents are bitmaps, one for each run of 2^15 document ids: one
bit instead of a posting. A run that holds few of them is a list of places in it, two
bytes for each, as long as that is shorter: most terms are rare in most runs. Where a query requires several words, the bitmaps of its
rarest one choose the runs, those of the others are intersected with them, and only
the postings of documents that are left are scored. Rare terms have no stored
bitmaps; theirs are made from their few postings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.operators.clauses import CLAUSE, PATTERNS, clause_terms, repeated, requirements
from litscope.operators.matching import _part, document_scores, pruned, term_matches, weighted_terms
from litscope.session import durable, handed_out
from litscope.sources.store import Index

# How frequent a term is to have stored bitmaps.
LEAST_DF = 256
# Frequent terms, each of some 50 bytes, up to which all tasks get them.
HANDED_OUT = 200_000
# Documents of one bitmap, as Spark's bitmap functions have it.
RUN = 1 << 15
# Bytes of a bitmap. What is shorter is a list of places.
WIDTH = RUN // 8


@dataclass(frozen=True)
class Bitmaps:
    """Bitmaps of frequent terms, and from how many documents on a term has them."""

    table: DataFrame
    least_df: int


def _bitmap() -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position("doc_id")).alias("bits")


def _gathered(rows: DataFrame) -> DataFrame:
    """(field, bucket, term, run, places) of adjacent rows with (field, bucket, term, run, place).

    Postings lie in order of term and document, so nothing is sorted or hashed, and a
    task holds one Arrow batch. A run of a term may come in several rows.
    """
    key = ["field", "bucket", "term", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            turns = np.zeros(batch.num_rows - 1, bool)
            for name in key:
                column = batch.column(name)
                values = (column.dictionary_encode().indices if pa.types.is_string(column.type) else column).to_numpy()
                turns |= values[1:] != values[:-1]
            starts = np.append(0, np.flatnonzero(turns) + 1)
            places = batch.column("place").to_numpy().astype("<u2")
            bounds = (np.append(starts, len(places)) * places.itemsize).astype(np.int32)
            held = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(places)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(starts)) for c in key), held], names=[*key, "places"])

    return rows.mapInArrow(run, "field string, bucket int, term string, run bigint, places binary")


@F.arrow_udf(T.BinaryType())
def _packed(pieces):
    """Lists of places of one run, as one list or bitmap, whichever is shorter."""
    found = []
    for parts in pieces.to_pylist():
        places = np.unique(np.frombuffer(b"".join(parts), "<u2"))
        found.append(places.tobytes() if places.nbytes < WIDTH else _bits_of(places))
    return pa.array(found, pa.binary())


def _bits_of(places: np.ndarray) -> bytes:
    bits = np.zeros(RUN, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _places_of(held: bytes) -> np.ndarray:
    if len(held) < WIDTH:
        return np.frombuffer(held, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little"))


@F.arrow_udf(T.BinaryType())
def _unpacked(bits):
    """Bitmaps, of lists of places as well."""
    return pa.array([h if len(h) == WIDTH else _bits_of(_places_of(h)) for h in bits.to_pylist()], pa.binary())


def term_bitmaps(index: Index, least_df: int = LEAST_DF) -> DataFrame:
    """(field, bucket, term, run, bits) of terms in ``least_df`` documents or more."""
    frequent = index.term_stats.where(F.col("df") >= least_df).select("field", "bucket", "term")
    rows = index.postings.where("doc_id IS NOT NULL").join(handed_out(frequent, HANDED_OUT), ["field", "bucket", "term"], "left_semi")
    run, place = F.bitmap_bucket_number("doc_id").alias("run"), F.bitmap_bit_position("doc_id").alias("place")
    pieces = _gathered(rows.select("field", F.col("bucket").cast("int").alias("bucket"), "term", run, place))
    return pieces.groupBy("field", "bucket", "term", "run").agg(F.collect_list("places").alias("pieces")).withColumn("bits", _packed("pieces")).drop("pieces")


def write_bitmaps(index: Index, path: str, least_df: int = LEAST_DF) -> Bitmaps:
    """Store the bitmaps like postings: by field and bucket, sorted by term."""
    rows = term_bitmaps(index, least_df).hint("rebalance", "field", "bucket").sortWithinPartitions("field", "bucket", "term", "run")
    rows.write.mode("overwrite").partitionBy("field", "bucket").parquet(path)
    return Bitmaps(index.spark.read.schema(rows.schema).parquet(path), least_df)


@F.arrow_udf(T.ArrayType(T.LongType()))
def documents_in(run, bits):
    """The document ids of a bitmap: ids from 1 on count up from their run, others down."""
    found = []
    for number, held in zip(run.to_pylist(), bits.to_pylist()):
        places = _places_of(held)
        found.append((number - 1) * RUN + places + 1 if number > 0 else number * RUN - places)
    return pa.array(found, pa.list_(pa.int64()))


def required_documents(index: Index, bitmaps: Bitmaps, weighted: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, doc_id) of documents that hold every required word of a query.

    Queries that require nothing have no rows here. A required word that is in no
    document leaves its query without any.
    """
    key = ["field", "bucket", "term"]
    needed = terms.where("occur = 'must'").groupBy("query_id").agg(F.countDistinct(*CLAUSE).alias("needed"))
    musts = weighted.where("occur = 'must'")
    musts = musts.join(pruned(index.term_stats, musts).select(*key, "df"), key)
    musts = durable(musts.join(needed, "query_id").withColumn("stored", F.col("df") >= bitmaps.least_df))
    stored, rare = musts.where("stored").drop("stored"), musts.where("NOT stored").drop("stored")
    columns = ["query_id", "needed", *CLAUSE[1:], "df", "run", "bits"]
    known = pruned(bitmaps.table, stored).join(stored, key).select(*columns)
    run = F.bitmap_bucket_number("doc_id").alias("run")
    # One row of ``weighted`` per word: its postings become a bitmap for each run.
    made = term_matches(index, rare.drop("df", "needed")).groupBy(*CLAUSE, run).agg(_bitmap())
    made = made.join(rare.select(*CLAUSE, "df", "needed"), CLAUSE).select(*columns)
    # The rarest word of a query says which runs matter.
    rarest = musts.groupBy("query_id").agg(F.min(F.struct("df", *CLAUSE[1:])).alias("lead")).select("query_id", "lead.*")
    lead_rare = made.join(rarest, [*CLAUSE, "df"], "left_semi").select("query_id", "run")
    lead_known = known.join(rarest, [*CLAUSE, "df"], "left_semi").select("query_id", "run")
    runs = durable(lead_rare.unionByName(lead_known).distinct())
    rows = known.unionByName(made).join(runs, ["query_id", "run"], "left_semi").withColumn("bits", _unpacked("bits"))
    met = rows.groupBy("query_id", "needed", "run").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    met = met.where((F.col("n") == F.col("needed")) & (F.bitmap_count("bits") > 0))
    return met.select("query_id", F.explode(documents_in("run", "bits")).alias("doc_id"))


def conjunction_hits(index: Index, bitmaps: Bitmaps, clauses: DataFrame, strict_gaps: bool = True) -> DataFrame:
    """Hits of queries that require words: (query_id, doc_id, score).

    Other roles, groups, years and boosts hold as in any search. Every query must
    require a word, and clauses are single words: phrases, patterns and queries
    without a required word are an error, and for ``answer_clauses``.
    """
    clauses = durable(clauses)
    twice = repeated(clauses).limit(1).collect()
    if twice:
        raise ValueError(f"two clauses share {twice[0].asDict()}: give them clause_ids of their own")
    if not clauses.where(F.col("kind").isin(*PATTERNS)).isEmpty():
        raise ValueError("a conjunction takes no patterns")
    terms = durable(clause_terms(clauses, index.analysis, index.buckets, strict_gaps))
    musts = F.count_if(F.col("occur") == "must")
    wrong = terms.groupBy("query_id").agg(musts.alias("musts"), F.max("size").alias("size")).where("musts = 0 OR size > 1")
    if not wrong.isEmpty():
        raise ValueError("a conjunction takes clauses of single words, and requires one of them")
    weighted = durable(weighted_terms(index, terms))
    chosen = durable(required_documents(index, bitmaps, weighted, terms))
    rows = term_matches(index, weighted).join(chosen, ["query_id", "doc_id"], "left_semi")
    hits = rows.select("query_id", "doc_id", "grp", "occur", _part(F.col("tf")).alias("part"))
    return document_scores(hits, requirements(terms))
