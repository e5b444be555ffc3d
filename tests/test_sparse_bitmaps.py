"""Runs of few documents are stored as places, and mean the same as bitmaps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from litscope.functions.text import Analysis
from litscope.operators import bitmaps as M
from litscope.sources.store import build_index


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    # "all" is in 4,681 documents of the three inner runs, "some" in every fiftieth; ids come twice, and below zero.
    every = spark.range(-40_000, 70_000, 7).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "all some").otherwise("all").alias("title"))
    rows = every.unionByName(every.where("doc_id % 100 = 0")).withColumn("year", F.lit(2000))
    path = str(tmp_path_factory.mktemp("sparse") / "index")
    return build_index(rows, path, fields=("title",), analysis=Analysis().plain(), buckets=2, keep_corpus=False, positions=False)


def test_few_documents_take_few_bytes(index):
    table = {(r["term"], r["run"]): r["bits"] for r in M.term_bitmaps(index, 50).collect()}
    assert all(len(bits) <= M.WIDTH for bits in table.values())
    assert {run for (term, run), bits in table.items() if term == "all" and len(bits) == M.WIDTH} == {0, 1, 2}
    assert max(len(bits) for (term, _), bits in table.items() if term == "some") <= 2 * 100


def test_places_and_bitmaps_hold_the_same(index):
    expected = index.postings.groupBy("term", F.bitmap_bucket_number("doc_id").alias("run")).agg(M._bitmap())
    expected = {(r["term"], r["run"]): (bytes(r["bits"]), r["ids"]) for r in expected.withColumn("ids", M.documents_in("run", "bits")).collect()}
    found = M.term_bitmaps(index, 50).withColumn("ids", M.documents_in("run", "bits")).withColumn("whole", M._unpacked("bits"))
    assert {(r["term"], r["run"]): (bytes(r["whole"]), sorted(r["ids"])) for r in found.collect()} == {k: (b, sorted(i)) for k, (b, i) in expected.items()}
