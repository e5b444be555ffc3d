from __future__ import annotations

import pathlib
import re
import sys
import zlib

from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent))

import corpus_pipeline as P  # noqa: E402
from litscope.llm.queries import QUERIES  # noqa: E402
from litscope.llm.tiling import plain_words  # noqa: E402
from test_minhash import brute  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def stages():
    return dict(P.STAGES)


def test_every_stage_against_its_operator(spark):
    """Each stage keeps the rows that brute force or its operator's own answer keeps, unchanged."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    kept = stages()["language"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    after = {r["doc_id"]: r for r in kept.collect()}
    assert all(rows[i] == r for i, r in after.items())
    assert {i for i in rows if i not in after} <= {i for i, r in rows.items() if len(re.findall(r"[^\W\d_]", r["text"] or "")) < 20}

    single = {r["doc_id"] for r in stages()["near_copies"](spark, docs, FOLDER).collect()}
    expected = {i for i, _, c in brute([(i, r["text"]) for i, r in rows.items()], 5) if i == c}
    assert single == expected and len(single) < len(rows)

    clean = {r["doc_id"] for r in stages()["benchmark"](spark, docs, FOLDER).collect()}
    items = [r[0] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select(plain_words(F.col("text"))).collect()]
    texts = {r[0]: f" {r[1]} " for r in docs.select("doc_id", plain_words(F.col("text"))).collect()}
    leaked = {i for i, t in texts.items() if any(f" {item} " in t for item in items)}
    assert leaked and not leaked & clean
    hit = {r["doc_id"] for r in QUERIES["op6_string_tiling"](spark, FOLDER).collect() if r["contaminated"]}
    assert clean == set(rows) - hit

    mixed = {r["doc_id"] for r in stages()["mix"](spark, docs, FOLDER).collect()}
    assert mixed == {r["doc_id"] for r in QUERIES["op3_ipf_mixing"](spark, FOLDER).collect() if r["sampled"]}

    shards = stages()["shard"](spark, docs, FOLDER).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in shards} == {
        (i, len(r["text"].encode()) + 1, zlib.crc32(r["text"].encode())) for i, r in rows.items()
    }


def test_run_chains_the_stages(spark):
    found = P.run(spark, FOLDER)
    assert found.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    rows = found.collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0 < len(rows) < docs and len({r["doc_id"] for r in rows}) == len(rows)


def test_stages_on_edges(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, shard string, item_ids string"
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c d e f", None, "s", 11), (3, "a b c d e f", None, "s", 11),
        (None, "a b c d e f", "en", None, 11), (4, "12 !?", "de", "s", 5), (5, "der Hund und das Haus " * 20_000, "de", "s", None), (6, "the dog and the house", "en", "t", 21),
    ]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, frame, FOLDER)
            found = out.collect()
            assert name == "shard" or out.columns == docs.columns
            assert len(found) <= frame.count()
    assert len(stages()["near_copies"](spark, docs, FOLDER).where("doc_id = 3").collect()) == 2
