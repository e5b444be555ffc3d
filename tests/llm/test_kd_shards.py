from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from litscope.llm.kd_shards import kd_shards
from litscope.llm.queries import QUERIES, sharded

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clashes") for r in rows], SCHEMA)


def check(rows, found, shards):
    """Sizes, checksums and gapless slots; returns the bytes of each shard."""
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"] or 0) for r in found) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32(t.encode()) if t is not None else 0) for i, t, *_ in rows
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in found:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_near_equal_bytes_with_a_hot_group(spark):
    pick = random.Random(1)
    rows = [(i, "y" * pick.randrange(400) + str(i), pick.choice(["en", "fr", None]), f"src{i % 20 if i % 3 else 0}", pick.randrange(500)) for i in range(2500)]
    rows += [(10_000 + i, "the same text " * 20, "en", "src0", 280) for i in range(900)]
    rows += [(20_000 + i, "twice or so", "en", "src1", 11) for i in range(3)]
    found = sharded(frame(spark, rows), 8).collect()
    sizes = check(rows, found, 8)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes.values()) < 0.04 * mean
    assert len({r["shard"] for r in found if 20_000 <= r["doc_id"]}) == 1


@pytest.mark.parametrize("shards", [1, 3, 5])
def test_any_number_of_shards(spark, shards):
    rows = [(i, "z" * (i % 90), "en", "src1", i) for i in range(800)]
    sizes = check(rows, sharded(frame(spark, rows), shards).collect(), shards)
    mean = sum(sizes.values()) / shards
    assert len(sizes) == shards and max(abs(s - mean) for s in sizes.values()) < 0.06 * mean


def test_target_bytes(spark):
    rows = [(i, "z" * 99, "en", "src1", i) for i in range(400)]
    found = kd_shards(frame(spark, rows), {"n": F.col("n_chars")}, target_bytes=5000).collect()
    sizes = check(rows, found, 8)
    assert len(sizes) == 8 and max(sizes.values()) < 6000


def test_edges(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "x", -5), (None, "é", "", "src", 2**40), (3, "w" * 200_000, "en", "src1", 1), (3, "w" * 200_000, "en", "src1", 1)]
    check(rows, sharded(frame(spark, rows), 8).collect(), 8)
    assert sharded(frame(spark, rows).limit(0), 8).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op7_kd_sharding"](spark, folder)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    sizes = check(rows, found.collect(), 8)
    largest = max(len(t.encode()) for _, t in rows if t)
    mean = sum(sizes.values()) / 8
    assert all(abs(s - mean) < 2.5 * largest for s in sizes.values())
