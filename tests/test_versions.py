"""A stored index is replaced as a whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from litscope.functions.text import Analysis
from litscope.plans.search import Library
from litscope.sources.store import build_index, drop_versions, open_index, versions


def corpus(spark, word, n=5):
    return spark.createDataFrame([(i, f"{word} number {i}", 2000) for i in range(n)], "doc_id bigint, title string, year int")


def build(spark, path, records):
    return build_index(records, path, fields=("title",), analysis=Analysis().plain(), buckets=2)


def found(index, word):
    return Library(index).by_keyword(word).count()


def test_a_failed_build_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "index")
    build(spark, path, corpus(spark, "old"))
    # The failure comes late, after tables of the new build were written.
    bad = corpus(spark, "new").withColumn("title", F.when(F.col("doc_id") < 4, F.col("title")).otherwise(F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        build_index(bad, path, fields=("title",), analysis=Analysis().plain(), buckets=2, keep_corpus=False)
    assert len(versions(spark, path)) == 1
    index = open_index(spark, path)
    assert found(index, "old") == 5 and found(index, "new") == 0 and index.corpus.count() == 5


def test_readers_keep_what_they_opened(spark, tmp_path):
    path = str(tmp_path / "index")
    build(spark, path, corpus(spark, "old"))
    reader = open_index(spark, path)
    build(spark, path, corpus(spark, "new", 3))
    assert found(reader, "old") == 5 and found(reader, "new") == 0
    now = open_index(spark, path)
    assert found(now, "old") == 0 and found(now, "new") == 3
    first, last = versions(spark, path)
    assert found(open_index(spark, path, version=first), "old") == 5
    assert found(open_index(spark, f"{path}/{last}"), "new") == 3


def test_old_builds_go_when_asked(spark, tmp_path):
    path = str(tmp_path / "index")
    for word in ("one", "two", "three"):
        build(spark, path, corpus(spark, word))
    left = tmp_path / "index" / "v-failed"
    left.mkdir()
    before = versions(spark, path)
    drop_versions(spark, path, keep=1)
    assert versions(spark, path) == before[-1:] and left.exists()
    assert found(open_index(spark, path), "three") == 5
    assert sorted(p.name for p in (tmp_path / "index").iterdir() if p.name.startswith("v-")) == sorted([before[-1], "v-failed"])
    drop_versions(spark, path, keep=1, abandoned_hours=-1)
    assert not left.exists() and found(open_index(spark, path), "three") == 5
