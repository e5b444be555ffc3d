from __future__ import annotations

import pathlib

from pyspark.sql import functions as F

from litscope import session
from litscope.operators import clauses as C
from litscope.plans.search import search_clauses, with_records


def folders(spark):
    return {p.name for p in pathlib.Path(session.shared_folder(spark).removeprefix("file:")).glob("litscope-*")}


def test_durable_tables_are_written_and_go_with_their_scope(spark):
    frame = spark.range(30).withColumn("x", F.array(F.struct("id")))
    before = folders(spark)
    with session.scratch(spark):
        written = session.durable(frame)
        assert written.inputFiles() and sorted(map(str, written.collect())) == sorted(map(str, frame.collect()))
        assert len(folders(spark) - before) == 1
    assert folders(spark) == before


def test_a_search_leaves_nothing_behind(spark, library):
    before = folders(spark)
    with session.scratch(spark):
        assert library.by_keyword("things").collect()
        assert folders(spark) - before
    assert folders(spark) == before


def test_search_is_the_same_without_broadcasts(spark, library):
    texts = ["things", "neural network", "graph OR deep networks, thesis NOT practice"]
    queries = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "query_id string, text string")
    clauses = C.keyword_clauses(queries)

    def answer():
        hits = search_clauses(library.index, clauses)
        return sorted(map(str, with_records(hits, library.index.corpus).collect()))

    usual = answer()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert answer() == usual and len(usual) > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
