from __future__ import annotations

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from litscope.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, lang string, m_tokens string"


def dimensions():
    return {"source": F.col("source"), "lang": F.col("lang")}


def docs(spark, rows):
    return spark.createDataFrame([(*r, "clashes") for r in rows], SCHEMA)


def test_marginals_are_met(spark):
    rows = [(i, "word " * (1 + i % 7), f"s{i % 3 if i % 5 else 0}", ["en", "fr"][i % 4 == 0]) for i in range(300)]
    targets = {
        "source": spark.createDataFrame([("s0", 0.2), ("s1", 0.5), ("s2", 0.3), ("absent", 5.0)], "value string, share double"),
        "lang": spark.createDataFrame([("en", 3.0), ("fr", 1.0)], "value string, share double"),
    }
    found = mixing.mix_sources(docs(spark, rows), dimensions(), targets, rounds=20).collect()
    total = sum(r["m_tokens"] for r in found)
    for name, shares in (("m_source", {"s0": 0.2, "s1": 0.5, "s2": 0.3}), ("m_lang", {"en": 0.75, "fr": 0.25})):
        sums = defaultdict(float)
        for r in found:
            sums[r[name]] += r["m_tokens"] * r["m_weight"] / total
        assert sums == pytest.approx(shares, abs=1e-6)
    top = max(r["m_weight"] for r in found)
    assert all(math.isclose(r["m_probability"], r["m_weight"] / top) for r in found)
    kept = sum(r["m_sampled"] for r in found)
    expected = sum(r["m_probability"] for r in found)
    assert abs(kept - expected) < 4 * math.sqrt(expected)


def test_edges(spark):
    rows = [
        (1, "a b c", None, "en"), (2, None, "s", "en"), (3, "", "s", "en"), (4, " \t", "s", None), (5, "x", "s", None),
        (6, "a\x0bb\x0cc", "t", "en"), (None, "q", "t", "en"), (7, "x " * 100_000, "t", "fr"), (7, "x " * 100_000, "t", "fr"),
    ]
    found = mixing.mix_sources(docs(spark, rows), dimensions()).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["m_source"] == mixing.MISSING and by_id[5]["m_lang"] == mixing.MISSING
    assert [by_id[i]["m_tokens"] for i in (1, 2, 3, 4, 5, 6, 7)] == [3, 0, 0, 0, 1, 3, 100_000]
    for i in (2, 3, 4):
        assert (by_id[i]["m_weight"], by_id[i]["m_probability"], by_id[i]["m_sampled"]) == (0.0, 0.0, False)
    assert max(r["m_probability"] for r in found) == pytest.approx(1.0)
    assert mixing.mix_sources(docs(spark, rows).limit(0), dimensions()).count() == 0
    none = {"source": spark.createDataFrame([("s", None), ("t", -1.0)], "value string, share double")}
    assert not any(r["m_sampled"] for r in mixing.mix_sources(docs(spark, rows), dimensions(), none).collect())


def test_no_python_on_the_executors(spark):
    plan = mixing.mix_sources(docs(spark, [(1, "a", "s", "en")]), dimensions())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
