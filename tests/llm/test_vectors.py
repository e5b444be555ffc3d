from __future__ import annotations

import math
from collections import defaultdict

import numpy as np

from litscope.llm.components import components
from litscope.llm.embedding_pairs import near_vectors


def brute(rows, cosine):
    """(n_links, component) by id, over all pairs."""
    usable = {
        i: (label, np.array(v, float))
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    links, parent = defaultdict(set), {i: i for i, _, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(usable)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (la, va), (lb, vb) = usable[a], usable[b]
            if la == lb and len(va) == len(vb) and va @ vb / np.sqrt((va @ va) * (vb @ vb)) >= cosine:
                links[a].add(b)
                links[b].add(a)
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(links[i]), root(i)) for i in parent}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, [1.0, 0.0, 0.0], 1), (3, [2.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 2),
        (5, [1.0, 0.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1), (9, [1.0, nan, 0.0], 1),
        (10, [inf, 0.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.1], 1), (13, [1.0, 0.1, 0.0], 1), (14, [1.0, 0.3, 0.0], 1),
        (15, [3e38, 3e38, 3e38], 3), (16, [1.0, 1.0, 1.0], 3), (17, [1e-40, 1e-40, 1e-40], 3),
    ]
    every = rows + [rows[0], (None, [1.0, 0.0, 0.0], 1)]
    frame = spark.createDataFrame([(*r, "x") for r in every], "vec_id bigint, embedding array<float>, label int, entity string")
    found = near_vectors(frame)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    result = found.collect()
    assert len(result) == len(every)
    expected = brute(rows, 0.98)
    for r in result:
        if r["vec_id"] is None:
            assert tuple(r) == (None, 0, None, True)
        else:
            n, component = expected[r["vec_id"]]
            assert tuple(r) == (r["vec_id"], n, component, component == r["vec_id"])
    assert near_vectors(frame.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    from litscope.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected = brute(rows, 0.98)
    result = QUERIES["op1_pigeonhole_vectors"](spark, folder).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result} == expected and len(result) == len(rows)


def test_groups_against_brute_force(spark):
    random = np.random.default_rng(3)
    rows = []
    for i in range(400):
        centre = np.random.default_rng(i % 25).standard_normal(20)
        spread = random.choice([0.0, 0.1, 0.2, 0.22])
        rows.append((i, (centre + spread * random.standard_normal(20)).astype(np.float32).tolist(), i % 3))
    expected = brute(rows, 0.98)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    for width in (3, 8, 20):
        found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame, width=width).collect()}
        assert found == expected
    assert sum(n for n, _ in expected.values()) > 100


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 0, -1)] + [(200, 300), (300, 200), (7, 7), (None, 3), (500, 400)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {i: 1 for i in range(1, 102)} | {200: 200, 300: 200, 500: 400, 400: 400}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
