from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from litscope.llm.hard_negatives import exact_scores, mine_negatives, threshold_pairs


def brute(rows, positives=5, negatives=10, every=10):
    """All result rows, from all pairs in whole numbers."""
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(256 * x) >= 2**26 for x in v):
            continue
        usable[(i, label, tuple(math.floor(256 * x) for x in v))] = True
    usable = list(usable)
    out = []
    for a in usable:
        if a[0] % every:
            continue
        met = [(sum(x * y for x, y in zip(a[2], b[2])), b) for b in usable if b is not a and len(b[2]) == len(a[2])]
        met.sort(key=lambda m: (-m[0], m[1][0]))
        for score, b in [m for m in met if m[1][1] == a[1]][:positives]:
            window = [m for m in met if m[1][1] != a[1] and 30 * score <= 100 * m[0] <= 90 * score]
            out += [(a[0], b[0], k, n[0], score, s) for k, (s, n) in enumerate(window[:negatives], 1)]
    return sorted(out)


def check(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    found = mine_negatives(frame, F.col("vec_id") % 10 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute(rows, **options)
    assert sorted(map(tuple, found.collect())) == expected
    return expected


@pytest.mark.parametrize("labels", [1, 2, 7])
def test_random_vectors(spark, labels):
    rng = np.random.default_rng(labels)
    rows = [(i, rng.standard_normal(12).tolist(), int(rng.integers(labels))) for i in range(300)]
    # Copies, ties, and near rows under another label.
    rows += [(300 + i, rows[i][1], (rows[i][2] + i % 2) % 9) for i in range(80)]
    assert bool(check(spark, rows)) == (labels > 0)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.25], 2), (3, None, 1), (4, [1.0, nan], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 2),
        (7, [0.5, 0.5], None), (10, [], 1), (11, [], 1), (12, [], 2), (None, [1.0, 0.5], 2), (20, [0.0, 0.0], 3), (21, [0.0, 0.0], 3), (22, [0.0, 0.0], 4),
        (30, [-1.0, -1.0, 0.0], 5), (31, [1.0, 1.0, 0.0], 5), (32, [-0.5, -0.5, 0.0], 6), (40, [300000.0, 1.0], 1), (1, [1.0, 0.5], 1), (1, [0.7, 0.6], 2),
    ]
    check(spark, rows)
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int, rid string, dims int, win int")
    assert mine_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    lonely = spark.createDataFrame([(10, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    assert mine_negatives(lonely, F.col("vec_id") % 10 == 0).count() == 0


def test_thousands_of_copies(spark):
    rows = [(i, [1.0, 0.0, 0.25] if i % 3 == 0 else [1.0, i / 3000, -0.5], i % 2) for i in range(3000)]
    check(spark, [r for r in rows if r[0] % 10 or r[0] < 200])


def test_pairs_are_a_superset(spark):
    rng = np.random.default_rng(5)
    for spread in (0.0, 1.5):
        scale = np.exp(-spread * np.arange(40) / 8)
        rows = np.floor(rng.standard_normal((500, 40)) * 100 * scale).astype(np.int32)
        anchors = np.floor(rng.standard_normal((30, 40)) * 100 * scale).astype(np.int32)
        scores = anchors.astype(np.int64) @ rows.T.astype(np.int64)
        for share in (-0.5, 0.0, 0.3, 0.7, 1.2):
            thresholds = share * scores.max(axis=1)
            a, b = threshold_pairs(rows, anchors, thresholds)
            found = set(zip(a.tolist(), b.tolist()))
            wanted = set(zip(*(x.tolist() for x in np.nonzero(scores >= thresholds[:, None]))))
            assert wanted <= found and len(found) == len(a)
            assert (exact_scores(rows, anchors, a, b) == scores[a, b]).all()
            if share >= 0.7 and spread:
                assert len(found) < scores.size / 10  # remaining norms rule most pairs out
