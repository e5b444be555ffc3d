from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from litscope.llm.repeats import drop_repeats, exact_words, leftmost_least, window_hashes

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    """(n_words, spans, longest, kept) of every row, in order."""
    split = [SPACE.findall(t or "") for _, t in rows]
    repeats = {}
    size = length
    while any(len(w) >= size for w in split):
        counts = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
        repeats[size] = counts
        size *= 2
    out = []
    for (i, _), words in zip(rows, split):
        gone = set()
        for p in range(len(words) - length + 1):
            if repeats[length][tuple(words[p : p + length])] > 1:
                gone.update(range(p, p + length))
        starts = sorted(p for p in gone if p - 1 not in gone)
        ends = sorted(p + 1 for p in gone if p + 1 not in gone)
        reach = max((s for s in repeats if any(repeats[s][tuple(words[p : p + s])] > 1 for p in range(len(words) - s + 1))), default=0)
        out.append((i, len(words), len(gone), list(zip(starts, ends)), reach, " ".join(w for p, w in enumerate(words) if p not in gone)))
    return out


def check(spark, rows, length):
    expected = brute(rows, length)
    for beyond in (True, False):
        found = drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), length, beyond)
        assert found.columns == ["doc_id", "n_words", "n_removed", "spans", "longest", "kept"]
        result = [(r[0], r[1], r[2], [tuple(s) for s in r[3]], r[4], r[5]) for r in found.collect()]
        reached = [(*r[:4], r[4] if beyond else min(r[4], length), r[5]) for r in expected]
        assert sorted(result, key=repr) == sorted(reached, key=repr)


@pytest.mark.parametrize("length", [2, 3, 5, 8])
def test_random_texts(spark, length):
    rng = random.Random(length)
    passages = [" ".join(rng.choice("abcdef") + str(rng.randrange(3)) for _ in range(rng.randrange(3, 40))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(12)))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(6)))]
        rows.append((i, rng.choice([" ", "\t", " \n"]).join(parts)))
    check(spark, rows, length)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(5000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (4, "a b c"), (None, "a b c d"), (None, None), (5, "A b c"),
        (6, "z z z z z z z"), (7, long), (8, "q " + long + " r"), (9, "only here"), (10, "é é é é"), (11, "é é é é"), (12, "one\x0btwo\x0cthree"),
    ]
    check(spark, rows, 3)
    check(spark, rows, 35)
    check(spark, rows, 1)
    empty = spark.createDataFrame([], "doc_id string, text string, key_a int, copied int, places int, n_words int")
    assert drop_repeats(empty).count() == 0


def test_a_clean_table_loses_nothing(spark):
    rows = [(i, " ".join(f"{i}-{k}" for k in range(80))) for i in range(20)]
    check(spark, rows, 35)


def test_one_passage_in_all_texts(spark):
    line = " ".join(f"line{i}" for i in range(50))
    rows = [(i, f"{i} start {line} {i} end" if i % 3 else line) for i in range(90)]
    check(spark, rows, 35)


def test_hashes():
    words = exact_words("ab ba Ab ab a b")
    assert words[0] == words[3] and len(set(words.tolist())) == 5
    assert len(exact_words(None)) == 0
    values = np.array([5, 3, 3, 9, 1, 7, 1, 2], np.uint64)
    for width in range(1, 9):
        expected = [p + int(np.argmin(values[p : p + width])) for p in range(len(values) - width + 1)]
        assert leftmost_least(values, width).tolist() == expected
    assert len(window_hashes(words, 7, np.uint64(3))) == 0
