from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from litscope.llm.minhash_forest import _across, near_duplicates
from litscope.llm.shingles import shingle_set, word_hashes

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, size):
    found = words(text)
    if not found:
        return set()
    size = min(size, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def brute(rows, size, percent=80):
    """(number of shingles, component) by row, over all pairs that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < k).items():
            a, b = rows[k][0], rows[j][0]
            if None not in (a, b) and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted(((i, len(s), root(i) if i is not None else None) for (i, _), s in zip(rows, sets)), key=repr)


def check(spark, rows, size):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, region string")
    found = near_duplicates(frame, size=size).collect()
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == brute(rows, size)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\vTwo"), (8, "é É"), (9, "É é"), (10, "É É"),
        (11, "a b c d e f g h i j"), (12, "a b c d e f g h i k"), (13, "a b c d e f g h x y"), (14, long), (15, long + " end"),
        (15, long + " end"), (16, "same id"), (16, "other text here"), (17, "other text here"), (None, "one"), (None, None),
    ]
    check(spark, rows, 2)
    check(spark, rows, 5)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(empty).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert near_duplicates(empty).count() == 0


def test_groups_of_variants(spark):
    """A hub with variants at every distance, copies of it, and texts that only look alike."""
    pick = random.Random(5)
    base = [f"w{pick.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(160):
        text = list(base)
        for _ in range(pick.choice([0, 0, 1, 3, 6, 8, 9, 10, 12, 20])):
            text[pick.randrange(len(text))] = f"v{pick.randrange(900)}"
        rows.append((pick.randrange(10**9), " ".join(text)))
    for i in range(60):
        rows.append((10**9 + i, " ".join(f"w{pick.randrange(400)}" for _ in range(80))))
    check(spark, rows, 2)
    check(spark, rows, 5)


def test_query_against_brute_force(spark):
    from litscope.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op5_lsh_forest"](spark, folder).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == brute(rows, 2)


def test_hashed_words():
    text = "Ab c\tab  AB é\x0bÉ " + "z" * 5000
    hashes = word_hashes(text)
    assert len(hashes) == len(words(text))
    same = [[a == b for b in words(text)] for a in words(text)]
    assert (np.equal.outer(hashes, hashes) == np.array(same)).all()
    assert len(shingle_set(text, 2)) == len(shingles(text, 2))


def test_rows_of_a_group_follow_its_size(spark):
    """Variants that each share an extra with two others only are not all held against each other."""
    count, hub = 120, set(range(100))
    sets = {0: hub}
    for i in range(count):
        # 14 of the hub's shingles are missing, 14 are extra: under 0.8 to the hub, and near enough by what is extra somewhere.
        gone = {(7 * i + 3 * k) % 100 for k in range(14)}
        shared = {1000 + 20 * i + k for k in range(7)} | {1000 + 20 * ((i + 1) % count) + k for k in range(7)}
        sets[i + 1] = (hub - gone) | shared
    sets[count + 1] = set(sets[1]) - {1000}
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id bigint, shingles array<bigint>")
    places = spark.createDataFrame([(r, 0, i, i) for i in sets for r in (1, 2)], "region bigint, hub bigint, entity bigint, component bigint")
    found = {(r["a"], r["b"]) for r in _across(places, frame, 80).collect()}
    linked = {(a, b) for a in sets for b in sets if 0 < a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked and linked <= found
    assert len(found) < 6 * count


def test_variants_smaller_than_the_hub(spark):
    """Links that need no shingle beside the hub's, between texts that are not linked to it."""
    pick = random.Random(3)
    sets = {0: set(range(200))}
    for i in range(1, 90):
        kept = set(range(pick.choice([0, 0, 20, 40]), pick.choice([150, 155, 160, 200])))
        gone = set(pick.sample(sorted(kept), pick.choice([0, 2, 6, 12])))
        sets[i] = (kept - gone) | {1000 + pick.randrange(60) for _ in range(pick.choice([0, 0, 3, 8]))}
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id bigint, shingles array<bigint>")
    near = {i for i, s in sets.items() if 100 * len(s & sets[0]) >= 80 * len(s | sets[0])}
    parts = {i: 0 if i in near else i for i in sets}
    places = spark.createDataFrame([(1, 0, i, c) for i, c in parts.items()], "region bigint, hub bigint, entity bigint, component bigint")
    found = {(r["a"], r["b"]) for r in _across(places, frame, 80).collect()}
    linked = {
        (a, b) for a in sets for b in sets if a < b and parts[a] != parts[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    assert linked and linked <= found
