from __future__ import annotations

import random

from pyspark.sql import functions as F

from litscope.llm import tiling
from litscope.llm.queries import QUERIES
from litscope.llm.shingles import word_hashes


def brute(doc, item, least):
    """Greedy string tiling, word by word."""
    used_d, used_i, tiles = set(), set(), []
    while True:
        best = None
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and a + n not in used_d and b + n not in used_i:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return tiles
        a, b, n = best
        used_d |= set(range(a, a + n))
        used_i |= set(range(b, b + n))
        tiles.append(best)


def covered(tiles):
    return sum(n for _, _, n in tiles)


def test_tiles_are_greedy():
    pick = random.Random(2)
    for _ in range(150):
        item = [pick.choice("abcde") for _ in range(pick.randrange(3, 25))]
        doc = [pick.choice("abcdef") for _ in range(pick.randrange(0, 15))]
        for _ in range(pick.randrange(3)):
            k = pick.randrange(len(item))
            doc += item[k : k + pick.randrange(2, 15)]
        found = tiling.tile(word_hashes(" ".join(doc)), word_hashes(" ".join(item)), 3)
        assert all(doc[a : a + n] == item[b : b + n] for a, b, n in found)
        for side in (0, 1):
            places = [p for t in found for p in range(t[side], t[side] + t[2])]
            assert len(places) == len(set(places))
        expected = brute(doc, item, 3)
        assert max((n for _, _, n in found), default=0) == max((n for _, _, n in expected), default=0)
        assert abs(covered(found) - covered(expected)) <= 3


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def test_edges(spark):
    words = ITEM.split()
    turned = " ".join(words[8:] + ["stop"] + words[:8])
    rows = [
        (1, f"before {ITEM} after"), (2, turned.upper().replace(" ", ", ")), (3, " ".join(words[:6])), (4, None), (5, ""),
        (6, "filler " * 30_000 + ITEM), (7, ITEM), (7, ITEM), (None, ITEM), (8, "tiny item"), (9, "a tiny item here"), (10, " ".join(reversed(words))),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, item_ids string")
    items = [(1, ITEM), (2, None), (3, ""), (None, ITEM), (4, "Tiny item!"), (4, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = tiling.contaminated(docs, benchmark).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert {i for i, r in by_id.items() if r["contaminated"]} == {1, 2, 6, 7, None, 8, 9}
    assert by_id[2]["best_coverage"] == 1.0 and by_id[2]["n_tiles"] == 2 and by_id[8]["item_ids"] == [4]
    assert (by_id[4]["item_ids"], by_id[4]["best_coverage"], by_id[4]["n_tiles"]) == ([], 0.0, 0)
    assert tiling.contaminated(docs.limit(0), benchmark).count() == 0
    assert not any(r["contaminated"] for r in tiling.contaminated(docs, benchmark.limit(0)).collect())


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    usual = sorted(map(str, QUERIES["op6_string_tiling"](spark, folder).collect()))
    monkeypatch.setattr(tiling, "BLOCK_WORDS", 400)
    assert sorted(map(str, QUERIES["op6_string_tiling"](spark, folder).collect())) == usual


def test_query_against_brute_force(spark):
    """A text of more than half an item in one run must be found, and no clean one."""
    folder = "/root/testdata/sf0.001"
    clean = tiling.plain_words
    items = {r[0]: r[1].split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", clean(F.col("text"))).collect()}
    texts = {r[0]: r[1].split() for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", clean(F.col("text"))).collect()}
    found = {r["doc_id"]: r["item_ids"] for r in QUERIES["op6_string_tiling"](spark, folder).collect()}
    assert found.keys() == texts.keys()
    for i, words in texts.items():
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item, asked in items.items():
            under = {p for k in range(len(asked) - 4) if tuple(asked[k : k + 5]) in grams for p in range(k, k + 5)}
            whole = f" {' '.join(asked)} " in f" {' '.join(words)} "
            assert not whole or item in found[i]
            # Tiles never cover more than the shared runs do.
            assert item not in found[i] or len(under) >= 0.5 * len(asked)
