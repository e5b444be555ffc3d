"""Benchmark decontamination by greedy string tiling.

A document and a test item are candidates if they share a seed, a run of
``least`` words. Candidates are tiled: the longest common runs of words that are
still free in both are marked first, found by running Karp-Rabin hashes of falling
window lengths. The share of the item under tiles is the coverage, whatever order
the passages stand in.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.llm.shingles import distinct, runs, word_hashes
from litscope.session import ship_package

# Words of test items that the executors hold at once; a larger benchmark is met
# in several passes over the documents.
BLOCK_WORDS = 2_000_000

_HITS = "id bigint, item_id bigint, coverage double, tiles array<struct<doc_at:int,item_at:int,words:int>>"


def plain_words(text: Column) -> Column:
    """Small letters and digits, with single spaces for all else."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _windows(words: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and Karp-Rabin hashes of all windows of free words."""
    if len(words) < size:
        return np.empty(0, int), np.empty(0, np.uint64)
    sums = np.concatenate([[0], np.cumsum(free)])
    starts = np.flatnonzero(sums[size:] - sums[:-size] == size)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    powers = np.full(len(words) + 1, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    rolled = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[:-1], dtype=np.uint64, out=rolled[1:])
    # Moved to a common power, so that equal windows are equal numbers.
    return starts, (rolled[starts + size] - rolled[starts]) * powers[len(words) - starts]


def _matches(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(length, doc start, item start) of the maximal free matches of at least ``size`` words."""
    # Equal windows need a common power: both sides are hashed as one sequence.
    both, free = np.concatenate([doc, item]), np.concatenate([free_doc, free_item])
    starts, hashes = _windows(both, free, size)
    in_doc, in_item = starts + size <= len(doc), starts >= len(doc)
    order = np.argsort(hashes[in_item], kind="stable")
    item_at, item_hashes = starts[in_item][order] - len(doc), hashes[in_item][order]
    doc_at, doc_hashes = starts[in_doc], hashes[in_doc]
    lo, hi = np.searchsorted(item_hashes, doc_hashes), np.searchsorted(item_hashes, doc_hashes, "right")
    found = []
    for k in np.flatnonzero(hi > lo):
        i = int(doc_at[k])
        for j in item_at[lo[k] : hi[k]].tolist():
            if i and j and free_doc[i - 1] and free_item[j - 1] and doc[i - 1] == item[j - 1]:
                continue  # part of a match that starts earlier
            n = size
            while i + n < len(doc) and j + n < len(item) and free_doc[i + n] and free_item[j + n] and doc[i + n] == item[j + n]:
                n += 1
            found.append((n, i, j))
    return found


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (doc start, item start, words) of two sequences of word hashes.

    Longer tiles first; ties go to the earlier place in the document, then in the
    item. No word of either side is under two tiles.
    """
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles, size = [], max(least, min(len(doc), len(item)))
    while True:
        found = sorted(_matches(doc, item, free_doc, free_item, size), key=lambda m: (-m[0], m[1], m[2]))
        while found:
            n, i, j = found.pop(0)
            if free_doc[i : i + n].all() and free_item[j : j + n].all():
                free_doc[i : i + n] = free_item[j : j + n] = False
                tiles.append((i, j, n))
                continue
            # The free rest of a match that a longer tile has cut into.
            free = free_doc[i : i + n] & free_item[j : j + n]
            turns = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(int)))
            for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
                if b - a >= size:
                    found.append((b - a, i + a, j + a))
            found.sort(key=lambda m: (-m[0], m[1], m[2]))
        if size <= least:
            return tiles
        size = max(least, size // 2)


@dataclass
class _Block:
    """Some test items and an index of their seeds."""

    items: dict[int, np.ndarray]
    seeds: np.ndarray
    holders: dict[int, list[int]]


def _block(rows: list[tuple[int, str]], least: int) -> _Block:
    """Repeated item ids join their texts; items under ``least`` words are one seed."""
    texts = defaultdict(list)
    for item_id, text in rows:
        texts[item_id].append(word_hashes(text))
    items = {i: np.concatenate(parts) for i, parts in texts.items()}
    items = {i: words for i, words in items.items() if len(words)}
    holders = defaultdict(list)
    for i, words in items.items():
        for seed in distinct(runs(words, min(least, len(words)))).tolist():
            holders[seed].append(i)
    return _Block(items, np.array(sorted(holders), np.uint64), dict(holders))


def _near(words: np.ndarray, hit: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words under hit seeds, with a gap sign between stretches, and their places."""
    under = np.zeros(len(words) + 1, int)
    np.add.at(under, hit, 1)
    np.add.at(under, hit + size, -1)
    places = np.flatnonzero(np.cumsum(under)[:-1])
    gaps = np.flatnonzero(np.diff(places) > 1) + 1
    signs = np.arange(1, len(gaps) + 1, dtype=np.uint64)  # tiny numbers: no hashed word
    return np.insert(words[places], gaps, signs), np.insert(places, gaps, -1)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5) -> DataFrame:
    """(id, item_id, coverage, tiles) of documents and items with enough coverage.

    ``docs`` has id and text, ``benchmark`` item_id and text. Words are runs of
    letters and digits in lower case; tiles count in words. An item of fewer than
    ``least`` words is met only as a whole. Null and empty texts meet nothing; items
    without an id are ignored, and items that share an id are one item.
    """
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), plain_words(F.col("text")).alias("text"))
    words = items.agg(F.coalesce(F.sum(F.size(F.split("text", " "))), F.lit(0)).alias("n")).first()["n"]
    blocks = 1 + words // BLOCK_WORDS
    texts = docs.select("id", plain_words(F.col("text")).alias("text"))
    parts = [_hits(texts, items, k, blocks, least, coverage) for k in range(blocks)]
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    return hits


def _hits(texts: DataFrame, items: DataFrame, k: int, blocks: int, least: int, coverage: float) -> DataFrame:
    """Hits of one block of items; about BLOCK_WORDS words reach the driver at once."""
    rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).dropna().collect()
    held = texts.sparkSession.sparkContext.broadcast(_block([(r["item_id"], r["text"]) for r in rows], least))
    sizes = sorted({min(least, len(w)) for w in held.value.items.values()})

    def candidates(words: np.ndarray, block: _Block) -> Iterator[tuple[int, np.ndarray, int]]:
        """Items that share a seed, the places of the seeds and their size."""
        for size in sizes:
            hashes = runs(words, size)
            at = np.searchsorted(block.seeds, hashes)
            at[at == len(block.seeds)] = 0
            hit = np.flatnonzero(block.seeds[at] == hashes) if len(block.seeds) else np.empty(0, int)
            by_item = defaultdict(list)
            for place in hit.tolist():
                for i in block.holders[int(hashes[place])]:
                    by_item[i].append(place)
            for i, places in by_item.items():
                if min(least, len(block.items[i])) == size:
                    yield i, np.array(places), size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        for batch in batches:
            found = []
            for identity, text in zip(batch.column("id"), batch.column("text")):
                words = word_hashes(text.as_py())
                for i, places, size in candidates(words, block):
                    near, original = _near(words, places, size)
                    tiles = tile(near, block.items[i], size)
                    share = sum(n for _, _, n in tiles) / len(block.items[i])
                    if share >= coverage:
                        spans = [{"doc_at": int(original[a]), "item_at": b, "words": n} for a, b, n in tiles]
                        found.append((identity.as_py(), i, share, spans))
            columns = list(zip(*found)) if found else [[]] * 4
            span = pa.struct([("doc_at", pa.int32()), ("item_at", pa.int32()), ("words", pa.int32())])
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(span))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "item_id", "coverage", "tiles"])

    return texts.mapInArrow(run, _HITS)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with contaminated, item_ids (sorted), best_coverage and n_tiles.

    A document is contaminated if tiles cover at least ``coverage`` of an item. Rows
    that share an id share the answer, those with a null id too. Without hits,
    item_ids is empty and the numbers are 0. Columns of these names give way.
    """
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    hits = benchmark_hits(texts, benchmark, least, coverage)
    best = hits.groupBy(F.col("id").alias("_id")).agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        F.max("coverage").alias("best_coverage"),
        F.max(F.size("tiles")).cast("bigint").alias("n_tiles"),
    )
    out = ["contaminated", "item_ids", "best_coverage", "n_tiles"]
    rest = docs.select(*(c for c in docs.columns if c not in out))
    joined = rest.join(best, rest[id_column].cast("bigint").eqNullSafe(best["_id"]), "left")
    return joined.select(
        *(rest[c] for c in rest.columns),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("best_coverage", F.lit(0.0)).alias("best_coverage"),
        F.coalesce("n_tiles", F.lit(0)).cast("bigint").alias("n_tiles"),
    )
