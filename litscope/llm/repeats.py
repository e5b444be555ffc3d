"""Removing passages that occur more than once, by doubling the length of repeated windows.

A window is a run of adjacent words of one document. Windows of half the asked
length come first, then the asked length, then twice that, and so on: a window is
looked at only where the windows it is made of repeat, until none is left. What is
removed depends on the asked length alone; longer ones tell how far the repeats reach,
and can be left out.

At half the length, not every window has to travel. Each window of the full length
is represented by the least hash among the half windows inside it (its anchor). Equal
windows have equal anchors, and neighbours mostly share one, so about a tenth of the
half windows stand for all: where an anchor occurs once, no window above it repeats.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litscope.llm.shingles import mix, word_bounds
from litscope.session import durable, scratch, ship_package

# Multipliers of two independent window hashes, and what tells levels apart.
_STEPS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15))
_LEVEL = np.uint64(0xA0761D6478BD642F)

KEYS = ["key_a", "key_b"]


def exact_words(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word of a text, letter case kept; null counts as empty."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(lengths.sum()) - np.repeat(first, lengths)
    letters = data[np.repeat(starts, lengths) + within]
    # Each letter at its place is one random number; a word is their sum.
    placed = mix((within.astype(np.uint64) << np.uint64(8)) + letters + _LEVEL)
    return mix(np.add.reduceat(placed, first) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, size: int, step: np.uint64) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * step + words[i : i + count]
    return mix(total)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, the place of its least one, the first of equals."""
    best, size = np.arange(len(values)), 1
    while size * 2 <= width:
        left, right = best[: len(best) - size], best[size:]
        best, size = np.where(values[right] < values[left], right, left), size * 2
    count = len(values) - width + 1
    left, right = best[:count], best[width - size : width - size + count]
    return np.where(values[right] < values[left], right, left)


def _anchors(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the anchors, and each window's anchor value. ``words`` has a window."""
    half = (length + 1) // 2
    values = window_hashes(words, half, _STEPS[0])
    least = leftmost_least(values, length - half + 1)
    return least[np.concatenate([[True], least[1:] != least[:-1]])], values[least]


def _anchor_rows(length: int):
    schema = pa.schema([("key_a", pa.int64()), ("key_b", pa.int64()), ("anchors", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = [], []
            for i, text in enumerate(batch.column("text")):
                words = exact_words(text.as_py())
                if len(words) >= length:
                    places, _ = _anchors(words, length)
                    half = (length + 1) // 2
                    values, n = np.unique(window_hashes(words, half, _STEPS[0])[places], return_counts=True)
                    rows.append(i)
                    # Twice is all that matters about a count.
                    lists.append(np.repeat(values, np.minimum(n, 2)).view(np.int64))
            keys = [batch.column(k).take(pa.array(rows, pa.int64())) for k in KEYS]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(lists, pa.list_(pa.int64()))], schema=schema)

    return run


def _window_rows(length: int):
    """The windows whose anchor is wanted, as (place, two hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, wanted in zip(batch.column("text"), batch.column("anchors")):
                words = exact_words(text.as_py())
                _, values = _anchors(words, length)
                places = np.flatnonzero(np.isin(values.view(np.int64), wanted.values.to_numpy(zero_copy_only=False)))
                found.append((places.astype(np.int32), *(window_hashes(words, length, s)[places].view(np.int64) for s in _STEPS)))
            yield _level_batch(batch, [*KEYS, "copied"], found)

    return run


def _longer_rows(length: int):
    """Windows of twice ``length`` words, made of two windows that both repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], []
            for i, windows in enumerate(batch.column("windows")):
                places, a, b = (windows.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                order = np.argsort(places)
                places, hashes = places[order], (a[order], b[order])
                later = np.minimum(np.searchsorted(places, places + length), len(places) - 1)
                whole = np.flatnonzero(places[later] == places + length)
                if len(whole):
                    rows.append(i)
                    joint = (mix(mix(h.view(np.uint64)[whole] + _LEVEL) * s + h.view(np.uint64)[later[whole]]).view(np.int64) for h, s in zip(hashes, _STEPS))
                    found.append((places[whole], *joint))
            yield _level_batch(batch.take(pa.array(rows, pa.int64())), ["number", "copied"], found)

    return run


_LISTS = "places array<int>, a array<bigint>, b array<bigint>"


def _level_batch(batch: pa.RecordBatch, kept: list[str], found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64())
    lists = [pa.array([f[k] for f in found], pa.list_(kind)) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *lists], names=[*kept, "places", "a", "b"])


def _windows(level: DataFrame) -> DataFrame:
    windows = level.select("number", "copied", F.explode(F.arrays_zip("places", "a", "b")).alias("w"))
    return windows.select("number", "copied", F.col("w.places").alias("place"), F.col("w.a").alias("a"), F.col("w.b").alias("b"))


def _shared(level: DataFrame) -> DataFrame:
    """The windows that occur again, one of them in a text that occurs once.

    Counts add up in each task before they move.
    """
    counted = _windows(level).groupBy("a", "b").agg(F.sum(F.when(F.col("copied"), 2).otherwise(1)).alias("n"), F.bool_or(~F.col("copied")).alias("open"))
    shared = durable(counted.where("n > 1 AND open").select("a", "b"))
    _release(shared)
    return shared


def _repeated_places(level: DataFrame) -> DataFrame:
    """(number, places) of windows that occur again, of texts that occur once.

    The rows of a frequent window meet its one count in a join, which Spark may split.
    """
    with scratch(level.sparkSession):
        met = _windows(level).where("NOT copied").select("number", "place", "a", "b").join(_shared(level), ["a", "b"])
        return durable(met.groupBy("number").agg(F.collect_list("place").alias("places")), outlive=True)


def _repeated(level: DataFrame) -> DataFrame:
    """(number, copied, windows) that occur again, to make longer ones of."""
    with scratch(level.sparkSession):
        met = _windows(level).join(_shared(level), ["a", "b"])
        return durable(met.groupBy("number", "copied").agg(F.collect_list(F.struct("place", "a", "b")).alias("windows")), outlive=True)


def _release(df: DataFrame) -> None:
    """Let Spark remove the shuffle files of finished steps, which it does as their plans are collected."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def _repeats(keyed: DataFrame, length: int, beyond: bool) -> DataFrame:
    """(keys, copied, places, longest) of the texts with a window that repeats.

    A text that occurs in several rows repeats whole; it has no places. Without
    ``beyond``, longest is null.
    """
    anchors = durable(keyed.mapInArrow(_anchor_rows(length), "key_a bigint, key_b bigint, anchors array<bigint>"))
    texts = durable(anchors.groupBy(*KEYS).agg(F.count("*").alias("copies"), F.first("anchors").alias("anchors")))
    texts = texts.select(*KEYS, (F.col("copies") > 1).alias("copied"), F.explode("anchors").alias("anchor"))
    counted = texts.groupBy("anchor").agg(F.sum(F.when(F.col("copied"), 2).otherwise(1)).alias("n"), F.bool_or(~F.col("copied")).alias("open"))
    shared = durable(counted.where("n > 1 AND open").select("anchor"))
    wanted = durable(texts.join(shared, "anchor").groupBy(*KEYS, "copied").agg(F.collect_set("anchor").alias("anchors")))
    _release(wanted)

    # One row stands for the copies of a text: the one with the least id.
    least = keyed.groupBy(*KEYS).agg(F.min("id").alias("least"))
    chosen = wanted.join(least, KEYS).withColumnsRenamed({k: f"w_{k}" for k in KEYS})
    same = (F.col("key_a") == F.col("w_key_a")) & (F.col("key_b") == F.col("w_key_b")) & F.col("id").eqNullSafe(F.col("least"))
    met = keyed.join(durable(chosen), same).select(*KEYS, "text", "copied", "anchors")
    level = met.mapInArrow(_window_rows(length), f"key_a bigint, key_b bigint, copied boolean, {_LISTS}")
    # Windows travel with a number, which is fixed as it is written; it is shorter than the text's keys.
    level = durable(level.withColumn("number", F.monotonically_increasing_id()))
    _release(level)
    whole = anchors.groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1")
    whole = whole.select(*KEYS, F.lit(True).alias("copied"), F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("int").alias("longest"))
    part = _reach(level, length) if beyond else _repeated_places(level).withColumn("longest", F.lit(None).cast("int"))
    part = level.select("number", *KEYS).join(part, "number")
    return whole.unionByName(part.select(*KEYS, F.lit(False).alias("copied"), "places", "longest"))


def _reach(level: DataFrame, length: int) -> DataFrame:
    """The same as ``_repeated_places``, with the largest doubling at which a window of the text still repeats."""
    found, size = _repeated(level), length
    places = found.where("NOT copied").select("number", F.col("windows.place").alias("places"))
    longest = places.select("number", F.lit(size).alias("longest"))
    while True:
        level = durable(found.mapInArrow(_longer_rows(size), f"number bigint, copied boolean, {_LISTS}"))
        if level.isEmpty():
            break
        found, size = _repeated(level), size * 2
        longest = longest.unionByName(found.where("NOT copied").select("number", F.lit(size).alias("longest")))
        _release(level)
    return places.join(longest.groupBy("number").agg(F.max("longest").alias("longest")), "number")


_OUT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("longest", pa.int32()),
        ("kept", pa.string()),
    ]
)
_OUT_SCHEMA = "n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>, longest int, kept string"


def _cut(length: int, beyond: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, copied, places, longest in zip(*(batch.column(c) for c in ("text", "copied", "places", "longest"))):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n, reach = len(words), longest.as_py() or 0
                spans = []
                if copied.as_py():
                    spans, reach = [(0, n)], length
                    while beyond and reach * 2 <= n:
                        reach *= 2
                elif places.is_valid:
                    starts = np.sort(places.values.to_numpy(zero_copy_only=False))
                    cuts = np.flatnonzero(np.diff(starts) > length) + 1
                    first = starts[np.concatenate([[0], cuts]).astype(np.int64)]
                    last = starts[np.concatenate([cuts - 1, [len(starts) - 1]]).astype(np.int64)] + length
                    spans, reach = list(zip(first.tolist(), last.tolist())), max(reach, length)
                kept, at = [], 0
                for start, end in spans:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                rows.append((n, n - len(kept), [{"start": s, "end": e} for s, e in spans], reach, b" ".join(kept).decode("utf-8", "surrogatepass")))
            columns = zip(*rows) if rows else [[] for _ in _OUT]
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, _OUT)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names=["id", *_OUT.names])

    return run


def drop_repeats(
    docs: DataFrame, length: int = 35, beyond: bool = True, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, spans, longest, kept) for every row of ``docs``.

    Words are runs of anything but space and tab to carriage return, as they stand.
    Every word of a window of ``length`` words that also starts elsewhere, in any
    row or further on in the same one, is removed. ``spans`` are the removed runs
    of words (end exclusive), ``kept`` the other words joined by one space, and
    ``longest`` the largest doubling of ``length`` at which a window still repeats
    (0: none does). Without ``beyond`` the search ends at ``length`` itself.

    A null text has no words, like an empty one; neither repeats. Rows with equal
    texts repeat each other, whatever their ids: repeated rows, and rows without an
    id, are rows like any other. A text under ``length`` words loses nothing. Texts
    are read whole, however long. No rows give no rows; other columns are not
    looked at, whatever their names.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    keyed = rows.select("id", "text", F.xxhash64("text").alias("key_a"), F.xxhash64(F.lit("text"), "text").alias("key_b"))
    with scratch(spark):
        found = durable(_repeats(keyed.where(F.col("text").isNotNull()), length, beyond), outlive=True)
    _release(found)
    marked = keyed.join(found, KEYS, "left").select("id", "text", "copied", "places", "longest")
    out = marked.mapInArrow(_cut(length, beyond), f"id {rows.schema['id'].dataType.simpleString()}, {_OUT_SCHEMA}")
    return out.withColumnRenamed("id", id_column)
