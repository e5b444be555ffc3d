"""Many topics against many phrases by token-set similarity, as a join.

Both sides are reduced to their sets of words first. A pair is a match in one of two
ways, and each has a lookup that loses none:

- it shares a word: an equality join on the words, cut by the lengths of what is
  shared and what is left before any letter is compared;
- it shares none: then the common subsequence of its letters must reach a share of
  both lengths that the threshold sets, so the lengths must be close, and the
  letters of both, in whatever order, must have so many in common. Blocks of phrases
  meet blocks of topics, and a block counts letters for all its pairs at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.functions.similarity import MATCH_THRESHOLD, token_set_ratio
from litscope.functions.text import candidate_phrases
from litscope.session import durable, rows_at_once, ship_package

# Phrases and topics of a block, and pairs of blocks that a task holds at once.
PHRASES, TOPICS, PAIRS = 4096, 256, 16
# Letters that fit one number in the comparison of many pairs at once.
SHORT = 63


def word_set(text: Column) -> Column:
    """The distinct words of a phrase in order, as the similarity sees them, joined by blanks."""
    kept = F.lower(F.regexp_replace(text, "[\\x{80}-\\x{ff}]", ""))
    words = F.split(F.trim(F.regexp_replace(kept, r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), " ")


def letter_share(threshold: int) -> float:
    """The least common subsequence of a match without shared words, as a share of both lengths together."""
    return (threshold - 0.5) / 200


def _rounds_to(ratio: Column, threshold: int) -> Column:
    """Whether a ratio may round to the threshold or above, halves to even."""
    return ratio >= threshold - 0.5 - 1e-9


@F.arrow_udf(T.IntegerType())
def _ratios(phrases, topics):
    return pa.array([token_set_ratio(a, b) for a, b in zip(phrases.to_pylist(), topics.to_pylist())], pa.int32())


def sharing_pairs(phrases: DataFrame, topics: DataFrame, threshold: int) -> DataFrame:
    """(phrase, topic, ratio) of pairs of word sets that share a word and reach the threshold."""
    listed = F.explode(F.split("phrase", " ")).alias("word")
    met = phrases.select("phrase", listed).join(topics.select("topic", F.explode(F.split("topic", " ")).alias("word")), "word")
    pairs = met.groupBy("phrase", "topic").agg(F.sum(F.length("word")).alias("letters"), F.count("*").alias("n"))
    shared = F.col("letters") + F.col("n") - 1
    words = {side: F.size(F.split(side, " ")) for side in ("phrase", "topic")}
    # What is left of a side: its other words and the blanks between them.
    rest = {side: F.when(words[side] == F.col("n"), 0).otherwise(F.length(side) - shared - 1) for side in words}
    joint = {side: shared + F.when(rest[side] > 0, rest[side] + 1).otherwise(0) for side in words}
    whole = (rest["phrase"] == 0) | (rest["topic"] == 0)
    alone = [100 - 100 * (1 + rest[s]) / (shared + joint[s]) for s in words]
    lengths = 2 * (shared + 1) + rest["phrase"] + rest["topic"]
    most = 100 - 100 * F.abs(rest["phrase"] - rest["topic"]) / lengths
    near = whole | _rounds_to(F.greatest(most, *alone), threshold)
    found = pairs.where(near).select("phrase", "topic", _ratios("phrase", "topic").alias("ratio"))
    return found.where(F.col("ratio") >= threshold)


def common_subsequences(a: list[str], b: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of a[left] and b[right], for many pairs in step.

    One bit stands for a letter of the first; those are up to SHORT letters long.
    """
    letters, codes = np.unique(np.frombuffer("".join([*a, *b]).encode("utf-32-le"), np.uint32), return_inverse=True)
    sizes_a, sizes_b = (np.array([len(w) for w in words], np.int64) for words in (a, b))
    masks = np.zeros((len(a), len(letters) + 1), np.uint64)
    owner = np.repeat(np.arange(len(a)), sizes_a)
    place = np.arange(sizes_a.sum()) - np.repeat(np.cumsum(sizes_a) - sizes_a, sizes_a)
    np.bitwise_or.at(masks, (owner, codes[: sizes_a.sum()]), np.uint64(1) << place.astype(np.uint64))
    # Places past a word's end hold a letter that nothing has.
    spelled = np.full((len(b), sizes_b.max(initial=0)), len(letters))
    owner = np.repeat(np.arange(len(b)), sizes_b)
    spelled[owner, np.arange(sizes_b.sum()) - np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_b)] = codes[sizes_a.sum() :]
    full = (np.uint64(1) << sizes_a[left].astype(np.uint64)) - np.uint64(1)
    row = full.copy()
    for j in range(sizes_b[right].max(initial=0)):
        hit = row & masks[left, spelled[right, j]]
        row = ((row + hit) | (row - hit)) & full
    return sizes_a[left] - np.bitwise_count(row).astype(np.int64)


def near_in_letters(phrases: list[str], topics: list[str], threshold: int) -> list[tuple[str, str, int]]:
    """(phrase, topic, ratio) of the pairs without a shared word that reach the threshold."""
    share = letter_share(threshold)
    letters, codes = np.unique(np.frombuffer("".join([*phrases, *topics]).encode("utf-32-le"), np.uint32), return_inverse=True)
    sizes = np.array([len(w) for w in [*phrases, *topics]], np.int64)
    counts = np.zeros((len(sizes), len(letters)), np.int16)
    np.add.at(counts, (np.repeat(np.arange(len(sizes)), sizes), codes), 1)
    n = len(phrases)
    order = np.argsort(sizes[:n], kind="stable")
    ordered, lengths = counts[:n][order], sizes[:n][order]
    left, right = [], []
    for t in range(len(topics)):
        size = sizes[n + t]
        first = np.searchsorted(lengths, math.floor(size * share / (1 - share) - 1e-9))
        last = np.searchsorted(lengths, math.ceil(size * (1 - share) / share + 1e-9), side="right")
        common = np.minimum(ordered[first:last], counts[n + t]).sum(axis=1)
        met = np.flatnonzero(common >= share * (lengths[first:last] + size) - 1e-9) + first
        left.append(order[met])
        right.append(np.full(len(met), t))
    left, right = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    long = sizes[left] > SHORT
    ratios = np.zeros(len(left))
    fits = np.flatnonzero(~long)
    if len(fits):
        # Words too long for one number are spelled in full only where they are compared.
        short = [w if len(w) <= SHORT else "" for w in phrases]
        lcs = common_subsequences(short, topics, left[fits], right[fits])
        both = sizes[left[fits]] + sizes[n + right[fits]]
        ratios[fits] = 100 - 100 * (both - 2 * lcs) / both
    out = []
    for k in np.flatnonzero(long | (ratios >= threshold - 0.5 - 1e-9)).tolist():
        phrase, topic = phrases[left[k]], topics[right[k]]
        if set(phrase.split(" ")).isdisjoint(topic.split(" ")):
            ratio = token_set_ratio(phrase, topic)
            if ratio >= threshold:
                out.append((phrase, topic, ratio))
    return out


def _blocks(df: DataFrame, column: str, size: int) -> DataFrame:
    """Rows of up to so many values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        for batch in batches:
            waiting += batch.column(0).to_pylist()
            while len(waiting) >= size:
                yield pa.RecordBatch.from_pydict({f"{column}s": [waiting[:size]]})
                waiting = waiting[size:]
        if waiting:
            yield pa.RecordBatch.from_pydict({f"{column}s": [waiting]})

    return df.select(column).mapInArrow(run, f"{column}s array<string>")


def disjoint_pairs(phrases: DataFrame, topics: DataFrame, threshold: int) -> DataFrame:
    """(phrase, topic, ratio) of pairs of word sets that share no word and reach the threshold.

    The topics are the queries: their blocks go to all groups of phrases.
    """
    groups = max(2 * phrases.sparkSession.sparkContext.defaultParallelism, phrases.count() // (8 * PHRASES))
    blocks = _blocks(phrases.repartition(groups), "phrase", PHRASES).withColumn("grp", F.pmod(F.spark_partition_id(), F.lit(groups)))
    asked = durable(_blocks(topics, "topic", TOPICS))
    spread = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = near_in_letters(row["phrases"], row["topics"], threshold)
                columns = list(zip(*found)) if found else [[], [], []]
                arrays = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["phrase", "topic", "ratio"])

    met = durable(blocks).join(spread, "grp").select("phrases", "topics")
    with rows_at_once(phrases.sparkSession, PAIRS):
        return durable(met.mapInArrow(run, "phrase string, topic string, ratio int"))


def topic_pairs(phrases: DataFrame, topics: DataFrame, threshold: int = MATCH_THRESHOLD) -> DataFrame:
    """(phrase, topic, ratio): every pair of a row of ``phrases`` and one of ``topics`` that matches.

    Texts of equal word sets are compared once. Nulls, and texts without a letter or
    digit, match nothing. A threshold is over 50: below it, pairs need have nothing
    in common that a lookup could start from.
    """
    if threshold <= 50:
        raise ValueError("the similarity join takes thresholds over 50")
    ship_package(phrases.sparkSession)
    sides = []
    for df, name in ((phrases, "phrase"), (topics, "topic")):
        rows = df.select(F.col(name).alias(f"{name}_text"), word_set(F.col(name)).alias(name)).where(F.col(name) != "").distinct()
        sides.append(durable(rows))
    wholes = [durable(rows.select(name).distinct()) for rows, name in zip(sides, ("phrase", "topic"))]
    found = sharing_pairs(*wholes, threshold).unionByName(disjoint_pairs(*wholes, threshold))
    out = durable(found).join(sides[0], "phrase").join(sides[1], "topic")
    return out.select(F.col("phrase_text").alias("phrase"), F.col("topic_text").alias("topic"), "ratio")


def topic_authors(
    records: DataFrame,
    topics: DataFrame,
    start: int | None = None,
    end: int | None = None,
    threshold: int = MATCH_THRESHOLD,
) -> DataFrame:
    """(topic, author, n) for a table of topics: how many phrases of an author's titles match.

    Phrases are counted by author before they meet the topics, so one that a third of
    all titles hold has a row for each of its authors and no more.
    """
    if start is not None:
        records = records.where(F.col("year").between(start, end or start))
    listed = records.select(F.explode(candidate_phrases(F.col("title"))).alias("phrase"), "author")
    counted = durable(listed.select("phrase", F.explode("author").alias("author")).groupBy("phrase", "author").agg(F.count("*").alias("n")))
    pairs = topic_pairs(counted.select("phrase").distinct(), topics, threshold)
    return pairs.join(counted, "phrase").groupBy("topic", "author").agg(F.sum("n").alias("n"))
