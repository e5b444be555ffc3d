"""Many phrases at once, in one pass over the texts.

A posting join reads the documents of each phrase's words; with as many phrases as a
corpus has, that is every common word again and again. Here each run of words of a
text is looked up among the phrases instead, and no posting list of a common word is
read at all. Texts are analysed once. Runs that no phrase can be are left out as soon as they are
hashed, by bits of the phrases' hashes, and of the rest a text's equal runs are one row. What
is left meets the phrases in one shuffle, in which it is also counted and cut to the
best; texts of phrases are put to it last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.functions.text import Analysis, analyse, held
from litscope.operators.matching import K1, SCORE_DIGITS, B
from litscope.operators.postings import document_terms
from litscope.operators.ranking import top_k
from litscope.session import durable, rows_at_once, shuffles_dropped

HASHES = ["key_a", "key_b"]

# Bits that tell which hashes may be a phrase's, kept as numbers of 64: so many, or with
# many phrases as many as leave few others, up to a size that every worker has room for.
# With more phrases than that they leave less out, and the join decides all the same.
BITS, MOST_BITS, BITS_PER_PHRASE = 1 << 27, 1 << 30, 12
# Numbers of 64 bits that the driver takes over at once.
AT_ONCE = 1 << 21
# Rows of an Arrow batch of hashed texts.
ROWS = 1000


RUNS = T.ArrayType(T.StructType([T.StructField("key_a", T.LongType()), T.StructField("key_b", T.LongType()), T.StructField("tf", T.IntegerType())]))

# Words of texts that are worked on at once; a longer text is worked on alone.
WORDS = 1 << 19

_STEP, _PLACE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(terms: Column) -> list[Column]:
    """Two hashes of every word."""
    return [F.transform(terms, lambda t: F.xxhash64(t.term)), F.transform(terms, lambda t: F.xxhash64(F.lit("run"), t.term))]


def _with_word(key: np.ndarray, words: np.ndarray, off: np.ndarray | int) -> np.ndarray:
    """A run's hash with one more word, so far from its first."""
    x = key * _STEP + words + (np.asarray(off, np.int64).astype(np.uint64) + np.uint64(1)) * _PLACE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _flat(lists: pa.Array, kind: type) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind)


@F.arrow_udf(T.StructType([T.StructField("key_a", T.LongType()), T.StructField("key_b", T.LongType())]))
def _phrase_hashes(hashes_a, hashes_b, offs):
    """128 bits of the words of each phrase and the distances between them."""
    off, sizes = _flat(offs, np.int64), pc.list_value_length(offs).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    keys = []
    for hashes in (hashes_a, hashes_b):
        words, key = _flat(hashes, np.uint64), sizes.astype(np.uint64)
        for j in range(sizes.max(initial=0)):
            rows = np.flatnonzero(sizes > j)
            key[rows] = _with_word(key[rows], words[begins[rows] + j], off[begins[rows] + j])
        keys.append(pa.array(key.view(np.int64)))
    return pa.StructArray.from_arrays(keys, names=["key_a", "key_b"])


def _places(key: np.ndarray, size: int) -> list[np.ndarray]:
    """Three bits of a hash, of ``size`` that are a power of two."""
    last = np.uint64(size - 1)
    mixed = (key ^ (key >> np.uint64(29))) * _STEP
    return [key & last, (key >> np.uint64(30)) & last, (mixed >> np.uint64(32)) & last]


def _bit_places(size: int):
    """A phrase's bits, as numbers of 64 and one bit of each."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("number", T.IntegerType()), T.StructField("bit", T.LongType())])))
    def places(keys):
        place = np.stack(_places(keys.to_numpy(zero_copy_only=False).view(np.uint64), size), axis=1).ravel()
        number, bit = (place >> np.uint64(6)).astype(np.int32), (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
        structs = pa.StructArray.from_arrays([pa.array(number), pa.array(bit)], names=["number", "bit"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * 3), structs)

    return places


def phrase_bits(keys: DataFrame) -> np.ndarray:
    """The bits of all phrases, as numbers of 64."""
    size = BITS
    while size < min(MOST_BITS, BITS_PER_PHRASE * keys.count()):
        size *= 2
    set_bits = keys.select(F.inline(_bit_places(size)("key_a"))).groupBy("number").agg(F.bit_or("bit").alias("bits"))
    set_bits = durable(set_bits)
    bits = np.zeros(size // 64, np.uint64)
    for start in range(0, len(bits), AT_ONCE):
        part = set_bits.where(F.col("number").between(start, start + AT_ONCE - 1)).toArrow()
        bits[part["number"].to_numpy()] = part["bits"].to_numpy().view(np.uint64)
    return bits


def _held(key: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The places of the hashes whose bits are all set."""
    left = np.arange(len(key))
    for j in range(3):
        place = _places(key[left], 64 * len(bits))[j]
        left = left[(bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0]
    return left


def _text_runs(shapes: list[list[int]], bits=None):
    """The distinct runs of a text that have one of the shapes, hashed as phrases are, and how often each occurs.

    A run has a word at each place of the shape; between them may stand anything, as
    a stop word's place in a phrase is open. With ``bits``, a broadcast of
    ``phrase_bits``, runs that no phrase can be are left out.
    """

    def runs_of(hashes_a: pa.Array, hashes_b: pa.Array, places: pa.Array, sizes: np.ndarray) -> tuple[pa.StructArray, np.ndarray]:
        words = [_flat(h, np.uint64) for h in (hashes_a, hashes_b)]
        row = np.repeat(np.arange(len(sizes)), sizes)
        # Rows stand so far apart that no shape reaches the next one.
        place = _flat(places, np.int64) + row * (1 << 33)
        found = [(row[:0], *(w[:0] for w in words))]
        for shape in shapes:
            first, at = np.arange(len(place)), []
            for off in shape:
                here = np.searchsorted(place, place[first] + off)
                held = here < len(place)
                held[held] = place[here[held]] == place[first[held]] + off
                first, at = first[held], [a[held] for a in at] + [here[held]]
            keys = []
            for w in words:
                key = np.full(len(first), len(shape), np.uint64)
                for off, here in zip(shape, at):
                    key = _with_word(key, w[here], off)
                keys.append(key)
                if bits is not None and len(keys) == 1:
                    left = _held(key, bits.value)
                    keys, first, at = [key[left]], first[left], [a[left] for a in at]
            found.append((row[first], *keys))
        row, key_a, key_b = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((key_a, row))
        row, key_a, key_b = row[order], key_a[order], key_b[order]
        new = np.ones(len(order), bool)
        new[1:] = (key_a[1:] != key_a[:-1]) | (key_b[1:] != key_b[:-1]) | (row[1:] != row[:-1])
        heads = np.flatnonzero(new)
        columns = [key_a[heads].view(np.int64), key_b[heads].view(np.int64), np.diff(np.append(heads, len(order))).astype(np.int32)]
        structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["key_a", "key_b", "tf"])
        return structs, np.bincount(row[heads], minlength=len(sizes))

    @F.arrow_udf(RUNS)
    def run(hashes_a, hashes_b, places):
        sizes = pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64)
        parts = np.cumsum(sizes) // WORDS
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(sizes)]])
        found = [runs_of(*(x.slice(s, e - s) for x in (hashes_a, hashes_b, places)), sizes[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]
        offsets = np.append(0, np.cumsum(np.concatenate([n for _, n in found]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays([structs for structs, _ in found]))

    return run


def asked_phrases(queries: DataFrame, analysis: Analysis, field: str) -> DataFrame:
    """(query_id, words, shape, keys): the analysed phrase of each query, its places, and its hashes.

    Queries without a term that counts have no row. Stays within the row.
    """
    rows = analyse(queries.select("query_id", "text", F.lit(field).alias("field")), "text", analysis).where(F.size("terms") > 0)
    shape = F.transform("terms", lambda t: t.pos - F.get("terms", F.lit(0)).pos)
    keyed = held(rows.withColumn("shape", shape), "key", _phrase_hashes(*_word_hashes(F.col("terms")), F.col("shape")))
    return keyed.select("query_id", F.col("terms.term").alias("words"), "shape", "key.key_a", "key.key_b")


def _possible(runs: DataFrame, keys: DataFrame) -> DataFrame:
    """The runs whose hash has its bit set by one of the keys."""
    place = F.pmod("key_a", F.lit(BITS))
    number, bit = F.shiftright(place, 6).alias("number"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    bits = keys.select(number, bit.alias("bit")).groupBy("number").agg(F.bit_or("bit").alias("bits"))
    met = runs.withColumns({"number": number, "bit": bit}).join(F.broadcast(bits), "number")
    return met.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).drop("number", "bit", "bits")


def phrase_batch(
    corpus: DataFrame, queries: DataFrame, analysis: Analysis, field: str = "title", k: int | None = None, distinct: bool = False
) -> DataFrame:
    """(query_id, doc_id, score) of every document with a query's phrase.

    With ``k``, (query_id, rank, doc_id, score) of each query's best ``k``.

    ``queries`` are (query_id, text), one phrase each; a stop word inside keeps its
    place. Scores are those of a search for the phrase alone. Repeated rows of a
    query are one; ``distinct`` says that there are none. Texts and statistics are
    those of ``corpus``, read once.
    """
    spark = corpus.sparkSession
    with shuffles_dropped(spark):
        docs = durable(document_terms(corpus, [field], analysis).select("doc_id", "length", "terms"))
        queries = queries if distinct else queries.dropDuplicates(["query_id"])
        asked = durable(asked_phrases(queries.where("query_id IS NOT NULL"), analysis, field))
        # The ways in which words and gaps follow each other: a few, however many the phrases.
        shapes = sorted(r["shape"] for r in asked.select("shape").distinct().collect())

        # The rarity of the phrases' words: one count of documents for each.
        words = asked.withColumn("row", F.monotonically_increasing_id()).select(*HASHES, "row", F.explode("words").alias("term"))
        df = docs.select(F.explode(F.array_distinct(F.col("terms.term"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        docs_and_mean = docs.agg(F.count("*").alias("docs"), F.avg("length").alias("mean")).first()
        idf = F.log(1 + (F.lit(docs_and_mean["docs"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        # One row for each word and each phrase: looked up by hashing, their many uses need no sort.
        rated = words.join(df.hint("shuffle_hash"), "term").select(*HASHES, "row", idf.alias("idf")).repartition(*HASHES)
        # Queries that ask for one phrase have equal sums.
        weights = rated.groupBy(*HASHES, "row").agg(F.sum("idf").alias("weight")).groupBy(*HASHES).agg(F.max("weight").alias("weight"))
        weights = durable(weights)

        bits = spark.sparkContext.broadcast(phrase_bits(weights))
        found = _text_runs(shapes, bits)(*_word_hashes(F.col("terms")), F.col("terms.pos"))
        runs = docs.select("doc_id", "length", F.inline(found))
        met = runs.repartition(*HASHES).join(weights.hint("shuffle_hash"), HASHES)
        found = met
        if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            # Rows that share an id are one document; else a text's equal runs are one row already.
            found = met.groupBy(*HASHES, "weight", "doc_id", "length").agg(F.sum("tf").alias("tf"))
        norm = K1 * (1 - B + B * F.col("length") / F.lit(docs_and_mean["mean"] or 1.0))
        score = F.round(F.col("weight") * F.col("tf") / (F.col("tf") + norm), SCORE_DIGITS)
        scored = found.select(*HASHES, "doc_id", score.alias("score"))
        columns = ["query_id", "doc_id", "score"]
        if k is not None:
            # A phrase's best are the best of every query that asks for it.
            scored = top_k(scored, HASHES, [F.col("score").desc(), F.col("doc_id").asc()], k)
            columns.insert(1, "rank")
        with rows_at_once(spark, ROWS):
            return durable(scored.join(asked.select("query_id", *HASHES), HASHES).select(*columns))
