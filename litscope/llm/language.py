"""Language identification by a string kernel.

A text is the set of its letter n-grams of several lengths (the blended
spectrum); two texts' kernel is the size of the sets' intersection over the
geometric mean of their sizes. Landmark texts span a Nyström approximation of
that kernel, in which a ridge regression for each language against the rest is
fitted. Texts are scored in batches: presence matrix times landmark matrix times
weights. Every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.llm.shingles import distinct
from litscope.operators.ranking import top_k
from litscope.session import durable, ship_package

ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
# Rows of a presence matrix.
BLOCK = 64


@cache
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 where it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            table[point] = ord(lower[0])
    return table


def grams(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text's words, with their borders."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate([[0], _letters()[points], [0]]).astype(np.uint32)
    # One border between words, however many other signs stand there.
    letters = letters[np.concatenate([[True], (letters[1:] != 0) | (letters[:-1] != 0)])]
    if len(letters) < 3:
        return np.empty(0, np.uint32)
    run, found = np.zeros(len(letters), np.uint32), []
    for n in range(1, max(ORDERS) + 1):
        count = len(letters) - n + 1
        if count <= 0:
            break
        run = run[:count] * np.uint32(0x01000193) + letters[n - 1 :] * np.uint32(0x9E3779B1) + np.uint32(n)
        run ^= run >> np.uint32(15)
        if n in ORDERS:
            found.append(run)
    return distinct(np.concatenate(found))


@dataclass
class Model:
    """Landmarks and weights; its size is bounded by the landmark texts' n-grams."""

    languages: list[str]
    vocabulary: np.ndarray  # hashes of the landmarks' n-grams
    presence: np.ndarray  # vocabulary x landmarks
    sizes: np.ndarray  # n-grams of every landmark
    weights: np.ndarray  # landmarks x languages

    def kernels(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts with the landmarks."""
        present = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        for i, found in enumerate(sets):
            places = np.searchsorted(self.vocabulary, found)
            places[places == len(self.vocabulary)] = 0
            present[i, places[self.vocabulary[places] == found]] = 1
        sizes = np.array([max(1, len(s)) for s in sets], np.float32)
        return (present @ self.presence) / np.sqrt(sizes[:, None] * self.sizes[None, :])

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """Share of each language in the positive answers of the regressions."""
        answers = np.clip(self.kernels(sets).astype(float) @ self.weights, 1e-9, 1)
        return answers / answers.sum(axis=1, keepdims=True)


def _chosen(labelled: DataFrame, count: int) -> DataFrame:
    """So many distinct texts of each language: those with the least hashes.

    Hashes are made distinct before they are ranked, so copies count once; the texts
    of the least hashes are fetched afterwards. Each task's own hashes are cut first.
    """
    rows = labelled.select("text", "lang", F.pmod(F.xxhash64("text"), F.lit(2**31)).alias("hash"))
    least = durable(top_k(rows.select("lang", "hash").distinct(), ["lang"], [F.col("hash").asc()], count).select("lang", "hash"))
    # As many rows of each language as are wanted; texts that share a hash all come, and are ranked.
    few = rows.join(F.broadcast(least), ["lang", "hash"]).select("text", "lang", "hash").distinct()
    return top_k(few, ["lang"], [F.col("hash").asc(), F.col("text").asc()], count)


def train(labelled: DataFrame, landmarks: int = 16, samples: int = 400, ridge: float = 1e-3) -> Model:
    """Fit on ``labelled`` (text, lang); rows without a language or a letter don't count.

    ``landmarks`` texts and ``samples`` rows of each language are the bound of what
    is learnt from: distinct texts, chosen by their hash over the whole table. The
    driver gets the landmarks' texts, and of the samples one row of kernel values
    each, computed on the executors.
    """
    ship_package(labelled.sparkSession)
    texts = labelled.where(r"lang IS NOT NULL AND text RLIKE '\\p{L}'")
    chosen = durable(_chosen(texts, samples))
    model = _with_landmarks([r["text"] for r in chosen.where(F.col("rank") <= landmarks).orderBy("lang", "rank").collect()])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = list(model.kernels([grams(t.as_py()) for t in batch.column("text")]).astype(float))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(values, pa.list_(pa.float64()))], names=["lang", "k"])

    sample = chosen.select("text", "lang").mapInArrow(rows, "lang string, k array<double>").collect()
    model.languages = sorted({r["lang"] for r in sample})
    if not sample:
        return model
    # Nyström: features are the kernel values times the inverse root of the landmarks' own kernel.
    own = (model.presence.T @ model.presence) / np.sqrt(model.sizes[:, None] * model.sizes[None, :])
    values, vectors = np.linalg.eigh(own.astype(float))
    strong = values > 1e-6 * values.max()
    root = vectors[:, strong] / np.sqrt(values[strong])
    features = np.array([r["k"] for r in sample]) @ root
    answers = np.array([[float(r["lang"] == c) for c in model.languages] for r in sample])
    fitted = np.linalg.solve(features.T @ features + ridge * len(sample) * np.eye(features.shape[1]), features.T @ answers)
    model.weights = root @ fitted
    return model


def _with_landmarks(texts: list[str]) -> Model:
    sets = [grams(t) for t in texts]
    vocabulary = distinct(np.concatenate(sets)) if sets else np.zeros(1, np.uint32)
    presence = np.zeros((len(vocabulary), len(sets)), np.float32)
    for i, found in enumerate(sets):
        presence[np.searchsorted(vocabulary, found), i] = 1
    return Model([], vocabulary, presence, np.array([len(s) for s in sets], np.float32), np.zeros((len(sets), 0)))


def classify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, from the text alone.

    Null texts and texts without a letter, and all texts if the model has learnt
    nothing, get ``und`` and 0. Otherwise score is the best language's share of the
    positive answers, in (0, 1]. Ties go to the language that sorts first. Repeated
    rows are judged alike. Columns named lang_pred and score give way.
    """
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model)
    rest = docs.select(*(c for c in docs.columns if c not in ("lang_pred", "score")))
    names_out, place = [*rest.columns, "lang_pred", "score"], rest.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                sets = [grams(t.as_py()) for t in batch.column(place)]
                names, scores = [UNKNOWN] * len(sets), np.zeros(len(sets))
                if model.languages:
                    found = model.scores(sets)
                    known = np.array([len(s) > 0 for s in sets])
                    names = [model.languages[i] if k else UNKNOWN for i, k in zip(found.argmax(axis=1), known)]
                    scores = np.where(known, found.max(axis=1), 0.0)
                columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=names_out)

    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rest.mapInArrow(run, schema)


def held_out(identity: Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.encode(identity.cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def known_rows(docs: DataFrame) -> DataFrame:
    """What may be learnt from: text and language of the rows not held out."""
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    return docs.where(crc % 4 != 2).select("text", "lang")
