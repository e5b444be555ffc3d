"""How the tokens of two tokenizers line up over the same bytes.

One encodes a text to byte-level tokens with character offsets, the other to pieces
with spans. Where an offset or span ends at a whole character, it is a cut; tokens
that end inside a character, and pieces of single bytes, are placed by the bytes they
decode to. Where both have a cut, they end together: such ends part a text into
groups, and the two tokens that end there are linked.

Neither tokenizer joins a letter or sign with a blank after it, so texts are encoded
as chunks, each a blank with what follows it. A task encodes each chunk once, many in
one call, and remembers it. Chunks with white space at an end, which are the first or
last of a text, are encoded alone.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litscope.session import durable, scratch, ship_package

# Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE = 2 << 20
# Chunks encoded in one call; the tokenizers slow down on more.
TOGETHER = 1000
# Chunks a worker remembers.
REMEMBERED = 400_000
# Id pairs that hold at least one in so many of all links are few, and handed to all tasks.
FREQUENT = 1 << 17

BLANK = 0x20
# What stands for a blank in pieces.
MARK = "▁"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level tokens: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            known = all(ch in letters for ch in token)
            self.a_bytes[number] = bytes(letters[ch] for ch in token) if known else token.encode("utf-8", "surrogatepass")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_single = np.array([self.b.is_byte(i) for i in range(len(pieces))], bool)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if single else p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p, single in zip(pieces, self.b_single)
        ]
        # Ids as texts.
        self.a_names, self.b_names = (pa.array([str(i) for i in range(len(x))], pa.large_string()) for x in (self.a_bytes, self.b_bytes))
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # Chunks are sound if no piece runs from a sign into a blank, and byte-level words start at blanks.
        joined = any(MARK in p.lstrip(MARK) for p in pieces)
        self.by_chunk = not joined and type(self.a.pre_tokenizer).__name__ == "ByteLevel" and self.a.normalizer is None

    def a_tokens(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and byte ends of the byte-level tokens; None if they decode to something else."""
        encoding = self.a.encode(text, add_special_tokens=False)
        numbers = encoding.ids
        if b"".join([self.a_bytes[i] for i in numbers]) != data:
            return None
        ids = np.array(numbers, np.int64)
        offsets = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        # A character's first byte, from the bytes that do not continue one.
        if len(data) == len(text):
            ends = offsets[:, 1]
        else:
            heads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            ends = np.append(heads, len(data))[offsets[:, 1]]
        # The next token starts inside the character that this one ends in.
        inside = np.append(offsets[1:, 0] < offsets[:-1, 1], False)
        return ids, _refined(ends, inside, self.a_sizes[ids])

    def b_tokens(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and byte ends of the pieces. The text starts with a blank, which the pieces' own blank stands for."""
        pieces = list(self.b.encode(text[1:], return_type="proto", num_threads=1).pieces)
        numbers = [p.id for p in pieces]
        if b"".join([self.b_bytes[i] for i in numbers]) != data:
            return None
        ids = np.array(numbers, np.int64)
        ends = np.fromiter((p.end for p in pieces), np.int64, len(pieces)) + 1
        return ids, _refined(ends, self.b_single[ids], self.b_sizes[ids])


def _refined(ends: np.ndarray, inside: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cuts for all tokens: those inside a character lie so many decoded bytes after the last whole one."""
    if not inside.any():
        return ends
    decoded = np.cumsum(sizes)
    sure = np.maximum.accumulate(np.where(inside, -1, np.arange(len(ends))))
    before = np.where(sure < 0, 0, ends[sure] - decoded[sure])
    return np.where(inside, before + decoded, ends)


@cache
def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


class Aligned:
    """What chunks have come to, as columns: counts, links as id pairs, and the groups as text."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.good, self.uses = np.empty(0, bool), np.empty(0, np.int64)
        self.n_a, self.n_b = np.empty(0, np.int64), np.empty(0, np.int64)
        # The links of chunk i follow those of the chunks before it.
        self.sizes, self.links = np.empty(0, np.int64), np.empty(0, np.int64)
        self.groups = pa.array([], pa.large_string())

    def add(self, chunks: list[bytes], good: bool, n_a: np.ndarray, n_b: np.ndarray, sizes: np.ndarray, links: np.ndarray, groups: pa.Array) -> None:
        first = len(self.good)
        self.places.update(zip(chunks, range(first, first + len(chunks))))
        self.good = np.append(self.good, np.full(len(chunks), good))
        self.uses = np.append(self.uses, np.zeros(len(chunks), np.int64))
        self.n_a, self.n_b = np.append(self.n_a, n_a), np.append(self.n_b, n_b)
        self.sizes, self.links = np.append(self.sizes, sizes), np.append(self.links, links)
        self.groups = pa.concat_arrays([self.groups, groups])

    def forget(self) -> None:
        """Keep what was used more than once."""
        kept = np.flatnonzero(self.uses > 1)
        number = np.full(len(self.uses), -1)
        number[kept] = np.arange(len(kept))
        self.places = {c: n for c, i in self.places.items() if (n := int(number[i])) >= 0}
        self.links = self.links[np.repeat(number >= 0, self.sizes)]
        self.good, self.n_a, self.n_b, self.sizes = (x[kept] for x in (self.good, self.n_a, self.n_b, self.sizes))
        self.uses, self.groups = np.zeros(len(kept), np.int64), self.groups.take(pa.array(kept))


@cache
def _memory(a_path: str, b_path: str) -> Aligned:
    return Aligned()


def _joined(values: pa.Array, bounds: np.ndarray, between: str) -> pa.Array:
    """Neighbouring texts joined, from one bound to the next."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values), pa.scalar(between, values.type))


def _encode(pair: Tokenizers, chunks: list[bytes], known: Aligned) -> None:
    """Align chunks, some in one call of each tokenizer. If their bytes come out otherwise, halves are tried alone."""
    good, bad = [], []

    def tried(group: list[bytes]) -> None:
        data = b"".join(group)
        text = data.decode("utf-8", "surrogatepass")
        a, b = pair.a_tokens(text, data), pair.b_tokens(text, data)
        if a is not None and b is not None:
            good.append((group, a, b))
        elif len(group) == 1:
            bad.extend(group)
        else:
            middle = len(group) // 2
            tried(group[:middle])
            tried(group[middle:])

    # White space at the end of a text, or at its start, would run into that of the next chunk, or the one before.
    sizes = np.array([len(c) for c in chunks])
    ends = np.cumsum(sizes)
    starts, stops = _signs(np.frombuffer(b"".join(chunks), np.uint8))
    beside = (starts[ends - sizes + 1] & stops[ends - 1] & pair.by_chunk).tolist()
    joined = [c for c, one in zip(chunks, beside) if one]
    for i in range(0, len(joined), TOGETHER):
        tried(joined[i : i + TOGETHER])
    for c, one in zip(chunks, beside):
        if not one:
            tried([c])

    if bad:
        none = np.zeros(len(bad), np.int64)
        known.add(bad, False, none, none, none, none[:0], pa.array([""] * len(bad), pa.large_string()))
    if good:
        begins = np.cumsum([0, *(sum(map(len, group)) for group, _, _ in good)])
        a, b = ([np.concatenate(x) for x in ([g[i][0] for g in good], [g[i][1] + begin for g, begin in zip(good, begins)])] for i in (1, 2))
        _add(pair, [c for group, _, _ in good for c in group], a, b, known)


def _add(pair: Tokenizers, chunks: list[bytes], a: list[np.ndarray], b: list[np.ndarray], known: Aligned) -> None:
    """Remember what chunks that follow each other come to, by the ids and byte ends of their tokens."""
    (a_ids, a_ends), (b_ids, b_ends) = a, b
    # Both run over the same bytes without empty tokens, so ends rise and meet at most once.
    common, a_at, b_at = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    links = (a_ids[a_at] << 32) | b_ids[b_at]
    sides = [_joined(names.take(pa.array(ids)), np.append(0, at + 1), ",") for names, ids, at in ((pair.a_names, a_ids, a_at), (pair.b_names, b_ids, b_at))]
    groups = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
    ends = np.cumsum([len(c) for c in chunks])
    last, a_last, b_last = (np.searchsorted(x, ends, side="right") for x in (common, a_ends, b_ends))
    sizes, n_a, n_b = (np.diff(x, prepend=0) for x in (last, a_last, b_last))
    known.add(chunks, True, n_a, n_b, sizes, links, _joined(groups, np.append(0, last), ";"))


def _signs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that start, and those that end, a sign that is surely no white space."""
    sign = (data > 0x20) & (data < 0x7F)
    # Signs of two bytes: no white space has a first byte from C3 on.
    lead = (data >= 0xC3) & (data < 0xE0)
    ends = sign.copy()
    ends[1:] |= lead[:-1]
    return sign | lead, ends


def chunk_starts(data: np.ndarray) -> np.ndarray:
    """Where chunks start: at blanks between two signs that are surely no white space."""
    starts, ends = _signs(data)
    found = np.flatnonzero(data[1:-1] == BLANK) + 1
    return found[ends[found - 1] & starts[found + 1]]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of up to SLICE bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > SLICE:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


_ROW = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<bigint>, times array<int>"


@contextlib.contextmanager
def _no_collection():
    """Millions of short-lived tuples without a cycle among them need no search for cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, known = _tokenizers(a_path, b_path), _memory(a_path, b_path)
        for batch in batches:
            for start, stop in _slices(batch.column("text")):
                with _no_collection():
                    aligned = _aligned(batch.slice(start, stop - start), pair, known)
                yield aligned

    return run


def _aligned(batch: pa.RecordBatch, pair: Tokenizers, known: Aligned) -> pa.RecordBatch:
    rows = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in batch.column("text").to_pylist()]
    whole = b"".join(rows)
    ends = np.cumsum([len(r) for r in rows])
    filled = np.flatnonzero(np.diff(ends, prepend=0))
    begins = (ends - [len(r) for r in rows])[filled]
    cuts = chunk_starts(np.frombuffer(whole, np.uint8)) if pair.by_chunk and len(whole) > 2 else np.empty(0, np.int64)
    cuts = np.sort(np.concatenate([cuts, begins]))
    cuts = cuts[np.diff(cuts, prepend=-1) > 0]
    offsets = pa.array(np.append(cuts, len(whole)).astype(np.int64))
    chunks = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, offsets.buffers()[1], pa.py_buffer(whole)]).dictionary_encode()
    distinct = chunks.dictionary.to_pylist()
    if len(known.good) + len(distinct) > REMEMBERED:
        known.forget()
    missing = [c for c in distinct if c not in known.places]
    if missing:
        _encode(pair, missing, known)
    codes = np.fromiter(map(known.places.__getitem__, distinct), np.int64, len(distinct))[chunks.indices.to_numpy()]
    np.add.at(known.uses, codes, 1)
    # Chunks of row k of the filled ones are those from first[k] to first[k + 1].
    first = np.append(np.searchsorted(cuts, begins), len(cuts))
    n_rows = len(rows)

    def summed(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n_rows, np.int64)
        if len(filled):
            out[filled] = np.add.reduceat(values[codes], first[:-1])
        return out

    good = np.zeros(n_rows, bool)
    if len(filled):
        good[filled] = np.logical_and.reduceat(known.good[codes], first[:-1])

    digests, texts = [""] * n_rows, _joined(known.groups.take(pa.array(codes)), first, ";")
    for k, groups in zip(filled.tolist(), texts):
        if good[k]:
            digests[k] = hashlib.sha256(groups.as_buffer()).hexdigest()

    # The links of a row, each pair once with its count.
    begin = np.cumsum(known.sizes) - known.sizes
    each = known.sizes[codes]
    total = int(each.sum())
    place = np.repeat(begin[codes] - (np.cumsum(each) - each), each) + np.arange(total)
    row = np.repeat(np.repeat(filled, np.diff(first)), each)
    links = known.links[place]
    held = good[row]
    row, links = row[held], links[held]
    order = np.lexsort((links, row))
    row, links = row[order], links[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (links[1:] != links[:-1])])) if len(row) else np.empty(0, np.int64)
    times = np.diff(np.append(new, len(row))).astype(np.int32)
    bounds = pa.array(np.searchsorted(row[new], np.arange(n_rows + 1)).astype(np.int32))
    n_groups = np.bincount(row, minlength=n_rows)
    arrays = [
        batch.column("id"),
        pa.array(np.where(good, summed(known.n_a), 0)),
        pa.array(np.where(good, summed(known.n_b), 0)),
        pa.array(n_groups.astype(np.int64)),
        pa.array(digests, pa.string()),
        pa.ListArray.from_arrays(bounds, pa.array(links[new])),
        pa.ListArray.from_arrays(bounds, pa.array(times)),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "times"])


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    ``a_path`` is a byte-level tokenizer file, ``b_path`` a model of pieces. The first
    encodes a blank and the text, the second the text, to which it adds the blank. A
    link is a pair of tokens that end at the same byte; a pair of ids counts by its
    links in all rows. ``n_best`` counts the row's links whose pair is the most frequent
    one of its second id (ties count), ``count_sum`` adds up their counts.

    Null and empty texts, and texts whose tokens do not decode to a blank and the text,
    have no tokens: zeros and an empty digest, and no part in any count. Strings of
    special tokens are plain text. Repeated rows and rows that share an id are rows of
    their own; the id may be null and of any type. Long texts are encoded whole. No
    rows give no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    with scratch(spark):
        aligned = durable(rows.mapInArrow(_align(a_path, b_path), f"id {kind}, {_ROW}").withColumn("row", F.monotonically_increasing_id()))
        scored = durable(_counted(aligned), outlive=True)
    return scored.select(F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _counted(aligned: DataFrame) -> DataFrame:
    """Add the corpus-wide counts of each row's links.

    Pairs that hold one in FREQUENT of all links or more are at most FREQUENT; each
    task gets them. The others travel with their rows' links.
    """
    links = aligned.select("row", F.explode(F.arrays_zip("links", "times")).alias("l")).select("row", F.col("l.links").alias("link"), F.col("l.times").alias("times"))
    counts = durable(links.groupBy("link").agg(F.sum("times").alias("n")))
    second = F.col("link").bitwiseAND(F.lit(0xFFFFFFFF))
    best = counts.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    judged = durable(counts.withColumn("b", second).join(best, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best")))
    total = judged.agg(F.sum("n")).first()[0] or 0
    is_frequent = F.col("n") * FREQUENT >= total
    frequent, rare = F.broadcast(judged.where(is_frequent)), judged.where(~is_frequent)
    sums = (
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
    )
    others = links.join(frequent, "link", "left_anti").join(rare, "link")
    summed = links.join(frequent, "link").groupBy("row").agg(*sums).unionByName(others.groupBy("row").agg(*sums))
    summed = summed.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    out = aligned.drop("links", "times").join(summed, "row", "left")
    return out.select("*", F.col("n_groups").alias("n_links")).fillna(0, ["count_sum", "n_best"])
