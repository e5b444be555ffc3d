"""Token counts that follow edits.

A document's text is cut into pre-tokens, which a byte-pair encoder treats one by
one, and every so many of them make a segment. A segment tree over a document
keeps the signs and tokens of every subtree. An edit re-encodes the segments it
touches, from a little before it until a boundary between old pre-tokens is met
again, and updates the sums above them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import batched

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.session import ship_package

# Pre-tokens of a new segment, and the size at which a segment is cut anew.
SEGMENT, LARGEST = 64, 256
# Signs before an edit that may decide where a pre-token ends.
CONTEXT = 8
# Different pre-tokens whose counts a worker remembers.
REMEMBERED = 500_000

# Fixed value: the published pattern of GPT-2's pre-tokens. Every sign is in one.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

EDITS = "array<struct<start:int,end:int,text:string>>"
_STATE = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("seg_chars", "seg_tokens")]


class _Counts(dict):
    """Tokens of a pre-token, remembered."""

    def __init__(self, path: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[piece] = found = len(self.encoding.encode_ordinary(piece))
        return found


@cache
def _counts(path: str) -> _Counts:
    return _Counts(path)


_split = regex.compile(PATTERN)


def _cut(pieces: list[str], counts: _Counts) -> tuple[list[int], list[int]]:
    """Signs and tokens of segments of pre-tokens."""
    if not pieces:
        return [], []
    starts = np.arange(0, len(pieces), SEGMENT)
    chars = np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), starts)
    tokens = np.add.reduceat(np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces)), starts)
    return chars.tolist(), tokens.tolist()


class Tree:
    """Sums of signs and tokens over segments: node 1 is the root, 2n and 2n + 1 are below n."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.chars, self.tokens = ([0] * self.size + x + [0] * (self.size - len(x)) for x in (chars, tokens))
        for n in range(self.size - 1, 0, -1):
            self.chars[n] = self.chars[2 * n] + self.chars[2 * n + 1]
            self.tokens[n] = self.tokens[2 * n] + self.tokens[2 * n + 1]

    def find(self, place: int) -> tuple[int, int]:
        """The segment that holds a place, and where it starts."""
        n, start = 1, 0
        while n < self.size:
            n *= 2
            if place >= start + self.chars[n] and self.chars[n + 1]:
                start += self.chars[n]
                n += 1
        return n - self.size, start

    def set(self, segment: int, chars: int, tokens: int) -> None:
        n = segment + self.size
        self.chars[n], self.tokens[n] = chars, tokens
        while n > 1:
            n //= 2
            self.chars[n] = self.chars[2 * n] + self.chars[2 * n + 1]
            self.tokens[n] = self.tokens[2 * n] + self.tokens[2 * n + 1]

    def leaves(self) -> tuple[list[int], list[int]]:
        pairs = [(c, t) for c, t in zip(self.chars[self.size :], self.tokens[self.size :]) if c]
        return [c for c, _ in pairs], [t for _, t in pairs]


def edit(text: str, tree: Tree, start: int, end: int, new: str, counts: _Counts) -> tuple[str, Tree, int]:
    """Text and tree after replacing [start, end), and the signs that were encoded for it."""
    changed = text[:start] + new + text[end:]
    shift = len(new) - (end - start)
    first, at = tree.find(max(0, start - CONTEXT))
    last, last_at = tree.find(max(start, end - 1) if end else 0)
    goal = last_at + tree.chars[last + tree.size]  # the old end of the touched segments
    pieces, place = [], at
    scan = _split.finditer(changed, at)
    while place < len(changed):
        # A boundary behind the edit that is one of the old segments' ends.
        while goal + shift < place or goal < end:
            last += 1
            goal += tree.chars[last + tree.size]
        if place == goal + shift and place >= start + len(new):
            break
        found = next(scan)
        pieces.append(found[0])
        place = found.end()
    else:
        last = len(tree.chars) - tree.size - 1
    old = [s for s in range(first, last + 1) if tree.chars[s + tree.size]] or [first]
    share = max(1, -(-len(pieces) // len(old)))
    if share > LARGEST:
        before, after = (list(zip(*[(tree.chars[s + tree.size], tree.tokens[s + tree.size]) for s in part])) or [(), ()] for part in (range(first), range(last + 1, tree.size)))
        chars, tokens = _cut(pieces, counts)
        every = [(c, t) for c, t in zip([*before[0], *chars, *after[0]], [*before[1], *tokens, *after[1]]) if c]
        return changed, Tree([c for c, _ in every], [t for _, t in every]), place - at
    parts = [list(p) for p in batched(pieces, share)]
    for k, s in enumerate(old):
        part = parts[k] if k < len(parts) else []
        tree.set(s, sum(map(len, part)), sum(map(counts.__getitem__, part)))
    return changed, tree, place - at


def segment_trees(docs: DataFrame, vocabulary: str, text_column: str = "text") -> DataFrame:
    """``docs`` with seg_chars, seg_tokens and n_tokens: the state that edits start from.

    ``vocabulary`` is the path of a file of ranks, there on every executor. Null and
    empty texts have no segments and 0 tokens. Repeated rows are counted alike;
    columns of these names give way. No rows give no rows.
    """
    ship_package(docs.sparkSession)
    rest = docs.select(*(c for c in docs.columns if c not in ("seg_chars", "seg_tokens", "n_tokens")))
    place, names = rest.columns.index(text_column), [*rest.columns, "seg_chars", "seg_tokens", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in batches:
            cuts = [_cut(_split.findall(x.as_py() or ""), counts) for x in batch.column(place)]
            arrays = [pa.array([c[i] for c in cuts], pa.list_(pa.int32())) for i in (0, 1)]
            totals = pa.array([sum(c[1]) for c in cuts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays, totals], names=names)

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, *_STATE, T.StructField("n_tokens", T.LongType())]))


def apply_edits(trees: DataFrame, vocabulary: str, edits_column: str = "edits", text_column: str = "text") -> DataFrame:
    """State after the edits of a column, with n_tokens anew and encoded_chars.

    Edits are structs (start, end, text) in code points of the text before any of
    them, end exclusive. They are applied from the last place to the first. An edit
    with a null place, or that overlaps one after it, is left out; places beyond the
    text count as its end; a null replacement is empty. A null text counts as empty,
    so edits may fill it; without edits a row stays as it is.
    """
    ship_package(trees.sparkSession)
    rest = trees.select(*(c for c in trees.columns if c not in ("n_tokens", "encoded_chars")), "n_tokens")
    at = {n: rest.columns.index(n) for n in (text_column, "seg_chars", "seg_tokens", edits_column, "n_tokens")}
    names = [*rest.columns, "encoded_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() if n != text_column else list(batch.column(i)) for n, i in at.items()}
            encoded = [0] * batch.num_rows
            for k, edits in enumerate(columns[edits_column]):
                if not edits:
                    columns[text_column][k] = columns[text_column][k].as_py()
                    continue
                text, tree = columns[text_column][k].as_py() or "", Tree(columns["seg_chars"][k], columns["seg_tokens"][k])
                free = len(text)
                for e in sorted((e for e in edits if e and e["start"] is not None and e["end"] is not None), key=lambda e: (-e["start"], -e["end"])):
                    start, end = min(max(0, e["start"]), len(text)), min(max(e["start"], e["end"]), len(text))
                    if end <= free:
                        text, tree, n = edit(text, tree, start, end, e["text"] or "", counts)
                        free, encoded[k] = start, encoded[k] + n
                columns[text_column][k] = text
                columns["seg_chars"][k], columns["seg_tokens"][k] = tree.leaves()
                columns["n_tokens"][k] = tree.tokens[1]
            arrays = list(batch.columns)
            for n in (text_column, "seg_chars", "seg_tokens", "n_tokens"):
                arrays[at[n]] = pa.array(columns[n], batch.column(at[n]).type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(encoded, pa.int64())], names=names)

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("encoded_chars", T.LongType())]))


def full_count(text: str | None, vocabulary: str) -> int:
    """Tokens of a text encoded as a whole, to check against."""
    return len(_counts(vocabulary).encoding.encode_ordinary(text or ""))
