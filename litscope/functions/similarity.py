"""Token-set similarity of two short strings, 0 to 100."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code points dropped before comparing, and the match threshold.
DROPPED = dict.fromkeys(range(128, 256))
MATCH_THRESHOLD = 80

# Phrases a worker keeps the answer for.
REMEMBERED = 200_000


def normalised(text: str) -> str:
    kept = text.translate(DROPPED).lower()
    return "".join(ch if ch.isalnum() else " " for ch in kept).strip()


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of a."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def word_set(text: str) -> frozenset[str]:
    return frozenset(normalised(text).split())


def token_set_ratio(left: str | None, right: str | None) -> int:
    """Best ratio between shared words, and shared words plus either remainder."""
    if left is None or right is None:
        return 0
    return set_ratio(word_set(left), word_set(right))


def set_ratio(a: frozenset[str], b: frozenset[str], least: int = 0) -> int:
    """``token_set_ratio`` of two word sets; 0 may stand for a ratio under ``least``."""
    if not a or not b:
        return 0
    if least and a.isdisjoint(b):
        # Without a shared word, letters that one side has more than the other are all apart.
        len_a, len_b = sum(map(len, a)) + len(a) - 1, sum(map(len, b)) + len(b) - 1
        if round(100 - 100 * abs(len_a - len_b) / (len_a + len_b)) < least:
            return 0
    shared = " ".join(sorted(a & b))
    only_a, only_b = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if shared and (not only_a or not only_b):
        return 100
    joint = len(shared) + 1 if shared else 0
    len_a, len_b = joint + len(only_a), joint + len(only_b)
    apart = len(only_a) + len(only_b) - 2 * _common_subsequence(only_a, only_b)
    best = 100 - 100 * apart / (len_a + len_b)
    if shared:
        for longer, rest in ((len_a, only_a), (len_b, only_b)):
            best = max(best, 100 - 100 * (1 + len(rest)) / (len(shared) + longer))
    return round(best)


def topic_matcher(topics: list[str], threshold: int = MATCH_THRESHOLD):
    """A list-column UDF: for each phrase, which topics it matches.

    Topics are call parameters, not data. The answer for a phrase is kept in the
    task, so a frequent phrase is compared once.
    """
    known: dict[str, list[int]] = {}
    sets = [word_set(t) if t is not None else frozenset() for t in topics]

    def matches(phrase: str) -> list[int]:
        if phrase not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            found = word_set(phrase) if phrase is not None else frozenset()
            known[phrase] = [i for i, t in enumerate(sets) if set_ratio(found, t, threshold) >= threshold]
        return known[phrase]

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def match(phrases):
        import pyarrow as pa

        rows = [None if row is None else [matches(p) for p in row] for row in phrases.to_pylist()]
        return pa.array(rows, pa.list_(pa.list_(pa.int32())))

    return match
