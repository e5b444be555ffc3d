"""Porter's 1980 suffix stripping, run once per distinct word of an Arrow batch."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Suffix -> replacement tables of the published algorithm, with
# its author's two later changes ("bli" and "logi").
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP_4 = dict.fromkeys(
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(), ""
)


def _shape(word: str) -> str:
    """One letter per character: v for a vowel, c for a consonant."""
    out = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _ends_double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _ends_short(word: str) -> bool:
    return len(word) > 2 and _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, table: dict[str, str]) -> str | None:
    for size in range(min(7, len(word)), 1, -1):
        if word[-size:] in table:
            return word[-size:]
    return None


def _replace(word: str, table: dict[str, str], least: int) -> str:
    suffix = _longest(word, table)
    if suffix is None:
        return word
    root = word[: -len(suffix)]
    if _measure(root) <= least or (suffix == "ion" and root[-1:] not in ("s", "t")):
        return word
    return root + table[suffix]


def _inflections(word: str) -> str:
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix) and "v" in _shape(word[: -len(suffix)]):
            root = word[: -len(suffix)]
            if root.endswith(("at", "bl", "iz")):
                return root + "e"
            if _ends_double(root):
                return root if root[-1] in "lsz" else root[:-1]
            return root + "e" if _measure(root) == 1 and _ends_short(root) else root
    return word


@lru_cache(maxsize=200_000)
def porter(word: str) -> str:
    """Stem one lower-case word."""
    if len(word) < 3:
        return word
    word = _inflections(word)
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, STEP_2, 0)
    word = _replace(word, STEP_3, 0)
    word = _replace(word, STEP_4, 1)
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _ends_short(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_terms(words):
    """Stem a list column; each distinct word of the batch is stemmed once."""
    import pyarrow as pa
    import pyarrow.compute as pc

    coded = words.flatten().dictionary_encode()
    stems = pa.array([porter(w) for w in coded.dictionary.to_pylist()], pa.string())
    offsets = pc.subtract(words.offsets, words.offsets[0])
    flat = stems.take(coded.indices)
    return pa.ListArray.from_arrays(offsets, flat, mask=words.is_null() if words.null_count else None)
