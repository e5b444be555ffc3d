"""Text analysis as columns: words, stop words, positions, phrase candidates."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.functions.stem import stem_terms
from litscope.functions.words import PHRASE_STOP_WORDS, PUNCTUATION, SEARCH_STOP_WORDS

# Word boundaries after UAX #29. Letters keep inner apostrophes, dots and colons, digits
# keep inner separators; the last repeat is possessive, so a chain of any length needs
# no deep recursion. An ideograph or a hiragana sign is a word of its own, katakana and
# scripts without spaces of south-east Asia make runs, and an emoji sequence is a word.
# Emoji are known by their blocks.
#
# Scripts are looked up sign by sign, which is slow. So the first three forms are words
# that ranges of signs tell, up to a sign that can neither go on nor join; the others
# find the same words there. White space begins none.
_KATAKANA = r"\p{IsKatakana}\x{30FC}\x{FF70}\x{FF9E}\x{FF9F}"
_OTHER = rf"&&[^\p{{IsIdeographic}}\p{{IsHiragana}}{_KATAKANA}\x{{FE0F}}]"
_LETTER = rf"[\p{{L}}\p{{M}}{_OTHER}]"
_PART = rf"[\p{{L}}\p{{M}}\p{{N}}_{_OTHER}]"
_PICTURE = r"[\x{2600}-\x{27BF}\x{1F300}-\x{1F5FF}\x{1F600}-\x{1F6FF}\x{1F900}-\x{1FAFF}]\x{FE0F}?[\x{1F3FB}-\x{1F3FF}]?"
_SMALL, _IDEOGRAPH, _KANA = r"a-z0-9_", r"\x{4E00}-\x{9FEF}\x{3041}-\x{3096}", r"\x{30A1}-\x{30FA}"
_ENDS = r"\x{00}-\x{26}\x{28}-\x{2B}\x{2D}\x{2F}\x{3C}-\x{40}\x{5B}-\x{5E}\x{60}\x{7B}-\x{7F}"
WORD = (
    r"(?![\x{00}-\x{20}])(?:"
    rf"[{_SMALL}]++(?=[{_ENDS}{_IDEOGRAPH}{_KANA}]|\z)"
    rf"|[{_IDEOGRAPH}](?=[\x{{00}}-\x{{7F}}{_IDEOGRAPH}{_KANA}]|\z)"
    rf"|[{_KANA}]++(?=[\x{{00}}-\x{{7F}}{_IDEOGRAPH}]|\z)"
    rf"|{_PART}+"
    rf"(?:(?:(?<={_LETTER})['’.:](?=[\p{{L}}{_OTHER}])|(?<=\p{{N}})['’.,;](?=\p{{N}}))"
    rf"{_PART}+)*+"
    rf"|[{_KATAKANA}][{_KATAKANA}\p{{M}}]*+"
    r"|[\p{IsIdeographic}\p{IsHiragana}]\p{M}*+"
    rf"|[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|{_PICTURE}(?:\x{{200D}}{_PICTURE})*+"
    r")"
)
# Plain runs of letters and digits, for engines whose regex has no look-around.
SIMPLE_WORD = r"[\p{L}\p{N}_]+"
# Words and runs of punctuation, as key-phrase extraction sees a title.
PHRASE_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]+"

POSSESSIVE = "['’]s$"

# How many words a key phrase may have.
MIN_WORDS, MAX_WORDS = 2, 4


@dataclass(frozen=True)
class Analysis:
    """How field text becomes terms. The same value must serve index and query."""

    word: str = WORD
    possessive: bool = True
    stop_words: tuple[str, ...] = SEARCH_STOP_WORDS
    stem: bool = True
    # Fields that are lower-cased words only: no stop words, no stemming.
    simple_fields: tuple[str, ...] = ()

    def plain(self) -> "Analysis":
        """The same chain without stemming or look-around, for SQL comparison."""
        return replace(self, word=SIMPLE_WORD, possessive=False, stem=False)


def words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def held(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that later filters and columns read without redoing it.

    The optimizer copies a plain column into every expression that uses it; it
    does not look through a generator.
    """
    return df.select("*", F.explode_outer(F.array(column)).alias(name))


def analyse(df: DataFrame, text: str, analysis: Analysis, field: str = "field") -> DataFrame:
    """Add ``terms array<struct<term, pos>>``: stop words leave position gaps.

    Stays within the row, so it needs no shuffle; the stemmer works on the
    distinct words of each Arrow batch.
    """
    simple = F.col(field).isin(list(analysis.simple_fields)) if analysis.simple_fields else F.lit(False)
    out = held(df, "_words", words(F.col(text), analysis.word))
    # Few words have a possessive, and telling them is quicker than replacing.
    owns = lambda t: t.contains("'s") | t.contains("’s")
    trimmed = lambda w: F.when(owns(w), F.regexp_replace(w, POSSESSIVE, "")).otherwise(w)
    plain = simple | ~owns(F.lower(F.col(text))) if analysis.possessive else F.lit(True)
    common = list(analysis.stop_words)
    if analysis.stem:
        if analysis.possessive:
            bare = F.when(plain, F.col("_words")).otherwise(F.transform("_words", trimmed))
            out = held(out, "_bare", bare).drop("_words").withColumnRenamed("_bare", "_words")
        out = held(out, "_stems", F.when(simple, F.col("_words")).otherwise(stem_terms("_words")))
        placed = F.transform(
            "_words",
            lambda w, i: F.struct(F.get("_stems", i).alias("term"), i.alias("pos"), w.alias("word")),
        )
        kept = F.filter(placed, lambda t: simple | ~t.word.isin(common))
        terms = F.transform(kept, lambda t: F.struct(t.term.alias("term"), t.pos.alias("pos")))
        out = held(out, "terms", terms).drop("_stems")
    else:
        placed = F.when(plain, F.transform("_words", lambda w, i: F.struct(w.alias("term"), i.alias("pos"))))
        placed = placed.otherwise(F.transform("_words", lambda w, i: F.struct(trimmed(w).alias("term"), i.alias("pos"))))
        out = held(out, "terms", F.filter(placed, lambda t: simple | ~t.term.isin(common)))
    return out.drop("_words")


def candidate_phrases(text: Column, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS) -> Column:
    """Maximal runs free of stop words and punctuation, as ``array<string>``.

    Runs longer than ``max_words`` are left out whole. Punctuation of more than
    one character is not in the ignore list and counts as a word.
    """
    ignored = list(PHRASE_STOP_WORDS + PUNCTUATION)
    tokens = F.regexp_extract_all(text, F.lit(PHRASE_TOKEN), F.lit(0))
    # No token holds white space, so a line break can stand for "run ends here".
    marked = F.transform(F.transform(tokens, F.lower), lambda t: F.when(t.isin(ignored), F.lit("\n")).otherwise(t))
    runs = F.transform(F.split(F.array_join(marked, " "), "\n"), lambda r: F.trim(r))
    return F.filter(
        runs,
        # Of a span, the size would be counted for each end.
        lambda r: (F.length(r) > 0) & F.size(F.split(r, " ")).isin(list(range(min_words, max_words + 1))),
    )


def holds_any(phrase: Column, fragments: tuple[str, ...]) -> Column:
    """True where the phrase contains one of the fragments as a substring."""
    found = F.lit(False)
    for fragment in fragments:
        found = found | phrase.contains(fragment)
    return found
