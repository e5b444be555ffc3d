"""Key phrases of a corpus: candidates, counts, word and phrase scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.functions.text import MAX_WORDS, candidate_phrases, holds_any
from litscope.functions.words import TREND_BLOCK_LIST
from litscope.operators.ranking import top_k
from litscope.session import durable


def phrase_occurrences(df: DataFrame, keep: list[str], text: str = "title") -> DataFrame:
    """One row per candidate phrase occurrence. Narrow: no shuffle."""
    found = df.where(F.col(text).isNotNull())
    rows = found.select(*keep, F.explode_outer(candidate_phrases(F.col(text))).alias("phrase"))
    return rows.where(F.col("phrase").isNotNull())


def phrase_counts(df: DataFrame, scope: list[str], text: str = "title") -> DataFrame:
    """Occurrences per (scope, phrase); summed within each task before the shuffle."""
    return phrase_occurrences(df, scope, text).groupBy(*scope, "phrase").agg(F.count("*").alias("n"))


def word_scores(counts: DataFrame, scope: list[str], only: DataFrame | None = None) -> DataFrame:
    """Degree, frequency and their ratio per (scope, word).

    Each occurrence of a word adds its phrase's length to the degree, so the
    word pairs inside a phrase never need to be listed. ``only`` limits the work
    to the (scope, word) pairs it holds.
    """
    split = F.split("phrase", " ")
    each = counts.select(*scope, "n", F.size(split).alias("length"), F.explode(split).alias("word"))
    if only is not None:
        each = each.join(only, [*scope, "word"], "left_semi")
    totals = each.groupBy(*scope, "word").agg(
        F.sum(F.col("n") * F.col("length")).alias("degree"), F.sum("n").alias("freq")
    )
    return totals.withColumn("word_score", F.col("degree") / F.col("freq"))


def phrase_words(phrases: DataFrame, scope: list[str]) -> DataFrame:
    return phrases.select(*scope, "phrase", "n", F.posexplode(F.split("phrase", " ")).alias("at", "word"))


def phrase_scores(phrases: DataFrame, scores: DataFrame, scope: list[str], max_words: int = MAX_WORDS) -> DataFrame:
    """Add ``score``: the sum of the word scores, added in word order.

    ``phrases`` holds (scope, phrase, n). At most ``max_words`` rows meet per
    phrase, and each fills the slot of its place, so the sum does not depend on
    the order they arrive in. A word common to many phrases of one scope is a
    skewed join key and is split by adaptive execution (the word side has one row
    per key).
    """
    each = phrase_words(phrases, scope)
    parts = each.join(scores.select(*scope, "word", "word_score"), [*scope, "word"])
    slots = [f"_at{i}" for i in range(max_words)]
    placed = [F.max(F.when(F.col("at") == i, F.col("word_score"))).alias(slot) for i, slot in enumerate(slots)]
    score = F.lit(0.0)
    for slot in slots:
        score = score + F.coalesce(F.col(slot), F.lit(0.0))
    summed = parts.groupBy(*scope, "phrase", "n").agg(*placed)
    return summed.select(*scope, "phrase", "n", score.alias("score"))


def scored_within(phrases: DataFrame, counts: DataFrame, scope: list[str]) -> DataFrame:
    """Score a few stored phrases against the word statistics of all of them."""
    needed = phrase_words(phrases, scope).select(*scope, "word")
    return phrase_scores(phrases, word_scores(counts, scope, needed), scope)


def allowed(phrase: Column | str = "phrase", block_list: tuple[str, ...] = TREND_BLOCK_LIST) -> Column:
    phrase = F.col(phrase) if isinstance(phrase, str) else phrase
    return ~holds_any(phrase, block_list)


def phrase_order() -> list[Column]:
    """Most frequent first, then best scored, then last in the alphabet."""
    return [F.col("n").desc(), F.col("score").desc(), F.col("phrase").desc()]


def top_phrases(
    counts: DataFrame,
    scope: list[str],
    k: int,
    block_list: tuple[str, ...] = TREND_BLOCK_LIST,
) -> DataFrame:
    """The k leading phrases per scope: (scope, phrase, n, score, rank).

    ``counts`` is read several times and should be stored. Only phrases that
    reach the k-th largest count of their scope can place, so only those are
    scored; word scores still come from every phrase, blocked ones included.
    """
    # Blocked phrases count as 0 rather than being filtered out first.
    open_n = F.when(allowed(block_list=block_list), F.col("n")).otherwise(F.lit(0))
    best = top_k(counts.select(*scope, open_n.alias("n")), scope, [F.col("n").desc()], k)
    cut = durable(best.where("n > 0").groupBy(*scope).agg(F.min("n").alias("least")))
    contenders = durable(counts.join(cut, scope).where(open_n >= F.col("least")).drop("least"))
    return top_k(scored_within(contenders, counts, scope), scope, phrase_order(), k)
