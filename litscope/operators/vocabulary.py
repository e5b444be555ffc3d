"""A dictionary of an index's terms, for looking up patterns without trying each on every term.

Tables over the terms of all fields:

``deletions``  each term under what is left of its first letters when up to two of
               them are left out: fuzzy patterns meet terms with equal rests
``grams``      each term under its runs of three letters: wildcard and regex
               patterns meet terms that hold their rarest ones (``gram_stats``)
``ordered``    terms in order, in parts of a few thousand
``points``     the first and last term of each part: prefixes and ranges meet the
               parts they lie in

Each lookup is an equality join on keys that spread over the vocabulary, and every
candidate is then checked by the pattern itself. Deletions and grams may be stored,
for lookups that read a few of them; they hold a term some 29 times and once for
each letter. Left unstored, they are made in the pass over the terms that looks a
batch of patterns up.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.operators.clauses import IDENTITY, PATTERNS
from litscope.operators.patterns import _wildcard
from litscope.operators.ranking import top_k
from litscope.session import durable, handed_out
from litscope.sources.store import Index

# Letters of a term that deletions look at, and the most edits they serve.
LEADING, MOST_EDITS = 7, 2
# Marks of a term's start and end in its grams; no word holds them.
START, END = "\x02", "\x03"
GRAM = 3
# Grams of a pattern that terms are looked up by, the rarest ones.
PROBES = 3
# Terms of a part of the ordered dictionary.
PART_TERMS = 20_000
# No term goes on with this code point.
LAST = "\U0010ffff"
# Rows of a batch's keys, each of some 100 bytes, up to which all tasks get them.
HANDED_OUT = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """The tables of a dictionary."""

    deletions: DataFrame
    grams: DataFrame
    gram_stats: DataFrame
    ordered: DataFrame
    points: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.points.sparkSession


def _without_one(word: Column) -> Column:
    """The word without its first letter, without its second, and so on."""
    places = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))
    return F.transform(places, lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))


def rests(word: Column, edits: Column | int = MOST_EDITS) -> Column:
    """What is left of a word's first letters without up to ``edits`` of them, as array<struct<rest, gone>>.

    Two words ``edits`` apart share one: take from each the letters that the edits
    touch (a substitution or a swap takes one of each), and cut the longer of the two
    leading parts that are left to the shorter, which together takes no more letters.
    """
    edits = F.lit(edits) if isinstance(edits, int) else edits
    lead = F.substr(word, F.lit(1), F.lit(LEADING))
    once = F.when((edits >= 1) & (F.length(lead) > 0), _without_one(lead)).otherwise(F.array().cast("array<string>"))
    twice = F.flatten(F.transform(F.filter(once, lambda w: (edits >= 2) & (F.length(w) > 0)), _without_one))

    def tagged(words: Column, gone: int) -> Column:
        return F.transform(F.array_distinct(words), lambda w: F.struct(w.alias("rest"), F.lit(gone).alias("gone")))

    return F.concat(tagged(F.array(lead), 0), tagged(once, 1), tagged(twice, 2))


def grams_of(text: Column) -> Column:
    """All runs of three letters."""
    last = F.length(text) - GRAM + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(GRAM))))


def _stored(rows: DataFrame, path: str, *order: str) -> DataFrame:
    rows.hint("rebalance", "field", order[0]).sortWithinPartitions("field", *order).write.mode("overwrite").partitionBy("field").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_vocabulary(index: Index, path: str, part_terms: int = PART_TERMS, stored: bool = True) -> Vocabulary:
    """Make the tables of an index's terms; what was at ``path`` is replaced.

    With ``stored=False``, deletions and grams are not written.
    """
    terms = index.term_stats.select("field", "bucket", "term")
    deletions = terms.select("field", "bucket", "term", F.inline(rests(F.col("term"))))
    marked = F.concat(F.lit(START), "term", F.lit(END))
    grams = terms.select("field", F.explode(grams_of(marked)).alias("gram"), "bucket", "term")
    if stored:
        deletions = _stored(deletions, f"{path}/deletions", "rest", "term")
        grams = _stored(grams, f"{path}/grams", "gram", "term")
    gram_stats = _stored(grams.groupBy("field", "gram").agg(F.count("*").alias("terms")), f"{path}/gram_stats", "gram")

    parts = max(1, -(-terms.count() // part_terms))
    placed = terms.repartitionByRange(parts, "field", "term").sortWithinPartitions("field", "term").withColumn("part", F.spark_partition_id())
    placed.write.mode("overwrite").partitionBy("part").parquet(f"{path}/ordered")
    ordered = index.spark.read.schema(placed.schema).parquet(f"{path}/ordered")
    points = ordered.groupBy("part", "field").agg(F.min("term").alias("first"), F.max("term").alias("last"), F.count("*").alias("terms"))
    return Vocabulary(deletions, grams, gram_stats, ordered, durable(points))


def osa_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Insertions, deletions, substitutions and swaps of neighbours, no letter edited twice, of many pairs at once."""
    sizes_a, sizes_b = (np.array([len(w) for w in words]) for words in (left, right))
    out = np.zeros(len(left), np.int32)
    # Pairs of like length are worked on together, all in step.
    order = np.lexsort((sizes_b, sizes_a))
    for part in np.array_split(order, max(1, len(order) // 4096)):
        if not len(part):
            continue
        na, nb = sizes_a[part], sizes_b[part]
        a, b = (_letters([words[i] for i in part], n.max()) for words, n in ((left, na), (right, nb)))
        rows = np.zeros((na.max() + 1, nb.max() + 1, len(part)), np.int32)
        rows[:, 0], rows[0] = np.arange(na.max() + 1)[:, None], np.arange(nb.max() + 1)[:, None]
        for i in range(1, na.max() + 1):
            for j in range(1, nb.max() + 1):
                same = a[i - 1] == b[j - 1]
                best = np.minimum(np.minimum(rows[i - 1, j], rows[i, j - 1]) + 1, rows[i - 1, j - 1] + ~same)
                if i > 1 and j > 1:
                    swapped = (a[i - 1] == b[j - 2]) & (a[i - 2] == b[j - 1])
                    best = np.where(swapped, np.minimum(best, rows[i - 2, j - 2] + 1), best)
                rows[i, j] = best
        out[part] = rows[na, nb, np.arange(len(part))]
    return out


def _letters(words: list[str], width: int) -> np.ndarray:
    """Code points, one row for each place."""
    text = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(text, np.uint32).reshape(len(words), width).T


@F.arrow_udf(T.IntegerType())
def _apart(terms, texts):
    return pa.array(osa_distances(terms.to_pylist(), texts.to_pylist()), pa.int32())


def fuzzy_terms(vocabulary: Vocabulary, patterns: DataFrame) -> DataFrame:
    """(IDENTITY, bucket, term, apart): terms up to ``edits`` from a pattern's text.

    The lengths and plain distance, which counts a swap as two, rule most candidates
    out before the exact distance is taken.
    """
    wrong = F.raise_error(F.concat(F.lit(f"the dictionary serves up to {MOST_EDITS} edits, not "), F.col("edits").cast("string")))
    edits = F.when(F.col("edits") <= MOST_EDITS, F.col("edits")).otherwise(wrong.cast("int"))
    asked = patterns.select(*IDENTITY, "text", edits.alias("edits"))
    asked = asked.select("*", F.inline(rests(F.col("text"), F.col("edits")))).withColumnRenamed("gone", "own")
    asked = asked.groupBy(*IDENTITY, "text", "edits", "rest").agg(F.min("own").alias("own"))
    met = vocabulary.deletions.join(handed_out(asked, HANDED_OUT), ["field", "rest"]).where((F.col("gone") <= F.col("edits")) & (F.col("own") <= F.col("edits")))
    near = (F.abs(F.length("term") - F.length("text")) <= F.col("edits")) & (F.levenshtein("term", "text", 2 * MOST_EDITS) >= 0)
    near = near & (F.levenshtein("term", "text", 2 * MOST_EDITS) <= 2 * F.col("edits"))
    pairs = met.where(near).select(*IDENTITY, "bucket", "term", "text", "edits").distinct()
    return pairs.withColumn("apart", _apart("term", "text")).where(F.col("apart") <= F.col("edits")).select(*IDENTITY, "bucket", "term", "apart")


def required_runs(pattern: str) -> list[str]:
    """Letters that stand next to each other in every match of a regex, as far as is plain to see.

    Only the outermost sequence is looked at. Groups, classes, escapes and signs end a
    run; a letter that may be repeated or left out ends it too; an outer alternative
    leaves nothing for sure. What is not found only widens the lookup.
    """
    if "(?" in pattern:
        return []
    runs, run, depth, i = [], START, 0, 0
    while i < len(pattern):
        ch, quantified = pattern[i], False
        size = 1
        if ch == "\\":
            kind = pattern[i + 1 : i + 2]
            if kind.isalnum() and kind not in "dDsSwWbB" and not (kind in "pP" and pattern[i + 2 : i + 3] == "{"):
                return []
            size = 2
        elif ch == "[":
            close = pattern.find("]", i + 2 + (pattern[i + 1 : i + 2] == "^"))
            if close < 0 or "&&" in pattern[i:close] or "[" in pattern[i + 1 : close] or "\\" in pattern[i:close]:
                return []
            size = close - i + 1
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "|" and depth == 0:
            return []
        elif ch == "{":
            close = pattern.find("}", i)
            size = close - i + 1 if close > 0 else 1
        following = pattern[i + size : i + size + 1]
        quantified = following in ("*", "?", "+", "{") and following != ""
        if depth == 0 and ch.isalnum() and not quantified:
            run += ch
        else:
            if depth == 0 and ch.isalnum() and following == "+":
                run += ch  # once at least, and what follows need not be next to it
            runs.append(run)
            run = ""
        i += size
    return [r for r in [*runs, run + END] if r]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _runs(kinds, texts):
    found = []
    for kind, text in zip(kinds.to_pylist(), texts.to_pylist()):
        if kind == "wildcard":
            parts = re.split(r"[*?]+", text)
            parts[0], parts[-1] = START + parts[0], parts[-1] + END
            found.append(parts)
        else:
            found.append(required_runs(text))
    return pa.array(found, pa.list_(pa.string()))


def shaped_terms(vocabulary: Vocabulary, patterns: DataFrame) -> DataFrame:
    """(IDENTITY, bucket, term): terms that a wildcard or regex pattern fits.

    Terms are looked up by a pattern's rarest gram, tried on its next rarest ones where
    they are met, and then by the pattern itself. A gram that no term has ends the search.
    Patterns without a gram meet every part of the ordered dictionary in its own task.
    """
    asked = patterns.select(*IDENTITY, "text", _runs("kind", "text").alias("runs"))
    asked = durable(asked.withColumn("grams", F.array_distinct(F.flatten(F.transform("runs", grams_of)))).drop("runs"))
    probes = asked.select(*IDENTITY, F.explode("grams").alias("gram")).join(vocabulary.gram_stats, ["field", "gram"], "left")
    probes = probes.withColumn("terms", F.coalesce("terms", F.lit(0)))
    probes = top_k(probes, IDENTITY, [F.col("terms").asc(), F.col("gram").asc()], PROBES)
    probes = probes.groupBy(*IDENTITY).agg(F.min_by("gram", "rank").alias("gram"), F.collect_list("gram").alias("probes"))
    probes = handed_out(probes.join(asked.select(*IDENTITY, "text"), IDENTITY), HANDED_OUT)
    marked = F.concat(F.lit(START), "term", F.lit(END))
    held = vocabulary.grams.join(probes, ["field", "gram"]).where(F.forall("probes", lambda gram: marked.contains(gram)))
    held = held.select(*IDENTITY, "bucket", "term", "text")
    # Without a gram: one row for each part of the field.
    bare = asked.where(F.size("grams") == 0).select(*IDENTITY, "text").join(vocabulary.points.select("field", "part"), "field")
    every = vocabulary.ordered.join(bare, ["field", "part"]).select(*IDENTITY, "bucket", "term", "text")
    regex = F.when(F.col("kind") == "wildcard", _wildcard(F.col("text"))).otherwise(F.concat(F.lit("^(?:"), "text", F.lit(")$")))
    return held.unionByName(every).where(F.rlike("term", regex)).select(*IDENTITY, "bucket", "term")


def ranged_terms(vocabulary: Vocabulary, patterns: DataFrame) -> DataFrame:
    """(IDENTITY, bucket, term): terms of a range, both ends included, or with a prefix.

    The points of the parts, one row for each, say which parts a pattern lies in;
    only those are read.
    """
    upper = F.when(F.col("kind") == "prefix", F.concat("text", F.lit(LAST))).otherwise(F.col("upper"))
    asked = patterns.select(*IDENTITY, "text", upper.alias("upto"))
    points = vocabulary.points.select("field", "part", "first", "last")
    lying = durable(asked.join(points, "field").where((F.col("first") <= F.col("upto")) & (F.col("last") >= F.col("text"))).drop("first", "last"))
    # At most as many numbers as the dictionary has parts.
    parts = [r["part"] for r in lying.select("part").distinct().collect()]
    rows = vocabulary.ordered.where(F.col("part").isin(parts)).join(lying, ["field", "part"])
    return rows.where(F.col("term").between(F.col("text"), F.col("upto"))).select(*IDENTITY, "bucket", "term")


def looked_up(vocabulary: Vocabulary, patterns: DataFrame) -> DataFrame:
    """(IDENTITY, bucket, term, apart) of all patterns; ``apart`` is 0 for all but fuzzy ones."""
    patterns = durable(patterns.where(F.col("kind").isin(*PATTERNS)))
    kinds = {r["kind"] for r in patterns.select("kind").distinct().collect()}
    parts = [fuzzy_terms(vocabulary, patterns.where("kind = 'fuzzy'"))]
    if kinds & {"wildcard", "regex"}:
        parts.append(shaped_terms(vocabulary, patterns.where("kind IN ('wildcard', 'regex')")).withColumn("apart", F.lit(0)))
    if kinds & {"prefix", "range"}:
        parts.append(ranged_terms(vocabulary, patterns.where("kind IN ('prefix', 'range')")).withColumn("apart", F.lit(0)))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def dictionary_terms(vocabulary: Vocabulary, patterns: DataFrame) -> DataFrame:
    """The terms of each pattern clause as clause terms, as ``patterns.pattern_terms`` has them."""
    found = looked_up(vocabulary, patterns).withColumn("matched", F.lit(True))
    asked = patterns.where(F.col("kind").isin(*PATTERNS)).select(*IDENTITY, "occur", "boost", "text", "year_from", "year_to")
    rows = asked.join(found, IDENTITY, "left")
    close = 1 - F.col("apart") / F.greatest(F.lit(1), F.least(F.length("term"), F.length("text")))
    weight = F.when(F.col("matched") & (F.col("kind") == "fuzzy"), F.col("boost") * F.greatest(close, F.lit(0.0))).otherwise(F.col("boost"))
    return rows.select(
        *IDENTITY, F.lit(0).alias("sub"), "occur",
        F.coalesce("bucket", F.lit(0)).alias("bucket"), "term",
        F.lit(0).alias("off"), F.lit(1).alias("size"), weight.alias("boost"), F.lit(0).alias("slop"),
        "year_from", "year_to",
        F.lit(True).alias("constant"),
    )
