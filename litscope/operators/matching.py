"""Match clause terms against the index and score documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.operators.clauses import CLAUSE, IDENTITY, PATTERNS, clause_table, clause_terms, group_bit, pattern_rows, repeated, requirements
from litscope.operators.patterns import pattern_terms
from litscope.operators.vocabulary import Vocabulary, dictionary_terms
from litscope.session import durable, handed_out
from litscope.sources.store import Index

# Term saturation and length normalisation of the ranking.
K1, B = 1.2, 0.75

# Scores are rounded so that the order of additions cannot change a rank.
SCORE_DIGITS = 9

# What a pattern's hits depend on; clauses that share it are one pattern.
PATTERN = ["field", "kind", "text", "upper", "edits", "year_from", "year_to"]
# Rows of a batch's patterns, each of some 100 bytes, up to which all tasks get them.
HANDED_OUT = 200_000
# Bits that tell which (clause, document) pairs may hold a phrase, kept as numbers of 64.
BITS = 1 << 27


def pruned(table: DataFrame, terms: DataFrame) -> DataFrame:
    """Limit an index table to the partitions asked for, and to the span of the terms.

    There are at most fields x buckets places to list, whatever the number of terms.
    """
    places = terms.groupBy("field", "bucket").agg(F.min("term").alias("least"), F.max("term").alias("most")).collect()
    for column in ("field", "bucket"):
        table = table.where(F.col(column).isin(sorted({p[column] for p in places})))
    bounds = [v for p in places for v in (p["least"], p["most"]) if v is not None]
    return table.where(F.col("term").between(min(bounds), max(bounds))) if bounds else table.where(F.lit(False))


def weighted_terms(index: Index, terms: DataFrame) -> DataFrame:
    """Clause terms with their rarity; clauses that cannot match are gone.

    A phrase weighs the sum of its terms' rarities. ``lead`` marks its rarest
    term. The result grows with the queries, not with the corpus. Terms of a
    pattern only need the mean length: however many they are, they meet no window.
    """
    fields = F.broadcast(index.field_stats)  # one row per field
    out = [
        "field", "bucket", "term", *(c for c in CLAUSE if c != "field"), "occur", "off", "size", "slop",
        "year_from", "year_to", "constant", "weight", "mean_length", "lead",
    ]
    plain = terms.where(~F.col("constant"))
    rows = pruned(index.term_stats, plain).join(plain, ["field", "bucket", "term"]).join(fields, "field")
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    window = Window.partitionBy(*CLAUSE)
    rows = rows.withColumn("idf", idf).withColumns(
        {
            "weight": F.col("boost") * F.sum("idf").over(window),
            "found": F.count("*").over(window),
            "lead": F.row_number().over(window.orderBy("df", "off")) == 1,
        }
    )
    scored = rows.where(F.col("found") == F.col("size")).select(*out)
    fixed = terms.where(F.col("constant") & F.col("term").isNotNull()).join(fields, "field")
    return scored.unionByName(fixed.withColumns({"weight": F.col("boost"), "lead": F.lit(True)}).select(*out))


def term_matches(index: Index, weighted: DataFrame) -> DataFrame:
    """Postings of the clause terms within each query's years."""
    rows = pruned(index.postings, weighted).join(weighted, ["field", "bucket", "term"])
    last_year = F.coalesce("year_to", "year_from")
    rows = rows.where(F.col("year_from").isNull() | F.col("year").between(F.col("year_from"), last_year))
    norm = K1 * (1 - B + B * F.col("length") / F.col("mean_length"))
    return rows.withColumn("norm", norm)


def _part(freq: Column) -> Column:
    scored = F.col("weight") * freq / (freq + F.col("norm"))
    return F.when(F.col("constant"), F.col("weight")).otherwise(scored)


def single_hits(index: Index, weighted: DataFrame) -> DataFrame:
    """Clauses of one term: every posting is a hit, scored where it is read."""
    rows = term_matches(index, weighted.where((F.col("size") == 1) & ~F.col("constant")))
    return rows.select("query_id", "doc_id", "grp", "occur", _part(F.col("tf")).alias("part"))


def own_patterns(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clause terms of constant score as ``constant_hits`` takes them: each clause is a pattern of its own."""
    roles = [*CLAUSE, "occur", "year_from", "year_to"]
    clauses = durable(terms.where("constant").select(*roles).distinct().withColumn("pattern", F.monotonically_increasing_id()))
    found = terms.where(F.col("constant") & F.col("term").isNotNull()).join(clauses.select(*CLAUSE, "pattern"), CLAUSE)
    return found.select("pattern", "field", "bucket", "term", F.col("boost").alias("factor")), clauses.withColumn("boost", F.lit(1.0))


def shared_patterns(index: Index, clauses: DataFrame, vocabulary: Vocabulary | None) -> tuple[DataFrame, DataFrame]:
    """(pattern, field, bucket, term, factor) of the distinct patterns, and the clauses with the pattern of each.

    However many clauses ask for it, a pattern is looked up once.
    """
    clauses = clauses.where(F.col("kind").isin(*PATTERNS))
    distinct = durable(clauses.select(*PATTERN).distinct().withColumn("pattern", F.monotonically_increasing_id()))
    asked = clause_table(distinct.withColumn("query_id", F.col("pattern").cast("string")))
    terms = dictionary_terms(vocabulary, asked) if vocabulary else pattern_terms(index, asked)
    found = terms.where(F.col("term").isNotNull()).select(F.col("query_id").cast("long").alias("pattern"), "field", "bucket", "term", F.col("boost").alias("factor"))
    numbered = distinct.withColumnsRenamed({c: f"_{c}" for c in PATTERN})
    same = F.lit(True)
    for c in PATTERN:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return found, clauses.join(numbered, same).select(*IDENTITY, "occur", "boost", "year_from", "year_to", "pattern")


def constant_hits(index: Index, found: DataFrame, asked: DataFrame) -> DataFrame:
    """Clauses that stand for many terms: a document counts once per clause, by its best term.

    ``found`` are (pattern, field, bucket, term, factor), ``asked`` clauses with their
    pattern. Terms that meet the same patterns are one set, and postings travel
    once, by document, as the number of their set. There they become the patterns that the
    document meets, and last the clauses of these: however many clauses a term
    meets, no row of a clause travels before it is added up. ``n`` counts clauses.
    """
    spans = asked.select("pattern", "year_from", "year_to").distinct()
    found = found.join(spans, "pattern").select("field", "bucket", "term", F.struct("pattern", "factor", "year_from", "year_to").alias("p"))
    met = durable(found.groupBy("field", "bucket", "term").agg(F.array_sort(F.collect_list("p")).alias("patterns")))
    sets = durable(met.select("patterns").distinct().withColumn("set", F.monotonically_increasing_id()))
    terms = durable(met.join(sets, "patterns").select("field", "bucket", "term", "set"))
    sets = handed_out(sets.select("set", F.inline("patterns")), HANDED_OUT)
    up, down = F.greatest("boost", F.lit(0.0)), F.least("boost", F.lit(0.0))
    asked = asked.groupBy("pattern", "query_id", "grp", "occur").agg(F.sum(up).alias("up"), F.sum(down).alias("down"), F.count("*").alias("n"))
    asked = handed_out(asked, HANDED_OUT)

    rows = pruned(index.postings, terms).join(terms, ["field", "bucket", "term"]).select("doc_id", "year", "set")
    rows = rows.repartition("doc_id").join(sets, "set")
    rows = rows.where(F.col("year_from").isNull() | F.col("year").between(F.col("year_from"), F.coalesce("year_to", "year_from")))
    best = rows.groupBy("doc_id", "pattern").agg(F.max("factor").alias("most"), F.min("factor").alias("least"))
    # A boost below zero makes the least factor the best.
    part = F.col("up") * F.col("most") + F.col("down") * F.col("least")
    return best.join(asked, "pattern").select("query_id", "doc_id", "grp", "occur", part.alias("part"), "n")


def _maybe(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose hash has its bit set by one of the keys: none of theirs is left out, and few others stay."""
    place = F.pmod(F.xxhash64(*by), F.lit(BITS))
    number, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    bits = keys.select(number.alias("number"), bit.alias("bit")).groupBy("number").agg(F.bit_or("bit").alias("bits"))
    met = rows.withColumns({"number": number, "bit": bit}).join(F.broadcast(bits), "number")
    return met.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).drop("number", "bit", "bits")


def phrase_hits(index: Index, weighted: DataFrame, sloppy: bool = False) -> DataFrame:
    """Exact phrases: all terms stand at the same start position plus offset.

    Only documents with the phrase's rarest term can hold it, so those are found
    first and the long postings of its common terms are cut down to them where they
    are read, by bits of their hashes, and then for certain. What a clause is known by
    does not travel, only its number; positions of a (clause, document) pair meet in one
    shuffle, which the next groupings share.
    """
    phrases = weighted.where((F.col("size") > 1) & ~F.col("constant"))
    roles = ["query_id", "grp", "occur", "size", "slop", "constant", "weight"]
    clauses = phrases.select(*CLAUSE, *(c for c in roles if c not in CLAUSE)).distinct()
    clauses = durable(clauses.withColumn("clause", F.monotonically_increasing_id()))
    phrases = durable(phrases.join(clauses.select(*CLAUSE, "clause"), CLAUSE))
    clauses = handed_out(clauses.select("clause", *roles), HANDED_OUT)
    pair = ["clause", "doc_id"]
    leads = durable(term_matches(index, phrases.where("lead")).where(F.col("doc_id").isNotNull()).select(*pair))
    rows = _maybe(term_matches(index, phrases).select(*pair, "off", "norm", "positions"), leads, pair)
    # A semi-join would be moved in front of the bits.
    rows = rows.join(leads.distinct(), pair).select(*pair, "off", "norm", F.explode("positions").alias("pos"))
    rows = rows.withColumn("start", F.col("pos") - F.col("off"))
    known = [*pair, *roles, "norm"]
    if sloppy:
        hits = _sloppy_frequency(rows.join(clauses, "clause"), [c for c in known if c != "slop"])
    else:
        starts = rows.groupBy(*pair, "norm", "start").agg(F.count("*").alias("n")).join(clauses, "clause").where(F.col("n") == F.col("size"))
        hits = starts.groupBy(*known).agg(F.count("*").alias("freq"))
    return hits.select("query_id", "doc_id", "grp", "occur", _part(F.col("freq")).alias("part"))


def sloppy_sum(places: list[dict], size: int, slop: int) -> float:
    """The sum of 1 / (1 + width) over the windows of up to ``slop`` that hold a phrase.

    ``places`` are (start, off) in order of start. A window ends at a place and
    begins as late as it can; no window holds another that ends where it ends.
    """
    latest: dict[int, int] = {}
    total, before = 0.0, None
    for k, place in enumerate(places):
        latest[place["off"]] = place["start"]
        more = k + 1 < len(places) and places[k + 1]["start"] == place["start"]
        if len(latest) == size and not more:
            begin = min(latest.values())
            width = place["start"] - begin
            # The same beginning belongs to the window that ended first.
            if width <= slop and begin != before:
                total += 1 / (1 + width)
                before = begin
    return total


@F.arrow_udf(T.DoubleType())
def _sloppy(places, size, slop):
    rows = zip(places.to_pylist(), size.to_pylist(), slop.to_pylist())
    return pa.array([sloppy_sum(*row) for row in rows], pa.float64())


def _sloppy_frequency(rows: DataFrame, clause: list[str]) -> DataFrame:
    """Phrases whose offset-adjusted positions lie up to ``slop`` apart.

    Positions of one phrase in one document meet, in order, and one window slides
    over them. Exact occurrences have width 0 and count 1 each.
    """
    placed = rows.groupBy(*clause, "slop").agg(F.sort_array(F.collect_list(F.struct("start", "off"))).alias("places"))
    found = placed.withColumn("freq", _sloppy("places", "size", "slop"))
    return found.where("freq > 0")


def document_scores(hits: DataFrame, needs: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of documents that meet all roles of a query.

    A hit stands for ``n`` clauses if it says so, else for one.
    """
    n = F.col("n") if "n" in hits.columns else F.lit(1)
    excluded, optional = F.col("occur") == "must_not", F.col("occur") == "should"
    flagged = hits.select(
        "query_id",
        "doc_id",
        F.when(excluded, 0.0).otherwise(F.col("part")).alias("part"),
        F.when(F.col("occur") == "must", n).otherwise(0).alias("met"),
        F.when(optional, group_bit(F.col("grp"))).otherwise(F.lit(0).cast("long")).alias("seen"),
        excluded.alias("barred"),
    )
    per_doc = flagged.groupBy("query_id", "doc_id").agg(
        F.sum("part").alias("score"),
        F.sum("met").alias("met"),
        F.bit_or("seen").alias("seen"),
        F.max("barred").alias("barred"),
    )
    joined = per_doc.join(needs, "query_id").where(
        ~F.col("barred")
        & (F.col("met") == F.col("musts"))
        & (F.col("seen").bitwiseAND(F.col("groups")) == F.col("groups"))
    )
    # A year range is one more required clause, of constant score 1.
    score = F.col("score") + F.when(F.col("year_from").isNotNull(), 1.0).otherwise(0.0)
    return joined.select("query_id", "doc_id", F.round(score, SCORE_DIGITS).alias("score"))


def search(index: Index, terms: DataFrame, sloppy: bool = False, patterned: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """All hits of all queries: (query_id, doc_id, score).

    ``terms`` has a row for each pattern clause too; ``patterned`` are the patterns and their
    clauses, as ``constant_hits`` takes them, and else come from ``terms``.
    """
    terms = durable(terms)
    weighted = durable(weighted_terms(index, terms))
    alone, constant = F.col("size") == 1, F.col("constant")
    has = weighted.agg(
        *(F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in (("phrase", ~alone & ~constant), ("pattern", constant), ("single", alone & ~constant)))
    ).first()
    if patterned is None and has["pattern"]:
        patterned = own_patterns(terms)
    parts = []
    if has["phrase"]:
        parts.append(phrase_hits(index, weighted, sloppy).withColumn("n", F.lit(1).cast("long")))
    if patterned is not None:
        parts.append(constant_hits(index, *patterned))
    if not parts or has["single"]:
        parts.append(single_hits(index, weighted).withColumn("n", F.lit(1).cast("long")))
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.unionByName(more)
    return document_scores(hits, requirements(terms))


def answer_clauses(
    index: Index, clauses: DataFrame, strict_gaps: bool = True, sloppy: bool = False, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """Hits of a clause table, patterns included. Clauses that cannot be told apart are an error.

    Patterns are looked up in ``vocabulary`` if there is one.
    """
    clauses = durable(clauses)
    twice = repeated(clauses).limit(1).collect()
    if twice:
        raise ValueError(f"two clauses share {twice[0].asDict()}: give them clause_ids of their own")
    terms = clause_terms(clauses, index.analysis, index.buckets, strict_gaps)
    patterned = None
    if not clauses.where(F.col("kind").isin(*PATTERNS)).isEmpty():
        patterned = shared_patterns(index, clauses, vocabulary)
        terms = terms.unionByName(pattern_rows(clauses))
    return search(index, terms, sloppy, patterned)
