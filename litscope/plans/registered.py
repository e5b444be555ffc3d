"""The registered queries: each runs over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litscope.functions.stem import stem_terms
from litscope.functions.text import SIMPLE_WORD, Analysis, candidate_phrases, words
from litscope.operators import clauses as C
from litscope.operators import phrases as K
from litscope.operators import postings as P
from litscope.operators import topic_join, topics, trends
from litscope.operators.bitmaps import Bitmaps, documents_in, write_bitmaps
from litscope.operators.bounds import Bounds, write_bounds
from litscope.operators.patterns import Pattern, pattern_clauses
from litscope.operators.phrase_batch import phrase_batch
from litscope.operators.vocabulary import MOST_EDITS, Vocabulary, fuzzy_terms, ranged_terms, shaped_terms, write_vocabulary
from litscope.plans import search as S
from litscope.plans import trends as R
from litscope.plans.trends import searched_titles
from litscope.session import durable, local_table, shared_folder, ship_package
from litscope.sources.entities import entity_texts
from litscope.sources.records import judged_records, parsed_records, read_dump, split_records
from litscope.sources.store import Index, build_index, flat_records, write_hits
from litscope.sources.tables import documents_corpus, read_table, spread

# SQL engines without look-around or a stemmer can follow this chain exactly.
PLAIN = Analysis().plain()

START, END = 2014, 2018

# A text between tags that holds one of two entities.
ENTITY_TEXT = "(?<![^<>])[^<>]*&(?:middot|copy);[^<>]*"

_indexes: dict[tuple[str, str], Index] = {}


def index_for(spark: SparkSession, folder: str) -> Index:
    """The index of a table folder, built on first use in the shared folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _indexes:
        name = folder.strip("/").replace("/", "_")
        path = f"{shared_folder(spark)}/litscope-index-{key[0]}/{name}"
        _indexes[key] = build_index(_texts(spark, folder), path, analysis=PLAIN, keep_corpus=False)
    return _indexes[key]


_made: dict[tuple, object] = {}


def _own_path(spark: SparkSession, folder: str, kind: str) -> str:
    """A path in the shared folder for what this application makes of a table folder."""
    name = folder.strip("/").replace("/", "_").replace(":", "_")
    return f"{shared_folder(spark)}/litscope-{kind}-{spark.sparkContext.applicationId}/{name}"


def _once(spark: SparkSession, folder: str, kind: str, make: Callable[[str], object]):
    """What ``make`` stores at a path of its own in the shared folder, made on first use."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _made:
        _made[key] = make(_own_path(spark, folder, kind))
    return _made[key]


def title_index(spark: SparkSession, folder: str) -> Index:
    """An index of the texts alone, without positions."""

    def make(path: str) -> Index:
        return build_index(_texts(spark, folder), path, fields=("title",), analysis=PLAIN, keep_corpus=False, positions=False)

    return _once(spark, folder, "titles", make)


def bounds_for(spark: SparkSession, folder: str) -> Bounds:
    return _once(spark, folder, "bounds", lambda path: write_bounds(title_index(spark, folder), path))


def bitmaps_for(spark: SparkSession, folder: str) -> Bitmaps:
    return _once(spark, folder, "bitmaps", lambda path: write_bitmaps(title_index(spark, folder), path))


def vocabulary_for(spark: SparkSession, folder: str) -> Vocabulary:
    return _once(spark, folder, "vocabulary", lambda path: write_vocabulary(title_index(spark, folder), path, stored=False))


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus laid out for work on its text."""
    return spread(documents_corpus(spark, folder), "doc_id")


def _title_terms(spark: SparkSession, folder: str) -> DataFrame:
    return P.document_terms(_texts(spark, folder), ["title"], PLAIN)


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def record_count_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return documents_corpus(spark, folder).groupBy("type").agg(F.count("*").alias("records"))


def tokens_title(spark: SparkSession, folder: str) -> DataFrame:
    return P.occurrences(_title_terms(spark, folder)).select("doc_id", "pos", "term")


def tokens_english(spark: SparkSession, folder: str) -> DataFrame:
    """Words with inner apostrophes, dots and separators; possessives are put into the texts, and come off."""
    owned = F.regexp_replace("title", "([a-z])er ", "$1er's ")
    terms = P.document_terms(_texts(spark, folder).withColumn("title", owned), ["title"], Analysis(stem=False))
    return P.occurrences(terms).select("doc_id", "pos", "term")


def tokens_scripts(spark: SparkSession, folder: str) -> DataFrame:
    """Words of texts whose vowels are written as ideographs, hiragana and katakana."""
    mixed = F.translate(F.lower("title"), "aeo", "漢ひカ")
    terms = P.document_terms(_texts(spark, folder).withColumn("title", mixed), ["title"], Analysis(stem=False))
    return P.occurrences(terms).select("doc_id", "pos", "term")


def tokens_simple(spark: SparkSession, folder: str) -> DataFrame:
    """Authors under the chain that keeps stop words and skips stemming."""
    analysis = replace(PLAIN, stem=True, simple_fields=("author", "key"))
    terms = P.document_terms(documents_corpus(spark, folder), ["author", "key"], analysis)
    return P.occurrences(terms).select("field", "doc_id", "pos", "term")


def postings_title(spark: SparkSession, folder: str) -> DataFrame:
    rows = P.postings(P.document_postings(_title_terms(spark, folder)))
    return rows.select("term", "doc_id", "tf", F.array_join("positions", ",").alias("positions"))


def term_stats(spark: SparkSession, folder: str) -> DataFrame:
    return P.term_stats(P.document_postings(_title_terms(spark, folder))).select("term", "df")


def doc_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return P.document_lengths(_title_terms(spark, folder)).select("doc_id", "length")


def field_stats(spark: SparkSession, folder: str) -> DataFrame:
    terms = P.document_terms(_texts(spark, folder), ["title", "author", "key", "booktitle"], PLAIN)
    return P.field_stats(terms).withColumn("mean_length", F.round("mean_length", 6))


def year_range(spark: SparkSession, folder: str) -> DataFrame:
    return S.year_hits(documents_corpus(spark, folder), 2015, 2017).select("doc_id", "score")


def year_single(spark: SparkSession, folder: str) -> DataFrame:
    return S.year_hits(documents_corpus(spark, folder), 2016).select("doc_id", "score")


def exact_field(spark: SparkSession, folder: str) -> DataFrame:
    return S.exact_hits(documents_corpus(spark, folder), "type", "article").select("doc_id", "score")


def year_batch(spark: SparkSession, folder: str) -> DataFrame:
    spans = read_table(spark, folder, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        (F.lit(2012) + F.col("item_id") % 7).cast("int").alias("year_from"),
        (F.lit(2012) + F.col("item_id") % 11).cast("int").alias("year_to"),
    )
    hits = S.year_hits_batch(documents_corpus(spark, folder), spans, S.DEFAULT_TOP_K)
    return _rounded(S.ranked(hits, S.DEFAULT_TOP_K))


def _clauses(spark: SparkSession, *rows: tuple) -> DataFrame:
    names = "query_id string, grp int, clause_id int, field string, occur string, kind string, text string"
    return C.clause_table(local_table(spark, list(rows), names))


def _answer(spark: SparkSession, folder: str, clauses: DataFrame, **options) -> DataFrame:
    return _rounded(S.search_clauses(index_for(spark, folder), clauses, **options))


def search_term(spark: SparkSession, folder: str) -> DataFrame:
    return _answer(spark, folder, _clauses(spark, ("q", 0, 0, "title", "must", "text", "eriner")))


def search_should(spark: SparkSession, folder: str) -> DataFrame:
    rows = [("q", 0, i, "title", "should", "text", t) for i, t in enumerate(["eriner", "thanea", "heed"])]
    return _answer(spark, folder, _clauses(spark, *rows))


def search_must(spark: SparkSession, folder: str) -> DataFrame:
    rows = [("q", 0, 0, "title", "must", "text", "er"), ("q", 0, 1, "title", "must", "text", "re"),
            ("q", 0, 2, "title", "should", "text", "thanea")]
    return _answer(spark, folder, _clauses(spark, *rows))


def search_must_not(spark: SparkSession, folder: str) -> DataFrame:
    rows = [("q", 0, 0, "title", "must", "text", "heed"), ("q", 0, 1, "title", "must_not", "text", "eash")]
    return _answer(spark, folder, _clauses(spark, *rows))


def search_phrase(spark: SparkSession, folder: str) -> DataFrame:
    return _answer(spark, folder, C.keyword_clauses(S.one_query(spark, "eriner thanea")))


def search_phrase_gap(spark: SparkSession, folder: str) -> DataFrame:
    """A phrase with a stop word inside keeps the word's place open."""
    return _answer(spark, folder, C.keyword_clauses(S.one_query(spark, "attion to thanedble the anea")))


def search_phrase_slop(spark: SparkSession, folder: str) -> DataFrame:
    clauses = _clauses(spark, ("q", 0, 0, "title", "must", "text", "thanedble eriner")).withColumn("slop", F.lit(3))
    return _answer(spark, folder, clauses, sloppy=True)


def search_boost(spark: SparkSession, folder: str) -> DataFrame:
    rows = [("q", 0, 0, "title", "should", "text", "eriner"), ("q", 0, 1, "title", "should", "text", "thanea")]
    boosted = F.when(F.col("clause_id") == 1, 2.5).otherwise(1.0)
    return _answer(spark, folder, _clauses(spark, *rows).withColumn("boost", boosted))


def search_author_any(spark: SparkSession, folder: str) -> DataFrame:
    return _answer(spark, folder, C.author_clauses(S.one_query(spark, "a3 b7")))


def search_venue(spark: SparkSession, folder: str) -> DataFrame:
    return _answer(spark, folder, C.venue_clauses(S.one_query(spark, "src3")))


def search_return_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every hit of a venue and its rank, numbered without a single-task sort."""
    return _answer(spark, folder, C.venue_clauses(S.one_query(spark, "src3")), k=None)


def search_multi(spark: SparkSession, folder: str) -> DataFrame:
    hits = S.Library(index_for(spark, folder)).hits(2014, 2016, venue="src3 src7 src11", keyword="er", author="a3 a5 b7 b9 b11")
    return _rounded(S.ranked(hits))


def _benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")


def search_batch(spark: SparkSession, folder: str) -> DataFrame:
    """All benchmark texts as queries in one job: any of their words may match."""
    return _answer(spark, folder, C.any_clauses(_benchmark_queries(spark, folder), "title", C.TITLE))


def search_batch_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """All benchmark texts as keyword queries: commas part their phrases."""
    return _answer(spark, folder, C.keyword_clauses(_benchmark_queries(spark, folder)))


def search_known_items(spark: SparkSession, folder: str) -> DataFrame:
    """Every key phrase of the documents as a query of its own, searched for in all of them."""
    texts = _texts(spark, folder)
    phrases = texts.select(F.explode(candidate_phrases(F.col("title"))).alias("text")).distinct()
    hits = phrase_batch(texts, phrases.select(F.col("text").alias("query_id"), "text"), PLAIN, k=S.DEFAULT_TOP_K, distinct=True)
    return _rounded(hits)


def posting_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """The most that a frequent word adds to a document's score, block by block."""
    return bounds_for(spark, folder).table.select("term", "block", "docs", F.round("bound", 6).alias("bound"))


def search_top_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """All benchmark texts as queries of any of their words, scoring only what bounds leave."""
    clauses = C.any_clauses(_benchmark_queries(spark, folder), "title", C.TITLE)
    return _rounded(S.search_best(title_index(spark, folder), bounds_for(spark, folder), clauses))


def posting_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of frequent words, from bitmaps."""
    rows = bitmaps_for(spark, folder).table.select("term", "run", documents_in("run", "bits").alias("ids"))
    total = F.aggregate("ids", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return rows.select("term", "run", F.size("ids").alias("docs"), F.array_min("ids").alias("first"), F.array_max("ids").alias("last"), total.alias("total"))


def search_three_musts(spark: SparkSession, folder: str) -> DataFrame:
    """Of each benchmark text, the rarest, the middle and the commonest word: all three must occur."""
    found = _benchmark_queries(spark, folder).select("query_id", F.explode(F.array_distinct(words(F.col("text"), SIMPLE_WORD))).alias("text"))
    index = title_index(spark, folder)
    rated = found.join(index.term_stats.select(F.col("term").alias("text"), "df"), "text")
    rated = rated.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("df", "text"))).alias("w"))
    places = F.array_distinct(F.array(F.lit(0), F.floor((F.size("w") - 1) / 2).cast("int"), F.size("w") - 1))
    rows = rated.select("query_id", F.explode(F.transform(places, lambda i: F.struct(i.alias("clause_id"), F.get("w", i).text.alias("text")))).alias("c"))
    clauses = rows.select("query_id", "c.clause_id", "c.text").withColumns({"grp": F.lit(C.TITLE), "field": F.lit("title"), "kind": F.lit("exact")})
    return _rounded(S.search_conjunctions(index, bitmaps_for(spark, folder), C.clause_table(clauses)))


def _benchmark_words(spark: SparkSession, folder: str) -> DataFrame:
    texts = read_table(spark, folder, "benchmark").select(F.explode(words(F.col("text"), SIMPLE_WORD)).alias("word"))
    return texts.distinct()


def _word_patterns(spark: SparkSession, folder: str, *kinds: tuple) -> DataFrame:
    """(kind, text, upper) of every benchmark word, as clauses of queries of their own."""
    listed = F.array(*(F.struct(F.lit(k).alias("kind"), t.alias("text"), (F.lit(None).cast("string") if u is None else u).alias("upper")) for k, t, u in kinds))
    rows = _benchmark_words(spark, folder).select(F.col("word").alias("query_id"), F.inline(listed))
    return C.clause_table(rows.withColumns({"field": F.lit("title"), "edits": F.lit(MOST_EDITS)}))


def fuzzy_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark word with the words of the documents up to two edits from it."""
    found = fuzzy_terms(vocabulary_for(spark, folder), _word_patterns(spark, folder, ("fuzzy", F.col("word"), None)))
    return found.select(F.col("query_id").alias("word"), "term", "apart")


def shaped_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Words that hold a benchmark word's inner letters, or share its start and its ending."""
    inner = F.concat(F.lit("*"), F.substring("word", 2, 3), F.lit("*"))
    outer = F.concat(F.substring("word", 1, 2), F.lit("[a-z]*"), F.right("word", F.lit(3)))
    clauses = _word_patterns(spark, folder, ("wildcard", inner, None), ("regex", outer, None)).where(F.length("query_id") >= 4)
    return shaped_terms(vocabulary_for(spark, folder), clauses).select("kind", F.col("query_id").alias("word"), "term")


def ranged_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """How many words lie between a benchmark word and its last continuation, or share its first four letters."""
    clauses = _word_patterns(
        spark, folder, ("range", F.col("word"), F.concat("word", F.lit("z"))), ("prefix", F.substring("word", 1, 4), None)
    )
    found = ranged_terms(vocabulary_for(spark, folder), clauses).groupBy("kind", F.col("query_id").alias("word"))
    return found.agg(F.count("*").alias("terms"), F.min("term").alias("first"), F.max("term").alias("last"))


def hits_with_records(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of the batch with stored fields and the labels of their documents."""
    hits = search_batch(spark, folder)
    corpus = documents_corpus(spark, folder).select("doc_id", "key", "year", F.array_join("author", ", ").alias("authors"))
    labels = read_table(spark, folder, "labels")
    return S.with_records(hits, corpus).join(labels, "doc_id", "left")


def _pattern(spark: SparkSession, folder: str, *patterns: Pattern) -> DataFrame:
    return _answer(spark, folder, pattern_clauses(spark, list(patterns)))


def search_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return _pattern(spark, folder, Pattern("prefix", "erine"))


def search_wildcard(spark: SparkSession, folder: str) -> DataFrame:
    return _pattern(spark, folder, Pattern("wildcard", "er?n*sh"))


def search_regex(spark: SparkSession, folder: str) -> DataFrame:
    return _pattern(spark, folder, Pattern("regex", "th(an|in)e[ae]"))


def search_fuzzy(spark: SparkSession, folder: str) -> DataFrame:
    return _pattern(spark, folder, Pattern("fuzzy", "eriner"))


def search_term_range(spark: SparkSession, folder: str) -> DataFrame:
    return _pattern(spark, folder, Pattern("range", "thana", upper="thanz"), Pattern("range", "heea", upper="heed"))


def search_author_or_venue(spark: SparkSession, folder: str) -> DataFrame:
    """Any-word clauses over two fields of one group."""
    query = S.one_query(spark, "a3 src7")
    return _answer(spark, folder, C.any_clauses(query, "author", C.AUTHOR).unionByName(C.any_clauses(query, "booktitle", C.AUTHOR)))


def search_keyword_and_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """A keyword and a pattern, both required, with the ids they come with."""
    keyword = C.keyword_clauses(S.one_query(spark, "heed"))
    return _answer(spark, folder, keyword.unionByName(pattern_clauses(spark, [Pattern("prefix", "erine", clause_id=0)])))


def search_pattern_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Patterns made of all words of every benchmark text, the kinds in turn, any of which may match."""
    found = words(F.col("text"), SIMPLE_WORD)
    rows = read_table(spark, folder, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.posexplode(found).alias("clause_id", "word"))
    turn, start = F.col("clause_id") % 5, F.substring("word", 1, 3)
    shaped = F.concat(F.substring("word", 1, 2), F.lit("?*"), F.right("word", F.lit(1)))
    kind = F.get(F.array(*(F.lit(k) for k in ("prefix", "wildcard", "fuzzy", "range", "regex"))), turn)
    text = F.get(F.array(F.substring("word", 1, 4), shaped, F.col("word"), start, F.concat(F.substring("word", 1, 2), F.lit("(th|er)+"))), turn)
    upper = F.when(kind == "range", F.concat(start, F.lit("c")))
    clauses = rows.select("query_id", "clause_id", kind.alias("kind"), text.alias("text"), upper.alias("upper"))
    clauses = clauses.withColumns({"field": F.lit("title"), "occur": F.lit("should"), "edits": F.lit(1)})
    index, vocabulary = title_index(spark, folder), vocabulary_for(spark, folder)
    return _rounded(S.search_clauses(index, C.clause_table(clauses), vocabulary=vocabulary))


def _scope(spark: SparkSession, folder: str) -> DataFrame:
    return trends.venue_titles(_texts(spark, folder), START, END)


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return K.phrase_counts(_scope(spark, folder), ["venue", "year"])


def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(spark, folder)


def word_scores(spark: SparkSession, folder: str) -> DataFrame:
    return K.word_scores(_counts(spark, folder), ["venue", "year"]).withColumn("word_score", F.round("word_score", 6))


def phrase_scores(spark: SparkSession, folder: str) -> DataFrame:
    scope, counts = ["venue", "year"], durable(_counts(spark, folder))
    return K.phrase_scores(counts, K.word_scores(counts, scope), scope).withColumn("score", F.round("score", 6))


def _score6(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


def hotspots_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return _score6(trends.hotspots_by_year(_scope(spark, folder)))


def hotspots_filled(spark: SparkSession, folder: str) -> DataFrame:
    """A span wider than the data: years without phrases appear empty."""
    ranked = trends.hotspots_by_year(_scope(spark, folder), 1)
    return _score6(trends.fill_years(ranked, documents_corpus(spark, folder), START - 1, END + 1))


def hotspot_evolution(spark: SparkSession, folder: str) -> DataFrame:
    return _score6(trends.hotspot_evolution(_scope(spark, folder)))


def hotspot_series(spark: SparkSession, folder: str) -> DataFrame:
    return trends.hotspot_series(_scope(spark, folder), START, END)


def hotspot_table(spark: SparkSession, folder: str) -> DataFrame:
    """The series with a column per year."""
    table = trends.series_table(hotspot_series(spark, folder), START, END)
    return table.withColumnsRenamed({str(y): f"y{y}" for y in range(START, END + 1)})


def hotspots_blocked(spark: SparkSession, folder: str) -> DataFrame:
    """Hotspots of titles that each hold a phrase of the block list and one that is not on it."""
    held = F.concat("title", F.lit("\n"), "booktitle", F.lit(" case study. "), "booktitle", F.lit(" new venue. "))
    return _score6(trends.hotspots_by_year(trends.venue_titles(_texts(spark, folder).withColumn("title", held), START, END)))


def searched_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    """Hotspots of whatever a venue search finds, as one scope per year."""
    titles = searched_titles(S.Library(index_for(spark, folder)), "src3 src7", START, END)
    return _score6(trends.hotspots_by_year(titles))


def searched_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """Evolution of whatever a venue search finds, in another letter case, over a span wider than the data."""
    library = S.Library(index_for(spark, folder))
    return _score6(R.hotspot_evolution(library, START - 1, END, "SRC3 src7", fill=True))


def searched_authors(spark: SparkSession, folder: str) -> DataFrame:
    """Leading authors of a topic among the records a venue search finds, in order."""
    library = S.Library(index_for(spark, folder))
    return R.leading_authors(library, "eriner thanea", START, END, venue="src3 src7 src11 src12")


def pivot_authors_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Only full matches: all words of the topic, or of the phrase, are shared."""
    return topics.pivot_authors(_texts(spark, folder), ["eriner thanea"], START, END, threshold=100)


def pivot_authors_fuzzy(spark: SparkSession, folder: str) -> DataFrame:
    return topics.pivot_authors(_texts(spark, folder), ["eriner thanea", "heed thhend"], START, END)


def topic_authors(spark: SparkSession, folder: str) -> DataFrame:
    """Every key phrase of the benchmark as a topic, and who writes about it how often."""
    topics = read_table(spark, folder, "benchmark").select(F.explode(candidate_phrases(F.col("text"))).alias("topic")).distinct()
    return topic_join.topic_authors(_texts(spark, folder), topics, START, END)


def page_key_tokens(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(read_table(spark, folder, "pages").select("page_id", "url"), "page_id")
    return pages.select("page_id", F.posexplode(words(F.col("url"), SIMPLE_WORD)).alias("pos", "term"))


def stemmed_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Every word with its stem; words are counted first, so each is stemmed once."""
    documents = spread(read_table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    rows = documents.select(F.explode(F.array_distinct(words(F.col("text"), SIMPLE_WORD))).alias("word"))
    counted = rows.groupBy("word").agg(F.count("*").alias("df"))
    return counted.withColumn("stem", F.get(stem_terms(F.array("word")), F.lit(0))).select("word", "stem", "df")


def record_parse(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as XML chunks of a dump, read back into records."""

    rows = _texts(spark, folder)
    chunk = F.concat(
        F.lit('2020-01-01" key="'), "key", F.lit('">\n'),
        F.array_join(F.transform("author", lambda a: F.concat(F.lit("<author>"), a, F.lit("</author>"))), "\n"),
        F.lit("<title><i>"), _escaped(F.col("title")), F.lit("</i></title>\n<year>"), F.col("year").cast("string"),
        F.lit("</year><booktitle>"), "booktitle", F.lit("</booktitle>\n</inproceedings>\n<inproceedings "),
    )
    corpus, _ = split_records(judged_records(parsed_records(rows.select(chunk.alias("value")))))
    return corpus.select("key", "type", "year", "booktitle", F.array_join("author", ", ").alias("authors"),
                         F.regexp_replace("title", r"\s+", "").alias("title"))


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def record_dump_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The documents written as dumps, plain and gzipped, and read back from the files."""
    rows = documents_corpus(spark, folder)
    # Every second title has markup within, every third record an empty child.
    title = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<i>"), _escaped(F.substring("title", 1, 3)), F.lit("</i>"), _escaped(F.substr("title", F.lit(4)))))
    record = F.concat(
        F.lit('<inproceedings mdate="2020-01-01" key="'), "key", F.lit('">\n'),
        F.array_join(F.transform("author", lambda a: F.concat(F.lit("<author>"), a, F.lit("</author>"))), "\n"),
        F.lit("<title>"), F.coalesce(title, _escaped(F.col("title"))), F.lit("</title>\n<year>"), F.col("year").cast("string"),
        F.when(F.col("doc_id") % 3 == 0, "</year><journal></journal><booktitle>").otherwise("</year><booktitle>"),
        "booktitle", F.lit("</booktitle>\n</inproceedings>"),
    )
    found = []
    for name, codec in (("plain", "none"), ("gzip", "gzip")):
        path = _own_path(spark, folder, f"dump-{name}")
        rows.select(record.alias("value")).write.mode("overwrite").option("compression", codec).text(path)
        corpus, _ = read_dump(spark, path)
        found.append(flat_records(corpus).select(F.lit(name).alias("file"), "key", "type", "year", "booktitle", "journal",
                                                 F.array_join("author", ", ").alias("authors"), "title"))
    return found[0].unionByName(found[1])


def dump_entities(spark: SparkSession, folder: str) -> DataFrame:
    """A dump whose titles use entities of its own document type; records with others are not taken."""
    kind = (
        "<!-- <!ENTITY ending 'no'> -->\n<!ENTITY ending \"e&letter; \">\n<!ENTITY ending 'a second one'>\n<!ENTITY letter '&#x72;'>\n"
        "<!ENTITY % sets SYSTEM 'none.ent'>\n<!ENTITY loop '&pool;'><!ENTITY pool '&loop;'>\n<!ELEMENT title (#PCDATA)>"
    )
    local_table(spark, [(kind,)], "value string").coalesce(1).write.mode("overwrite").text(_own_path(spark, folder, "doctype"))
    title = F.replace(_escaped(F.col("title")), F.lit("er "), F.lit("&ending;"))
    strange = F.when(F.col("doc_id") % 10 == 0, "&nowhere;").when(F.col("doc_id") % 10 == 1, "&loop;").otherwise("")
    record = F.concat(
        F.lit('<article mdate="2020-01-01" key="'), "key", F.lit('">\n<title>'), title, strange, F.lit("</title>\n</article>"),
    )
    path = _own_path(spark, folder, "entities")
    documents_corpus(spark, folder).select(record.alias("value")).write.mode("overwrite").text(path)
    corpus, rejected = read_dump(spark, path, entities=entity_texts(spark, _own_path(spark, folder, "doctype")))
    kept = corpus.select("key", F.regexp_replace("title", r"\s+", "").alias("title"), F.lit("").alias("reason"))
    return kept.unionByName(rejected.select(F.regexp_extract("record", 'key="([^"]*)"', 1).alias("key"), F.lit("").alias("title"), "reason"))


def fresh_dumps(spark: SparkSession, folder: str) -> DataFrame:
    """Of two dumps in a folder, the one that came after the other was read."""
    rows = documents_corpus(spark, folder).withColumn("later", F.col("doc_id") % 2 == 0)
    record = F.concat(
        F.lit('<article mdate="2020-01-01" key="'), "key", F.lit('">\n<title>'), _escaped(F.col("title")), F.lit("</title>\n<year>"),
        F.col("year").cast("string"), F.lit("</year>\n</article>"),
    )
    path = _own_path(spark, folder, "arrivals")
    rows.where("NOT later").select(record.alias("value")).write.mode("overwrite").text(path)
    seen = spark.read.text(path).agg(F.max("_metadata.file_modification_time")).first()[0]
    rows.where("later").select(record.alias("value")).write.mode("append").text(path)
    corpus, _ = read_dump(spark, path, since=seen)
    return corpus.select("key", "type", "year", F.regexp_replace("title", r"\s+", "").alias("title"))


def hits_as_json(spark: SparkSession, folder: str) -> DataFrame:
    """Hits with their records as lines of JSON, read back; missing labels are left out of a line."""
    hits = hits_with_records(spark, folder)
    path = _own_path(spark, folder, "hits")
    write_hits(hits, path)
    return spark.read.schema(hits.schema).json(path)


def page_entities_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of pages that hold named entities, as titles of records."""
    pages = spread(read_table(spark, folder, "pages").select("page_id", "html"), "page_id")
    # A text is tried from its beginning only: trying it from each of its signs takes the square of its length.
    texts = F.array_distinct(F.regexp_extract_all("html", F.lit(ENTITY_TEXT), F.lit(0)))
    rows = pages.select("page_id", F.posexplode(texts).alias("at", "text"))
    chunk = F.concat(
        F.lit('2020-01-01" key="'), F.col("page_id").cast("string"), F.lit("/"), F.col("at").cast("string"),
        F.lit('">\n<title>'), "text", F.lit("</title></www>\n<www "),
    )
    corpus, _ = split_records(judged_records(parsed_records(rows.select(chunk.alias("value")))))
    return corpus.select("key", "title")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        record_count_by_type, tokens_title, tokens_english, tokens_scripts, tokens_simple, postings_title, term_stats, doc_lengths, field_stats,
        year_range, year_single, year_batch, exact_field,
        search_term, search_should, search_must, search_must_not, search_phrase, search_phrase_gap,
        search_phrase_slop, search_boost, search_author_any, search_venue, search_return_all, search_multi,
        search_batch, search_batch_keywords, search_known_items, hits_with_records,
        posting_bounds, search_top_bounded, posting_bitmaps, search_three_musts,
        fuzzy_vocabulary, shaped_vocabulary, ranged_vocabulary,
        search_author_or_venue, search_keyword_and_prefix, search_pattern_batch,
        search_prefix, search_wildcard, search_regex, search_fuzzy, search_term_range,
        phrases, word_scores, phrase_scores, hotspots_by_year, hotspots_filled, hotspot_evolution, hotspot_series,
        hotspot_table, hotspots_blocked, searched_hotspots, searched_evolution, searched_authors,
        pivot_authors_exact, pivot_authors_fuzzy, topic_authors, page_key_tokens, stemmed_vocabulary, record_parse,
        record_dump_scan, dump_entities, fresh_dumps, hits_as_json, page_entities_decoded,
    )
}


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _ready(query) for name, query in QUERIES.items()}
