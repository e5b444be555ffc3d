"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib.util
import pathlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litscope.llm import embedding_pairs, hard_negatives, html_text, kd_shards, language, minhash_forest, mixing, pii, repeats, tiling
from litscope.llm import token_alignment, token_counts, url_rules
from litscope.session import ship_package
from litscope.sources.tables import read_table

# The rules the URL query applies, as (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

# What a text is about, by the first pattern that occurs in it.
TOPICS = [
    ("legal", r"(?i)\b(licensed?|copyright)\b"),
    ("contact", r"@[A-Za-z0-9-]+\.|\+[0-9]"),
    ("technical", r"(?i)\b(token|password|AKIA[A-Z0-9]+)\b"),
]
ROUNDS = 8


# Words of a passage that must not occur twice.
PASSAGE = 35


def tokenizer_file(name: str) -> str:
    """The place of an installed tokenizer file."""
    found = importlib.util.find_spec("public_tokenizers")
    folder = pathlib.Path(found.origin).parent if found else pathlib.Path("/opt/tokenizers")
    return str(folder / name)


def vocabulary() -> str:
    """The installed file of GPT-2-like ranks."""
    return tokenizer_file("byte_bpe_50k.tiktoken")


def mixture(docs: DataFrame) -> DataFrame:
    """The production mix: source, language and topic, tempered towards equal shares."""
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.keyword_topic(F.col("text"), TOPICS)}
    return mixing.mix_sources(docs, dimensions, rounds=ROUNDS)


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """Shards by the metadata of ``documents``: length, language and source."""
    code = F.coalesce(F.ascii("lang") * 256 + F.ascii(F.substring("lang", 2, 1)), F.lit(0))
    number = F.coalesce(F.try_to_number(F.regexp_extract("source", "([0-9]{1,6})$", 1), F.lit("999999")), F.lit(0)).cast("bigint")
    dimensions = {"chars": F.col("n_chars"), "lang": code, "source": number}
    return kd_shards.kd_shards(docs, dimensions, shards=shards)


def op1_pigeonhole_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_pairs.near_vectors(read_table(spark, folder, "embeddings"), cosine=0.98)


def op2_html_layout(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "html")
    return html_text.extract_text(pages).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))


def op3_ipf_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    mixed = mixture(docs)
    return mixed.select(
        "doc_id",
        *(F.col(f"m_{n}").alias(n) for n in ("source", "lang", "topic")),
        F.col("m_tokens").alias("tokens"),
        F.round("m_weight", 6).alias("weight"),
        F.round("m_probability", 6).alias("probability"),
        F.col("m_sampled").alias("sampled"),
    )


def op4_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = language.train(language.known_rows(docs))
    judged = language.classify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return minhash_forest.near_duplicates(docs, size=2, percent=80)


def op6_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = tiling.contaminated(docs, read_table(spark, folder, "benchmark"))
    return found.select("doc_id", "contaminated", "item_ids", F.round("best_coverage", 6).alias("best_coverage"), "n_tiles")


def op7_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    placed = sharded(docs, 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_edit_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document before and after its personal data is written over."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    trees = token_counts.segment_trees(docs, vocabulary())
    trees = pii.with_redactions(trees.withColumnRenamed("n_tokens", "tokens_before").withColumn("n_tokens", F.col("tokens_before")))
    counted = token_counts.apply_edits(trees, vocabulary())
    return counted.select(
        "doc_id",
        "tokens_before",
        F.col("n_tokens").alias("tokens_after"),
        F.size("edits").cast("bigint").alias("n_edits"),
        "encoded_chars",
        F.length("text").cast("bigint").alias("chars_after"),
    )


def op9_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.personal_data(read_table(spark, folder, "documents").select("doc_id", "text")))


def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(repr, URL_RULES))} AS t(host, path, verdict)")
    judged = url_rules.judge_urls(read_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_span_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return token_alignment.align_tokens(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_level_doubling(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = repeats.drop_repeats(docs, length=PASSAGE)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_threshold_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    # Every seventh row is given another label, so that near rows differ in theirs.
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pigeonhole_vectors, op2_html_layout, op3_ipf_mixing, op4_kernel_language, op5_lsh_forest,
        op6_string_tiling, op7_kd_sharding, op8_edit_counts, op9_bootstrapped_pii, op10_url_rules,
        op11_span_alignment, op12_level_doubling, op13_threshold_negatives,
    )
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return query(spark, folder)

        return run

    return {name: ready(query) for name, query in QUERIES.items()}


def _url_sql() -> str:
    rules = ", ".join(map(str, URL_RULES))
    return f"""WITH rules(host, path, verdict) AS (VALUES {rules}),
rest AS (SELECT page_id, url, substr(url, strpos(url, '://') + 3) AS r FROM pages),
parts AS (SELECT page_id,
  CASE WHEN strpos(url, '://') > 0 THEN lower(regexp_extract(r, '^[^/?#]*')) ELSE '' END AS host,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(r, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM rest),
met AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
  row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.host || r.path) DESC NULLS LAST) AS n
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM met WHERE n = 1"""


def _mix_sql() -> str:
    names = ("source", "lang", "topic")
    # DuckDB's case of a pattern is an option, not part of it.
    topics = " ".join(
        f"WHEN regexp_matches(text, '{p.removeprefix('(?i)')}'{', ' + repr('i') if p.startswith('(?i)') else ''}) THEN '{n}'" for n, p in TOPICS
    )
    sql = [
        rf"""marked AS (SELECT doc_id, coalesce(source, '{mixing.MISSING}') AS source, coalesce(lang, '{mixing.MISSING}') AS lang,
  CASE {topics} ELSE 'general' END AS topic,
  coalesce(len(list_filter(string_split_regex(text, '[ \t-\r]+'), lambda w: w <> '')), 0) AS tokens FROM documents)""",
        "cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM marked GROUP BY ALL HAVING sum(tokens) > 0)",
    ]
    for n in names:
        sql.append(f"l_{n} AS (SELECT {n}, pow(CAST(sum(tokens) AS DOUBLE), 0.9) AS lifted FROM cells GROUP BY {n})")
        sql.append(f"g_{n} AS (SELECT {n}, lifted / sum(lifted) OVER () AS goal FROM l_{n})")
    factor = dict.fromkeys(names, "")
    for k in range(ROUNDS):
        for n in names:
            others = [f for f in names if f != n and factor[f]]
            joins = " ".join(f"JOIN {factor[o]} USING ({o})" for o in others)
            weight = " * ".join(["CAST(tokens AS DOUBLE)", *(f"{factor[o]}.f" for o in others)])
            sql.append(
                f"f_{n}{k} AS MATERIALIZED (SELECT {n}, any_value(goal) / sum({weight}) AS f FROM cells {joins} JOIN g_{n} USING ({n}) GROUP BY {n})"
            )
            factor[n] = f"f_{n}{k}"
    joins = " ".join(f"JOIN {factor[n]} USING ({n})" for n in names)
    weight = " * ".join(f"{factor[n]}.f" for n in names)
    sql.append(f"rated AS (SELECT source, lang, topic, {weight} * (SELECT sum(tokens) FROM cells) AS weight FROM cells {joins})")
    sql.append("chances AS (SELECT *, least(1.0, weight / max(weight) OVER ()) AS probability FROM rated)")
    chance = "CASE WHEN tokens > 0 THEN coalesce({}, 0) ELSE 0 END"
    drawn = "CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) / 281474976710656.0"
    return f"""WITH {', '.join(sql)}
SELECT doc_id, source, lang, topic, tokens, round({chance.format('weight')}, 6) AS weight,
  round({chance.format('probability')}, 6) AS probability, {drawn} < {chance.format('probability')} AS sampled
FROM marked LEFT JOIN chances USING (source, lang, topic)"""


def _repeats_sql() -> str:
    return rf"""WITH listed AS (SELECT row_number() OVER () AS r, doc_id,
  list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS w FROM documents),
windows AS (SELECT r, unnest(list_transform(range(1, len(w) - {PASSAGE} + 2), lambda i: md5(array_to_string(w[i : i + {PASSAGE - 1}], ' ')))) AS h,
  unnest(range(1, len(w) - {PASSAGE} + 2)) AS p FROM listed WHERE len(w) >= {PASSAGE}),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, p + k AS p FROM windows JOIN twice USING (h), range(0, {PASSAGE}) AS t(k)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM listed),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM listed LEFT JOIN kept USING (r)"""


def _negatives_sql() -> str:
    return """WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
  CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM scores WHERE alike),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM ranked WHERE place <= 5),
windows AS (SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM positives JOIN (SELECT * FROM scores WHERE NOT alike) USING (anchor_id)
  WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 10"""


def oracles() -> dict[str, str]:
    return {
        "op3_ipf_mixing": _mix_sql(),
        "op10_url_rules": _url_sql(),
        "op12_level_doubling": _repeats_sql(),
        "op13_threshold_negatives": _negatives_sql(),
    }
