from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from litscope.llm import language
from litscope.llm.queries import QUERIES


def test_grams_are_the_distinct_runs_of_letters():
    def brute(text):
        words = "".join(c.lower()[0] if c.isalpha() else " " for c in text).split()
        line = f" {' '.join(words)} "
        return {line[i : i + n] for n in language.ORDERS for i in range(len(line) - n + 1)} if words else set()

    for text in ("Der Hund, 12 ÄPFEL", "a", " ", "", "1 2", "İstanbul", "x" * 100, "ab-cd\n\nef"):
        assert len(language.grams(text)) == len(brute(text)), text
    assert (language.grams("Ab  c!") == language.grams("aB c")).all()
    assert len(language.grams(None)) == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op4_kernel_language"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() == found.count()
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1


def test_edges(spark):
    schema = "doc_id bigint, text string, lang string, score string"
    known = [(i, t, lang, "x") for i, (t, lang) in enumerate([("the house and the dog", "en"), ("das Haus und der Hund", "de"), ("the cat is in the house", "en"), ("die Katze ist in dem Haus", "de")] * 3)]
    rows = known + [(None, "the dog", None, None), (90, None, "en", "x"), (91, "", "en", "x"), (92, "12 !?", "de", "x"), (93, "der Hund " * 20_000, None, "x"), (93, "der Hund " * 20_000, None, "x")]
    docs = spark.createDataFrame(rows, schema)
    model = language.train(docs.select("text", "lang"), landmarks=4, samples=10)
    found = language.classify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    result = found.withColumn("held_out", language.held_out(F.col("doc_id"))).collect()
    assert len(result) == len(rows)
    by_id = {r["doc_id"]: r for r in result}
    for i in (90, 91, 92):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[None]["lang_pred"] == "en" and by_id[None]["held_out"] is False
    assert by_id[93]["lang_pred"] == "de"
    assert all(by_id[i]["lang_pred"] == lang for i, _, lang, _ in known)
    empty = docs.limit(0)
    nothing = language.train(empty.select("text", "lang"))
    assert language.classify(empty, nothing).count() == 0
    assert {r["lang_pred"] for r in language.classify(docs, nothing).collect()} == {"und"}


def test_only_rows_not_held_out_are_learnt_from(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en" if i % 2 else None) for i in range(50)] + [(None, "t", "en")], "doc_id bigint, text string, lang string")
    learnt = {r["text"] for r in language.known_rows(docs).collect()}
    assert learnt == {f"text {i}" for i in range(50) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_copies_do_not_crowd_out_a_language(spark):
    copies = spark.range(50_000).select(F.lit("one text copied many times").alias("text"), F.lit("en").alias("lang"))
    others = spark.range(15).select(F.concat(F.lit("other text "), "id").alias("text"), F.lit("en").alias("lang"))
    labelled = copies.union(others).union(spark.createDataFrame([("ein Haus", "de")], "text string, lang string"))
    hashed = labelled.distinct().where("lang = 'en'").select("text", F.pmod(F.xxhash64("text"), F.lit(2**31)).alias("hash")).collect()
    least = [r["text"] for r in sorted(hashed, key=lambda r: (r["hash"], r["text"]))]
    for count, wanted in ((10, least[:10]), (100, least)):
        chosen = language._chosen(labelled, count).where("lang = 'en'").orderBy("rank").collect()
        assert [r["text"] for r in chosen] == wanted
    assert language.train(labelled, landmarks=4, samples=10).languages == ["de", "en"]
