from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from litscope.plans.search import exact_hits
from litscope.schema import RECORD_KINDS
from litscope.sources import entities
from litscope.sources.records import (
    count_by_kind,
    decode_entities,
    dump_chunks,
    ingest_dump,
    judged_records,
    parsed_records,
    read_dump,
)
from litscope.sources.store import flat_records, write_hits
from litscope.streaming.arrivals import follow_dumps


def by_key(corpus, key):
    return corpus.where(F.col("key") == key).collect()


def test_every_kind_is_read_and_counted(records):
    counts = {r["type"]: r["records"] for r in count_by_kind(records[0]).collect()}
    assert set(counts) == set(RECORD_KINDS)
    assert counts["article"] == 2 and counts["inproceedings"] == 2


def test_markup_entities_lists_and_empty_children(records):
    first = [r for r in by_key(records[0], "journals/x/A1") if r["publtype"]][0]
    assert first["title"] == "On the k-server problem with <b> marks ½ & co."
    assert first["author"] == ["Jürgen Möller", "Ann Lee"]
    assert first["ee"] == ["https://one.example", "https://two.example"]
    assert first["note"] is None and first["year"] == 2014 and first["mdate"] == "2020-01-01"


def test_title_that_starts_with_markup(records):
    assert by_key(records[0], "conf/aaai/LeeB15")[0]["title"] == "Internet of things"


def test_legacy_text_stops_at_the_first_inline_tag(spark, dump):
    corpus, _ = read_dump(spark, dump, legacy_text=True)
    titles = {r["title"] for r in corpus.collect()}
    assert "On the" in titles and "Internet of things" in titles


def test_duplicates_of_a_key_stay(records):
    assert len(by_key(records[0], "journals/x/A1")) == 2


def test_quarantine_names_its_reasons(records):
    reasons = sorted(r["reason"] for r in records[1].collect())
    assert reasons == ["no key", "not well formed", "year is not a number"]
    assert by_key(records[0], "conf/aaai/2015")[0]["year"] is None


def test_attribute_before_the_separator_goes_to_quarantine(spark, tmp_path):
    path = tmp_path / "late.xml"
    path.write_text('<r>\n<article key="a" mdate="2020-01-01"><title>T</title></article>\n</r>')
    corpus, quarantine = read_dump(spark, str(path))
    assert corpus.count() == 0
    assert [r["reason"] for r in quarantine.collect()] == ["no key"]


def test_gzip_gives_the_same_records(spark, zipped, records):
    corpus, _ = read_dump(spark, zipped)
    assert sorted(r["key"] for r in corpus.collect()) == sorted(r["key"] for r in records[0].collect())


def test_small_splits_lose_and_double_nothing(spark, dump, records):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        chunks = dump_chunks(spark, dump)
        assert chunks.rdd.getNumPartitions() > 3
        assert chunks.count() == 15
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latin_1_bytes(spark, tmp_path):
    path = tmp_path / "latin.xml"
    text = '<r><article mdate="2020-01-01" key="a"><title>Café</title></article></r>'
    path.write_bytes(text.encode("latin-1"))
    corpus, _ = read_dump(spark, str(path), encoding="ISO-8859-1")
    assert corpus.first()["title"] == "Café"


def test_decode_leaves_xml_entities():
    assert decode_entities("&uuml; &amp; &lt; &Eacute;") == "ü &amp; &lt; É"


def test_only_newer_files(spark, dump):
    now = datetime.now()
    assert dump_chunks(spark, dump, since=now - timedelta(days=36500)).count() == 15
    old, _ = read_dump(spark, dump, since=now - timedelta(days=36500))
    new, quarantine = read_dump(spark, dump, since=now + timedelta(days=1))
    assert old.count() > 10 and new.count() == 0 and quarantine.count() == 0


def test_a_gzipped_dump_is_parsed_by_many_tasks(spark, zipped, dump):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks = dump_chunks(spark, zipped)
        parts = chunks.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    # Ids follow the file, whatever task parses a piece.
    ordered = [r["key"] for r in read_dump(spark, zipped)[0].orderBy("doc_id").collect()]
    assert ordered == [r["key"] for r in read_dump(spark, dump)[0].orderBy("doc_id").collect()]


def test_hits_as_json_lines(library, tmp_path):
    path = str(tmp_path / "hits")
    write_hits(library.by_keyword("internet"), path)
    lines = [json.loads(line) for f in (tmp_path / "hits").glob("part-*") for line in f.read_text().splitlines()]
    assert [(h["title"], h["author"]) for h in lines] == [("Internet of things", ["Ann Brown", "Cid Dove"])]


def test_stream_reads_each_file_once(spark, dump, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    text = open(dump).read()
    for name in ("one", "two"):
        (folder / f"{name}.xml").write_text(text)
        for _ in range(2):
            query = follow_dumps(spark, str(folder), out, str(tmp_path / "state"))
            query.awaitTermination()
    corpus = spark.read.parquet(f"{out}/corpus")
    assert corpus.count() == 24
    assert corpus.select("doc_id").distinct().count() == 24
    assert spark.read.parquet(f"{out}/quarantine").count() == 6


def test_ingest_writes_what_read_gives(spark, dump, records, tmp_path):
    corpus, quarantine = ingest_dump(spark, dump, str(tmp_path / "out"))
    drop = [c for c in corpus.columns if c != "doc_id"]
    assert sorted(map(str, corpus.select(drop).collect())) == sorted(map(str, records[0].select(drop).collect()))
    assert quarantine.count() == 3
    assert corpus.select("doc_id").distinct().count() == 12


def test_dump_is_scanned_once_and_parsed_once(spark, dump):
    plan = judged_records(parsed_records(dump_chunks(spark, dump)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("from_xml(") == 1


def test_one_value_per_field_keeps_the_last(records):
    flat = flat_records(records[0].where("publtype = 'informal'")).first()
    assert flat["ee"] == "https://two.example" and flat["author"] == ["Jürgen Möller", "Ann Lee"]
    assert flat["editor"] is None


def test_exact_fields(records):
    assert exact_hits(records[0], "isbn", "978-1").count() == 1
    assert exact_hits(records[0], "volume", "1").count() == 0


def test_entities_of_a_document_type(spark, tmp_path):
    dtd = tmp_path / "own.dtd"
    dtd.write_text(
        """<!-- a comment <!ENTITY gone "x"> -->
<!ENTITY uuml "&#252;"> <!ENTITY Name 'M&uuml;ller'>
<!ENTITY Name "another"> <!ENTITY % part "skipped"> <!ENTITY far SYSTEM "far.ent">
<!ENTITY a "&b;"><!ENTITY b "&c;"><!ENTITY c "&a;"><!ENTITY open "&nothing;">
<!ENTITY less "&#38;#60;"> <!ENTITY x.y-z "dotted &amp; dashed"><!ENTITY big "&#x1D11E;">""",
        encoding="utf-8",
    )
    texts = entities.entity_texts(spark, str(dtd))
    own = {n: t for n, t in texts.items() if n not in entities.GIVEN}
    assert own == {"uuml": "ü", "Name": "Müller", "less": "<", "x.y-z": "dotted & dashed", "big": "\U0001d11e"}
    assert {r["name"] for r in entities.entity_table(spark, str(dtd)).collect()} == set(texts)
    dump = tmp_path / "dump.xml"
    titles = ["by &Name; &x.y-z; 1 &less; 2 &amp; &#65;", "&Name;&gone;", "&a;", "plain", "&eacute;"]
    dump.write_text(
        "<dblp>\n" + "\n".join(f'<article mdate="2020-01-01" key="k{i}"><title>{t}</title></article>' for i, t in enumerate(titles)) + "\n</dblp>",
        encoding="utf-8",
    )
    corpus, quarantine = read_dump(spark, str(dump), entities=texts)
    assert {r["key"]: r["title"] for r in corpus.collect()} == {"k0": "by Müller dotted & dashed 1 < 2 & A", "k3": "plain"}
    assert [r["reason"] for r in quarantine.collect()] == [entities.UNKNOWN] * 3
    # Without a document type, names are HTML's.
    assert read_dump(spark, str(dump))[0].where("key = 'k4'").first()["title"] == "é"


def test_long_texts_of_pages_are_tried_once(spark):
    """Texts that hold an entity are found, and a long one without takes time by its length, not its square."""
    import time

    from pyspark.sql import functions as F

    from litscope.plans.registered import ENTITY_TEXT

    plain = "[^<>]*&(?:middot|copy);[^<>]*"
    pages = ["a&copy;b<i>c &middot; &copy;</i>&copy;", "&copy", "<&middot;>&copy;>x&copy; &copy", "x &amp; y", "", None, "\n&copy;\n<"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    found = df.select(*(F.regexp_extract_all("html", F.lit(p), F.lit(0)) for p in (ENTITY_TEXT, plain))).collect()
    assert all(new == old for new, old in found) and found[0][0] == ["a&copy;b", "c &middot; &copy;", "&copy;"]
    start = time.time()
    long = spark.range(1).select(F.concat(F.repeat(F.lit("word & "), 60_000), F.lit("<b>&copy;")).alias("html"))
    long = long.select(F.regexp_extract_all("html", F.lit(ENTITY_TEXT), F.lit(0)).alias("t"))
    assert long.first()["t"] == ["&copy;"] and time.time() - start < 30
