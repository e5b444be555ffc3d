"""Read a dump of XML records into a corpus, in one splittable pass."""

from __future__ import annotations

import html
import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.functions.text import held
from litscope.schema import FIELDS, LIST_FIELDS, RECORD_KINDS, corpus_schema
from litscope.session import durable
from litscope.sources.entities import UNKNOWN, entity_decoder

# Every record carries this attribute first, so splitting there cuts the dump
# between records. Each chunk starts right after it.
SEPARATOR = 'mdate="'

# Inline markup inside a field, dropped together with its tags.
INLINE_TAGS = ("i", "sub", "sup", "tt", "ref")

# Entities the XML reader itself understands.
XML_ENTITIES = frozenset({"amp", "lt", "gt", "quot", "apos"})

NAMED_ENTITY = "&([A-Za-z][A-Za-z0-9]*);"
# An entity of a document type: any XML name but those five.
ENTITY = r"&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z_:][\w:.-]*;"

BAD_YEAR = "year is not a number"

_KINDS = "|".join(RECORD_KINDS)


def decode_entities(text: str) -> str:
    """Replace named entities such as &uuml;, leaving XML's own five alone."""

    def one(match: re.Match) -> str:
        return match.group(0) if match.group(1) in XML_ENTITIES else html.unescape(match.group(0))

    return re.sub(NAMED_ENTITY, one, text)


@F.pandas_udf(T.StringType())
def _decoded(texts):
    return texts.map(decode_entities, na_action="ignore")


def dump_chunks(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    separator: str = SEPARATOR,
    since: datetime | None = None,
) -> DataFrame:
    """(value, place): pieces of the dump between separators, numbered in file order.

    Only files that changed after ``since`` are read, if given. A gzipped file is
    read by one task; its pieces are dealt out to others before they are parsed.
    """
    lines = spark.read.option("lineSep", separator).text(path)
    zipped = any(f.endswith(".gz") for f in lines.inputFiles())
    if since is not None:
        lines = lines.where(F.col("_metadata.file_modification_time") > F.lit(since))
    lines = lines.select("value", F.monotonically_increasing_id().alias("place"))
    return chunk_text(lines.hint("rebalance") if zipped else lines, encoding)


def chunk_text(lines: DataFrame, encoding: str) -> DataFrame:
    """Decode raw lines; the text source hands bytes through unchanged."""
    if encoding.upper() == "UTF-8":
        return lines
    return lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))


def _record_schema() -> T.StructType:
    attributes = [T.StructField(f"_{a}", T.StringType()) for a in ("mdate", "key", "publtype")]
    children = [T.StructField(f, T.ArrayType(T.StringType())) for f in FIELDS]
    return T.StructType([*attributes, *children, T.StructField("_corrupt_record", T.StringType())])


def _without_markup(text: Column, legacy_text: bool) -> Column:
    tags = "|".join(INLINE_TAGS)
    if legacy_text:
        # Keep a text only up to its first inline tag, unless it starts with one.
        cut = rf"(?s)(<(\w+)(?:\s[^<>]*)?>[^<]+)<(?:{tags})\b[^>]*>.*?(</\2>)"
        text = F.regexp_replace(text, cut, "$1$3")
    return F.regexp_replace(text, rf"</?(?:{tags})\b[^>]*>", "")


def parsed_records(
    chunks: DataFrame, separator: str = SEPARATOR, legacy_text: bool = False, entities: dict[str, str] | None = None
) -> DataFrame:
    """One row per chunk: its kind, the parsed record and the reason to reject it.

    ``entities`` are those of the dump's document type (``entities.entity_texts``); a
    record with any other is rejected. Without them, entities are HTML's.
    """
    body = rf"(?s)^(.*?)</({_KINDS})>"
    if "place" not in chunks.columns:
        chunks = chunks.withColumn("place", F.monotonically_increasing_id())
    rows = chunks.where(F.col("value").rlike(r"\S")).select(
        "value",
        "place",
        F.regexp_extract("value", body, 1).alias("inner"),
        F.regexp_extract("value", body, 2).alias("type"),
    )
    raw = F.concat(F.lit(f"<rec {separator}"), _without_markup(F.col("inner"), legacy_text), F.lit("</rec>"))
    rows = held(rows, "raw", raw)
    named = F.col("raw").rlike(r"&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z][A-Za-z0-9]*;")
    # Python gets the text of rows with a named entity, and nulls for the others.
    if entities is not None:
        named = F.col("raw").rlike(ENTITY)
        rows = held(rows, "filled", F.coalesce(entity_decoder(entities)(F.when(named, F.col("raw"))), F.col("raw")))
        rows = rows.withColumn("unknown", F.col("filled").rlike(ENTITY))
        return held(rows, "rec", F.from_xml("filled", _record_schema(), {"mode": "PERMISSIVE"})).drop("raw", "filled")
    decoded = F.coalesce(_decoded(F.when(named, F.col("raw"))), F.col("raw"))
    return held(rows, "rec", F.from_xml(decoded, _record_schema(), {"mode": "PERMISSIVE"})).drop("raw")


def _rejection(unknown: Column) -> Column:
    kinds = rf"<(?:{_KINDS})[\s>]"
    year = F.element_at(F.filter(F.col("rec.year"), lambda v: F.length(v) > 0), -1)
    return (
        F.when(F.col("type") == "", F.lit("no closing tag"))
        .when(F.col("inner").rlike(kinds), F.lit("second record inside"))
        .when(unknown, F.lit(UNKNOWN))
        .when(F.col("rec").isNull() | F.col("rec._corrupt_record").isNotNull(), F.lit("not well formed"))
        .when(F.col("rec._key").isNull(), F.lit("no key"))
        .when(year.isNotNull() & year.try_cast("int").isNull(), F.lit(BAD_YEAR))
    )


def read_dump(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    separator: str = SEPARATOR,
    legacy_text: bool = False,
    since: datetime | None = None,
    entities: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(corpus, quarantine) of a dump. A record whose year is no number is in both:
    it is kept with a null year and reported. Each of the two parses the dump."""
    chunks = dump_chunks(spark, path, encoding, separator, since)
    return split_records(judged_records(parsed_records(chunks, separator, legacy_text, entities)))


def ingest_dump(
    spark: SparkSession,
    path: str | list[str],
    out: str,
    encoding: str = "UTF-8",
    separator: str = SEPARATOR,
    legacy_text: bool = False,
    since: datetime | None = None,
    entities: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write ``out/corpus`` and ``out/quarantine``, parsing the dump once."""
    chunks = dump_chunks(spark, path, encoding, separator, since)
    judged = durable(judged_records(parsed_records(chunks, separator, legacy_text, entities)))
    for name, rows in zip(("corpus", "quarantine"), split_records(judged)):
        rows.write.mode("overwrite").parquet(f"{out}/{name}")
    return spark.read.parquet(f"{out}/corpus"), spark.read.parquet(f"{out}/quarantine")


def judged_records(parsed: DataFrame) -> DataFrame:
    """(type, rec, reason, record): the raw text only of what is rejected."""
    # What precedes the first record is no record at all.
    preamble = (F.col("type") == "") & F.col("value").rlike(r"^\s*<")
    unknown = F.col("unknown") if "unknown" in parsed.columns else F.lit(False)
    judged = held(parsed.where(~preamble), "reason", _rejection(unknown))
    return judged.select("place", "type", "rec", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("record"))


def split_records(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    kept = F.col("reason").isNull() | (F.col("reason") == BAD_YEAR)
    quarantine = judged.where(F.col("reason").isNotNull()).select("reason", "record")
    return _as_corpus(judged.where(kept)), quarantine


def _as_corpus(rows: DataFrame) -> DataFrame:
    def values(name: str) -> Column:
        return F.filter(F.transform(F.col(f"rec.{name}"), lambda v: F.trim(v)), lambda v: F.length(v) > 0)

    columns = []
    for field in corpus_schema():
        name = field.name
        if name == "doc_id":
            column = F.col("place")
        elif name == "type":
            column = F.col("type")
        elif name in ("key", "publtype", "mdate"):
            column = F.col(f"rec._{name}")
        elif name in LIST_FIELDS:
            column = values(name)
        else:
            column = F.get(values(name), F.size(values(name)) - 1)
            column = column.try_cast("int") if name == "year" else column
        columns.append(column.alias(name))
    return rows.select(*columns)


def count_by_kind(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("type").agg(F.count("*").alias("records"))
