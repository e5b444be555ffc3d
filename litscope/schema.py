"""Record kinds, the field catalogue and the corpus schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Record kinds taken from a dump.
RECORD_KINDS = (
    "article",
    "inproceedings",
    "proceedings",
    "book",
    "incollection",
    "phdthesis",
    "mastersthesis",
    "www",
    "person",
    "data",
)

# Child elements kept from a record; anything else is dropped.
FIELDS = (
    "address",
    "author",
    "booktitle",
    "cdrom",
    "chapter",
    "cite",
    "crossref",
    "editor",
    "ee",
    "isbn",
    "journal",
    "month",
    "note",
    "number",
    "pages",
    "publisher",
    "publnr",
    "school",
    "series",
    "title",
    "url",
    "volume",
    "year",
)

# Fields that hold several values.
LIST_FIELDS = ("author", "cite", "editor", "ee")

# Fields matched as one whole string.
EXACT_FIELDS = ("type", "isbn", "volume")

# Fields that are kept but not searched.
STORED_FIELDS = (
    "publnr",
    "url",
    "ee",
    "cdrom",
    "pages",
    "school",
    "series",
    "address",
    "chapter",
)

# Fields whose text is searchable word by word.
ANALYSED_FIELDS = ("key", "publtype") + tuple(
    f for f in FIELDS if f not in EXACT_FIELDS + STORED_FIELDS + ("year",)
)

# Fields that the named searches ask about.
DEFAULT_FIELDS = ("title", "author", "key", "booktitle", "journal")


def corpus_schema() -> T.StructType:
    columns = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("publtype", T.StringType()),
        T.StructField("mdate", T.StringType()),
    ]
    for name in FIELDS:
        if name == "year":
            kind: T.DataType = T.IntegerType()
        elif name in LIST_FIELDS:
            kind = T.ArrayType(T.StringType())
        else:
            kind = T.StringType()
        columns.append(T.StructField(name, kind))
    return T.StructType(columns)
