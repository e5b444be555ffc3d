"""Entities that a dump's own document type declares."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscope.session import local_table

# A declaration of a general entity by its text; parameter and outside ones have no text here.
DECLARATION = r"""<!ENTITY\s+([A-Za-z_:][\w:.-]*)\s+("[^"]*"|'[^']*')\s*>"""
COMMENT = r"(?s)<!--.*?-->"
REFERENCE = r"&(#[0-9]+|#x[0-9A-Fa-f]+|[A-Za-z_:][\w:.-]*);"

# The entities every document has.
GIVEN = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

# Declarations that are handed to tasks; a document type has hundreds.
MOST = 100_000

UNKNOWN = "unknown entity"


def declarations(spark: SparkSession, path: str) -> DataFrame:
    """(name, value, place) of the entities that the files at ``path`` declare, in order, comments left out."""
    texts = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", COMMENT, "").alias("value"))
    names, values = (F.regexp_extract_all("value", F.lit(DECLARATION), F.lit(i)) for i in (1, 2))
    rows = texts.select(F.posexplode(F.arrays_zip(names.alias("name"), values.alias("text"))).alias("place", "d"))
    return rows.select(F.col("d.name").alias("name"), F.expr("substring(d.text, 2, length(d.text) - 2)").alias("value"), "place")


def resolved(declared: dict[str, str]) -> dict[str, str]:
    """The text of each entity, with those inside it and numbered characters filled in.

    What refers to itself, or to an entity that is not declared, has no text and is left out.
    """
    known: dict[str, str | None] = dict(GIVEN)

    def text(name: str, above: tuple[str, ...]) -> str | None:
        if name not in known:
            if name in above or name not in declared:
                return None
            found = fill(declared[name], (*above, name))
            if found is None and above:
                return None  # perhaps only because of what stands above
            known[name] = found
        return known[name]

    def fill(value: str, above: tuple[str, ...]) -> str | None:
        parts, at = [], 0
        for match in re.finditer(REFERENCE, value):
            name = match[1]
            if name.startswith("#"):
                number = int(name[2:], 16) if name[1] == "x" else int(name[1:])
                part = chr(number) if 0 < number < 0x110000 and not 0xD800 <= number < 0xE000 else None
            else:
                part = text(name, above)
            if part is None:
                return None
            parts += [value[at : match.start()], part]
            at = match.end()
        return "".join([*parts, value[at:]])

    for name in declared:
        text(name, ())
    # A numbered ampersand may begin another number: such values are written twice.
    twice = re.compile("&#([0-9]+);")
    return {n: twice.sub(lambda m: chr(int(m[1])), t) for n, t in known.items() if t is not None}


def entity_texts(spark: SparkSession, path: str) -> dict[str, str]:
    """name -> text of all entities a document type at ``path`` declares; of two of a name the first counts."""
    rows = declarations(spark, path).orderBy("place").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} entities")
    return resolved({r["name"]: r["value"] for r in reversed(rows)})


def entity_table(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) of the entities a document type declares, and of the given ones."""
    return local_table(spark, sorted(entity_texts(spark, path).items()), "name string, text string")


def entity_decoder(texts: dict[str, str]):
    """A UDF that fills in entities by name; unknown ones stay, and so do the five of XML."""
    escaped = {n: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") for n, t in texts.items() if n not in GIVEN}

    @F.pandas_udf(T.StringType())
    def decoded(values: pd.Series) -> pd.Series:
        pattern = re.compile(r"&([A-Za-z_:][\w:.-]*);")
        return values.map(lambda v: pattern.sub(lambda m: escaped.get(m[1], m[0]), v), na_action="ignore")

    return decoded
