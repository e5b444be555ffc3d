"""Allow and block rules for URLs by hashed host suffixes and path prefixes.

Every distinct host and path is expanded into (host suffix, path prefix)
expressions, at the lengths that rules have. A short prefix of the expression's
SHA-256 equi-joins it with the rules; the full digest confirms, and the longest
rule wins. Only hashes of rules travel, however many rules there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.session import durable

# Hexadecimal digits of the hash prefix.
SHORT = 8
# Longer than any path of a rule.
WIDE = 2**24


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` has columns host, path and verdict. A rule fits its host and all
    subdomains if the path starts with the rule's. The longest host and path win,
    then the longer host, then ``block``. Rules with a null or an empty host never
    fit; a null path counts as empty. Equal rules count once.

    A null URL or one without ``://`` has an empty host and path, fits no rule and
    gets the default, as does any URL that no rule fits. Rows are kept as they are,
    repeated ones too. Columns of ``pages`` named host, path, rule or verdict give
    way to the results.
    """
    host, path = url_parts(F.col(url_column).cast("string"))
    out = ["host", "path", "rule", "verdict"]
    rest = [c for c in pages.columns if c not in out]
    rules = rules.where("host <> ''").select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct()
    rules = durable(
        rules.select(
            F.concat("host", "path").alias("rule"),
            F.size(F.split("host", r"\.", -1)).cast("bigint").alias("labels"),
            F.length("path").alias("letters"),
            F.length("host").alias("host_letters"),
            "verdict",
            _digest(F.col("host"), F.col("path")).alias("digest"),
        ).withColumn("short", F.substring("digest", 1, SHORT))
    )
    # The shapes that rules have: one number for each label count and path length.
    shapes = [r["shape"] for r in rules.select((F.col("labels") * WIDE + F.col("letters")).alias("shape")).distinct().collect()]

    placed = pages.select(host.alias("host"), path.alias("path")).distinct().where("host <> ''")
    placed = placed.withColumn("parts", F.split("host", r"\.", -1))
    known = F.lit(sorted(shapes)) if shapes else F.array().cast("array<bigint>")
    fitting = F.filter(known, lambda n: (F.floor(n / WIDE) <= F.size("parts")) & (n % WIDE <= F.length("path")))
    expanded = placed.select("host", "path", "parts", F.explode(fitting).alias("n"))
    labels, letters = F.floor(F.col("n") / WIDE).cast("int"), (F.col("n") % WIDE).cast("int")
    suffix = F.array_join(F.slice("parts", F.size("parts") - labels + 1, labels), ".")
    prefix = F.substring("path", F.lit(1), letters)
    expanded = expanded.select("host", "path", _digest(suffix, prefix).alias("full"))
    met = expanded.join(rules, F.substring("full", 1, SHORT) == F.col("short")).where("full = digest")
    rank = F.struct(F.length("rule"), "host_letters", F.col("verdict") == "block", "rule", "verdict")
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best"))

    judged = pages.select(*rest, host.alias("host"), path.alias("path")).join(best, ["host", "path"], "left")
    return judged.select(
        *rest,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
