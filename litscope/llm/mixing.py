"""Mix sources to target weights by iterative proportional fitting.

Documents are summed into cells of (source, language, topic, ...). The cells'
token weights are raked: each dimension in turn is scaled so that its sums meet
the target marginals. A cell's weight is its tokens times one factor for each
dimension, so only the factors change between steps, and documents are read
twice: to count, and to be sampled by their cell's calibrated probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litscope.session import durable

# What a null category counts as.
MISSING = "(none)"


def word_count(text: Column) -> Column:
    """Words of a text: runs of bytes other than space and tab to carriage return."""
    return F.coalesce(F.size(F.filter(F.split(text, "[ \t-\r]+", -1), lambda w: w != "")), F.lit(0)).cast("bigint")


def keyword_topic(text: Column, topics: list[tuple[str, str]], other: str = "general") -> Column:
    """The first topic whose pattern occurs in the text."""
    found = F.lit(other)
    for name, pattern in reversed(topics):
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def tempered_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share): shares of tokens raised to a power below 1, which lifts the small."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("lifted"))
    return sums.select("value", (F.col("lifted") / _number(sums, F.sum("lifted"), 1.0)).alias("share"))


def _number(df: DataFrame, aggregate: Column, empty: float) -> Column:
    """One number of a table of cells or values, as a literal."""
    found = df.agg(aggregate.cast("double").alias("n")).first()["n"]
    return F.lit(found if found else empty)


def measure_cells(docs: DataFrame, dimensions: dict[str, Column], tokens: Column) -> tuple[DataFrame, DataFrame]:
    """Documents with ``m_<dimension>`` and ``m_tokens``, and the cells with tokens."""
    marked = docs.withColumns(
        {f"m_{n}": F.coalesce(c.cast("string"), F.lit(MISSING)) for n, c in dimensions.items()} | {"m_tokens": tokens.cast("bigint")}
    )
    cells = marked.groupBy(*(F.col(f"m_{n}").alias(n) for n in dimensions)).agg(F.sum("m_tokens").alias("tokens"))
    return marked, durable(cells.where("tokens > 0"))


def raked_factors(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> dict[str, DataFrame]:
    """(value, factor) of every dimension after so many rounds of raking.

    Targets of a dimension are scaled to sum to 1 over the values that hold tokens;
    a value without a target, or with a null or negative one, gets none.
    """
    goals, factors = {}, {}
    for n, target in targets.items():
        present = cells.select(F.col(n).alias("value")).distinct()
        share = F.greatest(F.coalesce(F.col("share").cast("double"), F.lit(0.0)), F.lit(0.0))
        target = target.groupBy("value").agg(F.sum(share).alias("share"))
        met = present.join(target, "value", "left").fillna(0.0, "share")
        goals[n] = durable(met.select("value", (F.col("share") / _number(met, F.sum("share"), 1.0)).alias("goal")))
        factors[n] = goals[n].select("value", F.lit(1.0).alias("factor"))
    for _ in range(rounds):
        for n in targets:
            weighed = _weighed(cells, {d: f for d, f in factors.items() if d != n})
            sums = weighed.groupBy(F.col(n).alias("value")).agg(F.sum("weight").alias("sum"))
            factor = F.when(F.col("sum") > 0, F.col("goal") / F.col("sum")).otherwise(0.0)
            factors[n] = durable(goals[n].join(sums, "value").select("value", factor.alias("factor")))
    return factors


def _weighed(cells: DataFrame, factors: dict[str, DataFrame]) -> DataFrame:
    weight = F.col("tokens").cast("double")
    for n, table in factors.items():
        cells = cells.join(table.select(F.col("value").alias(n), F.col("factor").alias(f"f_{n}")), n)
        weight = weight * F.col(f"f_{n}")
    return cells.withColumn("weight", weight)


def uniform(identity: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(2**48)


def mix_sources(
    docs: DataFrame,
    dimensions: dict[str, Column],
    targets: dict[str, DataFrame] | None = None,
    tokens: Column | None = None,
    rounds: int = 8,
    power: float = 0.9,
    most: float = 1.0,
    seed: str = "mix",
    id_column: str = "doc_id",
) -> DataFrame:
    """``docs`` with m_<dimension>, m_tokens, m_weight, m_probability and m_sampled.

    ``targets`` maps dimensions to tables (value, share); those not given are the
    corpus's own shares raised to ``power``. m_weight is the raked share of a
    document's cell divided by the cell's share of tokens: above 1 where the mix
    wants more of it. Probabilities are proportional to it, and ``most`` for the
    cell that is wanted most, so the sample meets the marginals in expectation
    without repeating a document.

    A null category is a category of its own, MISSING. Documents without tokens
    (null, empty or blank texts) carry no weight and are never sampled. Rows that
    share an id share its random number; a null id counts as an empty one. No rows
    give no rows. Columns of ``docs`` that start with m_ and clash give way.
    """
    body = F.col("text") if tokens is None else None
    marked, cells = measure_cells(docs, dimensions, word_count(body) if tokens is None else tokens)
    targets = {n: (targets or {}).get(n) or tempered_targets(cells, n, power) for n in dimensions}
    weighed = _weighed(cells, raked_factors(cells, targets, rounds))
    ratio = F.col("weight") * _number(cells, F.sum("tokens"), 1.0) / F.col("tokens")
    rated = durable(weighed.select(*(F.col(n).alias(f"m_{n}") for n in dimensions), ratio.alias("m_weight")))
    share = F.least(F.lit(1.0), most * F.col("m_weight") / _number(rated, F.max("m_weight"), 1.0))
    chances = durable(rated.withColumn("m_probability", share))
    rest = [c for c in marked.columns if c not in ("m_weight", "m_probability", "m_sampled")]
    mixed = marked.select(*rest).join(chances, [f"m_{n}" for n in dimensions], "left")
    has = F.col("m_tokens") > 0
    mixed = mixed.withColumns({c: F.when(has, F.coalesce(c, F.lit(0.0))).otherwise(0.0) for c in ("m_weight", "m_probability")})
    return mixed.select(*rest, "m_weight", "m_probability", (uniform(F.col(id_column), seed) < F.col("m_probability")).alias("m_sampled"))
