"""Ranks and top-k within groups, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litscope.session import durable


def _cut_per_task(spark: SparkSession) -> int:
    """Up to which k Spark cuts every task's rows to k before a ranking window."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The k best rows of each group, numbered from 1.

    As far as Spark cuts each task's own rows to k first, a hot group never
    travels whole. For a larger k all rows are numbered by range, then filtered.
    """
    if k <= _cut_per_task(df.sparkSession):
        window = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return rank_all(df, by, order, rank).where(F.col(rank) <= k)


def rank_all(df: DataFrame, by: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Number every row of every group without gathering a group in one task.

    One range shuffle sorts by group and order, so a large group spans many
    tasks. Row ids follow that order; each (task, group) run starts at the number
    of rows the group has in earlier tasks. The rows are kept durably before the
    sort, which reads them twice, and after it, since the run lengths must describe
    exactly the rows they number.
    """
    df = durable(df)
    keys = [F.col(c).asc_nulls_first() for c in by]
    ordered = df.orderBy(*keys, *order).withColumn("_row", F.monotonically_increasing_id())
    ordered = durable(ordered).withColumn("_task", F.shiftright("_row", 33))
    # One row per (task, group): bounded by tasks plus groups.
    runs = ordered.groupBy(*by, "_task").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    runs = durable(runs.withColumnsRenamed({c: f"_run_{c}" for c in [*by, "_task"]}))
    same = F.col("_task") == F.col("_run__task")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_run_{c}"))
    number = F.col("_row") - F.col("_first") + F.col("_before") + 1
    return ordered.join(runs, same).select(*df.columns, number.cast("int").alias(rank))
