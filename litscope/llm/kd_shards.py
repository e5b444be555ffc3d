"""Shards of near-equal bytes by a k-d tree over metadata.

Texts that are equal form one group with one place in every dimension. Nodes are
split at the weighted median along their widest dimension until each leaf is one
shard. Medians are found over the whole table by narrowing: every pass sums bytes
per node and slice of the remaining interval, so a pass moves one row for each
node, slice and task, and no node is ever gathered or sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litscope.session import durable

# Slices of the interval that still holds the median, per pass.
SLICES_LOG2 = 16
# Rows of a shard that one task numbers.
NUMBERED = 50_000
# A group of equal texts stays whole up to this share of a shard, and is dealt
# into pieces of at most that size beyond it.
PIECE = 1 / 128


def _values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A few numbers as an inline table."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(map(repr, rows))} AS t({columns})")


def _measured(docs: DataFrame, text: str, dimensions: dict[str, Column], id_column: str) -> DataFrame:
    """Id, size, crc, group and dimensions of every row: all that is read of a text."""
    body = F.col(text).cast("string")
    size = F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint") + 1
    return docs.select(
        F.col(id_column).alias("id"),
        size.alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        F.xxhash64(body).alias("group"),
        *(F.least(F.greatest(F.coalesce(c.cast("bigint"), F.lit(0)), F.lit(0)), F.lit(2**31 - 1)).alias(f"d_{n}") for n, c in dimensions.items()),
    )


def _pieces(rows: DataFrame, names: list[str], piece_bytes: float) -> DataFrame:
    """Rows with the coordinates they share with their piece of a group."""
    # Places of a group come from its least values; partial sums keep hot groups light.
    groups = durable(rows.groupBy("group").agg(F.sum("size").alias("group_bytes"), *(F.min(f"d_{n}").alias(f"g_{n}") for n in names)))
    rows = rows.select("id", "size", "text_crc32", "group").join(groups, "group")
    parts = F.ceil(F.col("group_bytes") / piece_bytes)
    piece = F.when(parts > 1, F.pmod(F.xxhash64("id"), parts)).otherwise(0)
    # 31 bits of the value, then 32 bits of the piece's hash, so that pieces hardly tie.
    tie = F.shiftrightunsigned(F.xxhash64("group", piece), 32)
    coordinates = [(F.shiftleft(f"g_{n}", 32) + tie).alias(f"c_{n}") for n in names]
    return rows.select("id", "size", "text_crc32", *coordinates)


def _scaled(spread: Column, whole: Column) -> Column:
    return F.when(whole > 0, spread / whole).otherwise(0.0)


def _cuts(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, cut): the least coordinate along the node's axis whose share of bytes is reached.

    ``nodes`` has node and share; ``points`` has node, x and bytes.
    """
    total = points.groupBy("node").agg(F.sum("bytes").alias("total"))
    state = durable(
        nodes.join(total, "node").select("node", (F.col("total") * F.col("share")).alias("goal"), F.lit(0).cast("bigint").alias("base"))
    )
    width = 63
    while width > 0:
        slices = min(width, SLICES_LOG2)
        width -= slices
        # One state row for each node of the level: at most as many as shards.
        here = points.join(F.broadcast(state), "node")
        offset = F.shiftrightunsigned(F.col("x") - F.col("base"), width)
        inside = (F.col("x") >= F.col("base")) & (offset < 2**slices)
        sums = here.where(inside).groupBy("node", "goal", "base", offset.alias("slice")).agg(F.sum("bytes").alias("bytes"))
        upto = Window.partitionBy("node").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("bytes").over(upto))
        # The last slice stands for goals that rounding puts past the end.
        last = F.max("slice").over(Window.partitionBy("node"))
        reached = sums.withColumn("last", last).where("upto >= goal OR slice = last")
        first = reached.groupBy("node").agg(F.min_by(F.struct("slice", "goal", "base", "upto", "bytes"), "slice").alias("s"))
        state = durable(
            first.select(
                "node",
                (F.col("s.goal") - (F.col("s.upto") - F.col("s.bytes"))).alias("goal"),
                (F.col("s.base") + F.shiftleft(F.col("s.slice"), width)).alias("base"),
            )
        )
    return state.select("node", F.col("base").alias("cut"))


def kd_shards(
    docs: DataFrame,
    dimensions: dict[str, Column],
    shards: int | None = None,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of ``docs``.

    ``dimensions`` are integer columns from 0 to 2**31 - 1 (clipped; null is 0).
    Either the number of shards is given or the bytes a leaf should reach. A node
    of k leaves is split in the proportion of k // 2 to the rest. A row weighs its
    text's UTF-8 bytes plus 1 (a null text weighs 1), so shards differ by about
    one piece of a group for each level.

    Equal texts share a shard unless their group weighs over 1/128 of a shard; such
    a group is dealt into pieces by id. Null texts are one group. Rows that
    are wholly equal get one shard or another as their pieces do, and slots of
    their own. Slots are gapless from 0 in each shard. Extra columns are ignored; no
    rows give no rows.
    """
    spark = docs.sparkSession
    measured = durable(_measured(docs, text_column, dimensions, id_column))
    total = measured.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    names = list(dimensions)
    rows = durable(_pieces(measured, names, max(1.0, total / shards * PIECE)))
    coordinates = [f"c_{n}" for n in names]
    # One row per piece: what the tree is built over. The node is the path from the root.
    points = rows.groupBy(*coordinates).agg(F.sum("size").alias("bytes")).select(*coordinates, "bytes", F.lit(0).alias("node"))
    points = durable(points)
    widest_all = points.agg(*(F.coalesce(F.max(c) - F.min(c), F.lit(0)).alias(c) for c in coordinates)).first()
    leaves = {0: (0, shards)}  # node -> first shard, number of leaves; bounded by shards
    done: dict[int, int] = {}
    while leaves:
        done |= {node: first for node, (first, n) in leaves.items() if n == 1}
        leaves = {node: v for node, v in leaves.items() if v[1] > 1}
        if not leaves:
            break
        open_nodes = _values(spark, "node, share", [(k, float((n // 2) / n)) for k, (_, n) in leaves.items()])
        spreads = points.groupBy("node").agg(*(F.max(c).alias(f"hi_{c}") for c in coordinates), *(F.min(c).alias(f"lo_{c}") for c in coordinates))
        wide = [
            F.struct(_scaled(F.col(f"hi_{c}") - F.col(f"lo_{c}"), F.lit(float(widest_all[c]))).alias("w"), F.lit(-i).alias("i"))
            for i, c in enumerate(coordinates)
        ]
        axis = (-F.array_max(F.array(*wide))["i"]).alias("axis")
        axes = durable(open_nodes.join(spreads, "node").select("node", "share", axis))
        along = F.coalesce(*(F.when(F.col("axis") == i, F.col(c)) for i, c in enumerate(coordinates)))
        here = points.join(F.broadcast(axes.select("node", "axis")), "node", "left").withColumn("x", along)
        cuts = _cuts(here.where("axis IS NOT NULL").select("node", "x", "bytes"), axes)
        child = F.when(F.col("cut").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(F.col("x") <= F.col("cut"), 1).otherwise(2))
        points = durable(here.join(F.broadcast(cuts), "node", "left").select(*coordinates, "bytes", child.cast("int").alias("node")))
        grown = {}
        for node, (first, n) in leaves.items():
            grown[2 * node + 1] = (first, n // 2)
            grown[2 * node + 2] = (first + n // 2, n - n // 2)
        leaves = grown
    table = _values(spark, "node, shard", sorted(done.items()))
    placed = points.join(F.broadcast(table), "node").select(*coordinates, "shard")
    return numbered(rows.join(placed, coordinates).select("id", "size", "text_crc32", "shard").withColumnRenamed("id", id_column), id_column)


def numbered(rows: DataFrame, id_column: str) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard, ordered by a hash of the id.

    A shard is dealt into as many bins as its rows need, every bin is numbered by
    itself, and starts where the bins before it end.
    """
    rows = durable(rows)
    counts = rows.groupBy("shard").agg(F.ceil(F.count("*") / NUMBERED).cast("int").alias("bins"))
    # One row per shard.
    binned = durable(rows.join(F.broadcast(counts), "shard").withColumn("bin", F.pmod(F.xxhash64(id_column), "bins").cast("int")).drop("bins"))
    sizes = binned.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = Window.partitionBy("shard", "bin").orderBy(id_column, "size", "text_crc32")
    ranked = binned.withColumn("at", F.row_number().over(inner) - 1)
    # One row for each 50,000 rows.
    slotted = ranked.join(starts, ["shard", "bin"])
    return slotted.select(id_column, "size", "text_crc32", "shard", (F.col("at") + F.col("start")).cast("bigint").alias("slot"))
