"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated, which keeps their distances, and split into blocks of a
few dimensions. A cosine of at least c is a squared distance of at most 2 - 2c; so
in at least one block the squared distance is within the block's share of it, in
proportion to its dimensions. Each block is range-joined under its budget: its
first coordinates are laid on a grid as wide as the budget allows, and only
neighbouring cells meet. The union of the candidates is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litscope.llm.components import components
from litscope.session import durable, ship_package

# Cells met from a cell, so that every pair of neighbouring cells meets once.
STEPS = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))
# Room for rounding in the rotated coordinates; the exact check decides.
SLACK = 1e-9


@cache
def _rotation(dimensions: int) -> np.ndarray:
    """A fixed random rotation, which spreads a difference evenly over the blocks."""
    normal = np.random.default_rng(dimensions).standard_normal((dimensions, dimensions))
    return np.linalg.qr(normal)[0]


def _blocks(entities: DataFrame, cosine: float, width: int) -> DataFrame:
    """A row for every vector and block: rotated coordinates, cell and budget."""
    names = [f"x{i}" for i in range(width)]
    schema = f"entity bigint, label string, dims int, block int, budget double, cx int, cy int, {', '.join(f'{n} double' for n in names)}"
    limit = 2 - 2 * cosine

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            # Vectors of one length at a time, as one matrix.
            for dims in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dims))
                vectors = part.column("unit").flatten().to_numpy().reshape(-1, dims) @ _rotation(dims)
                for block, start in enumerate(range(0, dims, width)):
                    own = vectors[:, start : start + width]
                    budget = limit * own.shape[1] / dims + SLACK
                    cells = np.floor(own / np.sqrt(budget)).astype(np.int32)
                    padded = np.zeros((len(own), width))
                    padded[:, : own.shape[1]] = own
                    n = len(own)
                    arrays = [
                        part.column("entity"),
                        part.column("label"),
                        part.column("dims"),
                        pa.array(np.full(n, block, np.int32)),
                        pa.array(np.full(n, budget)),
                        pa.array(cells[:, 0]),
                        pa.array(cells[:, 1] if own.shape[1] > 1 else np.zeros(n, np.int32)),
                        *(pa.array(np.ascontiguousarray(padded[:, i])) for i in range(width)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["entity", "label", "dims", "block", "budget", "cx", "cy", *names])

    return entities.select("entity", "label", "dims", "unit").mapInArrow(run, schema)


def _candidates(entities: DataFrame, cosine: float, width: int) -> DataFrame:
    """Pairs within the budget of some block."""
    rows = durable(_blocks(entities, cosine, width))
    names = [f"x{i}" for i in range(width)]
    steps = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in STEPS))
    there = rows.withColumn("step", F.explode(steps)).select(
        F.col("entity").alias("b"),
        "label",
        "dims",
        "block",
        (F.col("cx") + F.col("step.x")).alias("cx"),
        (F.col("cy") + F.col("step.y")).alias("cy"),
        ((F.col("step.x") == 0) & (F.col("step.y") == 0)).alias("same"),
        *(F.col(n).alias(f"y{i}") for i, n in enumerate(names)),
    )
    here = rows.withColumnRenamed("entity", "a")
    distance = F.expr(" + ".join(f"(x{i} - y{i}) * (x{i} - y{i})" for i in range(width)))
    keys = ["label", "dims", "block", "cx", "cy"]
    # Within a cell a pair meets twice; once is enough.
    met = here.join(there, keys).where(((F.col("a") < F.col("b")) | (~F.col("same") & (F.col("a") != F.col("b")))) & (distance <= F.col("budget")))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    width: int = 8,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors link if their labels are equal and not null and their cosine, in double
    precision, reaches ``cosine``; without a label column all may link. Vectors of
    different lengths never link. ``width`` dimensions make a block.

    Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing: no links, and a component of their own. Vectors with equal
    components are one entity under the smallest id, so copies cost nothing;
    n_links counts them all. Repeated rows with an equal id and vector count
    once; rows that share an id and differ are one vector whose links add up. A
    row without an id links with nothing, has a null component and is kept. No rows
    give no rows; other columns are not looked at.
    """
    ship_package(vectors.sparkSession)
    label = F.col(label_column).cast("string") if label_column else F.lit("")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), label.alias("label"), F.col(vector_column).cast("array<double>").alias("v"))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite & (largest > 0), F.lit(False))
    keys = [F.xxhash64(F.lit(salt), "label", "v").alias(f"key_{salt}") for salt in ("a", "b")]
    marked = rows.select("id", "label", "v", *keys, valid.alias("valid"))
    names = durable(marked.select("id", "key_a", "key_b", "valid"))
    scaled = F.transform("v", lambda x: x / largest)
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    entities = (
        marked.where("valid")
        .dropDuplicates(["key_a", "key_b", "id"])
        .groupBy("key_a", "key_b")
        .agg(F.min("id").alias("entity"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    )
    entities = entities.withColumn("scaled", scaled).withColumn("norm", norm)
    unit = F.transform("scaled", lambda x: x / F.col("norm"))
    entities = durable(entities.select("key_a", "key_b", "entity", "copies", "label", F.size("v").alias("dims"), unit.alias("unit")))

    pairs = durable(_candidates(entities, cosine, width))
    for c in "ab":
        pairs = pairs.join(entities.select(F.col("entity").alias(c), F.col("unit").alias(f"u{c}"), F.col("copies").alias(f"n{c}")), c)
    links = durable(pairs.where(_dot("ua", "ub") >= cosine).select("a", "b", "na", "nb"))
    linked = links.select(F.explode(F.array(F.struct(F.col("a").alias("entity"), F.col("nb").alias("n")), F.struct(F.col("b").alias("entity"), F.col("na").alias("n")))).alias("l"))
    linked = linked.groupBy("l.entity").agg(F.sum("l.n").alias("others"))

    members = names.where("valid").select("id", "key_a", "key_b").distinct()
    members = members.join(entities.select("key_a", "key_b", "entity", "copies"), ["key_a", "key_b"])
    members = durable(members.join(linked, "entity", "left").select("id", "entity", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n")))
    groups = components(links.select("a", "b").unionByName(members.select(F.col("id").alias("a"), F.col("entity").alias("b"))))
    counted = members.groupBy("id").agg(F.sum("n").alias("n_links"))
    found = names.select("id").join(counted, "id", "left").join(groups, "id", "left")
    component = F.coalesce("component", "id")
    return found.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
