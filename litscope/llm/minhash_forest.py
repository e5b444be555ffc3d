"""Near-duplicates of word-shingle sets by an LSH forest.

Every distinct set gets ``orders * DEPTHS[0]`` MinHash values. Each sorted order
starts at values of its own and goes on cyclically through the others, so it is a
tree of prefixes: two sets share a region of an order where their first values
agree, and the longer their common prefix, the closer they stand.

1. Candidates: some orders are sorted, over all tasks, by ever longer prefixes, and
   neighbours with a common prefix are candidates; how deep that prefix goes follows
   the density of the region. The texts of a region also meet its most copied one. A
   group of thousands of variants so yields a few candidates for each, not pairs.
2. Links confirmed on full sets give components.
3. Regions of all orders that still hold different components give the pairs
   across those components. Two texts share what both share with the region's most
   copied text, and some of what that one lacks. Pairs are looked up by the latter,
   and those that need none of it by their sizes, so that a group of thousands of
   variants is not held against itself. What is found is compared.

So every pair that shares a region is compared, or in one component, or cannot
link. Two sets of similarity s share no region with probability
``(1 - s ** DEPTHS[0]) ** orders``: 5e-7 at 0.8 with 48 orders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litscope.llm.components import components
from litscope.llm.shingles import mix, shingle_set
from litscope.session import durable, ship_package

# Prefix lengths that an order tells apart; the first bounds a region.
DEPTHS = (6, 12, 24)
# MinHash values that screen candidates.
SKETCH = 128

_PRINTS = "id bigint, n_shingles bigint, key_a bigint, key_b bigint, regions array<bigint>, middles array<int>, deeps array<int>, sketch array<tinyint>"


def _signer(orders: int, chains: int):
    """Values, hashes of every order's shortest prefix, and of the chains' longer ones."""
    count = orders * DEPTHS[0]
    factors = np.random.default_rng(7).integers(1, 2**32, count, dtype=np.uint32)[:, None] | np.uint32(1)
    places = (np.arange(orders)[:, None] * DEPTHS[0] + np.arange(DEPTHS[-1])) % count
    seeds = mix(np.arange(1, orders + 1, dtype=np.uint64))

    def sign(shingles: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        values = np.full(count, 2**32 - 1, np.uint32)
        for i in range(0, len(short), 4096):
            np.minimum(values, (factors * short[i : i + 4096]).min(axis=1), out=values)
        prefix, hashes = seeds, []
        for depth in range(DEPTHS[-1]):
            if depth == DEPTHS[0]:
                prefix = prefix[:chains]
            prefix = mix(prefix + values[places[: len(prefix), depth]])
            if depth + 1 in DEPTHS:
                hashes.append(prefix)
        return values, hashes

    return sign


def _prints(docs: DataFrame, size: int, orders: int, chains: int) -> DataFrame:
    """Set size, a 128-bit key of the set, prefixes and a sketch for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = _signer(orders, chains)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), size)
                if not len(shingles):
                    rows.append((0, 0, 0, [], [], [], []))
                    continue
                values, (regions, middles, deeps) = sign(shingles)
                key_a, key_b = shingles.sum(dtype=np.uint64), mix(shingles).sum(dtype=np.uint64)
                rows.append(
                    (
                        len(shingles),
                        key_a.astype(np.int64),
                        key_b.astype(np.int64),
                        regions.view(np.int64),
                        middles.astype(np.uint32).view(np.int32),
                        deeps.astype(np.uint32).view(np.int32),
                        (values[:SKETCH] & np.uint32(255)).astype(np.uint8).view(np.int8),
                    )
                )
            kinds = (pa.int64(), pa.int64(), pa.int64(), *(pa.list_(t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int8())))
            columns = zip(*rows) if rows else [[]] * len(kinds)
            arrays = [batch.column("id"), *(pa.array(list(c), t) for c, t in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _PRINTS.split(", ")])

    return docs.mapInArrow(run, _PRINTS)


def _neighbours(rows: DataFrame) -> DataFrame:
    """Adjacent rows of every order that agree in the shortest prefix at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = entity = np.empty(0, np.int64)
        for batch in batches:
            region = np.concatenate([region[-1:], batch.column("region").to_numpy()])
            entity = np.concatenate([entity[-1:], batch.column("entity").to_numpy()])
            near = (region[1:] == region[:-1]) & (entity[1:] != entity[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(entity[:-1][near]), pa.array(entity[1:][near])], names=["a", "b"])

    # The entity ends the sort key, so that a hot region spreads over tasks.
    order = ["region", "middle", "deep", "entity"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return _pairs(ordered.select("region", "entity").mapInArrow(run, "a bigint, b bigint"))


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _screened(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs whose sketches agree often enough to be worth their full sets."""
    for c in "ab":
        pairs = pairs.join(sketches.select(F.col("entity").alias(c), F.col("sketch").alias(f"s{c}")), c)
    equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return pairs.where(equal >= least * F.size("sa")).select("a", "b")


def _sets(docs: DataFrame, named: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of the documents that ``named`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), size).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return durable(docs.join(named, "id", "left_semi").mapInArrow(run, "id bigint, shingles array<bigint>"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    for c in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(c), F.col("shingles").alias(f"s{c}")), c)
    shared = F.size(F.array_intersect("sa", "sb"))
    return durable(pairs.where(_reaches(shared, F.size("sa"), F.size("sb"), percent)).select("a", "b").distinct())


def _reaches(shared: Column, one: Column, other: Column, percent: int) -> Column:
    return 100 * shared >= percent * (one + other - shared)


def _across(places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components near one hub that may link.

    ``places`` has region, hub, entity and component, and ``sets`` the shingles. What
    two texts share they share with the hub, or it is among the extra shingles that
    the hub lacks. So either both share an extra, and more of them the further one
    is from the hub: an equality join on extras, rare ones first, of which each text
    lists as many as leave out too few to link. Or what they share with the hub is
    enough for their sizes, which for a text that is not linked to the hub asks for
    one that is smaller than the hub: an equality join on these sizes.
    """
    near = durable(places.select("entity", "hub", "component").distinct())
    home = near.where("entity = hub").select("hub", F.col("component").alias("home"))
    # The hub itself has met all of its region.
    rows = near.where("entity <> hub").join(home, "hub").withColumn("home", F.col("component") == F.col("home"))
    for c in ("entity", "hub"):
        rows = rows.join(sets.select(F.col("id").alias(c), F.col("shingles").alias(f"s_{c}")), c)
    rows = durable(
        rows.select(
            "entity",
            "hub",
            "component",
            "home",
            F.size("s_entity").alias("n"),
            F.size(F.array_intersect("s_entity", "s_hub")).alias("shared"),
            F.array_except("s_entity", "s_hub").alias("extras"),
        )
    )
    extras = rows.select("entity", "hub", "component", F.explode("extras").alias("shingle"))
    several = extras.groupBy("hub", "shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("held"))
    several = durable(several.where("lo <> hi").select("hub", "shingle", "held"))
    extras = durable(extras.drop("component").join(several, ["hub", "shingle"]))
    common = extras.groupBy("entity", "hub").agg(F.count("*").alias("common"))
    least = rows.groupBy("hub").agg(F.min("n").alias("least"))
    known = rows.drop("extras").join(common, ["entity", "hub"], "left").join(least, "hub").fillna(0, ["common"])
    # So many extras has any text that links with this one in common with it.
    known = known.withColumn("needs", F.ceil(percent * (F.col("n") + F.col("least")) / (100 + percent)) - F.col("shared"))
    known = durable(known.where("needs <= common"))

    def side(df: DataFrame, by: list[str], c: str) -> DataFrame:
        return df.select(*by, *(F.col(x).alias(f"{x}_{c}") for x in ("entity", "component", "n", "shared", "common")))

    def may(extra: Column) -> Column:
        enough = _reaches(F.least("shared_a", "shared_b") + extra, F.col("n_a"), F.col("n_b"), percent)
        return enough & (F.col("component_a") != F.col("component_b"))

    rarest = Window.partitionBy("hub", "entity").orderBy("held", "shingle")
    listed = extras.join(known, ["entity", "hub"]).withColumn("place", F.row_number().over(rarest))
    listed = durable(listed.where(F.col("place") <= F.col("common") - F.greatest("needs", F.lit(1)) + 1))
    key = ["hub", "shingle"]
    pairs = side(listed, key, "a").join(side(listed, key, "b"), key)
    pairs = pairs.where(may(F.least("common_a", "common_b")) & (F.col("entity_a") < F.col("entity_b")))
    found = _pairs(pairs.select(F.col("entity_a").alias("a"), F.col("entity_b").alias("b")))

    # Sizes of texts that may link with a text of another component than the hub's by what both share with the hub.
    most = F.floor((100 + percent) * F.col("shared") / percent) - F.col("n")
    first = F.greatest(F.col("least").cast("bigint"), F.ceil(percent * F.col("n") / 100))
    close = known.where("needs <= 0")
    outer = close.where(~F.col("home")).withColumns({"first": first, "most": most}).where("first <= most")
    outer = outer.withColumn("size", F.explode(F.sequence("first", "most")))
    key = ["hub", "size"]
    pairs = side(outer, key, "a").join(side(close.withColumn("size", F.col("n").cast("bigint")), key, "b"), key).where(may(F.lit(0)))
    return found.unionByName(_pairs(pairs.select(F.col("entity_a").alias("a"), F.col("entity_b").alias("b")))).distinct()


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    orders: int = 48,
    chains: int = 3,
    screen: float = 0.6,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    ``size`` words make a shingle; texts with fewer words are one shingle.
    ``percent`` is the least 100 * intersection / union of linked sets. Pairs with
    under ``screen`` of their SKETCH MinHash values equal skip the full comparison
    (5.5 standard deviations below 0.8 for 128 values).

    Null, empty and blank texts have no shingles and link with nothing. Equal sets
    are one entity under its smallest id, so copies cost nothing. Rows that share
    an id are one document and so in one component. A null id links with nothing:
    its component is null and it is kept. Other columns are not looked at.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    prints = durable(_prints(docs, size, orders, chains))
    whole = prints.where("n_shingles > 0 AND id IS NOT NULL")
    key = ["key_a", "key_b", "n_shingles"]
    entities = durable(
        whole.groupBy(*key).agg(
            F.min("id").alias("entity"),
            F.count("*").alias("copies"),
            *(F.first(c).alias(c) for c in ("regions", "middles", "deeps", "sketch")),
        )
    )
    sketches = entities.select("entity", "sketch")
    # Copies hang on their entity; an id with several sets ties their entities together.
    copies = whole.join(entities.select(*key, "entity"), key).where("id <> entity").select(F.col("id").alias("a"), F.col("entity").alias("b"))

    rows = entities.select("entity", "copies", F.explode("regions").alias("region"))
    first = F.max_by("entity", F.struct("copies", -F.col("entity"))).alias("hub")
    crowded = rows.groupBy("region").agg(F.count("*").alias("n"), first).where("n > 1").select("region", "hub", "n")
    rows = durable(rows.select("region", "entity").join(durable(crowded), "region"))
    hubs = rows.where("entity <> hub").select(F.col("entity").alias("a"), F.col("hub").alias("b"))
    some = F.arrays_zip(F.slice("regions", 1, chains).alias("regions"), "middles", "deeps")
    sorted_rows = entities.select("entity", F.explode(some).alias("z"))
    sorted_rows = sorted_rows.select("entity", *(F.col(f"z.{c}s").alias(c) for c in ("region", "middle", "deep")))
    tried = durable(_screened(_pairs(hubs.unionByName(_neighbours(sorted_rows))), sketches, screen))
    links = _confirmed(tried, _sets(docs, _ends(tried), size), percent)
    groups = components(links)

    member = F.coalesce("component", "entity").alias("component")
    # Two in a region have met as text and hub.
    placed = rows.where("n > 2").join(groups.withColumnRenamed("id", "entity"), "entity", "left").select("region", "hub", "entity", member)
    several = placed.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = durable(placed.join(several.select("region"), "region", "left_semi"))
    sets = _sets(docs, mixed.select(F.col("entity").alias("id")).distinct(), size)
    untried = durable(_across(mixed, sets, percent).join(tried, ["a", "b"], "left_anti"))
    more = _confirmed(durable(_screened(untried, sketches, screen)), sets, percent)

    groups = components(links.unionByName(more).unionByName(copies))
    named = prints.select("id", "n_shingles").join(groups, "id", "left")
    component = F.coalesce("component", "id")
    return named.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
