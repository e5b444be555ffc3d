"""Hard negatives by threshold joins over an inverted index of vector blocks.

Rows lie in blocks; within a block the dimensions go by their energy, largest
first, and a block's index lists each dimension's values for the rows that need
it. A row is left out of a dimension's list once what remains of it, times what
remains of any anchor of the block it meets, cannot reach the threshold. Partial
scores are added up dimension by dimension, and a pair is dropped as soon as its
partial score and the remaining norms stay under the threshold. Pairs that are
left are scored again in whole numbers. Thresholds start high and fall, and an
anchor leaves once its windows are full.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litscope.session import durable, scratch, ship_package

# Rows of a block of the index, anchors of a block, and blocks that share a group.
ROWS, ANCHORS, GROUP = 2048, 256, 64
# Dimensions added up between two rounds of pruning.
STRIDE = 16
# Shares of the largest possible score at which positives are looked for; then all rows are.
POSITIVE_STEPS = (0.6, 0.3, 0.1)
# Where a window's threshold starts and goes on, between its ceiling (1) and its floor (0).
NEGATIVE_STEPS = (0.6, 0.3, 0.1, 0.0)
# Scaled components stay below this, so that a score of 2^11 dimensions fits a long.
LARGEST = 2**26
# Room for rounding in bounds, as a share of the norms.
SLACK = 1e-9
# Pairs of rows that are scored at once, and pairs of blocks that a task holds at once.
PAIRS, BLOCKS_AT_ONCE = 65_536, 32


@contextlib.contextmanager
def _small_batches(spark: SparkSession, rows: int):
    """Arrow batches of so many rows, for rows that hold a block each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dims, rids, ids, labels, values): up to ``size`` vectors of one length."""
    schema = "dims int, rids array<bigint>, ids array<bigint>, labels array<bigint>, values array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[pa.RecordBatch]] = {}

        def block(part: pa.Table, dims: int) -> pa.RecordBatch:
            def one(name: str, kind) -> pa.Array:
                values = pa.concat_arrays(part.column(name).chunks) if part.num_rows else pa.array([], kind)
                values = values.flatten() if name == "v" else values
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            arrays = [pa.array([dims], pa.int32()), one("rid", pa.int64()), one("id", pa.int64()), one("label", pa.int64()), one("v", pa.int32())]
            return pa.RecordBatch.from_arrays(arrays, names=["dims", "rids", "ids", "labels", "values"])

        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                waiting.setdefault(dims, []).append(batch.filter(pa.array(sizes == dims)))
                if sum(b.num_rows for b in waiting[dims]) >= size:
                    table = pa.Table.from_batches(waiting.pop(dims))
                    whole = table.num_rows // size * size
                    for start in range(0, whole, size):
                        yield block(table.slice(start, size), dims)
                    if whole < table.num_rows:
                        waiting[dims] = table.slice(whole).to_batches()
        for dims, parts in waiting.items():
            yield block(pa.Table.from_batches(parts), dims)

    return rows.select("rid", "id", "label", "v", F.size("v").alias("dims")).mapInArrow(run, schema)


def _suffix_norms(matrix: np.ndarray) -> np.ndarray:
    """Per row the norm of what follows each dimension, from all of it to none."""
    squares = np.cumsum(matrix[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(matrix), 1))], axis=1))


def threshold_pairs(rows: np.ndarray, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) places of all pairs whose product may reach the anchor's threshold."""
    order = np.argsort(-np.sum(rows.astype(float) ** 2, axis=0), kind="stable")
    y, x = rows[:, order].astype(float), anchors[:, order].astype(float)
    found = []
    for pairs, chosen in ((_all_pairs, np.flatnonzero(thresholds <= 0)), (_indexed_pairs, np.flatnonzero(thresholds > 0))):
        if len(chosen) and len(y):
            a, b = pairs(y, x[chosen], thresholds[chosen].astype(float))
            found.append((chosen[a], b))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _all_pairs(y: np.ndarray, x: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A threshold of 0 or less bounds nothing: remaining norms cannot rule a pair out."""
    slack = SLACK * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)
    return np.nonzero(x @ y.T + slack >= thresholds[:, None])


def _indexed_pairs(y: np.ndarray, x: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rest_y, rest_x = _suffix_norms(y), _suffix_norms(x)
    # A row is listed up to the first dimension from which no anchor could reach its threshold.
    shares = np.max(rest_x / thresholds[:, None], axis=0) * (1 + SLACK)
    listed = (rest_y[:, :-1] * shares[:-1] >= 1).sum(axis=1)
    by_need = np.argsort(-listed, kind="stable")
    by_need = by_need[listed[by_need] > 0]
    y, rest_y, listed = y[by_need], rest_y[by_need], listed[by_need]
    slack = SLACK * rest_x[:, :1] * rest_y[:, 0]
    scores = np.zeros((len(x), len(y)))
    alive = np.ones(scores.shape, bool)
    for start in range(0, y.shape[1], STRIDE):
        stop = min(start + STRIDE, y.shape[1])
        # The rows on the lists of these dimensions come first.
        most = int(np.searchsorted(-listed, -start, side="left"))
        if most == 0 or not alive.any():
            break
        lists = y[:most, start:stop] * (np.arange(start, stop) < listed[:most, None])
        scores[:, :most] += x[:, start:stop] @ lists.T
        seen = np.minimum(listed, stop)
        rest = rest_x[:, seen] * rest_y[np.arange(len(y)), seen]
        alive &= scores + rest + slack >= thresholds[:, None]
    a, b = np.nonzero(alive)
    return a, by_need[b]


def exact_scores(rows: np.ndarray, anchors: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products of the given pairs, some of them at a time."""
    out = np.empty(len(a), np.int64)
    for start in range(0, len(a), PAIRS):
        part = slice(start, start + PAIRS)
        out[part] = np.einsum("ij,ij->i", anchors[a[part]].astype(np.int64), rows[b[part]].astype(np.int64))
    return out


def _first(anchor: np.ndarray, window: np.ndarray, score: np.ndarray, row_id: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n of each (anchor, window), by score, then id."""
    order = np.lexsort((row_id, -score, window, anchor))
    key = np.stack([anchor[order], window[order]])
    new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]) if len(order) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < n]


_FOUND = "anchor bigint, win int, row_id bigint, row bigint, score bigint"


def _matrix(values: pa.ListScalar, vectors: int) -> np.ndarray:
    flat = values.values.to_numpy(zero_copy_only=False)
    return flat.reshape(vectors, len(flat) // vectors)


def _meet(same_label: bool, n: int):
    """Join a block of anchors with a block of rows; each keeps its first n pairs a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = {name: batch.column(name)[i] for name in batch.schema.names}
                flat = {k: get[k].values.to_numpy(zero_copy_only=False) for k in ("rids", "ids", "labels", "a_rids", "a_labels", "wins", "least", "most")}
                owner = np.repeat(np.arange(len(flat["a_rids"])), get["n_wins"].values.to_numpy(zero_copy_only=False))
                rows, anchors = _matrix(get["values"], len(flat["rids"])), _matrix(get["a_values"], len(flat["a_rids"]))
                lowest = np.full(len(anchors), np.inf)
                np.minimum.at(lowest, owner, flat["least"].astype(float))
                a, b = threshold_pairs(rows, anchors, lowest)
                alike = flat["a_labels"][a] == flat["labels"][b]
                kept = np.flatnonzero((alike if same_label else ~alike) & (flat["a_rids"][a] != flat["rids"][b]))
                a, b = a[kept], b[kept]
                score = exact_scores(rows, anchors, a, b)
                # Every window of its anchor looks at the pair.
                first = np.searchsorted(owner, np.arange(len(anchors) + 1))
                counts = first[a + 1] - first[a]
                pair = np.repeat(np.arange(len(a)), counts)
                win = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts) + first[a][pair]
                inside = np.flatnonzero((score[pair] >= flat["least"][win]) & (score[pair] <= flat["most"][win]))
                pair, win = pair[inside], win[inside]
                best = _first(a[pair], win, score[pair], flat["ids"][b[pair]], n)
                pair, win = pair[best], win[best]
                arrays = (flat["a_rids"][a[pair]], flat["wins"][win], flat["ids"][b[pair]], flat["rids"][b[pair]], score[pair])
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(arrays, kinds)], names=["anchor", "win", "row_id", "row", "score"])

    return run


def _threshold_join(blocks: DataFrame, windows: DataFrame, groups: int, same_label: bool, n: int) -> DataFrame:
    """The first n rows of every (anchor, win) with a score from ``least`` to ``most``.

    ``windows`` are (rid, label, v, wins array<struct<win, least, most>>). Rows are in
    groups of blocks; the anchors' blocks go to every group.
    """
    schema = "dims int, a_rids array<bigint>, a_labels array<bigint>, a_values array<int>, n_wins array<int>, wins array<int>, least array<bigint>, most array<bigint>"
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dims))
                for start in range(0, part.num_rows, ANCHORS):
                    piece = part.slice(start, ANCHORS)
                    wins = piece.column("wins")
                    inner = wins.flatten()
                    columns = [
                        piece.column("rid"), piece.column("label"), piece.column("v").flatten(), wins.value_lengths(),
                        inner.field("win"), inner.field("least"), inner.field("most"),
                    ]
                    lists = [pa.array([c.to_pylist()], pa.list_(k)) for c, k in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), *lists], names=["dims", "a_rids", "a_labels", "a_values", "n_wins", "wins", "least", "most"])

    gathered = durable(windows.select("rid", "label", "v", F.size("v").alias("dims"), "wins").mapInArrow(gather, schema))
    spread = gathered.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = blocks.join(spread, ["grp", "dims"])
    columns = ["rids", "ids", "labels", "values", "a_rids", "a_labels", "a_values", "n_wins", "wins", "least", "most"]
    found = met.select(*columns).mapInArrow(_meet(same_label, n), _FOUND)
    order = Window.partitionBy("anchor", "win").orderBy(F.col("score").desc(), "row_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    with _small_batches(blocks.sparkSession, BLOCKS_AT_ONCE):
        return durable(ranked)


def _until_full(blocks: DataFrame, anchors: DataFrame, groups: int, same_label: bool, n: int, steps: tuple) -> DataFrame:
    """Lower every window's threshold until it holds n rows or has reached its floor.

    ``anchors`` are (rid, label, v, win, floor, ceiling, start). ``steps`` are shares
    of the way from the floor to the start; after the last one the floor itself holds.
    """
    found = None
    for i, share in enumerate((*steps, None)):
        least = F.col("floor") if share is None else F.greatest("floor", F.ceil(F.col("start") * share).cast("bigint"))
        struct = F.struct("win", least.alias("least"), F.col("ceiling").alias("most"))
        windows = anchors.groupBy("rid").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.collect_list(struct).alias("wins"))
        part = _threshold_join(blocks, windows, groups, same_label, n)
        if share is None:
            return part if found is None else found.unionByName(part)
        counts = part.groupBy(F.col("anchor").alias("rid"), "win").agg(F.count("*").alias("n"))
        judged = anchors.join(counts, ["rid", "win"], "left")
        full = F.coalesce(F.col("n") >= n, F.lit(False)) | (least == F.col("floor"))
        judged = durable(judged.withColumn("full", full).drop("n"))
        done = judged.where("full").select(F.col("rid").alias("anchor"), "win")
        part = part.join(done, ["anchor", "win"], "left_semi")
        found = part if found is None else found.unionByName(part)
        anchors = judged.where("NOT full").drop("full")
        if anchors.isEmpty():
            return found
    return found


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x), and a score is the whole-number inner
    product with the anchor. An anchor's positives are its first other rows of the
    same label, by score, ties by the smaller id. For each of them come the first
    rows of another label whose score is from ``low`` to ``high`` hundredths of the
    positive's; a positive of negative score has none. All rows are met: thresholds
    fall until the windows are full or their floor is reached, so results are exact.

    Rows take no part if the id, label or vector is null, if a component is null or
    not finite, or if it is 2^26 or more after scaling, where a score could leave a
    long. Rows that agree in id, label and vector count once. Rows that share an id
    and differ are different rows: each can be an anchor, and they can meet. Vectors
    of different lengths never meet; empty ones score 0 with each other. No rows give
    no rows; other columns are not looked at, but by ``is_anchor``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scaled = F.transform(F.col(vector_column).cast("array<double>"), lambda x: F.floor(x * scale))
    small = F.forall(F.col(vector_column).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST))
    valid = F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & F.coalesce(small, F.lit(False))
    rows = vectors.where(valid).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(label_column).cast("bigint").alias("label"),
        scaled.cast("array<int>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    with scratch(spark):
        rows = durable(rows.distinct().withColumn("rid", F.monotonically_increasing_id()))
        found = durable(_mined(rows, positives, negatives, low, high), outlive=True)
    return found


def _mined(rows: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = rows.sparkSession
    n_rows = rows.count()
    # Groups of GROUP blocks, but enough of them for all cores.
    groups = max(1, min(-(-n_rows // 64), max(2 * spark.sparkContext.defaultParallelism, n_rows // (ROWS * GROUP))))
    blocks = rows.repartition(groups).select("rid", "id", "label", "v")
    blocks = durable(_blocks(blocks, ROWS).withColumn("grp", F.pmod(F.spark_partition_id(), F.lit(groups))))
    anchors = durable(rows.where("is_anchor").select("rid", F.col("id").alias("anchor_id"), "label", "v"))

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    longest = rows.agg(F.max(norm)).first()[0] or 0.0
    lowest, highest = -(2**63), 2**63 - 1
    wanted = anchors.select(
        "rid", "label", "v", F.lit(0).alias("win"), F.lit(lowest).alias("floor"), F.lit(highest).alias("ceiling"), (norm * longest).alias("start")
    )
    near = _until_full(blocks, wanted, groups, True, positives, POSITIVE_STEPS)
    near = durable(near.select("anchor", F.col("rank").alias("win"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # Whole numbers: the least score of at least low hundredths, the largest of at most high ones.
    floor = F.expr(f"(positive_score * {low} + 99) div 100")
    ceiling = F.expr(f"(positive_score * {high}) div 100")
    asked = near.where("positive_score >= 0").withColumns({"floor": floor, "ceiling": ceiling}).where("floor <= ceiling")
    asked = anchors.join(asked, F.col("rid") == F.col("anchor")).select("rid", "label", "v", "win", "floor", "ceiling", F.col("ceiling").cast("double").alias("start"))
    far = _until_full(blocks, durable(asked), groups, False, negatives, NEGATIVE_STEPS)
    out = far.join(near, ["anchor", "win"]).join(anchors.select(F.col("rid").alias("anchor"), "anchor_id"), "anchor")
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
