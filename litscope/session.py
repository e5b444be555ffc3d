"""Session settings and durable intermediate results."""

from __future__ import annotations

import contextlib
import pathlib
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}

_shipped: set[str] = set()


def get_spark(app: str = "litscope", master: str | None = None, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = pathlib.Path(__file__).parent
        stem = f"{tempfile.mkdtemp(prefix='litscope-')}/litscope"
        archive = shutil.make_archive(stem, "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate data.

    Read from ``spark.checkpoint.dir``. Only a local session that names none
    gets a folder of its own; a cluster without one is a configuration error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="litscope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


# Folders of the open ``scratch`` scopes, innermost last.
_scopes: list[list[str]] = []


def durable(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage, so a lost executor costs no recomputation, and gives the
    planner the true size: a join then broadcasts this table only if it is small.
    The folder goes when the application ends, or with the ``scratch`` around it;
    with ``outlive``, with the one around that.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/litscope-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    scopes = _scopes[:-1] if outlive else _scopes
    if scopes:
        scopes[-1].append(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Drop the intermediate tables written inside when the block ends.

    What the block computes must be read or written before that.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Of what is written inside, each write's shuffle files go when it ends, not at some later collection."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def handed_out(df: DataFrame, most: int) -> DataFrame:
    """A table for a join: every task gets it if it has up to ``most`` rows, else Spark joins as it sees fit."""
    df = durable(df)
    return F.broadcast(df) if df.count() <= most else df


@contextlib.contextmanager
def rows_at_once(spark: SparkSession, rows: int):
    """Arrow batches of up to so many rows for what is computed inside, where a row is large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as a local table, which the planner sees in full."""
    kinds = T.DataType.fromDDL(schema)
    columns = zip(*rows) if rows else [[] for _ in kinds.fields]
    arrays = [pa.array(list(c), _ARROW[f.dataType.simpleString()]) for c, f in zip(columns, kinds.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=kinds.names), kinds)
