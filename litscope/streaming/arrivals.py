"""Follow a folder of dumps: each file is read once, when it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from litscope.session import durable
from litscope.sources.records import SEPARATOR, chunk_text, judged_records, parsed_records, split_records


def _first_free_id(spark: SparkSession, path: str, batch: int) -> int:
    """Ids go on where earlier batches stopped, so a replayed batch gets the same."""
    if batch == 0:
        return 0
    earlier = spark.read.parquet(path).where(F.col("batch") < batch)
    top = earlier.agg(F.max("doc_id")).first()[0]
    return 0 if top is None else top + 1


def follow_dumps(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    encoding: str = "UTF-8",
    separator: str = SEPARATOR,
) -> StreamingQuery:
    """Append the records of new files to ``out/corpus`` and ``out/quarantine``.

    Every batch owns a directory and overwrites only that, so a batch that is
    repeated after a failure leaves no duplicates.
    """
    lines = spark.readStream.option("lineSep", separator).text(folder)

    def append(chunks: DataFrame, batch: int) -> None:
        session = chunks.sparkSession
        parsed = parsed_records(chunk_text(chunks, encoding), separator)
        corpus, quarantine = split_records(durable(judged_records(parsed)))
        base = _first_free_id(session, f"{out}/corpus", batch)
        corpus = corpus.withColumn("doc_id", F.col("doc_id") + F.lit(base))
        corpus.write.mode("overwrite").parquet(f"{out}/corpus/batch={batch}")
        quarantine.write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch}")

    return (
        lines.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
