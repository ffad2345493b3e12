"""Incremental ingest as a file stream that runs until it is caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from glosswork.operators.ingest import normalize_corpus
from glosswork.plans.jobs import ingest
from glosswork.sources.tables import table_exists


def start_ingest(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checkpoint: str,
    handle: Callable[[DataFrame], object],
    text_column: str = "content",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Hand every new file to ``handle`` once, then stop.

    ``handle`` gets a micro-batch with an ``abstract`` column. A batch that is
    repeated after a lost driver must add nothing: use a handler that skips
    stored ids, such as ``enrich`` or ``append_new``.
    """
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )

    def each(batch: DataFrame, _batch_id: int) -> None:
        handle(normalize_corpus(batch, text_column))

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_new(path: str) -> Callable[[DataFrame], None]:
    """Handler: append the documents whose id is not in the table yet."""
    def handle(batch: DataFrame) -> None:
        spark = batch.sparkSession
        known = spark.createDataFrame([], "abstract_id string")
        if table_exists(spark, path):
            known = spark.read.schema("abstract_id string").parquet(path)
        ingest(batch, known).write.mode("append").parquet(path)

    return handle

