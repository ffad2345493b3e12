"""Corpus scans, stored tables and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from glosswork.operators.ingest import normalize_corpus
from glosswork.schema import STORED_BY, TABLES


def read_corpus(
    spark: SparkSession,
    path: str,
    text_column: str = "content",
    first: int | None = None,
    order_by: str | None = None,
    source_format: str = "parquet",
) -> DataFrame:
    """The source texts; ``first`` keeps only the lowest rows by ``order_by``."""
    df = normalize_corpus(spark.read.format(source_format).load(path), text_column)
    if first is not None:
        df = df.orderBy(order_by or "abstract").limit(first)
    return df


def setup_tables(spark: SparkSession, root: str) -> None:
    """Create every stored table that does not exist yet; safe to repeat."""
    for name, schema in TABLES.items():
        if not table_exists(spark, f"{root}/{name}"):
            append_table(spark.createDataFrame([], schema), root, name)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table, or an empty frame of its schema."""
    path = f"{root}/{name}"
    if not table_exists(spark, path):
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).parquet(path)


def append_table(df: DataFrame, root: str, name: str) -> None:
    schema: StructType = TABLES[name]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    writer = df.select(*typed).write.mode("append")
    if name in STORED_BY:
        writer = writer.partitionBy(*STORED_BY[name])
    writer.parquet(f"{root}/{name}")


def known_ids(spark: SparkSession, root: str, threshold: float | None = None) -> DataFrame:
    """Ids that need no work: stored summaries and rejected documents.

    With a ``threshold``, a document that a higher gate blocked comes again if
    its score now passes.
    """
    stored = read_table(spark, root, "summaries").select("abstract_id")
    blocked = read_table(spark, root, "rejected")
    if threshold is not None:
        blocked = blocked.filter(~F.coalesce(F.col("rouge_score").cast("double") >= threshold, F.lit(False)))
    return stored.union(blocked.select("abstract_id"))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append over JDBC straight from the executors; the caller gives the options."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.jdbc(url=url, table=table, properties=properties)
