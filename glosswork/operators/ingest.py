"""Content ids, duplicate removal, and what is new against the stored ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from glosswork.functions.text import content_id


def normalize_corpus(df: DataFrame, text_column: str = "content") -> DataFrame:
    """Rename the text column to ``abstract``; raise if it is missing."""
    if text_column not in df.columns:
        raise KeyError(f"no text column {text_column!r} among {df.columns}")
    return df.withColumnRenamed(text_column, "abstract")


def with_content_id(df: DataFrame) -> DataFrame:
    """Drop NULL texts and add the content hash as ``abstract_id``.

    The filter on the id drops nothing more. It is the one a join on the id
    would add to one of its sides, and lets both sides share a shuffle.
    """
    rows = df.na.drop(subset=["abstract"])
    rows = rows.withColumn("abstract_id", content_id(F.col("abstract")))
    return rows.filter(F.col("abstract_id").isNotNull())


def distinct_documents(
    df: DataFrame, order_by: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per content id; ``keep`` columns come from the lowest ``order_by``.

    Copies are merged before the shuffle, so a text that makes up a third of
    the input costs one row per task. The result is hash-partitioned by id, and
    the per-document operators after it need no further shuffle.
    """
    aggregates = [F.any_value("abstract").alias("abstract")]
    if order_by:
        first = F.min(F.struct(order_by, *[c for c in keep if c != order_by])).alias("_first")
        aggregates.append(first)
    out = df.groupBy("abstract_id").agg(*aggregates)
    return out.select("abstract_id", "abstract", *[F.col(f"_first.{c}").alias(c) for c in keep])


def new_documents(docs: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Documents whose id is not stored yet."""
    return docs.join(known_ids.select("abstract_id"), "abstract_id", "left_anti")


def ingest_accounting(docs: DataFrame, known_ids: DataFrame) -> DataFrame:
    """One row: rows loaded, already stored, new."""
    per_id = docs.groupBy("abstract_id").agg(F.count("*").alias("n"))
    known = known_ids.select("abstract_id").distinct().withColumn("stored", F.lit(True))
    stored = F.coalesce(F.col("stored"), F.lit(False))
    return per_id.join(known, "abstract_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.when(stored, F.col("n"))), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(~stored, F.col("n"))), F.lit(0)).alias("new"),
    )
