"""Corpus and topic statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def mean_rouge() -> Column:
    return F.round(F.avg(F.col("rouge_score").cast("double")), 3)




def vector_count(vectors: DataFrame) -> Column:
    """Row count of another table as a scalar subquery."""
    return vectors.agg(F.count("*").alias("n")).scalar()


def topic_histogram(summaries: DataFrame) -> DataFrame:
    return (
        summaries.groupBy("topic_label")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc_nulls_last("topic_label"))
    )


def topic_stats(summaries: DataFrame) -> DataFrame:
    """Count and mean score per topic, biggest first."""
    return (
        summaries.groupBy("topic_id", "topic_label")
        .agg(F.count("*").alias("count"), mean_rouge().alias("avg_rouge"))
        .orderBy(F.desc("count"), F.asc_nulls_last("topic_id"), F.asc_nulls_last("topic_label"))
    )


def corpus_stats(summaries: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: counts, mean score (0 when empty) and the topic map.

    Grouped by label first, so the last step sees one row per topic; rows
    without a label are counted, but have no place in the map.
    """
    per_topic = summaries.groupBy("topic_label").agg(
        F.count("*").alias("n"),
        F.sum(F.col("rouge_score").cast("double")).alias("total"),
        F.count("rouge_score").alias("scored"),
    )
    entry = F.when(F.col("topic_label").isNotNull(), F.struct("topic_label", "n"))
    mean = F.round(F.try_divide(F.sum("total"), F.sum("scored")), 3)
    out = per_topic.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_rouge"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("topics"),
    )
    return out.select("count", "avg_rouge", vector_count(vectors).alias("vectors"), "topics")


def verify_report(summaries: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: records, vectors, mean score, distinct labels."""
    out = summaries.agg(
        F.count("*").alias("records"),
        mean_rouge().alias("avg_rouge"),
        F.count_distinct("topic_label").alias("topics"),
    )
    return out.select("records", vector_count(vectors).alias("vectors"), "avg_rouge", "topics")


def source_count(retrieved: DataFrame) -> DataFrame:
    """Number of retrieved rows per query."""
    return retrieved.groupBy("query_id").agg(F.count("*").alias("sources"))


def topic_overview(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """Topic, count and name, in topic order."""
    counts = assigned.groupBy("topic_id").agg(F.count("*").alias("count"))
    name = F.concat_ws("_", F.col("topic_id").cast("string"), F.col("topic_label"))
    return (
        counts.join(labels.select("topic_id", "topic_label"), "topic_id", "left")
        .select(F.col("topic_id").alias("topic"), "count", name.alias("name"))
        .orderBy("topic")
    )
