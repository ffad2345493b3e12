"""ROUGE-L scores, the quality gate and its accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from glosswork.fixed_values import ROUGE_GATE
from glosswork.functions.rouge import rouge_l


def passes_gate(score: Column, threshold: float = ROUGE_GATE) -> Column:
    """NULL scores fail."""
    return F.coalesce(score.cast("double") >= threshold, F.lit(False))


def with_rouge(df: DataFrame, stemmed: bool = True) -> DataFrame:
    return df.withColumn("rouge_score", rouge_l(F.col("abstract"), F.col("summary"), stemmed))


def quality_gate(scored: DataFrame, threshold: float = ROUGE_GATE) -> DataFrame:
    return scored.filter(passes_gate(F.col("rouge_score"), threshold))


def gate_accounting(scored: DataFrame, threshold: float = ROUGE_GATE) -> DataFrame:
    """One row: total, kept, blocked, in a single pass."""
    passed = passes_gate(F.col("rouge_score"), threshold)
    return scored.agg(
        F.count("*").alias("total"),
        F.count_if(passed).alias("kept"),
        F.count_if(~passed).alias("blocked"),
    )
