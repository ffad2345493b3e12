"""Keyed writes: insert if absent, update by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def insert_if_absent(new: DataFrame, stored: DataFrame, key: str = "abstract_id") -> DataFrame:
    """Rows to append: one per key, none whose key is stored."""
    return new.dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def update_by_key(
    stored: DataFrame, updates: DataFrame, columns: list[str], key: str = "abstract_id"
) -> DataFrame:
    """``stored`` with ``columns`` taken from the matching update row, if any.

    Keys not stored are ignored. Of several updates of a key the one with the
    largest values, compared column by column in the order of ``columns`` with
    NULL lowest, is taken.
    """
    value = F.struct(*[F.col(c) for c in columns])
    new = updates.groupBy(key).agg(F.max(value).alias("_new"))
    joined = stored.join(new, key, "left")
    keep = [
        F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in stored.columns
    ]
    return joined.select(*keep)
