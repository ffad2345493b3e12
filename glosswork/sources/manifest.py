"""Versioned lists of what a stored table consists of.

A table of several folders is described by the rows of ``path/version=N`` with
the largest N. A list is one file, written after the folders it names, so a
reader sees all of a change or nothing of it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession


def versions(spark: SparkSession, path: str, schema: str) -> dict[int, list[Row]]:
    """The stored lists by version; empty where there is none."""
    try:
        rows = spark.read.schema(f"{schema}, version int").parquet(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    found: dict[int, list[Row]] = {}
    for r in rows:
        found.setdefault(r["version"], []).append(Row(**{c: v for c, v in r.asDict().items() if c != "version"}))
    return found


def newest(spark: SparkSession, path: str, schema: str) -> list[Row]:
    found = versions(spark, path, schema)
    return found[max(found)] if found else []


def publish(spark: SparkSession, path: str, schema: str, rows: list[tuple]) -> None:
    """Write the next list; fails if another writer was faster."""
    version = max(versions(spark, path, schema), default=0) + 1
    one_file = spark.createDataFrame(rows, schema).coalesce(1)
    one_file.write.mode("errorifexists").parquet(f"{path}/version={version}")
