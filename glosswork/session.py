"""Shared staging folder for tables that cut a long plan."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        base = os.path.join(tempfile.mkdtemp(prefix="glosswork-"), "glosswork")
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", here, "glosswork"))
        _shipped.add(app)


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is unset and the
    whole session is one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="glosswork-stage-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the staging folder and read it back."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it ends, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the input: neither goes through the driver, however small it is now."""
    return left.join(right.hint("merge"), on, how)


def drop_staged(*frames: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for frame in frames:
        spark, path = frame.sparkSession, getattr(frame, "staged_at", None)
        if path is None or not path.startswith(staging_root(spark)):
            raise ValueError("not a staged table")
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
