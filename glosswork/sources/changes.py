"""Tables updated by key through files of changes.

An update writes its own rows and nothing else; the newest value of a key is
taken when the table is read, and ``fold_changes`` now and then writes it into
the table. A change carries a version. Of several changes of a key the largest
version wins, whatever the order in which they were written; of equal versions
the largest values, column by column with NULL lowest, so a repeated change
changes nothing. Changes of keys that are not stored, or of NULL keys, are
ignored. Rows that share a key all change.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from glosswork.session import delete_folder
from glosswork.sources import manifest

_STATE = "folder string, changes boolean, key string, columns array<string>"


def create_table(rows: DataFrame, path: str, columns: list[str], key: str = "abstract_id") -> None:
    """Store ``rows``; changes will replace their ``columns``."""
    spark = rows.sparkSession
    if manifest.versions(spark, f"{path}/state", _STATE):
        raise ValueError(f"there is a table at {path}")
    folder = _write(rows.withColumn("_version", F.lit(None).cast("long")), path)
    manifest.publish(spark, f"{path}/state", _STATE, [(folder, False, key, columns)])


def append_changes(changes: DataFrame, path: str, version: Column) -> None:
    """Add new values of the changed columns by key; ``version`` is a number per row."""
    spark = changes.sparkSession
    state = _state(spark, path)
    key, columns = state[0]["key"], state[0]["columns"]
    folder = _write(changes.select(key, *columns, version.cast("long").alias("_version")), path)
    manifest.publish(spark, f"{path}/state", _STATE, [*map(tuple, state), (folder, True, key, columns)])


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table with the newest value of every changed column.

    A few changes meet the stored rows by broadcast, which Spark decides by
    their size; else both sides are shuffled by key.
    """
    return _current(spark, path, _state(spark, path)).drop("_version")


def fold_changes(spark: SparkSession, path: str) -> None:
    """Write the changes into the table.

    Rows remember the version they hold: a change that comes late is still
    ignored. Folders that only earlier states name are deleted; those replaced
    now stay for running readers until the next call.
    """
    states = manifest.versions(spark, f"{path}/state", _STATE)
    state = states.pop(max(states))
    for folder in {r["folder"] for rows in states.values() for r in rows} - {r["folder"] for r in state}:
        delete_folder(spark, f"{path}/{folder}")
    for version in states:
        delete_folder(spark, f"{path}/state/version={version}")
    if any(r["changes"] for r in state):
        folder = _write(_current(spark, path, state), path)
        manifest.publish(spark, f"{path}/state", _STATE, [(folder, False, state[0]["key"], state[0]["columns"])])


def _state(spark: SparkSession, path: str) -> list[Row]:
    state = manifest.newest(spark, f"{path}/state", _STATE)
    if not state:
        raise ValueError(f"no table at {path}")
    return state


def _write(rows: DataFrame, path: str) -> str:
    folder = f"rows-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    return folder


def _current(spark: SparkSession, path: str, state: list[Row]) -> DataFrame:
    table = next(spark.read.parquet(f"{path}/{r['folder']}") for r in state if not r["changes"])
    batches = [f"{path}/{r['folder']}" for r in state if r["changes"]]
    if not batches:
        return table
    key, columns = state[0]["key"], ["_version", *state[0]["columns"]]
    types = {f.name: f.dataType for f in table.schema}
    value = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns])
    new = spark.read.parquet(*batches).groupBy(key).agg(F.max(value).alias("_new"))
    # Where nothing was ever changed, any change wins.
    newer = F.col("_new").isNotNull() & (F.col("_version").isNull() | (F.col("_new") >= F.struct(*columns)))
    joined = table.join(new, key, "left").withColumn("_newer", newer)
    keep = [
        F.when(F.col("_newer"), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in table.columns
    ]
    return joined.select(*keep)
