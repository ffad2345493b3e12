import random

import pytest
from pyspark.sql import functions as F

from glosswork.sources import changes

CHANGE = "k int, a int, b string"


def rows_of(spark, path):
    return sorted(map(tuple, changes.read_current(spark, path).collect()), key=str)


def test_changes_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    stored = [(k % 12 if k else None, None if k % 5 == 0 else k, f"s{k}", f"other{k}") for k in range(20)]
    path = str(tmp_path / "table")
    changes.create_table(spark.createDataFrame(stored, CHANGE + ", other string"), path, ["a", "b"], "k")
    low = lambda v: (v is not None, v if v is not None else 0)
    best = {}

    def expected():
        got = [(k, *(best[k][1] if k in best else (a, b)), other) for k, a, b, other in stored]
        return sorted(got, key=str)

    assert rows_of(spark, path) == expected()
    for step in range(4):
        batch = []
        for _ in range(6):
            k, version = rng.choice([None, *range(14)]), rng.randint(1, 5)
            value = (rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]))
            batch.append((k, *value, version))
            rank = (version, low(value[0]), low(value[1]))
            if k is not None and rank >= best.get(k, ((0,), None))[0]:
                best[k] = (rank, value)
        df = spark.createDataFrame(batch, CHANGE + ", version long")
        changes.append_changes(df, path, F.col("version"))
        assert rows_of(spark, path) == expected()
        if step % 2:
            changes.fold_changes(spark, path)
            assert rows_of(spark, path) == expected()
    # A repeated batch changes nothing.
    changes.append_changes(df, path, F.col("version"))
    assert rows_of(spark, path) == expected()


def test_an_update_writes_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    table = spark.range(1000).select(F.col("id").alias("abstract_id"), F.lit(0).alias("topic_id"))
    changes.create_table(table, path, ["topic_id"])
    before = {p.name for p in (tmp_path / "table").glob("rows-*")}
    changes.append_changes(table.limit(10).withColumn("topic_id", F.lit(7)), path, F.lit(1))
    (new,) = {p.name for p in (tmp_path / "table").glob("rows-*")} - before
    assert spark.read.parquet(f"{path}/{new}").count() == 10
    changed = changes.read_current(spark, path)
    assert changed.filter("topic_id = 7").count() == 10 and changed.count() == 1000
    for _ in range(2):  # the second call deletes what the first replaced
        changes.fold_changes(spark, path)
    assert len(list((tmp_path / "table").glob("rows-*"))) == 1
    assert changes.read_current(spark, path).filter("topic_id = 7").count() == 10


def test_defined_errors(spark, tmp_path):
    empty = spark.createDataFrame([], CHANGE)
    with pytest.raises(ValueError):
        changes.append_changes(empty, str(tmp_path / "no"), F.lit(1))
    path = str(tmp_path / "table")
    changes.create_table(empty, path, ["a"], "k")
    changes.append_changes(empty, path, F.lit(1))
    assert rows_of(spark, path) == []
    with pytest.raises(ValueError):
        changes.create_table(empty, path, ["a"], "k")
