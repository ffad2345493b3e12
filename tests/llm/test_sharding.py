import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswork.llm import sharding as s


def written(spark, frame, path, **options):
    s.write_shards(frame, str(path), **options)
    return [(r.shard, r.slot, r.record) for r in s.read_shards(spark, str(path), frame.schema).collect()]


def check(rows, n, shards):
    slots = {}
    for shard, slot, _ in rows:
        slots.setdefault(shard, []).append(slot)
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert len(rows) == n and sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.fixture
def many(docs):
    return docs([(i, f"text {i % 50} " * (1 + i % 40)) for i in range(500)] + [(None, None), (None, None), (7, ""), (1, None)])


@pytest.mark.parametrize("shards,bucket", [(16, 4000), (16, 1 << 20), (7, 900)])
def test_shards_are_even_gapless_and_whole(spark, many, tmp_path, shards, bucket):
    rows = written(spark, many, tmp_path / "a", shards=shards, bucket_bytes=bucket)
    check(rows, 504, shards)
    assert Counter(r for *_, r in rows) == Counter(many.collect())


def test_order_follows_the_seed_not_the_layout(spark, many, tmp_path):
    place = lambda rows: sorted((k, j, str(r)) for k, j, r in rows)
    one = written(spark, many.repartition(1), tmp_path / "a", bucket_bytes=4000)
    two = written(spark, many.repartition(9, "n_chars"), tmp_path / "b", bucket_bytes=4000)
    other = written(spark, many, tmp_path / "c", bucket_bytes=4000, seed=2)
    assert place(one) == place(two) != place(other)
    assert [r.doc_id for *_, r in sorted(one, key=lambda x: x[:2])][:20] != list(range(20))


def test_files_hold_slots_in_order(spark, many, tmp_path):
    s.write_shards(many, str(tmp_path / "a"), shards=3, bucket_bytes=3000)
    for shard in range(3):
        slots = []
        for file in sorted((tmp_path / "a" / f"shard={shard}").glob("part-*")):
            slots += [r.slot for r in spark.read.parquet(str(file)).collect()]
        assert slots == list(range(len(slots)))


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(s.fisher_yates(4, 1, b)) for b in range(4800))
    assert len(seen) == 24 and all(120 < n < 290 for n in seen.values())


def test_places_are_uniform(spark, docs, tmp_path):
    rows = written(spark, docs([(i, f"t{i}") for i in range(2000)]), tmp_path / "a", shards=4, bucket_bytes=1000)
    table = np.zeros((4, 4))
    for shard, _, r in rows:
        table[r.doc_id // 500, shard] += 1
    assert (abs(table - 125) < 50).all()


def test_repeated_rows_are_dealt_over_buckets(spark, docs, tmp_path):
    frame = docs([(1, "same text here")] * 300 + [(i, f"other {i}") for i in range(300)])
    rows = written(spark, frame, tmp_path / "a", shards=4, bucket_bytes=500)
    check(rows, 600, 4)
    assert Counter(r for *_, r in rows) == Counter(frame.collect())
    assert all(sum(1 for k, _, r in rows if k == shard and r.doc_id == 1 and r.text == "same text here") > 30 for shard in range(4))


def test_few_rows_empty_tables_and_clashing_columns(spark, docs, tmp_path):
    check(written(spark, docs([(1, "a"), (2, "b")]), tmp_path / "a"), 2, 16)
    assert written(spark, docs([]), tmp_path / "b") == []
    frame = spark.createDataFrame([(1, "a", 5, 6), (2, None, 7, 8)], "doc_id bigint, text string, shard int, slot int")
    frame = frame.selectExpr("*", "1 AS bucket", "2 AS size", "3 AS key", "4 AS record", "5 AS place")
    rows = written(spark, frame, tmp_path / "c")
    assert Counter(r for *_, r in rows) == Counter(frame.collect())


def test_long_texts(spark, docs, tmp_path):
    frame = docs([(0, "x" * 9_000_000), (1, "y"), (2, "z" * 9_000_000)])
    rows = written(spark, frame, tmp_path / "a", shards=2, bucket_bytes=1 << 20)
    check(rows, 3, 2)
    assert {r.doc_id: zlib.crc32(r.text.encode()) for *_, r in rows} == {
        r.doc_id: r.c for r in frame.select("doc_id", F.crc32(F.col("text").cast("binary")).alias("c")).collect()
    }
