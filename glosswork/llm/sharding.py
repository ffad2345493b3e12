"""Two-pass external shuffle of a table into shards.

First pass: every record is dealt to one of many buckets by a seeded hash of
its id and text, so that a bucket holds about ``BUCKET_BYTES`` whatever the
size of the table. Second pass: one task reads one bucket into memory, brings
it into an order that does not depend on how it arrived, shuffles it by
Fisher-Yates with a generator seeded by (seed, bucket), and writes it. All
buckets in a row are one random order of the table; shards are even cuts of
it, so row counts differ by one at most and slots have no gaps. A task writes
one shard, or two where a cut falls into its bucket, and the files of a shard
hold its slots in order.

The count of rows per bucket is one row for ``BUCKET_BYTES`` of text (16 bytes
for 32 MB), which bounds what is broadcast and what one task sums up.

A bucket that outgrows its size holds rows that repeat with the same id and
text. All its rows are dealt once more, by a random number each, and written,
so that the number is fixed; only their places depend on the run. All other
rows have the same place in every run with the same seed.

Defined results: a null text has no bytes and counts one for the record; null
ids and repeated rows are records like any other; with fewer records than
shards, some shards have none; an empty table writes no records; a text larger
than a bucket makes its bucket that much larger; all columns are kept in one
struct ``record``, so no name clashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from glosswork.session import stage

BUCKET_BYTES = 32 << 20
OVERFULL = 4
PIECE_BYTES = 8 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A random order of n records; numpy's shuffle swaps from the last place down."""
    order = np.arange(n)
    np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, bucket]))).shuffle(order)
    return order


def _shuffled(rows: DataFrame, seed: int) -> DataFrame:
    """``bucket, place, record`` of rows ``bucket, size, record`` that are sorted by bucket."""

    def flush(batches: list[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches)
        order = fisher_yates(len(held), seed, bucket)
        piece = np.cumsum(held["size"].to_numpy()[order]) // PIECE_BYTES
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1, [len(order)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            picked = held.select(["bucket", "record"]).take(pa.array(order[a:b]))
            yield from picked.add_column(1, "place", pa.array(np.arange(a, b))).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and buckets[a] != current:
                    yield from flush(held, current)
                    held = []
                current = int(buckets[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush(held, current)

    fields = rows.schema
    out = StructType([fields["bucket"], StructField("place", LongType()), fields["record"]])
    return rows.mapInArrow(run, out)


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 16,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write all records in random order as Parquet, one folder per shard."""
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    text = F.col(text_col).cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size")
    key = F.xxhash64(F.lit(seed), F.col(id_col), text).alias("key")
    rows = docs.select(key, size, record)
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))

    def sized(frame: DataFrame) -> DataFrame:
        return frame.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))

    sizes = stage(sized(rows), "buckets")
    over = sizes.filter((F.col("bytes") > OVERFULL * bucket_bytes) & (F.col("n") > 1)).select("bucket")
    if not over.isEmpty():
        few = F.broadcast(over)  # one row for many times BUCKET_BYTES
        again = F.pmod(F.xxhash64("key", F.monotonically_increasing_id(), F.rand(seed)), F.lit(buckets)).cast("int")
        dealt = stage(rows.join(few, "bucket", "left_semi").withColumn("bucket", again), "dealt")
        rows = rows.join(few, "bucket", "left_anti").select(dealt.columns).unionByName(dealt)
        sizes = stage(sized(rows), "buckets")
    ordered = [F.col("bucket"), F.col("key"), F.col(f"record.`{id_col}`"), F.col(f"record.`{text_col}`")]
    rows = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions(*ordered)
    placed = _shuffled(rows.select("bucket", "size", "record"), seed)

    count = sizes.agg(F.sum("n")).first()[0] or 0
    before = F.expr("coalesce(sum(n) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    starts = sizes.select("bucket", before.cast("bigint").alias("start"))
    at = F.col("start") + F.col("place")
    out = placed.join(F.broadcast(starts), "bucket").withColumn("at", at)
    out = out.withColumn("shard", F.expr(f"CAST(at * {shards} DIV {max(count, 1)} AS INT)"))
    slot = F.expr(f"at - (shard * {count}L + {shards - 1}) DIV {shards}")
    out = out.select("record", slot.alias("slot"), "shard").sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``record, slot, shard`` of written shards of a table with this schema."""
    fields = [StructField("record", schema), StructField("slot", LongType()), StructField("shard", IntegerType())]
    return spark.read.schema(StructType(fields)).parquet(path)
