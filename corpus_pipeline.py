"""Training-data pipeline over the table documents: each stage keeps whole rows, the last gives tokens.

Toxic documents go, then exact copies, then near copies, then documents with
benchmark passages; the rest is encoded. Every stage sees all that the one
before kept, as a written table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from glosswork.llm import bpe, decontaminate, exact_dedup, near_dup, toxicity
from glosswork.session import ship, stage

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


BATCH_ROWS = 2000


def _ready(spark: SparkSession) -> None:
    """The package on the executors, and Arrow batches of so many whole texts."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    chain = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, chain)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each distinct text."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by five-word shingles at 0.8."""
    _ready(spark)
    dropped = near_dup.near_duplicates(docs, width=5, percent=80).filter("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids, and digests of the ids and of what they decode to."""
    _ready(spark)
    ranks = bpe.read_ranks(spark, RANKS)
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return bpe.digests(encoded, ranks, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]
# Near copies and merges are not SQL; the rows are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
