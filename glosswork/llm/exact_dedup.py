"""Exact duplicates: 128-bit content hash, bytes compared inside each hash.

Rows group by (hash, text): equal hashes with different bytes stay apart, and
copies merge in the task that reads them before any shuffle, so a text that a
third of all rows share sends one row per task. Members find their group by
(hash, SHA-256), a narrow join that adaptive execution splits on hot keys.

Defined results: a null text counts as empty; a null id never stays while the
group has another id; repeated rows (same id, same text) are copies of each
other and share the mark ``kept``; an empty table gives an empty result; other
columns are ignored by ``exact_groups`` and carried by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def content_hash(text: Column) -> Column:
    """MD5 of the UTF-8 bytes as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, lower-case hex."""
    return F.sha2(text.cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` names which id of a group stays, the smallest or the largest.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    pick = F.min if keep == "smallest" else F.max
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    groups = (
        rows.groupBy(content_hash(F.col("text")).alias("hash"), "text")
        .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", text_digest(F.col("text")).alias("text_sha256"), "keep_id", "group_size")
    )
    members = rows.select(
        "id", content_hash(F.col("text")).alias("hash"), text_digest(F.col("text")).alias("text_sha256")
    )
    return members.join(groups, ["hash", "text_sha256"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs``, one for each distinct text, with all their columns.

    Of repeated rows (same id, same text) any one stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    known = F.col(id_col).isNotNull()
    if keep == "smallest":
        best = F.min_by(row, F.struct(~known, F.col(id_col)))
    else:
        best = F.max_by(row, F.struct(known, F.col(id_col)))
    picked = docs.groupBy(content_hash(text).alias("_h"), text.alias("_t")).agg(best.alias("_row"))
    return picked.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
