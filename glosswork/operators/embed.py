"""Text embeddings: signed feature hashing by default, a model as a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glosswork.fixed_values import EMBED_DIM
from glosswork.functions.text import is_stop_word, tokens
from glosswork.session import stage


def term_bucket_and_sign(term: Column, dim: int) -> tuple[Column, Column]:
    """Vector position and sign of a term, from its md5 (Weinberger 2009)."""
    digest = F.md5(F.encode(term, "UTF-8"))
    number = F.conv(F.substring(digest, 1, 6), 16, 10).cast("int")
    odd = F.conv(F.substring(digest, 7, 1), 16, 10).cast("int") % 2 == 1
    return number % dim, F.when(odd, -1).otherwise(1)


def term_counts(docs: DataFrame) -> DataFrame:
    """``abstract_id, term, tf`` of the words that are not stop words.

    Grouped by document plus term: no further shuffle on a frame that is
    partitioned by ``abstract_id``.
    """
    terms = docs.select("abstract_id", F.explode(tokens(F.col("summary"))).alias("term"))
    return (
        terms.filter(~is_stop_word(F.col("term")))
        .groupBy("abstract_id", "term")
        .agg(F.count("*").cast("int").alias("tf"))
    )


def term_idf(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """``term, idf, n_docs`` over a corpus; keep it to embed other texts in the same space."""
    n_docs = docs.agg(F.count("*").alias("n")).scalar()
    idf = F.ln((1 + n_docs) / (1 + F.col("df"))) + 1
    found = counts.groupBy("term").agg(F.count("*").alias("df"))
    return found.select("term", idf.alias("idf"), n_docs.alias("n_docs"))


def weighted_cells(counts: DataFrame, idf: DataFrame, dim: int) -> DataFrame:
    """``abstract_id, bucket, w``: signed TF-IDF weights per vector position.

    A term is hashed once per document it occurs in. Terms that the corpus of
    ``idf`` lacks weigh as terms of no document.
    """
    unseen = F.ln(1 + idf.agg(F.max("n_docs").alias("n")).scalar()) + 1
    bucket, sign = term_bucket_and_sign(F.col("term"), dim)
    weight = F.col("tf") * F.coalesce("idf", unseen, F.lit(1.0)) * sign
    return (
        counts.join(idf.select("term", "idf"), "term", "left")
        .select("abstract_id", bucket.alias("bucket"), weight.alias("w"))
        .groupBy("abstract_id", "bucket")
        .agg(F.sum("w").alias("w"))
    )


def dense_vectors(docs: DataFrame, weights: DataFrame, dim: int = EMBED_DIM) -> DataFrame:
    """Unit vectors from position weights: ``abstract_id, embedding``.

    A text without words, or whose weights cancel out, is the zero vector.
    """
    # Sums that cancel are zero whatever the order of their parts.
    weights = weights.withColumn("w", F.round("w", 9))
    cells = F.sort_array(F.collect_list(F.struct("bucket", "w")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")))
    grouped = weights.groupBy("abstract_id").agg(cells.alias("cells"), norm.alias("norm"))
    # The positions are sorted; each value follows the zeros before it.
    buckets = F.transform(F.col("cells"), lambda c: c["bucket"])
    before = F.concat(F.array(F.lit(-1)), buckets)
    zero = F.lit(0.0)
    value = lambda c: F.when(F.col("norm") == 0, zero).otherwise(c["w"] / F.col("norm"))
    runs = F.zip_with(
        F.col("cells"),
        F.slice(before, 1, F.size("cells")),
        lambda c, p: F.concat(F.array_repeat(zero, c["bucket"] - p - 1), F.array(value(c))),
    )
    tail = F.array_repeat(zero, dim - 1 - F.element_at("cells", -1)["bucket"])
    full = grouped.select("abstract_id", F.concat(F.flatten(runs), tail).alias("embedding"))
    none = F.array_repeat(zero, dim)
    return docs.select("abstract_id").join(full, "abstract_id", "left").select(
        "abstract_id", F.coalesce("embedding", none).alias("embedding")
    )


def hash_embedding(docs: DataFrame, dim: int = EMBED_DIM, idf: DataFrame | None = None) -> DataFrame:
    """Embed ``abstract_id, summary`` as hashed TF-IDF (Weinberger 2009).

    Pass the ``idf`` of the corpus to embed queries or later texts. Without it
    the counts are written once, for the frequencies and the vectors.
    """
    counts = term_counts(docs)
    if idf is None:
        counts = stage(counts, "counts")
        idf = term_idf(counts, docs)
    return dense_vectors(docs, weighted_cells(counts, idf, dim), dim)


def model_embedding(
    docs: DataFrame, load_model: Callable[[], Callable[[Sequence[str]], np.ndarray]]
) -> DataFrame:
    """Embed with a caller's model, loaded once per task; unit float vectors."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            vectors = np.asarray(model(batch.tolist()), dtype=np.float32)
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
            yield pd.Series(list(unit))

    return docs.select("abstract_id", run.asNondeterministic()(F.col("summary")).alias("embedding"))
