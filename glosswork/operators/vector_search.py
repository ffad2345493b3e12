"""Vector search: exact top-k by inner product, and by cells.

Vectors come as ``abstract_id, embedding`` (plus ``cell``), queries as
``query_id, query_vector``. No pair table is built: each task multiplies a
block of vectors with a block of queries and keeps k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glosswork.fixed_values import SEED, VECTOR_TOP_K
from glosswork.operators.fulltext import first_per_query
from glosswork.session import stage

QUERY_BLOCK = 1024
VECTOR_BLOCK = 20_000
DIGITS = 6
_CHUNK = 256
_RUNS = 64


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors])


def _best(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = rows.sort_values(
        ["query_id", "similarity", "abstract_id"], ascending=[True, False, True]
    )
    return ordered.groupby("query_id", sort=False).head(k)


def _block_top_k(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> pd.DataFrame:
    """Best ``k`` vectors of one block for each query; ties by id.

    The ``k``-th greatest of the maxima of runs of vectors is at most the
    ``k``-th greatest score, so only scores from there on are rounded and ranked.
    """
    columns, run = vectors.T, max(1, len(ids) // (_RUNS * k))
    parts = []
    for start in range(0, len(query_ids), _CHUNK):
        scores = queries[start : start + _CHUNK] @ columns
        floor = -np.inf
        if len(ids) > k:
            whole = len(ids) // run
            tops = scores[:, : whole * run].reshape(len(scores), whole, run).max(axis=2)
            floor = np.partition(tops, -k, axis=1)[:, -k][:, None]
            floor = floor - 2 * 10.0**-DIGITS - 1e-15 * np.abs(floor)
        if np.isnan(scores.sum()):  # no number: neither ranked nor bounded by maxima
            scores = np.round(scores, DIGITS)
            floor = np.partition(scores, -k, axis=1)[:, -k][:, None] if len(ids) > k else -np.inf
        q, v = np.nonzero(scores >= floor)
        parts.append((q + start, v, np.round(scores[q, v], DIGITS)))
    picked_q, picked_v, similarity = (np.concatenate(p) for p in zip(*parts))
    rows = pd.DataFrame(
        {
            "query_id": query_ids[picked_q],
            "abstract_id": ids[picked_v],
            "similarity": similarity,
        }
    )
    return _best(rows, k)


def _result_type(vectors: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("abstract_id", vectors.schema["abstract_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )


def _rank(partial: DataFrame, k: int) -> DataFrame:
    return first_per_query(partial, k, F.desc("similarity"), F.asc("abstract_id"))


def _with_blocks(rows: DataFrame, of: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` with the number of blocks that ``of`` has in their cell.

    One row per cell is joined; without cells the number is a scalar.
    """
    blocks = F.ceil(F.count("*") / F.lit(size)).cast("int").alias(name)
    if "cell" in rows.columns:
        return rows.join(of.groupBy("cell").agg(blocks), "cell")
    return rows.withColumn(name, of.agg(F.greatest(blocks, F.lit(1)).alias(name)).scalar())


def _placed(rows: DataFrame, id_column: str, size: int, name: str) -> DataFrame:
    """Rows with their block, cut by a hash of the id inside each cell, so a
    cell with a third of all rows becomes many blocks."""
    block = F.pmod(F.xxhash64(id_column), F.col("n")).cast("int")
    return _with_blocks(rows, rows, size, "n").withColumn(name, block).drop("n")


def _search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Blocks of vectors meet blocks of queries; any number of either.

    A vector goes through the shuffle once. Queries are packed, a block in a
    row, and packed rows are repeated for the vector blocks of their cells. A
    task holds one block of vectors and streams the query blocks past it.
    """
    out = _result_type(vectors, queries)
    cell = [c for c in ("cell",) if c in vectors.columns]
    item = F.struct("query_id", "query_vector")
    asked = (
        _placed(queries, "query_id", QUERY_BLOCK, "qb")
        .groupBy(*cell, "qb")
        .agg(F.collect_list(item).alias("queries"))
    )
    asked = _with_blocks(asked, vectors, VECTOR_BLOCK, "nv").select(
        *cell, F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"), F.lit(1).alias("kind"), "queries"
    )
    held = _placed(vectors, "abstract_id", VECTOR_BLOCK, "vb").withColumn("kind", F.lit(0))
    rows = held.unionByName(asked, allowMissingColumns=True)
    rows = rows.select(
        (F.col("cell") if cell else F.lit(0)).alias("cell"), "vb", "kind", "abstract_id", "embedding", "queries"
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, parts, ids, matrix = None, [], None, None
        for batch in batches:
            for (cell, vb, kind), own in batch.groupby(["cell", "vb", "kind"], sort=True):
                if (cell, vb) != block:
                    block, parts, ids, matrix = (cell, vb), [], None, None
                if kind == 0:
                    parts.append(own[["abstract_id", "embedding"]])
                elif parts or ids is not None:
                    if ids is None:
                        whole, parts = pd.concat(parts), []
                        ids = whole["abstract_id"].to_numpy(dtype=object)
                        matrix = _matrix(whole["embedding"])
                    for queries in own["queries"]:
                        query_ids = np.array([q["query_id"] for q in queries], dtype=object)
                        yield _block_top_k(ids, matrix, query_ids, _matrix([q["query_vector"] for q in queries]), k)

    met = rows.repartition("cell", "vb").sortWithinPartitions("cell", "vb", "kind")
    return _rank(met.mapInPandas(score, out), k)


def _scan(vectors: DataFrame, queries: DataFrame, asked: list, k: int) -> DataFrame:
    """One block of queries goes to the tasks that read the vectors; these are not shuffled."""
    query_ids = np.array([q["query_id"] for q in asked], dtype=object)
    matrix = _matrix([q["query_vector"] for q in asked])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            if len(batch):
                ids = batch["abstract_id"].to_numpy(dtype=object)
                rows = _block_top_k(ids, _matrix(batch["embedding"]), query_ids, matrix, k)
                best = rows if best is None else _best(pd.concat([best, rows]), k)
        if best is not None:
            yield best

    return _rank(vectors.mapInPandas(score, _result_type(vectors, queries)), k)


def vector_search(vectors: DataFrame, queries: DataFrame, k: int = VECTOR_TOP_K) -> DataFrame:
    """Exact best ``k`` vectors per query: ``query_id, abstract_id, similarity, rank``.

    Up to ``QUERY_BLOCK`` queries travel through the driver to the vectors, a
    few megabytes; more of them meet the vectors in blocks.
    """
    vectors, queries = vectors.select("abstract_id", "embedding"), queries.select("query_id", "query_vector")
    asked = queries.limit(QUERY_BLOCK + 1).collect()
    if 0 < len(asked) <= QUERY_BLOCK:
        return _scan(vectors, queries, asked, k)
    return _search(vectors, queries, k)


def summary_search(
    vectors: DataFrame, queries: DataFrame, summaries: DataFrame, k: int = VECTOR_TOP_K
) -> DataFrame:
    """Best ``k`` vectors that have a summary, with the summary's columns.

    Vectors without one leave before the cut, so a query gets ``k`` rows
    wherever there are as many.
    """
    known = vectors.join(summaries.select("abstract_id"), "abstract_id", "left_semi")
    return with_summaries(vector_search(known, queries, k), summaries)


def with_summaries(hits: DataFrame, summaries: DataFrame) -> DataFrame:
    """Join the hits, already cut to k per query, with their summaries."""
    return hits.join(
        summaries.select("abstract_id", "summary", "rouge_score", "topic_label"), "abstract_id"
    )


def fit_cells(vectors: DataFrame, n_cells: int = 100, seed: int = SEED) -> list[list[float]]:
    """Centroids by cosine k-means; ``n_cells`` rows, the only thing the driver sees."""
    points = vectors.select(array_to_vector("embedding").alias("features"))
    kmeans = KMeans(k=n_cells, seed=seed, featuresCol="features", distanceMeasure="cosine")
    return [list(map(float, c)) for c in kmeans.fit(points).clusterCenters()]


def nearest(vector: Column, centroids: list[list[float]], n: int, ids: list[int] | None = None) -> Column:
    """The ``n`` centroids with the largest cosine, best first, as an array of
    ``id, similarity``; ties go to the lower id."""
    matrix = np.array(centroids, dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    names = np.array(ids if ids is not None else range(len(centroids)), dtype=np.int32)
    by_id = np.argsort(names, kind="stable")
    matrix, names = matrix[by_id], names[by_id]
    element = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("similarity", T.DoubleType())]
    )

    @F.pandas_udf(T.ArrayType(element))
    def rank(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype="object")
                continue
            points = _matrix(batch)
            size = np.linalg.norm(points, axis=1, keepdims=True)
            unit = np.divide(points, size, out=np.zeros_like(points), where=size > 0)
            scores = unit @ matrix.T
            order = np.argsort(-np.round(scores, DIGITS), axis=1, kind="stable")[:, :n]
            yield pd.Series(
                [
                    [{"id": int(names[c]), "similarity": float(row[c])} for c in picks]
                    for picks, row in zip(order, scores)
                ]
            )

    # Nondeterministic: a filter on the result must not run the function again.
    return rank.asNondeterministic()(vector)


def with_cell(vectors: DataFrame, centroids: list[list[float]], ids: list[int] | None = None) -> DataFrame:
    best = nearest(F.col("embedding"), centroids, 1, ids)
    return vectors.withColumn("cell", F.get(best, F.lit(0))["id"])


def write_cells(vectors: DataFrame, path: str, mode: str = "append") -> None:
    """Store vectors with the cell as partition column.

    Rows are rebalanced by cell: a large cell is written by many tasks.
    """
    vectors.hint("rebalance", "cell").write.mode(mode).partitionBy("cell").parquet(path)


def vector_search_cells(
    vectors: DataFrame,
    queries: DataFrame,
    centroids: list[list[float]],
    n_probe: int,
    k: int = VECTOR_TOP_K,
    ids: list[int] | None = None,
) -> DataFrame:
    """Best ``k`` among the ``n_probe`` nearest cells of each query.

    Vectors of cells that no query probes are pruned: at run time, from a table
    stored by cell. The probes are written once, for the pruning and the search.
    """
    probes = F.transform(nearest(F.col("query_vector"), centroids, n_probe, ids), lambda c: c["id"])
    probed = stage(queries.select("query_id", "query_vector", F.explode(probes).alias("cell")), "probed")
    # The comparison holds for every cell; Spark prunes partitions only by a filtered side.
    lowest = min(ids) if ids else 0
    wanted = probed.filter(F.col("cell") >= lowest).select("cell").distinct()
    wanted = F.broadcast(wanted)  # at most one row per centroid
    kept = vectors.select("abstract_id", "embedding", "cell").join(wanted, "cell", "left_semi")
    return _search(kept, probed, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of the exact hits that ``found`` holds."""
    key = ["query_id", "abstract_id"]
    hit = found.select(*key, F.lit(1).alias("hit"))
    return exact.select(key).join(hit, key, "left").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def mean_vectors(vectors: DataFrame, group: str) -> DataFrame:
    """Mean vector per group, summed position by position."""
    parts = vectors.select(group, F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(group).agg(F.transform(ordered, lambda p: p["x"]).alias("centroid"))
