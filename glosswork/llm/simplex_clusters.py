"""Clustering around centroids with an n-simplex filter before exact comparison.

Vectors become integer vectors, floor(scale * x). A few of them are pivots. The
exact distances of a vector to the pivots, taken once, give its apex: the place
of the vector over the simplex of the pivots, in as many coordinates as there
are pivots, the last being its height. Apexes are stored with the vectors. For
two vectors with apexes x and y, the distance of x and y is a lower bound, and
that of x and y mirrored at the base an upper bound of their true distance. In
every round a centroid gets an apex too; centroids whose lower bound exceeds
the least upper bound of a vector are out, and the rest are compared by exact
integer distances. Bounds carry a slack far above their rounding errors, so
the filter never decides wrongly, it only leaves more to compare.

Tasks add up the integer vectors of each centroid; one row per centroid and
component reaches the driver in a round, which takes exact floors. A vector
that a third of all rows share is added up where it is read, like any other.

Defined results: vectors of another length, or with null or non-finite
components, are left out, as are null vectors; repeated rows and equal vectors
each count; a null id is the last to become a first centroid; fewer vectors than centroids make fewer
centroids; of equal distances the smaller number wins; an empty centroid stays
where it is; an empty table gives an empty result; other columns are ignored.
Components beyond ``LIMIT`` after scaling raise an error, as their squared
distances could pass 64 bits; an inertia beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from glosswork.llm.near_dup import _binary, _rows
from glosswork.session import stage

PIVOTS = 16
POOL = 64  # rows among which pivots are chosen
LIMIT = 1 << 27
HEIGHT = 0.05  # least height of a pivot over the others, as a share of its distance to the first
SLACK = 1e-5
BLOCK = 8192


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, q``: the vectors that are kept, as arrays of integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter((F.size("v") == dims) & F.forall("v", finite))
    small = F.forall("v", lambda x: F.abs(x * scale) <= LIMIT)
    told = F.raise_error(F.lit(f"a component beyond {LIMIT} after scaling"))
    ints = F.transform("v", lambda x: F.floor(x * scale).cast("int"))
    return rows.select("id", F.when(small, ints).otherwise(told.cast("array<int>")).alias("q"))


class Simplex:
    """Pivots and the lower triangle of their coordinates."""

    def __init__(self, pool: np.ndarray, most: int = PIVOTS):
        """Pivots from the rows of ``pool``, in order; those almost in the span of the others are passed over."""
        self.pivots, self.base = pool[:1], np.zeros((0, 0))
        for row in pool[1:]:
            if len(self.pivots) == most:
                break
            apex = self.apex(row[None])[0]
            height = apex[-1]
            if height <= HEIGHT * np.linalg.norm(apex) or height == 0:
                continue
            size = len(apex)
            base = np.zeros((size, size))
            base[:-1, :-1], base[-1] = self.base, apex
            if np.linalg.cond(base) > 1e3:
                continue
            self.pivots, self.base = np.vstack([self.pivots, row[None]]), base

    def apex(self, rows: np.ndarray) -> np.ndarray:
        """Coordinates over the pivots, from exact squared distances."""
        far = np.stack([((rows - p) ** 2).sum(axis=1) for p in self.pivots], axis=1).astype(np.float64)
        out = np.zeros((len(rows), len(self.pivots)))
        if len(self.base):
            right = (far[:, :1] + (self.base**2).sum(axis=1) - far[:, 1:]) / 2
            out[:, :-1] = np.linalg.solve(self.base, right.T).T
        out[:, -1] = np.sqrt(np.maximum(far[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out


def _bounds(apex: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of all distances, slack included."""
    low = np.stack([((apex - c) ** 2).sum(axis=1) for c in centres], axis=1)
    up = low + 4 * apex[:, -1:] * centres[:, -1]
    slack = SLACK * ((apex**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1))
    return low - slack, up + slack


def nearest(rows: np.ndarray, apex: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, int]:
    """The number of the nearest centroid per row, and how many exact distances that took."""
    out, compared = np.zeros(len(rows), np.int64), 0
    for lo in range(0, len(rows), BLOCK):
        own = rows[lo : lo + BLOCK]
        low, up = _bounds(apex[lo : lo + BLOCK], centres)
        left = low <= up.min(axis=1, keepdims=True)
        out[lo : lo + BLOCK] = left.argmax(axis=1)
        open_ = np.flatnonzero(left.sum(axis=1) > 1)
        row, number = np.nonzero(left[open_])
        if not len(row):
            continue
        far = ((own[open_[row]] - centroids[number]) ** 2).sum(axis=1)
        compared += len(far)
        by = np.lexsort((number, far, row))
        first = by[np.flatnonzero(np.concatenate([[True], row[by][1:] != row[by][:-1]]))]
        out[lo + open_[row[first]]] = number[first]
    return out, compared


def _sums(projected: DataFrame, centroids: np.ndarray, centres: np.ndarray) -> DataFrame:
    """``cluster, dim, n, total, compared`` over all vectors."""
    dims, pivots = centroids.shape[1], centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, tried = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), 0
        for batch in batches:
            rows = _rows(batch.column(0), np.int32, dims).astype(np.int64)
            found, compared = nearest(rows, _rows(batch.column(1), np.float64, pivots), centroids, centres)
            n += np.bincount(found, minlength=len(n))
            tried += compared
            for c in np.unique(found):
                total[c] += rows[found == c].sum(axis=0)
        used = np.flatnonzero(n)
        cluster = np.repeat(used, dims)
        columns = [cluster, np.tile(np.arange(dims), len(used)), n[cluster], total[used].ravel(), np.zeros(len(cluster), np.int64)]
        if len(cluster):
            columns[4][0] = tried
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "dim", "n", "total", "compared"])

    parts = projected.select("q", "apex").mapInArrow(run, "cluster bigint, dim bigint, n bigint, total bigint, compared bigint")
    return parts.groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("compared").alias("compared")
    )


def _placed(projected: DataFrame, centroids: np.ndarray, centres: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of all vectors."""
    dims, pivots = centroids.shape[1], centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column(1), np.int32, dims).astype(np.int64)
            found, _ = nearest(rows, _rows(batch.column(2), np.float64, pivots), centroids, centres)
            far = ((rows - centroids[found]) ** 2).sum(axis=1)
            columns = [batch.column(0), pa.array(found.astype(np.int32)), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    fields = [projected.schema["id"], StructField("cluster", IntegerType()), StructField("distance", LongType())]
    return projected.select("id", "q", "apex").mapInArrow(run, StructType(fields))


def clusters(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    scale: int = 1024,
    k: int = 8,
    rounds: int = 10,
    salt: str = "3",
    seen: list | None = None,
) -> DataFrame:
    """Per kept vector: id, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    First centroids are the ``k`` vectors with the smallest SHA-256 of
    ``salt:id``. ``seen`` receives the number of exact distances per round.
    """
    spark = table.sparkSession
    rows = integer_vectors(table, id_col, vector_col, dims, scale)
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("mark")
    first = rows.select("q", mark).orderBy(F.asc_nulls_last("mark"), "q").limit(max(POOL, k)).collect()
    pool = np.array([r["q"] for r in first], np.int64).reshape(len(first), dims)
    simplex, centroids = Simplex(pool), pool[:k]
    id_field = rows.schema["id"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy()
            q = flat.reshape(batch.num_rows, dims)
            columns = [batch.column(0), _binary(q.astype(np.int32)), _binary(simplex.apex(q.astype(np.int64)))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "q", "apex"])

    if not len(pool):
        out = spark.createDataFrame([], StructType([id_field])).select(
            "id", F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
        return out.withColumnRenamed("id", id_col)
    kind = id_field.dataType.simpleString()
    projected = stage(rows.mapInArrow(project, f"id {kind}, q binary, apex binary"), "projected")
    for _ in range(rounds):
        sums = _sums(projected, centroids, simplex.apex(centroids)).collect()
        if seen is not None:
            seen.append(sum(r["compared"] for r in sums))
        moved = centroids.copy()
        for r in sums:
            moved[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
        if (moved == centroids).all():
            break
        centroids = moved
    placed = stage(_placed(projected, centroids, simplex.apex(centroids)), "placed")
    totals = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    fits = lambda x: x if x < 1 << 63 else None
    every = fits(sum(int(r["inertia"]) for r in totals))
    spelled = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(r["cluster"], fits(int(r["inertia"])), every, spelled[r["cluster"]]) for r in totals]
    fields = [("cluster", IntegerType()), ("cluster_inertia", LongType()), ("inertia", LongType()), ("centroid_sha256", StringType())]
    facts = spark.createDataFrame(facts, StructType([StructField(*f) for f in fields]))
    out = placed.join(F.broadcast(facts), "cluster")  # at most k rows
    return out.select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
