"""Approximate vector search over a graph of neighbours.

Vectors of unit length, ``abstract_id, embedding``, compared by inner product.

* **Build.** Cells give every vector its first neighbours. Then neighbours of
  neighbours meet: the vectors linked from one row travel to it once, are
  compared there, and a pair leaves only where it improves one of its lists.
  Lists are pruned to neighbours that are nearer to the row than to each other,
  and filled up with the nearest; links go both ways.
* **Search.** A beam per query, grown in rounds of joins: the best nodes not
  yet opened give their links, unseen ends fetch their vectors, and the best
  ``ef`` stay. It ends when all of them are open. Tables are stored by cell, and
  links name the cell of their end, so a round reads the cells it touches.
* **Insert.** Later vectors are searched for, linked to what they find and
  appended, with links back; nothing stored is rewritten. A search follows the
  ``2 * m`` strongest links of a node, however many were added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from glosswork.functions.vectors import inner_product
from glosswork.operators import vector_search as vs
from glosswork.session import stage

LINKS = 16
EF = 64
WIDTH = 8  # nodes opened per query and round
STARTS = 4
ROUNDS = 3
PROBES = 4


@dataclass
class Graph:
    """``vectors``: abstract_id, embedding, cell; ``links``: abstract_id, cell, to, to_cell, similarity;
    ``entries``: one vector per cell; ``centroids``: cell, centroid."""

    vectors: DataFrame
    links: DataFrame
    entries: DataFrame
    centroids: DataFrame
    m: int


def _best(edges: DataFrame, m: int) -> DataFrame:
    """The ``m`` most similar ends of every row."""
    order = Window.partitionBy("abstract_id").orderBy(F.desc("similarity"), "to")
    return edges.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= m).drop("rank")


def _gathered(vectors: DataFrame, edges: DataFrame, extra: dict) -> DataFrame:
    """Per row: itself and what it links to, as lists ``ids, points`` and more, itself first."""
    own = vectors.select("abstract_id", F.col("abstract_id").alias("to"), F.lit(2.0).alias("similarity"))
    met = own.unionByName(edges.select("abstract_id", "to", "similarity"))
    ends = vectors.select(F.col("abstract_id").alias("to"), "embedding", *extra.values())
    item = F.struct(F.negative("similarity").alias("far"), "to", "embedding", *extra)
    lists = met.join(ends, "to").groupBy("abstract_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return lists.select(
        "abstract_id", F.col("items.to").alias("ids"), F.col("items.embedding").alias("points"), *[F.col(f"items.{x}").alias(x) for x in extra]
    )


def _edge_type(vectors: DataFrame) -> T.StructType:
    kind = vectors.schema["abstract_id"].dataType
    return T.StructType([T.StructField("abstract_id", kind), T.StructField("to", kind), T.StructField("similarity", T.DoubleType())])


def _refined(vectors: DataFrame, edges: DataFrame, m: int) -> DataFrame:
    """One round in which neighbours of neighbours meet, by links in both directions."""
    floor = edges.groupBy("abstract_id").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least"))
    floor = vectors.join(floor, "abstract_id", "left").select(
        "abstract_id", "embedding", F.when(F.col("n") >= m, F.col("least")).otherwise(-np.inf).alias("floor")
    )
    back = edges.select(F.col("to").alias("abstract_id"), F.col("abstract_id").alias("to"), "similarity")
    met = _gathered(floor, _best(edges.unionByName(back).distinct(), m), {"floor": F.col("floor")})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for ids, points, floors in zip(batch["ids"], batch["points"], batch["floor"]):
                matrix = np.array(points.tolist(), dtype=np.float64)
                score = np.round(matrix @ matrix.T, vs.DIGITS)
                np.fill_diagonal(score, -np.inf)
                a, b = np.nonzero(score > np.asarray(floors)[:, None])
                parts.append((ids[a], ids[b], score[a, b]))
            if parts:
                a, b, score = (np.concatenate(p) for p in zip(*parts))
                yield pd.DataFrame({"abstract_id": a, "to": b, "similarity": score})

    new = met.mapInPandas(meet, _edge_type(vectors))
    return stage(_best(edges.unionByName(new).distinct(), m), "edges")


def _pruned(vectors: DataFrame, edges: DataFrame, m: int) -> DataFrame:
    """Links to ends that are nearer to the row than to a better end, at least half of ``m``; and back."""
    met = _gathered(vectors, edges, {})

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ids, points in zip(batch["ids"], batch["points"]):
                matrix = np.array(points.tolist(), dtype=np.float64)
                score = np.round(matrix @ matrix.T, vs.DIGITS)
                kept, left = [], []
                for i in range(1, len(ids)):
                    (kept if all(score[0, i] > score[i, j] for j in kept) else left).append(i)
                kept += left[: max(0, m // 2 - len(kept))]
                rows += [(ids[0], ids[i], score[0, i]) for i in kept]
            yield pd.DataFrame(rows, columns=["abstract_id", "to", "similarity"])

    one = met.mapInPandas(prune, _edge_type(vectors))
    both = one.unionByName(one.select(F.col("to").alias("abstract_id"), F.col("abstract_id").alias("to"), "similarity"))
    return _best(both.distinct(), 2 * m)


def _with_cells(links: DataFrame, placed: DataFrame) -> DataFrame:
    where = placed.select("abstract_id", "cell")
    links = links.join(where, "abstract_id").join(where.toDF("to", "to_cell"), "to")
    return links.select("abstract_id", "cell", "to", "to_cell", "similarity")


def build_graph(
    vectors: DataFrame, path: str, n_cells: int, m: int = LINKS, rounds: int = ROUNDS, probes: int = PROBES
) -> None:
    """Fit cells, link the vectors and store everything below ``path``.

    Lists hold ``2 * m`` neighbours while they are found, from ``probes`` cells first.
    """
    spark = vectors.sparkSession
    centroids = vs.fit_cells(vectors, n_cells)
    placed = stage(vs.with_cell(vectors.select("abstract_id", "embedding"), centroids), "placed")
    asked = placed.select(F.col("abstract_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    hits = vs.vector_search_cells(placed, asked, centroids, min(probes, n_cells), 2 * m + 1)
    edges = hits.filter(F.col("query_id") != F.col("abstract_id"))
    edges = edges.select(F.col("query_id").alias("abstract_id"), F.col("abstract_id").alias("to"), "similarity")
    edges = stage(_best(edges, 2 * m), "edges")
    for _ in range(rounds):
        edges = _refined(placed, edges, 2 * m)
    links = stage(_with_cells(_pruned(placed, edges, m), placed), "links")
    vs.write_cells(placed, f"{path}/vectors")
    vs.write_cells(links, f"{path}/links")
    rows = spark.createDataFrame(list(enumerate(centroids)), "cell int, centroid array<double>").coalesce(1)
    near = placed.join(F.broadcast(rows), "cell")  # one row per cell
    near = near.withColumn("near", inner_product(F.col("embedding"), F.col("centroid")))
    entry = F.max_by(F.struct("abstract_id", "embedding"), F.struct("near", "abstract_id")).alias("entry")
    near.groupBy("cell").agg(entry).select("cell", "entry.*").coalesce(1).write.parquet(f"{path}/entries")
    rows.write.parquet(f"{path}/centroids")


def read_graph(spark: SparkSession, path: str, m: int = LINKS) -> Graph:
    return Graph(*(spark.read.parquet(f"{path}/{name}") for name in ("vectors", "links", "entries", "centroids")), m)


def graph_search(graph: Graph, queries: DataFrame, k: int, ef: int = EF, width: int = WIDTH) -> DataFrame:
    """Approximate best ``k`` per query: ``query_id, abstract_id, similarity, rank, scored``.

    ``scored`` is the number of vectors that the query was compared with.
    """
    ef = max(ef, k)
    queries = stage(queries.select("query_id", "query_vector").filter("query_vector IS NOT NULL"), "queries")
    entries = graph.entries.select("abstract_id", "embedding", "cell")
    n_entries = entries.count()
    first = vs.vector_search(entries, queries, STARTS).join(entries.select("abstract_id", "cell"), "abstract_id")
    item = F.struct(F.negative("similarity").alias("far"), F.col("abstract_id").alias("id"), "cell", F.lit(True).alias("open"))
    state = first.groupBy("query_id").agg(F.sort_array(F.collect_list(item)).alias("beam"))
    seen = F.transform("beam", lambda x: x["id"]).alias("seen")
    state = stage(state.select("query_id", "beam", seen, F.lit(n_entries).alias("scored")), "beams")
    strongest = Window.partitionBy("query_id", "id").orderBy(F.desc("similarity"), "to")
    while True:
        ready = F.slice(F.filter("beam", lambda x: x["open"]), 1, width)
        front = state.select("query_id", F.explode(ready).alias("at")).select("query_id", "at.id", "at.cell")
        front = stage(front, "front")
        if front.isEmpty():
            break
        links = graph.links.select(F.col("abstract_id").alias("id"), "cell", "to", "to_cell", "similarity")
        met = _from_cells(links, front).join(front, ["cell", "id"])
        met = met.withColumn("rank", F.row_number().over(strongest)).filter(F.col("rank") <= 2 * graph.m)
        met = met.select("query_id", F.col("to").alias("id"), F.col("to_cell").alias("cell")).distinct()
        met = met.join(state.select("query_id", "seen"), "query_id").filter(~F.array_contains("seen", F.col("id"))).drop("seen")
        met = stage(met, "met")
        ends = graph.vectors.select(F.col("abstract_id").alias("id"), "cell", "embedding")
        found = _from_cells(ends, met).join(met, ["cell", "id"]).join(queries, "query_id")
        score = F.round(inner_product(F.col("embedding"), F.col("query_vector")), vs.DIGITS)
        item = F.struct(F.negative(score).alias("far"), "id", "cell", F.lit(True).alias("open"))
        found = found.groupBy("query_id").agg(F.collect_list(item).alias("new"))
        opened = front.groupBy("query_id").agg(F.collect_list("id").alias("opened"))
        state = state.join(opened, "query_id", "left").join(found, "query_id", "left")
        new = F.coalesce("new", F.array().cast(state.schema["beam"].dataType))
        done = F.coalesce("opened", F.array().cast(state.schema["seen"].dataType))
        closed = F.transform("beam", lambda x: x.withField("open", x["open"] & ~F.array_contains(done, x["id"])))
        state = state.select(
            "query_id",
            F.slice(F.sort_array(F.concat(closed, new)), 1, ef).alias("beam"),
            F.concat("seen", F.transform(new, lambda x: x["id"])).alias("seen"),
            (F.col("scored") + F.size(new)).alias("scored"),
        )
        state = stage(state, "beams")
    hits = state.select("query_id", "scored", F.posexplode(F.slice("beam", 1, k)).alias("pos", "hit"))
    return hits.select(
        "query_id", F.col("hit.id").alias("abstract_id"), F.negative("hit.far").alias("similarity"), (F.col("pos") + 1).alias("rank"), "scored"
    )


def _from_cells(table: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of a table stored by cell that lie in the cells asked for; others are not read."""
    cells = F.broadcast(asked.filter("cell >= 0").select("cell").distinct())  # at most one row per cell
    return table.join(cells, "cell", "left_semi")


def insert_vectors(graph: Graph, vectors: DataFrame, path: str, ef: int = EF) -> None:
    """Append vectors that the graph lacks, linked to what a search for them finds, and to each other.

    Ids that are stored already, and repeats, are left out.
    """
    fresh = vectors.select("abstract_id", "embedding").dropDuplicates(["abstract_id"])
    fresh = fresh.join(graph.vectors.select("abstract_id"), "abstract_id", "left_anti")
    rows = graph.centroids.orderBy("cell").collect()
    fresh = stage(vs.with_cell(fresh, [r["centroid"] for r in rows], [r["cell"] for r in rows]), "fresh")
    asked = fresh.select(F.col("abstract_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    old = graph_search(graph, asked, 2 * graph.m, ef)
    new = vs.vector_search_cells(fresh, asked, [r["centroid"] for r in rows], 1, graph.m + 1, [r["cell"] for r in rows])
    hits = old.select("query_id", "abstract_id", "similarity").unionByName(new.select("query_id", "abstract_id", "similarity"))
    hits = hits.filter(F.col("query_id") != F.col("abstract_id"))
    edges = hits.select(F.col("query_id").alias("abstract_id"), F.col("abstract_id").alias("to"), "similarity")
    edges = stage(_best(edges, 2 * graph.m), "edges")
    ends = edges.select(F.col("to").alias("abstract_id")).distinct()
    near = graph.vectors.select("abstract_id", "embedding", "cell").join(ends, "abstract_id", "left_semi")
    near = stage(near.unionByName(fresh.select("abstract_id", "embedding", "cell")), "near")
    # Rows that are only ends have no list of their own here.
    links = _pruned(near, edges, graph.m)
    links = stage(_with_cells(links, near), "links")
    vs.write_cells(fresh, f"{path}/vectors")
    vs.write_cells(links, f"{path}/links")


def search_quality(found: DataFrame, exact: DataFrame, n_vectors: int) -> DataFrame:
    """One row: ``recall`` against exact hits, and the mean ``share`` of the vectors scored per query."""
    share = found.groupBy("query_id").agg(F.first("scored").alias("scored"))
    share = share.agg((F.avg("scored") / F.lit(n_vectors)).alias("share"))
    return vs.recall(found, exact).join(share)  # one row each
