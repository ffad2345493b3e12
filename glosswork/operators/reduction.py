"""Few coordinates per vector that keep its neighbours, from a table of neighbours.

* **Graph.** A row's weight to a neighbour falls from 1 at its nearest one, at
  a rate chosen per row so that its weights add up to log2 of their number. The
  two directions of a pair unite as a + b - a * b.
* **Spectral layout.** The smoothest functions on the graph, by block power
  iteration: a few start columns, hashed from the ids, are multiplied by the
  normalised graph ``DEPTH`` times (a join and a sum each), and the best
  combinations of all products go on. Only sums of products of columns, some
  thousand numbers, reach the driver.
* **Forces.** In every round linked rows attract each other, and the rows of a
  random block of about ``BLOCK`` push each other apart on behalf of all others.

A round shuffles edges and rows a fixed number of times, and sends none of them
to the driver; no task holds more than one block. Equal seeds give equal layouts, up to the order of sums. Rows without
neighbours have no place; an empty table gives an empty layout. Neighbours in
different parts of an unconnected graph only repel each other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glosswork.fixed_values import SEED
from glosswork.functions.vectors import inner_product, l2_normalize
from glosswork.operators import vector_search as vs
from glosswork.session import drop_staged, merge_join, stage

DIMENSIONS = 5
HALVINGS = 40
FLATTEST = 1e-3  # least rate, as a share of a row's mean distance
DEPTH = 6
CYCLES = 3
SPARE = 2  # columns beyond those asked for, which speed up the others
ROUNDS = 20
BLOCK = 512
REPEL = 5.0  # push of all other rows against the pull of the links
SPREAD = 10.0  # the largest coordinate before the first round
SOFT, STEP, LONGEST = 0.01, 4.0, 4.0


def weights(neighbours: DataFrame) -> DataFrame:
    """``abstract_id, neighbour, weight`` from ``abstract_id, neighbour, distance``."""
    near = F.sort_array(F.collect_list(F.struct("distance", "neighbour"))).alias("near")
    rows = neighbours.groupBy("abstract_id").agg(near)
    rows = rows.withColumn("first", F.coalesce(F.array_min(F.filter("near.distance", lambda d: d > 0)), F.lit(0.0)))
    mean = F.aggregate("near.distance", F.lit(0.0), lambda s, d: s + d) / F.size("near")
    rows = rows.withColumn("mean", F.greatest(mean, F.lit(1e-9)))
    rows = rows.withColumn("excess", F.transform("near.distance", lambda d: F.greatest(d - F.col("first"), F.lit(0.0))))
    target = F.log2(F.size("near").cast("double"))

    def halve(bounds: Column, _: Column) -> Column:
        mid = (bounds["lo"] + bounds["hi"]) / 2
        total = F.aggregate("excess", F.lit(0.0), lambda s, x: s + F.exp(-x / mid))
        return F.struct(
            F.when(total > target, bounds["lo"]).otherwise(mid).alias("lo"),
            F.when(total > target, mid).otherwise(bounds["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0.0).alias("lo"), (F.col("mean") * 1024).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve)["hi"]
    rows = rows.withColumn("rate", F.greatest(found, F.col("mean") * FLATTEST))
    rows = rows.select("abstract_id", "rate", F.explode(F.arrays_zip("near", "excess")).alias("n"))
    return rows.select(
        "abstract_id", F.col("n.near.neighbour").alias("neighbour"), F.exp(-F.col("n.excess") / F.col("rate")).alias("weight")
    )


def fuzzy_graph(neighbours: DataFrame) -> DataFrame:
    """``a, b, weight``: every linked pair once, a < b."""
    rows = neighbours.filter("abstract_id <> neighbour").groupBy("abstract_id", "neighbour")
    pair = [F.least("abstract_id", "neighbour").alias("a"), F.greatest("abstract_id", "neighbour").alias("b")]
    one_way = weights(rows.agg(F.min("distance").alias("distance"))).select(*pair, "weight")
    united = F.sum("weight") - F.when(F.count("*") == 2, F.min("weight") * F.max("weight")).otherwise(0.0)
    return one_way.groupBy("a", "b").agg(united.alias("weight"))


def _both_ways(graph: DataFrame) -> DataFrame:
    graph = graph.select("a", "b", "weight")
    return graph.union(graph.select("b", "a", "weight")).toDF("abstract_id", "to", "weight")


def _noise(seed: int, n: int) -> Column:
    """``n`` numbers between -1 and 1 from the id."""
    return F.array(*[F.xxhash64("abstract_id", F.lit(seed), F.lit(i)) / F.lit(2.0**63) for i in range(n)])


def _each(n: int, value: Callable[[int], Column]) -> Column:
    """An array of ``n`` values, one expression each: per link, lambdas over arrays are interpreted and slow."""
    return F.array(*[value(i) for i in range(n)])


def _sums(values: Column, n: int) -> Column:
    return _each(n, lambda i: F.sum(values[i]))


def _combined(block: Column, matrix: np.ndarray) -> Column:
    """The row vector ``block`` times a small matrix."""
    return F.array(*[inner_product(block, F.array(*map(F.lit, column.tolist()))) for column in matrix.T])


def _products(blocks: DataFrame, width: int) -> np.ndarray:
    """Sums of products of every two columns, added up per task before they meet."""

    def add(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                rows = np.array(batch["z"].tolist(), dtype=np.float64)
                total += rows.T @ rows
        yield pd.DataFrame({"at": np.arange(width * width), "value": total.ravel()})

    sums = blocks.select("z").mapInPandas(add, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(width * width)
    for row in sums.collect():  # width * width numbers
        out[row["at"]] = row["value"]
    return out.reshape(width, width)


def _ritz(gram: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Best combinations of the products: values, and weights of all columns but the last products.

    The last column of ``gram`` is the constant function, which is taken out.
    Products follow z[j + 1] = 2 S z[j] - z[j - 1], so S of a column is known
    from its neighbours.
    """
    used = gram.shape[0] - 1 - columns
    applied = np.zeros((gram.shape[0], used))
    for i in range(used):
        if i < columns:
            applied[i + columns, i] = 1.0
        else:
            applied[[i + columns, i - columns], i] = 0.5
    flat = gram[:used, -1]
    held = gram[:used, :used] - np.outer(flat, flat)
    moved = gram[:used] @ applied - np.outer(flat, flat)
    scale = 1 / np.sqrt(np.maximum(np.diag(held), 1e-300))
    size, turn = np.linalg.eigh(held * np.outer(scale, scale))
    kept = size > 1e-8 * max(size[-1], 1e-300)
    white = scale[:, None] * turn[:, kept] / np.sqrt(size[kept])
    values, found = np.linalg.eigh(white.T @ ((moved + moved.T) / 2) @ white)
    best = np.argsort(-values, kind="stable")[:columns]
    combos = np.zeros((used + 1, columns))
    chosen = white @ found[:, best]
    chosen *= np.where((held[:columns] @ chosen).sum(0) < 0, -1.0, 1.0)  # one of two signs, by the columns before
    combos[:used, : len(best)] = chosen
    combos[used, : len(best)] = -flat @ chosen
    return values[best], combos


def spectral_layout(
    graph: DataFrame, k: int = DIMENSIONS, seed: int = SEED, cycles: int = CYCLES, depth: int = DEPTH
) -> DataFrame:
    """``abstract_id, embedding, degree``: the ``k`` smoothest functions on the graph but the constant one.

    Each has weighted variance 1. A graph of fewer rows than that has zeros in
    the other coordinates.
    """
    both = stage(_both_ways(graph), "links")
    degrees = stage(both.groupBy("abstract_id").agg(F.sum("weight").alias("degree")), "degrees")
    total = degrees.agg(F.sum("degree")).first()[0] or 1.0
    n = k + SPARE
    root = F.sqrt(F.col("degree"))
    ends = degrees.select(F.col("abstract_id").alias("to"), F.col("degree").alias("far"))
    shared = F.col("weight") / F.sqrt(F.col("degree") * F.col("far"))
    edges = stage(merge_join(merge_join(both, degrees, "abstract_id"), ends, "to").select("abstract_id", "to", shared.alias("s")), "edges")
    flat = degrees.select("abstract_id", F.array(root / F.sqrt(F.lit(total))).alias("z"))
    x = stage(degrees.select("abstract_id", _noise(seed, n).alias("z")), "columns")
    for _ in range(cycles):
        chain = [x]
        for step in range(depth):
            ends = chain[-1].select(F.col("abstract_id").alias("to"), "z")
            factor = F.col("s") * (1.0 if step == 0 else 2.0)
            parts = merge_join(edges, ends, "to").select("abstract_id", _each(n, lambda i: F.col("z")[i] * factor).alias("z"))
            if step:
                parts = parts.unionByName(chain[-2].select("abstract_id", _each(n, lambda i: -F.col("z")[i]).alias("z")))
            chain.append(stage(parts.groupBy("abstract_id").agg(_sums(F.col("z"), n).alias("z")), "columns"))
        every = flat.withColumn("at", F.lit(depth + 1))
        for at, block in enumerate(chain):
            every = every.unionByName(block.withColumn("at", F.lit(at)))
        lists = every.groupBy("abstract_id").agg(F.sort_array(F.collect_list(F.struct("at", "z"))).alias("all"))
        blocks = stage(lists.select("abstract_id", F.flatten(F.col("all.z")).alias("z")), "blocks")
        _, combos = _ritz(_products(blocks, n * (depth + 1) + 1), n)
        used = F.concat(F.slice("z", 1, n * depth), F.slice("z", n * (depth + 1) + 1, 1))
        x = stage(blocks.select("abstract_id", _combined(used, combos).alias("z")), "columns")
        drop_staged(blocks, *chain)
    spread = F.transform(F.slice("z", 1, k), lambda v: v * F.sqrt(F.lit(total)) / root)
    layout = stage(merge_join(x, degrees, "abstract_id").select("abstract_id", spread.alias("embedding"), "degree"), "spectral")
    drop_staged(x, edges, both, degrees)
    return layout


def graph_layout(
    neighbours: DataFrame, k: int = DIMENSIONS, seed: int = SEED, rounds: int = ROUNDS, cycles: int = CYCLES
) -> DataFrame:
    """``abstract_id, embedding``: ``k`` coordinates per row of the neighbour table."""
    graph = stage(fuzzy_graph(neighbours), "graph")
    at = spectral_layout(graph, k, seed, cycles)
    widest, n_rows = at.agg(F.max(F.array_max(F.transform("embedding", F.abs))), F.count("*")).first()
    scale = SPREAD / (widest or 1.0)
    # A little noise parts rows that the spectral layout puts on one point.
    spread = F.zip_with("embedding", _noise(seed + 1, k), lambda v, e: v * scale + e * 0.01)
    old, at = at, stage(at.select("abstract_id", spread.alias("y"), "degree"), "layout")
    drop_staged(old)
    edges = stage(_both_ways(graph), "links")
    blocks = max(1, -(-n_rows // BLOCK))
    for step in range(rounds):
        old, at = at, stage(_moved(at, edges, k, blocks, seed + step, 1 - step / rounds), "layout")
        drop_staged(old)
    drop_staged(graph, edges)
    return at.select("abstract_id", F.col("y").alias("embedding"))


def _moved(at: DataFrame, edges: DataFrame, k: int, blocks: int, seed: int, rate: float) -> DataFrame:
    """One round: pulled along the links, pushed by a random block, moved by a bounded step."""
    ends = at.select(F.col("abstract_id").alias("to"), F.col("y").alias("end"))
    met = merge_join(merge_join(edges, ends, "to"), at.select("abstract_id", "y"), "abstract_id")
    met = met.select("abstract_id", "weight", *[(F.col("end")[i] - F.col("y")[i]).alias(f"gap{i}") for i in range(k)])
    far = sum((F.col(f"gap{i}") * F.col(f"gap{i}") for i in range(k)), F.lit(0.0))
    met = met.withColumn("pull", F.col("weight") / (1 + far))
    pulled = met.groupBy("abstract_id").agg(_each(k, lambda i: F.sum(F.col(f"gap{i}") * F.col("pull"))).alias("pull"))

    def push(rows: pd.DataFrame) -> pd.DataFrame:
        y = np.array(rows["y"].tolist(), dtype=np.float64)
        far = ((y[:, None] - y[None]) ** 2).sum(-1)
        force = 1 / ((SOFT + far) * (1 + far))
        np.fill_diagonal(force, 0.0)
        out = (force.sum(1)[:, None] * y - force @ y) * (REPEL / len(rows))
        return rows[["abstract_id", "y", "degree"]].assign(push=list(out))

    kind = T.StructType([*at.select("abstract_id", "y", "degree").schema, T.StructField("push", T.ArrayType(T.DoubleType()))])
    block = F.pmod(F.xxhash64("abstract_id", F.lit(seed)), F.lit(blocks)).alias("block")
    pushed = at.select("abstract_id", "y", "degree", block).groupBy("block").applyInPandas(push, kind)
    force = F.zip_with("pull", "push", lambda a, b: (a / F.col("degree") + b) * STEP)
    step = F.transform(force, lambda v: F.greatest(F.lit(-LONGEST), F.least(F.lit(LONGEST), v)) * rate)
    return merge_join(pushed, pulled, "abstract_id").select(
        "abstract_id", F.zip_with("y", step, lambda a, b: a + b).alias("y"), "degree"
    )


def layout_neighbours(layout: DataFrame, k: int, of: DataFrame | None = None) -> DataFrame:
    """``abstract_id, neighbour, distance``: the nearest ``k`` other rows by their coordinates.

    ``of`` are placed rows whose neighbours are wanted, all of them by default.
    """
    points = layout.select("abstract_id", F.concat("embedding", F.array(_square())).alias("embedding"))
    asked = (layout if of is None else of).select(F.col("abstract_id").alias("query_id"), "embedding", _square().alias("own"))
    doubled = F.concat(F.transform("embedding", lambda v: 2 * v), F.array(F.lit(-1.0)))
    hits = vs.vector_search(points, asked.select("query_id", doubled.alias("query_vector")), k + 1)
    hits = merge_join(hits.filter(F.col("abstract_id") != F.col("query_id")), asked.select("query_id", "own"), "query_id")
    hits = vs.first_per_query(hits.drop("rank"), k, F.desc("similarity"), F.asc("abstract_id"))
    far = F.round(F.sqrt(F.greatest(F.lit(0.0), F.col("own") - F.col("similarity"))), 6)
    return hits.select(F.col("query_id").alias("abstract_id"), F.col("abstract_id").alias("neighbour"), far.alias("distance"))


def _square() -> Column:
    return inner_product(F.col("embedding"), F.col("embedding"))


def place_in_layout(neighbours: DataFrame, layout: DataFrame) -> DataFrame:
    """``abstract_id, embedding`` of unseen rows: the weighted mean of their neighbours' coordinates.

    ``neighbours`` lists theirs among the rows of the layout.
    """
    known = layout.select(F.col("abstract_id").alias("neighbour"), "embedding")
    met = merge_join(weights(neighbours), known, "neighbour")
    pairs = met.select("abstract_id", "weight", F.posexplode("embedding").alias("i", "v"))
    means = pairs.groupBy("abstract_id", "i").agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("v"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "v"))).alias("all")
    return means.groupBy("abstract_id").agg(ordered).select("abstract_id", F.col("all.v").alias("embedding"))


def trustworthiness(vectors: DataFrame, layout: DataFrame, of: DataFrame, k: int = 10) -> DataFrame:
    """One row, ``trust``: 1 if near rows of the layout are near vectors, less by the ranks they are off.

    Measured on the rows of ``of``, each against all vectors, ``vs.QUERY_BLOCK``
    of them to a pass. Ranks are by cosine; equal cosines share the better rank.
    """
    unit = vectors.filter(F.exists("embedding", lambda x: x != 0))
    unit = unit.select("abstract_id", l2_normalize(F.col("embedding")).alias("embedding"))
    picked = merge_join(layout, of.select("abstract_id"), "abstract_id", "left_semi")
    near = layout_neighbours(layout, k, picked)
    ends = unit.select(F.col("abstract_id").alias("neighbour"), F.col("embedding").alias("end"))
    near = merge_join(merge_join(near, unit, "abstract_id"), ends, "neighbour")
    similarity = F.round(inner_product(F.col("embedding"), F.col("end")), vs.DIGITS)
    item = F.sort_array(F.collect_list(similarity)).alias("met")
    asked = stage(near.groupBy("abstract_id").agg(F.first("embedding").alias("query"), item), "asked")
    n_asked, n_rows = asked.count(), unit.count()
    passes = max(1, -(-n_asked // vs.QUERY_BLOCK))
    worse = None
    for number in range(passes):
        rows = asked.filter(F.pmod(F.xxhash64("abstract_id"), F.lit(passes)) == number)
        found = _nearer(unit, rows.collect(), vs.QUERY_BLOCK)
        worse = found if worse is None else worse.unionByName(found)
    ranks = worse.groupBy("query", "j").agg((F.sum("n") + 1).alias("rank"))
    off = F.coalesce(F.sum(F.greatest(F.col("rank") - k, F.lit(0))), F.lit(0))
    most = max(1, n_asked) * k * max(1, 2 * n_rows - 3 * k - 1)
    return ranks.agg((1 - 2 * off / F.lit(float(most))).alias("trust"))


def _nearer(unit: DataFrame, asked: list, chunk: int) -> DataFrame:
    """``query, j, n``: vectors of a task that are nearer to a query than its neighbour ``j``."""
    ids = np.array([r["abstract_id"] for r in asked], dtype=object)
    queries = np.array([r["query"] for r in asked], dtype=np.float64)
    met = [np.asarray(r["met"]) for r in asked]

    def count(batches):
        total = [np.zeros(len(m), dtype=np.int64) for m in met]
        for batch in batches:
            for start in range(0, len(batch) if len(met) else 0, chunk):
                part = batch.iloc[start : start + chunk]
                scores = np.round(np.array(part["embedding"].tolist(), dtype=np.float64) @ queries.T, vs.DIGITS)
                scores[part["abstract_id"].to_numpy(dtype=object)[:, None] == ids[None]] = -np.inf
                for q, own in enumerate(met):
                    total[q] += (scores[:, q][:, None] > own[None]).sum(0)
        rows = [(ids[q], j, int(n)) for q, own in enumerate(total) for j, n in enumerate(own)]
        yield pd.DataFrame(rows, columns=["query", "j", "n"])

    kind = T.StructType([T.StructField("query", unit.schema["abstract_id"].dataType), T.StructField("j", T.IntegerType()), T.StructField("n", T.LongType())])
    return unit.mapInPandas(count, kind)
