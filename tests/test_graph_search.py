import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswork.operators import graph_search as g, vector_search as vs

SCHEMA = "abstract_id bigint, embedding array<double>"


def unit(seed, n, dims=12):
    rows = np.random.default_rng(seed).normal(size=(n, dims))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A graph of 400 vectors and what it was made from."""
    path = str(tmp_path_factory.mktemp("graph") / "g")
    rows = unit(1, 460)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], SCHEMA)
    g.build_graph(frame.filter("abstract_id < 400"), path, 8, m=8, rounds=1)
    return path, rows, frame


def asked(frame, condition):
    return frame.filter(condition).select(F.col("abstract_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def test_links_are_similarities_both_ways(spark, stored):
    path, rows, _ = stored
    links = {(r.abstract_id, r.to): r for r in g.read_graph(spark, path).links.collect()}
    cells = {r.abstract_id: r.cell for r in g.read_graph(spark, path).vectors.collect()}
    assert len(cells) == 400
    degree = {i: 0 for i in cells}
    for (a, b), r in links.items():
        assert a != b and abs(r.similarity - rows[a] @ rows[b]) < 1e-6
        assert (r.cell, r.to_cell) == (cells[a], cells[b])
        degree[a] += 1
    assert all(4 <= n <= 16 for n in degree.values())
    assert sum((b, a) in links for a, b in links) > 0.8 * len(links)


def test_recall_and_share(spark, stored):
    path, rows, frame = stored
    queries = asked(frame, "abstract_id % 10 = 0 AND abstract_id < 400")
    exact = vs.vector_search(frame.filter("abstract_id < 400"), queries, 5)
    found = g.graph_search(g.read_graph(spark, path, 8), queries, 5, ef=24, width=8)
    hits = found.collect()
    assert len(hits) == 40 * 5 and {r["rank"] for r in hits} == {1, 2, 3, 4, 5}
    assert all(abs(r.similarity - rows[r.query_id] @ rows[r.abstract_id]) < 1e-6 for r in hits)
    quality = g.search_quality(found, exact, 400).first()
    assert quality.recall >= 0.9 and 0.02 < quality.share < 0.75
    plan = g._from_cells(g.read_graph(spark, path).vectors, spark.createDataFrame([(1,)], "cell int"))
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()


def test_later_vectors_are_found_without_a_rebuild(spark, stored):
    path, _, frame = stored
    old = g.read_graph(spark, path, 8)
    files = set(old.vectors.inputFiles() + old.links.inputFiles())
    g.insert_vectors(old, frame.filter("abstract_id >= 390").union(frame.filter("abstract_id = 401")), path, ef=24)
    graph = g.read_graph(spark, path, 8)
    assert graph.vectors.count() == graph.vectors.select("abstract_id").distinct().count() == 460
    assert files < set(graph.vectors.inputFiles() + graph.links.inputFiles())
    queries = asked(frame, "abstract_id >= 400")
    found = g.graph_search(graph, queries, 3, ef=24)
    first = {r.query_id: r.abstract_id for r in found.filter("rank = 1").collect()}
    assert sum(first[i] == i for i in range(400, 460)) >= 57
    assert vs.recall(found, vs.vector_search(frame, queries, 3)).first().recall >= 0.85


def test_no_queries(spark, stored):
    path, _, frame = stored
    assert g.graph_search(g.read_graph(spark, path), asked(frame, "abstract_id < 0"), 3).count() == 0
