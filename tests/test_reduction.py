"""Neighbour-graph layout against a dense version and against principal components."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswork.operators import density, reduction as red, topics

ROWS, WIDE = 240, 12


@pytest.fixture(scope="module")
def points():
    """A curled sheet in twelve dimensions: flat near every row, folded as a whole."""
    rng = np.random.default_rng(5)
    turn, along = rng.uniform(1.5, 9, ROWS), rng.uniform(0, 6, ROWS)
    sheet = np.stack([turn * np.cos(turn), along, turn * np.sin(turn)], 1)
    return sheet @ rng.normal(size=(3, WIDE)) + 12 * rng.normal(size=WIDE)


@pytest.fixture(scope="module")
def vectors(spark, points):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "abstract_id long, embedding array<double>")


@pytest.fixture(scope="module")
def near(spark, vectors):
    rows = [tuple(r) for r in density.neighbour_table(vectors, 10).collect()]
    return spark.createDataFrame(rows, "abstract_id long, neighbour long, distance double")


def plain_graph(rows):
    lists = {}
    for a, b, d in rows:
        lists.setdefault(a, {})[b] = d
    one_way = {}
    for a, own in lists.items():
        first = min([d for d in own.values() if d > 0], default=0.0)
        mean = max(sum(own.values()) / len(own), 1e-9)
        lo, hi = 0.0, 1024 * mean
        for _ in range(60):
            mid = (lo + hi) / 2
            total = sum(math.exp(-max(0.0, d - first) / mid) for d in own.values())
            lo, hi = (lo, mid) if total > math.log2(len(own)) else (mid, hi)
        for b, d in own.items():
            one_way[a, b] = math.exp(-max(0.0, d - first) / max(hi, red.FLATTEST * mean))
    pairs = {tuple(sorted(p)) for p in one_way}
    out = {}
    for a, b in pairs:
        x, y = one_way.get((a, b), 0.0), one_way.get((b, a), 0.0)
        out[a, b] = x + y - x * y
    return out


def test_graph_equals_a_plain_version(near):
    want = plain_graph([tuple(r) for r in near.collect()])
    got = {(r.a, r.b): r.weight for r in red.fuzzy_graph(near).collect()}
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p], abs=1e-6) for p in want)


def test_weights_of_ties_repeats_and_lone_neighbours(spark):
    rows = [(1, 2, 0.0), (1, 3, 0.0), (2, 1, 0.5), (3, 1, 0.25), (3, 2, 0.25), (3, 2, 0.75), (3, 3, 0.0)]
    near = spark.createDataFrame(rows, "abstract_id long, neighbour long, distance double")
    got = {(r.a, r.b): round(r.weight, 6) for r in red.fuzzy_graph(near).collect()}
    assert got == {(1, 2): 1.0, (1, 3): 1.0, (2, 3): 1.0}


def test_spectral_layout_equals_dense_eigenvectors(near):
    graph = red.fuzzy_graph(near).cache()
    layout = {r.abstract_id: r.embedding for r in red.spectral_layout(graph, 3, cycles=6).collect()}
    ids = sorted(layout)
    at = {a: i for i, a in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for r in graph.collect():
        w[at[r.a], at[r.b]] = w[at[r.b], at[r.a]] = r.weight
    degree = w.sum(1)
    values, columns = np.linalg.eigh(w / np.sqrt(np.outer(degree, degree)))
    want = columns[:, ::-1][:, 1:4] * np.sqrt(degree.sum() / degree)[:, None]
    got = np.array([layout[a] for a in ids])
    for i in range(3):
        sign = np.sign((want[:, i] * got[:, i]).sum())
        assert np.abs(sign * got[:, i] - want[:, i]).max() < 0.05


def test_layout_keeps_neighbours_better_than_components(spark, vectors, near):
    first = red.graph_layout(near, 2, rounds=10).orderBy("abstract_id").collect()
    again = red.graph_layout(near.repartition(7), 2, rounds=10).orderBy("abstract_id").collect()
    assert np.allclose([r.embedding for r in first], [r.embedding for r in again], atol=1e-4)
    layout = spark.createDataFrame(first)
    trust = red.trustworthiness(vectors, layout, vectors).first().trust
    flat = red.trustworthiness(vectors, topics.reduce_dimensions(vectors, 2), vectors).first().trust
    assert trust > flat and trust > 0.93
    assert red.trustworthiness(vectors, layout, vectors.limit(0)).first().trust == 1.0


def test_trustworthiness_equals_a_plain_version(spark, points, vectors):
    layout = topics.reduce_dimensions(vectors, 2).cache()
    low = {r.abstract_id: np.array(r.embedding) for r in layout.collect()}
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    asked, k = list(range(0, ROWS, 7)), 6
    off = 0
    for q in asked:
        others = [j for j in range(ROWS) if j != q]
        chosen = sorted(others, key=lambda j: (round(float(((low[q] - low[j]) ** 2).sum()), 6), j))[:k]
        score = np.round(unit @ unit[q], 6)
        off += sum(max(0, 1 + sum(score[m] > score[j] for m in others) - k) for j in chosen)
    want = 1 - 2 * off / (len(asked) * k * (2 * ROWS - 3 * k - 1))
    of = vectors.filter(F.col("abstract_id").isin(asked))
    assert red.trustworthiness(vectors, layout, of, k).first().trust == pytest.approx(want, abs=2e-3)


def test_unseen_rows_go_between_their_neighbours(spark):
    layout = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 4.0])], "abstract_id long, embedding array<double>")
    near = spark.createDataFrame([(9, 1, 0.5), (9, 2, 0.5), (8, 2, 0.1)], "abstract_id long, neighbour long, distance double")
    got = {r.abstract_id: r.embedding for r in red.place_in_layout(near, layout).collect()}
    assert got == {9: [1.0, 2.0], 8: [2.0, 4.0]}


def test_empty_table(spark):
    near = spark.createDataFrame([], "abstract_id long, neighbour long, distance double")
    assert red.graph_layout(near, 2, rounds=2, cycles=1).collect() == []


def test_links_are_worked_on_without_lambdas(near, plan, monkeypatch):
    """Lambdas over arrays are interpreted for each link."""
    plans, real = [], red.stage
    monkeypatch.setattr(red, "stage", lambda df, name: (plans.append(plan(df)), real(df, name))[1])
    red.spectral_layout(red.fuzzy_graph(near), 2, cycles=1, depth=2)
    steps = [p for p in plans if "Join" in p and "sum(" in p]
    assert len(steps) == 2 and not any("lambda" in p for p in steps)
    at = real(red.spectral_layout(red.fuzzy_graph(near), 2, cycles=1).withColumnRenamed("embedding", "y"), "at")
    moved = plan(red._moved(at, red._both_ways(real(red.fuzzy_graph(near), "graph")), 2, 1, 0, 1.0))
    assert "sum(" in moved and not any("lambda" in line for line in moved.splitlines() if "sum(" in line or "gap0" in line)


def test_rows_and_links_never_go_through_the_driver(near, plan, monkeypatch):
    """However small they are, the tables of a layout and of its clusters are not broadcast."""
    plans = []
    for module in (red, density):
        real = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, real=real: (plans.append(plan(df)), real(df, name))[1])
    red.graph_layout(near, rounds=1, cycles=1)
    density.density_clusters(near, min_size=5)
    joins = [p for p in plans if "Join" in p]
    assert len(joins) > 10 and sum("BroadcastHashJoin" in p for p in joins) <= 1  # one row per topic
