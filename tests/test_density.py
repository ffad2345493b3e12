"""Density clusters against a plain version that cuts the tree from the top."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswork.operators import density as d


def edges_of(neighbours, min_samples):
    near = defaultdict(list)
    for a, b, far in neighbours:
        near[a].append(far)
    core = {a: sorted(v)[min_samples - 1] for a, v in near.items() if len(v) >= min_samples}
    pairs = {}
    for a, b, far in neighbours:
        if a in core and b in core and a != b:
            key = (min(a, b), max(a, b))
            pairs[key] = min(far, pairs.get(key, math.inf))
    return core, sorted((max(far, core[a], core[b], d.CLOSEST), a, b) for (a, b), far in pairs.items())


def brute(neighbours, min_size, min_samples):
    """id -> (cluster as a set or None, strength): full merge tree, condensed from its roots."""
    core, edges = edges_of(neighbours, min_samples)
    top, parts, length = {}, {}, {}

    def find(x):
        while x in top:
            x = top[x]
        return x

    for w, a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            node = ("m", a, b)
            top[x] = top[y] = node
            parts[node], length[node] = (x, y), w
    ids = {a for a, _, _ in neighbours}

    def leaves(x):
        out, todo = [], [x]
        while todo:
            y = todo.pop()
            if y in parts:
                todo += parts[y]
            else:
                out.append(y)
        return out

    clusters = []  # [birth, {row: density}, children, root]

    def condense(node, birth, root):
        own = {"birth": birth, "rows": {}, "children": [], "root": root, "death": None}
        clusters.append(own)
        while True:
            if node not in parts:
                own["rows"][node] = math.inf
                break
            now = 1 / length[node]
            sides = sorted(parts[node], key=lambda x: -len(leaves(x)))
            sizes = [len(leaves(x)) for x in sides]
            if sizes[1] >= min_size:
                own["death"] = now
                own["children"] = [condense(x, now, False) for x in sides]
                break
            own["rows"].update((x, now) for x in leaves(sides[1]))
            if sizes[0] < min_size:
                own["rows"].update((x, now) for x in leaves(sides[0]))
                break
            node = sides[0]
        if own["death"] is None:
            own["death"] = max(own["rows"].values())
        return own

    roots = [r for r in {find(x) for x in core} if len(leaves(r)) >= min_size]
    tops = [condense(r, 0.0, len(roots) == 1) for r in roots]

    def count(c):
        return len(c["rows"]) + sum(count(x) for x in c["children"])

    def value(c):
        below = sum(value(x) for x in c["children"])
        own = sum(x - c["birth"] for x in c["rows"].values())
        own += sum(count(x) for x in c["children"]) * (c["death"] - c["birth"])
        c["chosen"] = not c["root"] and own >= below
        return own if c["chosen"] else below

    for t in tops:
        value(t)
    out = dict.fromkeys(ids, (None, 0.0))

    def everything(c):
        return c["rows"] | {k: v for x in c["children"] for k, v in everything(x).items()}

    def choose(c):
        if c["chosen"]:
            rows = everything(c)
            members = frozenset(rows)
            out.update((x, (members, min(v, c["death"]) / c["death"])) for x, v in rows.items())
        else:
            for x in c["children"]:
                choose(x)

    for t in tops:
        choose(t)
    return out


def points(seed, n, lumps, dims=3, noise=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (lumps, dims)) * 3
    rows = [middle[rng.integers(lumps)] + rng.normal(0, 0.15 + 0.1 * (i % 3), dims) for i in range(n)]
    rows += [rng.normal(0, 3, dims) for _ in range(int(noise * n))]
    return np.array(rows)


def nearest(rows, k, name=lambda i: i):
    far = np.round(np.sqrt(((rows[:, None] - rows) ** 2).sum(axis=2)), 6)
    out = []
    for i in range(len(rows)):
        order = [j for j in np.lexsort((np.arange(len(rows)), far[i])) if j != i][:k]
        out += [(name(i), name(int(j)), float(far[i, j])) for j in order]
    return out


def found(model):
    rows = model.points.collect()
    members = defaultdict(set)
    for r in rows:
        members[r.topic_id].add(r.abstract_id)
    return {r.abstract_id: (None if r.topic_id < 0 else frozenset(members[r.topic_id]), r.strength) for r in rows}, members


def same(got, want):
    assert got.keys() == want.keys()
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def table(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"abstract_id {kind}, neighbour {kind}, distance double").repartition(3)


@pytest.mark.parametrize(
    "seed,n,lumps,k,merges",
    [(1, 120, 4, 200, d.MERGES), (2, 150, 6, 12, d.MERGES), (3, 200, 12, 15, 3), (4, 60, 1, 10, d.MERGES)],
)
def test_as_the_plain_version(spark, seed, n, lumps, k, merges):
    near = nearest(points(seed, n, lumps), k)
    got, members = found(d.density_clusters(table(spark, near), min_size=8, min_samples=4, merges=merges))
    same(got, brute(near, 8, 4))
    sizes = [len(members[t]) for t in sorted(t for t in members if t >= 0)]
    assert sizes == sorted(sizes, reverse=True)


def test_equal_rows_text_ids_and_rows_apart(spark):
    rows = np.concatenate([np.zeros((20, 2)), np.ones((15, 2)), points(7, 40, 3, 2), np.full((6, 2), 99.0)])
    near = nearest(rows, 6, name=lambda i: f"id{i:03d}") + [("lonely", "id000", 50.0)]
    got, _ = found(d.density_clusters(table(spark, near, "string"), min_size=10, min_samples=5))
    same(got, brute(near, 10, 5))
    assert got["lonely"] == (None, 0.0)


def test_chains_of_lone_rows(spark):
    """Each row picks the next of a long chain that ends in a dense group."""
    rows = np.concatenate([np.linspace(0, 0.1, 20), 0.2 + np.cumsum(np.linspace(0.02, 2, 60)), 500 + np.linspace(0, 0.1, 20)])
    near = nearest(rows[:, None], 8)
    got, _ = found(d.density_clusters(table(spark, near), min_size=10, min_samples=2))
    same(got, brute(near, 10, 2))


def test_small_and_empty_tables(spark):
    got, members = found(d.density_clusters(table(spark, nearest(points(1, 5, 1), 5)), min_size=10))
    assert set(members) == {-1}
    model = d.density_clusters(table(spark, []))
    assert model.points.count() == 0 and d.place(model, table(spark, [])).count() == 0


def test_single_linkage(spark):
    _, edges = edges_of(nearest(points(2, 80, 4), 6), 3)
    frame = spark.createDataFrame(edges, "w double, a bigint, b bigint")
    for cut in (0.0, 0.4, 0.8, 100.0):
        up = {x: x for e in edges for x in e[1:]}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for w, a, b in edges:
            if w <= cut:
                x, y = sorted((root(a), root(b)))
                up[y] = x
        assert {r.abstract_id: r.component for r in d.single_linkage(frame, cut).collect()} == {x: root(x) for x in up}


def test_neighbour_table(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)] + [(60, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "abstract_id bigint, embedding array<float>")
    unit = np.array([v for _, v in rows[:60]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    far = 2 - 2 * np.round(unit @ unit.T, 6)
    got = defaultdict(list)
    for r in d.neighbour_table(frame, 4).collect():
        got[r.abstract_id].append(r.neighbour)
        assert abs(r.distance - math.sqrt(max(0, far[r.abstract_id, r.neighbour]))) < 1e-5
    for i in range(60):
        best = sorted((round(float(far[i, j]), 6), j) for j in range(60) if j != i)[:4]
        assert sorted(got[i]) == sorted(j for _, j in best)
    assert 60 not in got
    some = d.neighbour_table(frame.filter("abstract_id < 50"), 3, frame.filter("abstract_id >= 50"))
    assert Counter(r.abstract_id for r in some.collect()) == {i: 3 for i in range(50, 60)}


def test_unseen_rows_join_their_cluster(spark):
    rows = points(11, 150, 4, noise=0.1)
    model = d.density_clusters(table(spark, nearest(rows, 12)), min_size=10, min_samples=5)
    known = {r.abstract_id: r for r in model.points.collect()}
    tops = {t for t in (r.topic_id for r in known.values()) if t >= 0}
    assert len(tops) >= 3
    inside = [i for i, r in known.items() if r.topic_id >= 0 and r.strength > 0.5]
    asked = [rows[i] + 0.01 for i in inside] + [np.full(3, 80.0)]
    near = []
    for q, x in enumerate(asked):
        far = np.sqrt(((rows - x) ** 2).sum(axis=1))
        near += [(1000 + q, int(j), float(far[j])) for j in np.argsort(far)[:12]]
    got = {r.abstract_id: r for r in d.place(model, table(spark, near)).collect()}
    right = sum(got[1000 + q].topic_id == known[i].topic_id for q, i in enumerate(inside))
    assert right >= 0.95 * len(inside)
    assert got[1000 + len(inside)].topic_id == -1 and all(0 <= r.strength <= 1 for r in got.values())
    scores = d.density_topics(model.points).filter("topic_id >= 0").agg(F.min("topic_score"), F.max("topic_score")).first()
    assert 0 < scores[0] < scores[1] <= 1
