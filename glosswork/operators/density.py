"""Density clusters with noise, their number unknown, from a table of neighbours.

The distance of two rows is their mutual reachability: the greatest of their
own distance and both core distances (to the neighbour number ``min_samples``).
Rows joined in order of that distance form a tree; a cluster is a branch with
``min_size`` rows or more, and the clusters whose rows stay together over the
widest range of densities are the topics. All other rows are noise.

The tree is built where the rows are, in three parts:

* Groups below ``min_size`` pick their nearest edge, Boruvka's step. Two that
  pick each other join; one that picks its way to a group of full size falls
  out of that group at the length of its own edge. So every row gets a seed,
  the smallest full-size group around it, and the length at which it joins.
  Rounds follow ``min_size`` and the logarithm of the longest chain.
* Edges between the rows of different seeds join full-size groups only. They
  are taken in order, ``MERGES`` at a time in one task of bounded size; between
  the tasks, edges inside a group and all but the shortest between two groups
  go. Only this part is sequential; seeds are at most rows / ``min_size``.
* Rows find their branch by doubling over ancestors, are summed up per branch,
  and stabilities flow up and choices down the tree of branches, again
  ``MERGES`` at a time.

Edges with equal lengths are ordered by their ends, so results do not depend on
the layout. Rows that the neighbour table does not connect meet at an infinite
distance. Rows with fewer than ``min_samples`` neighbours are noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from glosswork.fixed_values import SMALLEST_TOPIC
from glosswork.functions.text import topic_score
from glosswork.functions.vectors import l2_normalize
from glosswork.operators import vector_search as vs
from glosswork.session import merge_join, stage

NEIGHBOURS = 15
MIN_SAMPLES = 5
MERGES = 200_000  # edges or branches of the tree in one task
HOPS = 3  # doublings of a chain of small groups in one round
CLOSEST = 1e-6  # equal rows are this far apart
_EDGE = ("w", "a", "b")


@dataclass
class DensityModel:
    """``points``: abstract_id, core, seed, w, a, b, node, topic_id, strength, density.

    ``branches``: node, parent, their edges, size, stability, death, topic_id.
    """

    points: DataFrame
    branches: DataFrame
    min_samples: int


def neighbour_table(vectors: DataFrame, k: int = NEIGHBOURS, of: DataFrame | None = None) -> DataFrame:
    """``abstract_id, neighbour, distance``: the nearest ``k`` other rows, by the distance of unit vectors.

    ``of`` are the rows whose neighbours among ``vectors`` are wanted, all of them by
    default. Vectors without a direction have no neighbours and are nobody's.
    """
    unit = _unit(vectors)
    asked = unit if of is None else _unit(of)
    asked = asked.select(F.col("abstract_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    hits = vs.vector_search(unit, asked, k + 1).filter(F.col("abstract_id") != F.col("query_id"))
    rows = hits.select(
        F.col("query_id").alias("abstract_id"), F.col("abstract_id").alias("neighbour"), distance("similarity"), "rank"
    )
    own = Window.partitionBy("abstract_id").orderBy("rank")
    return rows.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).drop("rank")


def _unit(vectors: DataFrame) -> DataFrame:
    some = vectors.filter(F.exists("embedding", lambda x: x != 0))
    return some.select("abstract_id", l2_normalize(F.col("embedding")).alias("embedding"))


def distance(similarity: str) -> Column:
    """The distance of unit vectors with this cosine."""
    return F.round(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col(similarity))), 6).alias("distance")


def core_distances(neighbours: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """``abstract_id, core`` of the rows with enough neighbours."""
    near = F.get(F.sort_array(F.collect_list("distance")), F.lit(min_samples - 1))
    return neighbours.groupBy("abstract_id").agg(near.alias("core")).filter("core IS NOT NULL")


def reachability_edges(neighbours: DataFrame, core: DataFrame) -> DataFrame:
    """``w, a, b``: every pair of neighbours once, with its mutual reachability."""
    pair = [F.least("abstract_id", "neighbour").alias("a"), F.greatest("abstract_id", "neighbour").alias("b")]
    pairs = neighbours.filter(F.col("abstract_id") != F.col("neighbour")).select(*pair, "distance")
    pairs = pairs.groupBy("a", "b").agg(F.min("distance").alias("distance"))
    for end in ("a", "b"):
        pairs = merge_join(pairs, core.select(F.col("abstract_id").alias(end), F.col("core").alias(f"core_{end}")), end)
    far = F.greatest("distance", "core_a", "core_b", F.lit(CLOSEST))
    return pairs.select(far.alias("w"), "a", "b")


def single_linkage(edges: DataFrame, cut: float) -> DataFrame:
    """``abstract_id, component``: rows joined by edges of at most ``cut``; the smallest id names a component."""
    links = edges.filter(F.col("w") <= cut)
    ids = edges.select(F.col("a").alias("abstract_id")).union(edges.select("b")).distinct()
    both = links.select("a", "b").union(links.select("b", "a"))
    both = stage(both.union(ids.select("abstract_id", "abstract_id")).toDF("id", "other"), "links")
    at = stage(ids.select(F.col("abstract_id").alias("id"), F.col("abstract_id").alias("component")), "labels")
    while True:
        # The least label around, then the label of that label: chains halve.
        least = merge_join(both, at.select(F.col("id").alias("other"), "component"), "other")
        least = least.groupBy("id").agg(F.min("component").alias("mid"))
        jump = at.select(F.col("id").alias("mid"), "component")
        after = merge_join(least, jump, "mid").select("id", F.least("mid", "component").alias("component"))
        after = stage(after, "labels")
        if after.exceptAll(at).isEmpty():
            return after.withColumnRenamed("id", "abstract_id")
        at = after


def _edge() -> Column:
    return F.struct(*_EDGE)


def seeds(points: DataFrame, edges: DataFrame, min_size: int) -> DataFrame:
    """``abstract_id, core, seed, w, a, b`` of all ``points``; seed and edge are null where no full-size group is met."""
    none = [F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in _EDGE]
    at = stage(points.select("abstract_id", "core", F.col("abstract_id").alias("seed"), F.lit(1).alias("n"), *none), "groups")
    while True:
        ends = at.select("seed", "n", "abstract_id")
        live = edges
        for end in ("a", "b"):
            live = merge_join(live, ends.toDF(f"seed_{end}", f"n_{end}", end), end)
        small = F.least("n_a", "n_b") < min_size
        live = stage(live.filter((F.col("seed_a") != F.col("seed_b")) & small), "live")
        ways = [
            live.select(F.col(f"seed_{x}").alias("c"), F.col(f"n_{x}").alias("n"), F.col(f"seed_{y}").alias("o"), F.col(f"n_{y}").alias("m"), _edge().alias("e"))
            for x, y in (("a", "b"), ("b", "a"))
        ]
        picked = ways[0].unionByName(ways[1]).filter(F.col("n") < min_size).groupBy("c")
        picked = picked.agg(F.min("e").alias("e"), F.min_by(F.struct("o", "m", "n"), "e").alias("to")).select("c", "e", "to.*")
        picked = stage(picked, "picked")
        if picked.isEmpty():
            return at.select("abstract_id", "core", F.when(F.col("w").isNotNull(), F.col("seed")).alias("seed"), *_EDGE)
        full = F.col("m") >= min_size
        ends = picked.select("c", F.col("o").alias("end"), full.alias("met"))
        for _ in range(HOPS):
            further = ends.toDF("end", "next", "there")
            ends = merge_join(ends, further, "end", "left").select(
                "c", F.when(F.col("met"), F.col("end")).otherwise(F.col("next")).alias("end"), (F.col("met") | F.col("there")).alias("met")
            )
        fallen = merge_join(picked, ends.filter("met"), "c").select(
            F.col("c").alias("seed"), F.col("end").alias("to"), F.lit(min_size).alias("size"), "e"
        )
        other = picked.select(F.col("c").alias("o"), F.col("o").alias("c"), F.col("e").alias("f"))
        pairs = merge_join(picked, other, ["c", "o"]).filter(F.col("e") == F.col("f"))
        size = F.col("n") + F.col("m")
        joined = pairs.select(
            F.col("c").alias("seed"), F.least("c", "o").alias("to"), size.alias("size"), F.when(size >= min_size, F.col("e")).alias("e")
        )
        moved = merge_join(at, stage(fallen.unionByName(joined), "moves"), "seed", "left")
        at = moved.select(
            "abstract_id", "core", F.coalesce("to", "seed").alias("seed"), F.coalesce("size", "n").alias("n"),
            *[F.coalesce(c, f"e.{c}").alias(c) for c in _EDGE],
        )
        at = stage(at, "groups")


def _kruskal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Branches of edges between groups, in order, and where each group ends up."""
    up: dict = {}

    def find(x):
        root = x
        while root in up:
            root = up[root]
        while x in up and up[x] != root:
            up[x], x = root, up[x]
        return root

    rows, named = [], set()
    for batch in batches:
        for w, a, b, left, right in batch[["w", "a", "b", "left", "right"]].itertuples(index=False):
            named |= {left, right}
            left, right = find(left), find(right)
            if left != right:
                node = f"{a}\x1f{b}"
                up[left] = up[right] = node
                rows.append((w, a, b, node, left, right, None))
    rows += [(None, None, None, x, None, None, find(x)) for x in sorted(named)]
    yield pd.DataFrame(rows, columns=["w", "a", "b", "node", "left", "right", "top"], dtype=object)


def branches(points: DataFrame, edges: DataFrame, merges: int = MERGES) -> tuple[DataFrame, int]:
    """``w, a, b, node, left, right, step``: how full-size groups join, and the number of steps."""
    kind = edges.schema["a"].dataType.simpleString()
    seed = points.filter("seed IS NOT NULL").select("abstract_id", F.col("seed").cast("string").alias("seed"))
    between = edges
    for end, side in (("a", "left"), ("b", "right")):
        between = merge_join(between, seed.toDF(end, side), end)

    def shortest(rows: DataFrame) -> DataFrame:
        ends = [F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")]
        rows = rows.filter(F.col("left") != F.col("right")).select(*ends, _edge().alias("e"))
        return rows.groupBy("left", "right").agg(F.min("e").alias("e")).select("e.*", "left", "right")

    between, done, step = stage(shortest(between), "between"), [], 0
    schema = f"w double, a {kind}, b {kind}, node string, left string, right string, top string"
    while not between.isEmpty():
        lightest = stage(between.orderBy(*_EDGE).limit(merges), "lightest")
        last = lightest.agg(F.max(_edge()).alias("e"))
        joined = lightest.repartition(1).sortWithinPartitions(*_EDGE).mapInPandas(_kruskal, schema)
        joined = stage(joined, "joined")
        done.append(joined.filter("top IS NULL").drop("top").withColumn("step", F.lit(step)))
        top = joined.filter("top IS NOT NULL").select("node", "top")
        rest = between.join(last, _edge() > F.col("e")).drop("e")  # one row
        for side in ("left", "right"):
            rest = merge_join(rest, top.toDF(side, "top"), side, "left").withColumn(side, F.coalesce("top", side)).drop("top")
        between, step = stage(shortest(rest), "between"), step + 1
    if not done:
        empty = f"w double, a {kind}, b {kind}, node string, left string, right string, step int"
        return points.sparkSession.createDataFrame([], empty), 0
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return stage(out, "branches"), step


def _parents(tree: DataFrame) -> DataFrame:
    """``node, parent, e``: the branch above a group, with its edge."""
    child = F.explode(F.array("left", "right")).alias("node")
    return tree.select(child, F.col("node").alias("parent"), _edge().alias("e"))


def _attach(rows: DataFrame, parents: DataFrame) -> DataFrame:
    """``rows`` with ``node``, moved up to the highest branch whose edge is not after ``e``."""
    levels, above = [], stage(parents.select("node", F.col("parent").alias("to"), F.col("e").alias("at")), "above")
    while not above.isEmpty():
        levels.append(above)
        further = above.select(F.col("node").alias("to"), F.col("to").alias("far"), F.col("at").alias("when"))
        above = stage(merge_join(above, further, "to").select("node", F.col("far").alias("to"), F.col("when").alias("at")), "above")
    for level in reversed(levels):
        rows = merge_join(rows, level, "node", "left")
        higher = F.coalesce(F.col("at") <= F.col("e"), F.lit(False))
        rows = rows.withColumn("node", F.when(higher, F.col("to")).otherwise(F.col("node"))).drop("to", "at")
    return rows


def _density(w: Column) -> Column:
    return 1 / w


def _upward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size, stability, value and choice of branches whose children come before them."""
    known: dict = {}
    for rows in batches:
        out = []
        for r in rows.itertuples(index=False):
            size, value = 0, 0.0
            for child, n, v in ((r.left, r.left_size, r.left_value), (r.right, r.right_size, r.right_value)):
                n, v = known.pop(child, (n, v))
                size, value = size + n, value + v
            own = r.total - r.n * r.birth + size * (r.split - r.birth)
            chosen = bool(r.allowed and own >= value)
            known[r.node] = (size + r.n, own if chosen else value)
            out.append((r.node, int(known[r.node][0]), own, float(known[r.node][1]), chosen))
        yield pd.DataFrame(out, columns=["node", "size", "stability", "value", "chosen"])


def _downward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The chosen branch that each branch belongs to; parents come before children."""
    known: dict = {}
    for rows in batches:
        out = []
        for r in rows.itertuples(index=False):
            above = known.get(r.parent, r.above)
            above = None if above is None or above != above else above
            known[r.node] = above if above is not None else (r.node if r.chosen else None)
            out.append((r.node, known[r.node]))
        yield pd.DataFrame(out, columns=["node", "topic"])


def density_clusters(
    neighbours: DataFrame, min_size: int = SMALLEST_TOPIC, min_samples: int = MIN_SAMPLES, merges: int = MERGES
) -> DensityModel:
    """Cluster the rows of a neighbour table. Topic 0 is the largest, -1 is noise."""
    neighbours = stage(neighbours.select("abstract_id", "neighbour", "distance"), "neighbours")
    core = stage(core_distances(neighbours, min_samples), "core")
    edges = stage(reachability_edges(neighbours, core), "edges")
    everyone = merge_join(neighbours.select("abstract_id").distinct(), core, "abstract_id", "left")
    points = seeds(everyone, edges, min_size)
    points = stage(points.withColumn("node", F.col("seed").cast("string")).withColumn("e", _edge()), "seeds")
    tree, steps = branches(points, edges, merges)
    parents = stage(_parents(tree), "parents")
    placed = points.filter("node IS NOT NULL").select("abstract_id", "core", "seed", *_EDGE, "node", "e")
    placed = stage(_attach(placed, parents).drop("e"), "placed")

    # Sums per branch; a branch without a parent is born at density 0.
    sums = placed.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_density(F.col("w"))).alias("total"), F.max(_density(F.col("w"))).alias("densest")
    )
    every = points.filter("node IS NOT NULL").select("node").distinct()
    every = merge_join(every, tree.select("node"), "node", "left_anti").withColumn("step", F.lit(-1))
    inner = tree.select("node", "step", *_EDGE, "left", "right")
    every = inner.unionByName(every, allowMissingColumns=True)
    every = merge_join(merge_join(every, parents, "node", "left"), sums, "node", "left")
    every = every.select(
        "node", "parent", "step", *_EDGE, "left", "right", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce(_density(F.col("e.w")), F.lit(0.0)).alias("birth"),
        F.coalesce(_density(F.col("w")), F.col("densest")).alias("split"),
    )
    every = stage(every, "every")
    roots = every.filter("parent IS NULL").limit(2).count()
    allowed = F.col("parent").isNotNull() | F.lit(roots > 1)
    every = every.withColumn("allowed", allowed)

    leaf = every.filter("step < 0")
    own = F.col("total") - F.col("n") * F.col("birth")
    value = F.when(F.col("allowed"), own).otherwise(0.0)
    valued = leaf.select("node", F.col("n").alias("size"), own.alias("stability"), value.alias("value"), F.col("allowed").alias("chosen"))
    valued = stage(valued, "valued")
    results = "node string, size bigint, stability double, value double, chosen boolean"
    for step in range(steps):
        rows = every.filter(F.col("step") == step)
        for side in ("left", "right"):
            child = valued.select(F.col("node").alias(side), F.col("size").alias(f"{side}_size"), F.col("value").alias(f"{side}_value"))
            rows = merge_join(rows, child, side, "left")
        rows = rows.repartition(1).sortWithinPartitions(*_EDGE).mapInPandas(_upward, results)
        valued = valued.unionByName(stage(rows, "valued"))
    every = stage(merge_join(every, valued, "node"), "every")
    topics = None
    for step in reversed(range(steps)):
        rows = every.filter(F.col("step") == step).select("node", "parent", *_EDGE, "chosen")
        if topics is None:
            rows = rows.withColumn("above", F.lit(None).cast("string"))
        else:
            rows = merge_join(rows, topics.select(F.col("node").alias("parent"), F.col("topic").alias("above")), "parent", "left")
        down = [F.desc(c) for c in _EDGE]
        rows = rows.repartition(1).sortWithinPartitions(*down).mapInPandas(_downward, "node string, topic string")
        rows = stage(rows, "topics")
        topics = rows if topics is None else topics.unionByName(rows)
    leaf = every.filter("step < 0").select("node", "parent", "chosen")
    own = F.when(F.col("chosen"), F.col("node"))
    if topics is None:
        topics = leaf.select("node", own.alias("topic"))
    else:
        leaf = merge_join(leaf, topics.select(F.col("node").alias("parent"), F.col("topic").alias("above")), "parent", "left")
        topics = topics.unionByName(leaf.select("node", F.coalesce(F.col("above"), own).alias("topic")))
    topics = stage(topics, "topics")
    # One row per topic is numbered, by size.
    named = merge_join(every, topics.filter("topic = node"), "node").select("topic", "size", F.col("split").alias("death"))
    order = Window.orderBy(F.desc("size"), "topic")
    named = named.select("topic", "death", (F.row_number().over(order) - 1).alias("topic_id"))
    found = merge_join(every, topics, "node").join(named, "topic", "left").select(
        "node", "parent", *_EDGE, "size", "stability", "death", F.coalesce("topic_id", F.lit(-1)).alias("topic_id")
    )
    found = stage(found, "branches")
    kept = merge_join(placed, found.select("node", "topic_id", "death"), "node")
    density = _density(F.col("w"))
    kept = kept.select("abstract_id", "core", "seed", *_EDGE, "node", "topic_id", _strength(density), density.alias("density"))
    lost = points.filter("node IS NULL").select("abstract_id", "core", F.lit(-1).alias("topic_id"), F.lit(0.0).alias("strength"))
    points = stage(kept.unionByName(lost, allowMissingColumns=True), "points")
    return DensityModel(points, found, min_samples)


def _strength(density: Column) -> Column:
    """How long a row stays in its topic, against the densest of it."""
    inside = F.least(density, F.col("death")) / F.col("death")
    return F.when(F.col("topic_id") >= 0, inside).otherwise(0.0).alias("strength")


def place(model: DensityModel, neighbours: DataFrame) -> DataFrame:
    """``abstract_id, topic_id, strength`` of unseen rows, given their neighbours among the model's rows.

    A row goes to the branch of the neighbour it reaches first, as far up as
    its own distance asks. Rows with too few neighbours are noise.
    """
    known = model.points.filter("seed IS NOT NULL").select(
        F.col("abstract_id").alias("neighbour"), F.col("core").alias("near"), F.col("seed").cast("string").alias("node"), *_EDGE
    )
    core = core_distances(neighbours, model.min_samples)
    met = merge_join(merge_join(neighbours, core, "abstract_id"), known, "neighbour")
    met = met.withColumn("far", F.greatest("distance", "core", "near", F.lit(CLOSEST)))
    best = F.min_by(F.struct("far", "node", *_EDGE), F.struct("far", "neighbour")).alias("best")
    met = met.groupBy("abstract_id").agg(best).select("abstract_id", "best.*")
    met = met.select("abstract_id", "far", "node", F.struct(F.greatest("w", "far").alias("w"), "a", "b").alias("e"))
    parents = model.branches.select("node", "parent")
    edge = model.branches.select(F.col("node").alias("parent"), _edge().alias("e"))
    parents = merge_join(parents.filter("parent IS NOT NULL"), edge, "parent").select("node", "parent", "e")
    met = merge_join(_attach(stage(met, "met"), parents), model.branches.select("node", "topic_id", "death"), "node")
    met = met.select("abstract_id", "topic_id", _strength(_density(F.col("far"))))
    every = merge_join(neighbours.select("abstract_id").distinct(), met, "abstract_id", "left")
    return every.select("abstract_id", F.coalesce("topic_id", F.lit(-1)).alias("topic_id"), F.coalesce("strength", F.lit(0.0)).alias("strength"))


def density_topics(points: DataFrame) -> DataFrame:
    """``abstract_id, topic_id, topic_score`` as the topic jobs store them."""
    return points.select("abstract_id", "topic_id", topic_score(F.array("strength")).alias("topic_score"))
