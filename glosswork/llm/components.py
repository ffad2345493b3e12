"""Connected components of a table of links.

Links lead from a node to a smaller one. Every round finds the smallest
neighbour each node leads to (a minimum per node, merged per task before the
shuffle); by joins with it, a node's other neighbours are linked to the smallest
instead, and every link is led on to the smallest neighbour of its end. Adaptive
execution splits the joins' hot keys, so no node gathers its neighbours in one
place. A round makes as many links as it read, is
written to the staging folder, which cuts the plan, and counts its changes as it
is written; chains halve, so rounds grow with the logarithm of a component's
size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from glosswork.session import drop_staged, stage


def measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``df`` as a staged table, and aggregates over its rows, taken while it is written."""
    seen = Observation()
    staged = stage(df.observe(seen, *[column.alias(key) for key, column in measures.items()]), name)
    return staged, seen.get


def _step(links: DataFrame, least: DataFrame) -> DataFrame:
    """Links ``u, v`` from nodes to smaller ones, after a round; ``moved`` marks changes."""
    other = F.col("v") > F.col("m")
    star = links.select("u", "v").join(least.hint("merge"), "u")
    star = star.select(F.when(other, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), other.alias("moved"))
    ends = least.select(F.col("u").alias("v"), F.col("m").alias("further"))
    led = star.join(ends.hint("merge"), "v", "left")
    return led.select("u", F.coalesce("further", "v").alias("v"), (F.col("moved") | F.col("further").isNotNull()).alias("moved"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the smallest node names it.

    Links with a null end and links of a node to itself are ignored.
    """
    ends = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = links.filter(F.col(a) != F.col(b)).select(*ends).distinct()
    edges = stage(edges, "links")
    while True:
        before = edges
        # A table of its own: joins of plain tables have their hot keys split.
        least = stage(before.groupBy("u").agg(F.min("v").alias("m")), "least")
        edges, seen = measured(_step(before, least), "links", moved=F.count_if("moved"))
        drop_staged(before, least)
        if not seen["moved"]:
            break
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
    return named.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
