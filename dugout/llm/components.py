"""Connected components of an edge table, by joins and aggregates only.

Rounds of hooking and contraction: every vertex points to its smallest neighbour if that
is smaller, pointers are followed to their ends by doubling, and the edges are rewritten
to the ends. Only vertices smaller than all their neighbours are left for the next round.
Each step is a written table, so nothing depends on one executor, and hot vertices are
rows of ordinary joins that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _ends(parents: DataFrame) -> DataFrame:
    """(v, p) with every pointer followed to its end."""
    while True:
        up = parents.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
        stepped = stored(parents.join(up, F.col("p") == F.col("_v"), "left").select("v", F.coalesce("_p", "p").alias("p"), (F.col("_p") < F.col("p")).alias("moved")), "pointers")
        parents = stepped.select("v", "p")
        if stepped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for every vertex of edges (a, b); the component is its smallest vertex."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    known = None
    while True:
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("n")))
        parents = stored(both.groupBy("v").agg(F.min("n").alias("n")).select("v", F.least("v", "n").alias("p")), "parents")
        ends = _ends(parents)
        if known is None:
            known = ends
        else:
            up = ends.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
            known = stored(known.join(up, F.col("p") == F.col("_v"), "left").select("v", F.coalesce("_p", "p").alias("p")), "components")
        one = ends.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        two = ends.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(one, "a").join(two, "b").where("pa <> pb").select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b"))
        edges = stored(moved.distinct(), "edges")
        if edges.isEmpty():
            return known.select("v", F.col("p").alias("component"))


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (v, component) after further edges (a, b); works on the components the edges connect."""
    if edges.isEmpty():
        return labels
    one = labels.select(F.col("v").alias("a"), F.col("component").alias("ca"))
    two = labels.select(F.col("v").alias("b"), F.col("component").alias("cb"))
    between = edges.join(one, "a", "left").join(two, "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    between = stored(between, "edges")
    merged = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("v").alias("_v"), F.col("component").alias("_c"))
    new = between.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(labels, "v", "left_anti").select("v", F.col("v").alias("component"))
    return stored(labels.unionByName(new).join(merged, F.col("component") == F.col("_v"), "left").select("v", F.coalesce("_c", "component").alias("component")), "components")
