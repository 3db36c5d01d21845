"""Connected components of a graph that exists only as a distributed table of edges.

Each round every vertex points at its smallest neighbour (or itself), pointers are followed to their ends, and the
edges are rewritten to the vertices these reach, each smaller than all its neighbours; vertices without edges are
done. So at least half of the vertices with edges go in each round, and a chain of any length takes as many jumps as
its length has binary digits. Tables are written to the shared folder between the steps, so no lineage grows and a lost
executor costs the step at hand. Joins are plain equi-joins between two written tables, which Spark can split where
one vertex has many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def _followed(pointers: DataFrame) -> DataFrame:
    """(v, p) with p at the end of its chain of pointers: the distance doubles until nothing changes."""
    while True:
        targets = pointers.select(F.col("v").alias("p"), F.col("p").alias("q"))
        further = stored(pointers.join(targets, "p").select("v", "p", "q"), "pointers")
        if further.filter("p != q").isEmpty():
            return pointers
        pointers = further.select("v", F.col("q").alias("p"))


def components(edges: DataFrame) -> DataFrame:
    """Rows (v, root) for every vertex of `edges` (columns a, b; any direction, repeats and loops allowed)."""
    edges = stored(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    result: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("p")).union(edges.select("b", "a"))
        once = stored(both.groupBy("v").agg(F.least(F.min("p"), F.col("v")).alias("p")), "pointers")
        pointers = _followed(once)
        result = pointers if result is None else stored(
            result.join(pointers.select(F.col("v").alias("p"), F.col("p").alias("q")), "p", "left").select("v", F.coalesce("q", "p").alias("p")), "pointers"
        )
        left = edges.join(pointers.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a").select("pa", "b")
        left = stored(left, "edges").join(pointers.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        edges = stored(left.filter("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if result is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return result.select("v", F.col("p").alias("root"))
