"""Connected components of an edge table, by alternating large and small stars.

Each round rewires every edge to the least neighbour; the rounds needed grow with the
logarithm of the longest path. A node with very many edges is only ever reduced to a
minimum (partly in the map tasks) and joined row by row, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.runtime import stored


def _to_least(edges: DataFrame, small: bool) -> DataFrame:
    """edges (a, b): every row's b and, for small stars, a itself, joined to a's least neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = edges.join(least, "a")
    out = joined.where("b > a" if not small else "b <> m").select(F.col("b").alias("x"), F.col("m").alias("y"))
    if small:
        out = out.unionByName(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
    return out.where("x <> y").distinct()


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node in edges (x, y); root is the least node of its component."""
    stars = stored(edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x <> y").distinct(), "edges")
    before = _shape(stars)
    for _ in range(max_rounds):
        both = stars.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(stars.select(F.col("y").alias("a"), F.col("x").alias("b")))
        large = _to_least(both, small=False)
        # every edge points to the smaller node now
        stars = stored(_to_least(large.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")), small=True), "stars")
        now = _shape(stars)
        if now == before:
            roots = stars.select(F.col("y").alias("x")).distinct()
            return stars.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(roots.select(F.col("x").alias("node"), F.col("x").alias("root")))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
