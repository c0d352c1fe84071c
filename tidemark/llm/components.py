"""Connected components of an undirected graph, by alternating stars.

Each pass moves every edge towards the smallest node in reach; passes shrink the
paths roughly by half, so their number grows with the logarithm of the longest.
A node with very many edges is safe: minima are aggregated before the shuffle,
and the joins have unique keys opposite the edges. Where the number of edges proves
the minima small, they are broadcast and the edges stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizes import BROADCAST_LIMIT, broadcast_if
from tidemark.workspace import Workspace

# Two longs and their row, as ``measured_bytes`` counts them.
ROW_BYTES = 32


def _fits(edges: int) -> bool:
    """Whether a row for each node of so many edges, two nodes each at most, may be broadcast."""
    return 2 * edges * ROW_BYTES <= BROADCAST_LIMIT


def _towards_minimum(edges: DataFrame, small: bool) -> DataFrame:
    """For each node ``a``, its smaller or larger neighbours ``b`` tied to the smallest in reach."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(broadcast_if(least.withColumn("m", F.least("a", "m")), small), "a")


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tied = _towards_minimum(both, small).filter("b > a")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    tied = _towards_minimum(edges, small)
    moved = tied.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(tied.select("a", F.col("m").alias("b")))


def _pass(edges: DataFrame, small: bool) -> DataFrame:
    large = _large_star(edges, small)
    # With minima broadcast, making these edges twice is cheaper than shuffling them once.
    large = large if small else large.distinct()
    return _small_star(large, small).distinct()


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether each node is either a root or tied to one root alone."""
    below = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    above = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = below.unionAll(above).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    tangled = F.max((F.col("up") + F.col("down") > 1).cast("int"))
    found = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.coalesce(tangled, F.lit(0)).alias("tangled"))
    row = found.first()
    return row["n"], not row["tangled"]


def components(edges: DataFrame, workspace: Workspace, known: DataFrame | None = None) -> DataFrame:
    """``(node, root)`` for every node with an edge ``(a, b)``; root is the smallest node.

    ``known`` is what an earlier call returned: its components are kept and joined further.
    """
    if known is not None:
        if edges.isEmpty():
            return known
        edges = edges.select("a", "b").unionAll(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = workspace.store(down.filter("a != b").distinct(), "edges")
    n, done = _shape(now)
    while not done:
        now = workspace.store(_pass(now, _fits(n)), "edges")
        n, done = _shape(now)
    children = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return broadcast_if(workspace.store(children.unionAll(roots), "components"), _fits(n))
