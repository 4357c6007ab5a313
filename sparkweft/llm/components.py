"""Connected components of a graph too large for one task, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Edges that one task writes at least.
TASK_EDGES = 250_000
#: Nodes with more neighbours are centres; their minima go to all tasks, as there are at most CENTRES of them.
HEAVY = 512
CENTRES = 500_000


def _with_minima(edges: DataFrame, count: int) -> DataFrame:
    """Edges (u, v) with m, the minimum around u. count bounds the rows of edges.

    No task sees all neighbours of a centre: minima are aggregated before they are shuffled, those of centres
    (at most CENTRES, as each has over count / CENTRES edges) are sent to all tasks, and only the edges of other nodes are shuffled to meet theirs.
    """
    heavy = max(HEAVY, count // CENTRES)
    around = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n")).select("_u", F.least("_u", "m").alias("m"), "_n")
    around = written(around, "components-minima", 1 + count // TASK_EDGES)
    centres = F.broadcast(around.where(F.col("_n") > heavy).select(F.col("_u").alias("_c"), F.col("m").alias("_m")))
    named = edges.join(centres, F.col("u") == F.col("_c"), "left")
    rest = named.where("_c is null").select("u", "v").join(around.where(F.col("_n") <= heavy), F.col("u") == F.col("_u")).select("u", "v", "m")
    return named.where("_c is not null").select("u", "v", F.col("_m").alias("m")).union(rest)


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Larger neighbours of a node go to the least node around it."""
    both = edges.union(edges.select("v", "u"))
    near = _with_minima(both, 2 * count).where("v > u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """Smaller neighbours of a node, and the node, go to the least of them. Takes edges with u > v."""
    near = _with_minima(edges, count)
    moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its least node.

    Each round writes its edges to the shared folder and ends when a round changes nothing: the edges then
    are stars whose centres are the least nodes.
    """
    at = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")
    mark = _mark(at)
    while mark[0]:
        files = 1 + mark[0] // TASK_EDGES  # neither star makes more edges than there were
        large = written(_large_star(at, mark[0]), "components", files)
        new = written(_small_star(large, mark[0]), "components", files)
        now = _mark(new)
        at, done, mark = new, now == mark, now
        if done:
            break
    stars = at.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
