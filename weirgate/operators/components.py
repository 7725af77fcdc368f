"""Connected components: contraction inside tasks, then large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions import kernels
from weirgate.operators.skew import attach_group_value, hot_threshold
from weirgate.session import materialise

# Edge tables are written and contracted in tasks of about this many edges, and in at least so
# many tasks if their shuffle has as many partitions.
TASK_EDGES = 1 << 16
TASKS = 8

# The smallest neighbours of the nodes of up to this many edges are broadcast (3 MB).
BROADCAST_EDGES = 1 << 17


def connected_components(edges: DataFrame) -> DataFrame:
    """Label every node of ``edges(u, v)`` with the smallest node it is connected to.

    Returns ``(node, component)``. Tasks first replace their own edges by a spanning forest, so
    that only what connects them is left to the joins. Each round is two joins on the edge table
    and a contraction of the result; the edges are written after each, and rounds stop when the
    edges are stars. A node with a very long neighbour list is spread over tasks. The number of
    tasks follows the edges that are left, not the configured shuffle partitions alone.
    """
    current = materialise(_clean(contract(edges)))
    while True:
        n = current.count()
        if _are_stars(current, n):
            break
        linked = materialise(_in_few_tasks(_large_star(current, n), n))
        current = materialise(contract(_in_few_tasks(_small_star(linked, n), n)))
    children = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return children.unionByName(roots)


def contract(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes, at most as many in each task."""
    kinds = dict(edges.dtypes)
    return edges.where("u <> v").select("u", "v").mapInArrow(kernels.contracted, f"u {kinds['u']}, v {kinds['v']}")


def _in_few_tasks(rows: DataFrame, edges: int) -> DataFrame:
    return rows.coalesce(max(TASKS, -(-edges // TASK_EDGES)))


def _are_stars(edges: DataFrame, total: int) -> bool:
    """Whether every node with a smaller neighbour has that one neighbour only, once.

    Then every component is a star around its smallest node, and a round would change nothing.
    """
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = _in_few_tasks(ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n")), total)
    return nodes.agg(F.count_if(F.expr("up > 0 AND n > 1"))).first()[0] == 0


def _clean(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each, without loops."""
    return edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _with_smallest(pairs: DataFrame, total: int) -> DataFrame:
    groups = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if total <= BROADCAST_EDGES:
        return pairs.join(F.broadcast(_in_few_tasks(groups, total).select("u", "m")), "u")
    return attach_group_value(pairs, groups, ["u"], "m", "n", hot_threshold(total))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Connect each node's larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_smallest(both, 2 * total).where(F.col("v") > F.col("u"))
    return _clean(linked.select(F.col("v").alias("u"), F.least("m", "u").alias("v")))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of them."""
    linked = _with_smallest(edges, total)
    return _clean(
        linked.select("u", F.col("m").alias("v")).unionByName(linked.select(F.col("v").alias("u"), F.col("m").alias("v")))
    )
