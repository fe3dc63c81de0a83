"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Edges from which on a step's table gets a further file (at least one for each core).
FILE_EDGES = 50_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component; root is the smallest.

    ``edges`` has the long columns u and v, in any direction; loops, repeats and nulls
    are allowed and link nothing further; no edges give no rows. Each step writes its edges to the shared folder, so a lost executor
    costs at most one step. No node's neighbours are ever gathered: a hub is a
    hot join key with one row on its other side.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    now = checkpointed(now, "edges")
    state = _state(now)
    while state[0]:
        # Few edges go to few files: each file costs its executor a task and, without Hadoop's native library, a process.
        files = max(now.sparkSession.sparkContext.defaultParallelism, state[0] // FILE_EDGES + 1)
        # Large star: link each larger neighbour to the smallest one.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written out: the join meets two plain tables, and Spark can split a hub's rows.
        least = checkpointed(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).coalesce(files), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpointed(large.distinct().coalesce(files), "large-star")
        # Small star: link the smaller neighbours and the node itself to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(files), "small-star")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
