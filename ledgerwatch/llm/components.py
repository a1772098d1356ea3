"""Connected components of an edge table by alternating large and small stars.

Each round has two joins and three combined aggregates; its edges are stored, so nothing is
computed twice and a lost executor costs one round.  A hub is never gathered: the minimum of its
neighbours combines before the shuffle, and the join back is one that AQE can split.
"""

from pyspark.sql import functions as F

from ledgerwatch.llm.staging import stage


def _large_star(edges):
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges):
    """``edges`` point down (u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").filter("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges, a="u", b="v"):
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Nulls and self loops: an edge with a null end is dropped; a self loop makes its node known.
    Repeated edges and either direction are the same edge.  No edges give no rows.
    """
    raw = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "edges")
    current = raw.filter("u <> v")
    state = _state(current)
    while state[0]:
        current = stage(_small_star(_large_star(current)), "stars")
        before, state = state, _state(current)
        if tuple(before) == tuple(state):
            break
    nodes = raw.select(F.col("u").alias("node")).unionAll(raw.select("v")).distinct()
    return nodes.join(current.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))
