"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node of ``edges`` (two columns ``a``, ``b`` of one type, any order,
    repeats and self-loops allowed): ``node``, ``root``, the root being one node of the
    component. Nodes without a proper edge do not appear.

    Each round lets every node point at the neighbour of least priority (a hash that changes
    by round), follows the pointer of that neighbour once, and contracts the edges. A node's
    parent never has a larger priority, so pointers make no cycle, and with random priorities
    a path halves and a star vanishes in two rounds. Everything is a grouped minimum or an
    equi-join; each round's small tables are written, so nothing is recomputed.
    """
    edges = saved(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels, turn = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0), 0
    while not edges.isEmpty():
        def ranked(c, turn=turn):
            return F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("p"), F.col(c).alias("v"))

        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(ranked("b")).alias("m")).select(
            F.col("a").alias("node"), F.least(ranked("a"), "m")["v"].alias("parent"))
        least = saved(least, "parents")
        nexts = least.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = saved(least.join(nexts, "parent").select("node", F.col("grand").alias("up")),
                       "jumped")
        if turn == 0:
            labels = jumped.select("node", F.col("up").alias("root"))
        else:
            ups = jumped.select(F.col("node").alias("root"), "up")
            labels = saved(labels.join(ups, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")), "labels")
        for c in ("a", "b"):
            edges = edges.join(jumped.select(F.col("node").alias(c), "up"), c) \
                .drop(c).withColumnRenamed("up", c)
        edges = saved(edges.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        turn += 1
    return labels
