"""Connected components of a link table by randomised contraction.

Each round gives every node a pseudo-random priority (a hash of node and round, so retried tasks agree), moves it to
the neighbour of lowest priority, or to itself, and maps the links. About half of the nodes that still have links go
in each round, whatever the shape of the graph; no group is ever gathered, and hubs are aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import materialise


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another one; nodes of one component share their root, one of them.

    Links have no direction, may repeat and may be loops; rows with a NULL end link nothing.
    """
    pairs = lambda df: df.where("a < b").union(df.where("a > b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    left = materialise(pairs(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    moves, k = [], 0
    while not left.isEmpty():
        at = lambda c: F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("p"), F.col(c).alias("n"))  # noqa: B023, E731
        ends = left.union(left.select("b", "a")).groupBy("a").agg(F.min(at("b")).alias("m"))
        move = materialise(ends.select(F.col("a").alias("node"), F.least(F.col("m"), at("a"))["n"].alias("to")), "moves")
        one = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        two = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        left = materialise(pairs(left.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))), "links")
        moves.append(move)
        k += 1
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        roots = roots.join(move.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialise(roots, "roots")
