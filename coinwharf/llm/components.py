"""Connected components of links between numbers, by contraction over Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coinwharf.session import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node that has a link; nodes of a component share a root.

    Each round every node moves to the neighbour (or itself) that comes first in an order drawn
    anew by hashing, and links are rewritten to these and made distinct. A fixed share of the
    nodes goes in each round, whatever the shape, so the rounds grow as the logarithm of the
    nodes. Minima are taken before the shuffle; a node with a third of all links is a skewed
    join that adaptive execution splits. Each round's result is written to the shared folder.
    """
    spark = links.sparkSession
    edges = staged(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        seed = len(rounds)
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("rank"), F.col(c).alias("to"))
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        moves = staged(
            both.groupBy("a").agg(F.min(rank("b")).alias("best")).select(F.col("a").alias("node"), F.least(rank("a"), F.col("best"))["to"].alias("to")),
            "moves",
        )
        rounds.append(moves)
        left = edges.join(moves, edges["a"] == moves["node"]).select(F.col("to").alias("a"), "b")
        moved = left.join(moves, left["b"] == moves["node"]).select("a", F.col("to").alias("b"))
        edges = staged(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not rounds:
        return spark.createDataFrame([], "node long, root long")
    roots = rounds[-1].select("node", F.col("to").alias("root"))
    for moves in reversed(rounds[:-1]):
        step = moves.select(F.col("node").alias("from"), "to")
        roots = staged(
            step.join(roots, step["to"] == roots["node"], "left").select(F.col("from").alias("node"), F.coalesce("root", "to").alias("root")),
            "roots",
        )
    return roots
