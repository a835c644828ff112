"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syntenia.llm import common

ROUNDS = 40


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Whether two tables of distinct edges are equal."""
    return x.count() == y.count() and x.join(y, ["u", "v"], "left_anti").isEmpty()


def components(links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b), of any orderable type; root is the smallest node of its component.

    Each round relinks every node to the smallest neighbour (large star), then
    every node and its smaller neighbours to the smallest of them (small star),
    until no edge changes; the rounds grow with the logarithm of the longest path.
    Minima are aggregated before the shuffle. They are joined back one row for each
    node, so adaptive execution can split the neighbours of a hub over tasks.
    """
    edges = scratch.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    for _ in range(ROUNDS):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        new = scratch.write(small.where("u != v").distinct(), "edges")
        done = _same(new, edges)
        scratch.drop(edges)
        edges = new
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
