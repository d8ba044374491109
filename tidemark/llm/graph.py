"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import write_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u")
    return tied.select("u", F.col("m").alias("v")).unionByName(
        tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge to another: the root is the smallest node that it
    can reach. ``edges`` has two orderable columns u, v; loops and repeats do no harm. Alternates
    large-star and small-star rounds until the edge set stays the same; each round is written to the
    shared folder, so that a lost executor costs one round and plans stay short. No round gathers a
    node's neighbours: minima are pre-aggregated and joined back."""
    now = write_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
        now = write_table(_small_star(_large_star(now)), "edges")
