"""Connected components of an edge table, each named by its smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.storage import Stored, store


def components(edges: DataFrame) -> Stored:
    """(node, component) of every node of ``edges`` (a, b: long) by alternating large and small stars.

    A large star ties the larger neighbours of a node to its smallest one, a small star the smaller ones; both
    keep what is connected and, repeated, leave stars around the smallest nodes. Edges stay distributed and are
    cut by a stored table each time. Null ends and loops are passed over; repeated edges count once.
    """
    sound = edges.where("a != b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct()
    now = store(sound, "component-edges")
    before = None
    while True:
        state = now.df.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = now.df.unionAll(now.df.select(F.col("y").alias("x"), F.col("x").alias("y")))
        lowest = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.where("y > x").join(lowest, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        following = store(small.unionAll(least.select("x", F.col("m").alias("y"))).distinct(), "component-edges")
        now.release()
        now = following
    ends = now.df.select(F.col("x").alias("node"), F.col("y").alias("component"))
    roots = now.df.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    done = store(ends.unionAll(roots), "components")
    now.release()
    return done
