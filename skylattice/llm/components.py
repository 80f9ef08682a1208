"""Connected components over a distributed edge table.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): the edges of each component turn
into a star around its smallest node in a few rounds.  Only edges move, they are
written to the shared folder after each round, and nothing is collected; a node
with very many edges is never one key of a shuffled join (see told).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

#: Rounds are logarithmic in the longest path; far more means a fault.
MOST_ROUNDS = 60
#: A node with more edges than this, and than a thousandth of all edge ends, is hot.
HOT_EDGES = 64


def told(edges: DataFrame, least: DataFrame, hot: int) -> DataFrame:
    """edges (a and other columns) with the m of their a. least: a, n (rows of a in edges), m.

    Hot nodes are told by a broadcast: as each has more than a thousandth of all
    rows, there are at most a thousand.  The others meet by a shuffle, in which
    no key has more than ``hot`` rows.
    """
    loud = F.broadcast(least.where(F.col("n") > hot).select("a", "m"))
    return edges.join(loud, "a").unionByName(edges.join(loud, "a", "left_anti").join(least.where(F.col("n") <= hot).select("a", "m"), "a"))


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, component (smallest node reachable) of every node of edges (a, b)."""
    spark = edges.sparkSession
    sums = lambda table: table.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).head()
    now = storage.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/edges-0")
    last = sums(now)
    for k in range(1, MOST_ROUNDS):
        hot = max(HOT_EDGES, 2 * last["n"] // 1000)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.count("*").alias("n"), F.least(F.min("b"), F.col("a")).alias("m"))
        large = told(both, least, hot).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = storage.save(large.where("a <> b").distinct(), f"{folder}/large-{k}")
        smallest = large.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m"))
        linked = told(large, smallest, hot)
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smallest.select("a", F.col("m").alias("b")))
        after = storage.save(small.where("a <> b").distinct(), f"{folder}/edges-{k}")
        for done in (f"edges-{k - 1}", f"large-{k}"):
            storage.drop(spark, f"{folder}/{done}")
        now, seen = after, sums(after)  # a fixed point has the same number of edges and the same sum of their hashes
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
