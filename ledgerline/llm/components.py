"""Connected components of a graph given as edges: alternating large and small stars, a written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import forget, materialise


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node it reaches) for each node of `edges` (a, b: long, not null).

    Each star round points every neighbour at the smallest one. Rows never exceed the edges, groups are reduced by min()
    before they are joined back, and the number of rounds grows with the logarithm of the longest path. The result reads the
    last round's table, which `storage.forget` deletes.
    """
    links = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours of u point at u's least neighbour.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: smaller neighbours of u and u itself point at the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        done = materialise(small, "links")
        digest = lambda t: t.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        same = digest(done) == digest(links)
        forget(links)
        links = done
        if same:
            break
    out = links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct())
    out._scratch_path = links._scratch_path
    return out
