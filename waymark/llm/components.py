"""Connected components of a link table, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """links (a, b): longs. Returns (node, root), the least node that is reachable, for every node that has a link.

    Alternates between hanging a node's larger and its smaller neighbours on the
    least node around it, so that chains shrink by powers and each round is two
    grouped minima. A node of many links is a window over rows of two longs and
    is never collected. Stops when a round changes nothing.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges)
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(down.select("u", F.col("m").alias("v"))).distinct()
        edges, old = materialize(small), edges
        discard(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
