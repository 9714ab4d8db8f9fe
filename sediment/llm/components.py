"""Connected components of a graph given as edges, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.staging import Staging


def connected_components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """`node`, `root` for every node of `edges` (`a`, `b`: long, not null); root is the component's smallest node.

    Rounds of large-star and small-star: every node hands its larger neighbours, then its smaller ones, to the
    smallest node it knows. Rounds grow with the logarithm of the component's size, not its diameter; each is
    a written table, so a lost executor costs one round at most. No node's neighbours are gathered anywhere: the
    minimum is an aggregate and is joined back. Self-loops and repeated edges do no harm; no edges give no rows.
    """
    now = staging.write(f"{name}_0", _down(edges.where("a <> b")).distinct())
    seen = None
    for i in range(1, 200):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staging.write(f"{name}_{i}a", large.where("a <> b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        now = staging.write(f"{name}_{i}b", small)
        # Equal sums over all edges of two rounds in a row: nothing moves any more.
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("b", "a").cast("long"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
