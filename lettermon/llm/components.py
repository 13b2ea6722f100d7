"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """Rows ``node``, ``root`` for every node of ``edges`` (two columns of
    one integer type, self-loops and repeats allowed); ``root`` is the
    smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014)
    until the edges are stars around their roots.  Each round is two
    aggregations and joins over the edges, written to the shared folder, so
    no node's neighbours are gathered and no lineage grows.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    now = materialise(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                      "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialise(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = materialise(small, "small-star")
        last, mark = mark, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
