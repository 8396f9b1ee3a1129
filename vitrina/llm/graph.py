"""Connected components of a link table by alternating stars, with no link or component on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on (a, b) with a > b: neighbours are linked to the smallest of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a <> b").distinct())
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex that is not the smallest of its component; label is the smallest.

    ``edges``: (a, b) of longs, any order, loops and repeats allowed. Every step writes its links to the shared folder,
    so a lost executor costs one step. A vertex with very many links is only ever the single row of a join's other side.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(),
               "links")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return e.select(F.col("a").alias("v"), F.col("b").alias("label"))
        mark = now
        e = stored(_star(e), "links")
