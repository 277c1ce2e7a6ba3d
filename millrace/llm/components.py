"""Connected components of an edge list, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import attach, settled


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of ``edges`` (``u, v``, whole numbers); the root is the smallest.

    Each round hangs every node's larger neighbours, then its smaller ones, on the
    smallest node in sight; the rounds needed grow with the logarithm of the
    longest path.  A node with very many neighbours is dealt over several parts.
    """
    now = settled(edges.where("u <> v").distinct())
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both, seen[0] * 2, larger=True)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        small = _hung(settled(down), seen[0] * 2, larger=False)
        now = settled(small.where("u <> v").distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _hung(edges: DataFrame, total: int, larger: bool) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("degree"))
    least = least.withColumn("least", F.least("u", "least"))
    met = attach(edges, least, "u", "degree", total)
    if larger:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return met.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
        met.select("u", F.col("least").alias("v"))
    )
