"""Connected components of a table of links, in alternating star steps over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in `links` (a, b); the root is the smallest id that can be reached.

    Each round points the larger neighbours of an id, then its smaller ones, at the smallest of them.
    The number of rounds grows with the logarithm of the number of ids. No links give an empty table.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        outer = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = outer.groupBy("a").agg(F.min("b").alias("m"))
        inner = outer.join(lowest, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(inner.where("a <> b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(roots)
