"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); a component is its smallest id.

    Alternates two rewritings until nothing changes: every node hangs its larger neighbours on
    its smallest one (large star), then its smaller neighbours on the smallest (small star).
    Both keep the components; the graph ends as one star per component, in a number of rounds
    that grows with the logarithm of its diameter. Only minima are gathered per node.
    """
    links = stored(
        edges.filter("a <> b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.inline(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            ))).filter("u <> v").distinct()
        links = stored(small, "small")
        now = links.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.coalesce(F.sum("v").cast("decimal(38,0)"), F.lit(0)).alias("s")).first()
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
