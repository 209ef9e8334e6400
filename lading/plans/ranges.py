"""Comparing two stored listings by digests of ranges, and joining only the ranges that differ.

A stored listing is sorted by relative key and comes with a digest tree of two levels. A branch is a
folder, cut at ``DEPTH`` names below the prefix; its leaves are ``LEAVES`` shares of its keys, by a hash
of the key. A digest is the number of rows and the sum of their hashes, which no order changes. Two
listings are compared branch by branch, then leaf by leaf in branches that differ, and only the rows
of differing leaves are read and joined. The digests are small tables next to the listings: one row
for each leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import difference, keyed_source, keyed_target
from ..session import stored

DEPTH = 3
LEAVES = 64
FEW_BRANCHES = 10_000
_DIGEST = "branch string, leaf int, rows long, digest decimal(38,0)"
_ROWS = "rel_key string, key string, size long, etag string, last_modified timestamp_ntz"


def _branch(rel_key: Column) -> Column:
    """The first folders of a relative key."""
    parts = F.split(rel_key, "/")
    return F.array_join(F.slice(parts, 1, F.least(F.lit(DEPTH), F.size(parts) - 1)), "/")


def _leaf(rel_key: Column) -> Column:
    return F.pmod(F.xxhash64(rel_key), F.lit(LEAVES)).cast("int")


def store_listing(
    inventory: DataFrame, path: str, prefix: str = "", repeated_keys: bool = True
) -> None:
    """Writes the comparable rows of a listing, in the order of branch and key, and their digests."""
    rows = keyed_source(
        inventory.select("key", "size", "etag", "last_modified"), prefix, repeated_keys
    ).select("rel_key", "key", "size", "etag", "last_modified")
    rows.withColumn("branch", _branch(F.col("rel_key"))).repartitionByRange("branch", "rel_key") \
        .sortWithinPartitions("branch", "rel_key").write.parquet(f"{path}/rows")
    written = _rows(inventory.sparkSession, path)
    what = F.xxhash64("rel_key", "size", "etag", "last_modified").cast("decimal(38,0)")
    written.groupBy("branch", _leaf(F.col("rel_key")).alias("leaf")).agg(
        F.count("*").alias("rows"), F.sum(what).cast("decimal(38,0)").alias("digest")
    ).write.parquet(f"{path}/digests")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_ROWS}, branch string").parquet(f"{path}/rows")


def differing_leaves(spark: SparkSession, source: str, target: str) -> DataFrame:
    """``branch, leaf`` of the leaves whose digests differ between two stored listings."""
    def digests(path: str) -> DataFrame:
        return spark.read.schema(_DIGEST).parquet(f"{path}/digests")

    def differing(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
        sides = [
            side.groupBy(*keys).agg(F.sum("rows").alias(f"n_{k}"), F.sum("digest").alias(f"d_{k}"))
            for k, side in enumerate((a, b))]
        same = F.col("n_0").eqNullSafe(F.col("n_1")) & F.col("d_0").eqNullSafe(F.col("d_1"))
        return sides[0].join(sides[1], list(keys), "full_outer").filter(~same).select(*keys)

    branches = stored(differing(digests(source), digests(target), "branch"), "branches")
    some = F.broadcast(branches) if branches.count() <= FEW_BRANCHES else branches
    return stored(differing(
        digests(source).join(some, "branch", "left_semi"),
        digests(target).join(some, "branch", "left_semi"), "branch", "leaf"), "leaves")


def diff_by_ranges(spark: SparkSession, source: str, target: str) -> DataFrame:
    """``diff_join`` of two stored listings: ``key, rel_key, size, etag, reason`` of source rows that
    have to be copied. Rows of leaves that agree are neither shuffled nor, where whole files or row
    groups hold no other branch, read."""
    leaves = differing_leaves(spark, source, target)
    few = leaves.count() <= FEW_BRANCHES
    names = [r["branch"] for r in leaves.select("branch").distinct().limit(FEW_BRANCHES).collect()] if few else []

    def some(path: str) -> DataFrame:
        rows = _rows(spark, path)
        if few:
            # A condition the scan can use; branches lie together in the files.
            rows = rows.filter(F.col("branch").isin(names))
        return rows.withColumn("leaf", _leaf(F.col("rel_key"))).join(
            F.broadcast(leaves) if few else leaves, ["branch", "leaf"], "left_semi"
        ).drop("branch", "leaf")

    found = keyed_target(some(target).withColumn("key", F.col("rel_key")), "", False)
    return some(source).join(found, "rel_key", "left").withColumn(
        "reason", difference()).filter(F.col("reason").isNotNull()).select(
        "key", "rel_key", "size", "etag", "reason")
