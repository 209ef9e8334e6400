"""Object bodies: small ones as a column, digests for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .inventory import tree_key


def content_scan(
    spark: SparkSession, root: str, max_bytes: int | None = None
) -> DataFrame:
    """``key, length, content`` of the files, or of those up to ``max_bytes`` only.

    A body becomes a value, so give a limit where they may be large. The file source hides names
    that begin with a dot or an underscore, and empty files; ``jobs.objects.body_digests`` takes
    every object, of any length.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return _within(files, F.col("length"), max_bytes).select(
        tree_key("path", root).alias("key"), "length", "content")


def _within(rows: DataFrame, length: Column, max_bytes: int | None) -> DataFrame:
    return rows if max_bytes is None else rows.filter(length <= max_bytes)


def content_digest(bodies: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``key, length, md5`` of bodies, or of those up to ``max_bytes`` only.

    The digest is taken in the scan's own stage, so only 32 characters per object travel on.
    """
    length = F.octet_length("content").cast("long")
    return _within(bodies, length, max_bytes).select(
        "key", length.alias("length"), F.md5("content").alias("md5")
    )
