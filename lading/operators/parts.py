"""Byte ranges of large objects and their manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import MANIFEST_BLOCK_PARTS, MOST_PARTS, PART_BYTES


def part_plan(
    objects: DataFrame, part_size: int | Column = PART_BYTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per byte range: ``key, part_number, offset, length`` and the columns to ``keep``.

    An object up to ``part_size`` long is one part; a null size counts as 0. Ranges are generated row by row inside the
    scan's stage; nothing is shuffled.
    """
    size = F.coalesce(F.col("size"), F.lit(0).cast("long"))
    each = (part_size if isinstance(part_size, Column) else F.lit(part_size)).cast("long")
    n_parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("size") / each))
    offset = (F.col("part_number") - 1) * each
    return objects.withColumn("size", size).select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), n_parts)).alias("part_number")
    ).select(
        "key", "part_number", offset.alias("offset"),
        F.least(each, F.col("size") - offset).alias("length"), *keep,
    )


def part_bytes_of(size: Column, part_size: int, most_parts: int = MOST_PARTS) -> Column:
    """The part size of an object: ``part_size``, or more where that gave more than ``most_parts``."""
    return F.greatest(
        F.lit(part_size).cast("long"), F.ceil(F.coalesce(size, F.lit(0)) / most_parts).cast("long"))


def composite_etag(parts: DataFrame, *keys: str) -> DataFrame:
    """``keys, etag, n_parts`` from the ``md5`` of every part: of one part its digest, of several the
    digest of their digests in order, and their number.

    A group has as many rows as an object has parts (``part_bytes_of`` bounds them).
    """
    ordered = F.array_sort(F.collect_list(F.struct("part_number", "md5")))
    digests = F.transform(F.col("_parts"), lambda p: p["md5"])
    several = F.concat(
        F.md5(F.unhex(F.array_join(digests, ""))), F.lit("-"), F.size("_parts").cast("string"))
    return parts.groupBy(*keys).agg(ordered.alias("_parts")).select(
        *keys, F.when(F.size("_parts") == 1, digests[0]).otherwise(several).alias("etag"),
        F.size("_parts").cast("long").alias("n_parts"))


def part_order(parts: DataFrame, block_parts: int = MANIFEST_BLOCK_PARTS) -> DataFrame:
    """Manifests: the parts of each key in number order, in blocks of ``block_parts`` numbers.

    The blocks of a key, in block order, are its whole manifest. A block has a fixed size, so
    an object with a million parts never has to fit into one group.
    """
    block = F.floor((F.col("part_number") - 1) / F.lit(block_parts)).cast("long")
    return parts.groupBy("key", block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("part_number", "etag"))).alias("parts")
    )
