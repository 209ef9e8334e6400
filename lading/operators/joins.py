"""Joins between a source and a target inventory.

Tables may repeat keys (feeds, versioned listings and heads), and one key may hold a large
share of them. So both sides are reduced to the newest row of each key: partly before the
shuffle, then in the partitioning the join needs anyway. ``repeated_keys=False`` saves that
for plain listings, which hold each key once. All joins here are equi-joins on one key, so
each side is shuffled at most once and no hint overrides the size checks of the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import etag_normalize, relative_key
from ..functions.maps import map_or_empty
from ..sources.inventory import prefix_filter, single


def _size(column: str = "size") -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("long"))


def keyed_source(
    source: DataFrame, prefix: str = "", repeated_keys: bool = True
) -> DataFrame:
    """Source rows below the prefix with ``rel_key`` and comparable size and ETag."""
    rows = prefix_filter(source, prefix).withColumns({
        "rel_key": relative_key("key", prefix),
        "size": _size(),
        "etag": etag_normalize("etag"),
    })
    return single(rows, repeated_keys, "rel_key")


def keyed_target(
    target: DataFrame, prefix: str = "", repeated_keys: bool = True, with_etag: bool = True
) -> DataFrame:
    """Only what a comparison needs from the target: relative key, full key, size, ETag.

    Columns that go into the choice of the newest row cannot be pruned behind it, so those
    nobody asks for are left out here.
    """
    rows = prefix_filter(target, prefix).select(
        relative_key("key", prefix).alias("rel_key"),
        F.col("key").alias("t_key"),
        _size().alias("t_size"),
        *([etag_normalize("etag").alias("t_etag")] if with_etag else []),
        *(["last_modified"] if repeated_keys or with_etag else []),
    )
    newest = single(rows, repeated_keys, "rel_key")
    if not with_etag:
        return newest.drop("last_modified")
    return newest.withColumnRenamed("last_modified", "t_modified")


def difference() -> Column:
    """Why a source row differs from its target row; null where it does not.

    A blank ETag, as live listings have it, decides nothing. Then the size does, and between
    equal sizes the time: a source written after its copy counts as changed. So does one whose
    time is unknown on either side, since nothing shows that the copy is up to date.
    """
    comparable = (F.col("etag") != "") & (F.col("t_etag") != "")
    newer = ~F.coalesce(F.col("last_modified") <= F.col("t_modified"), F.lit(False))
    return (
        F.when(F.col("t_key").isNull(), F.lit("missing"))
        .when(comparable & (F.col("etag") != F.col("t_etag")), F.lit("etag"))
        .when(F.col("size") != F.col("t_size"), F.lit("size"))
        .when(~comparable & newer, F.lit("time"))
    )


def diff_join(
    source: DataFrame, target: DataFrame, source_prefix: str = "", target_prefix: str = "",
    repeated_keys: bool = True,
) -> DataFrame:
    """Source rows that have to be copied, with the reason: missing, etag or size."""
    needed = source.select("key", "size", "etag", "last_modified")
    joined = keyed_source(needed, source_prefix, repeated_keys).join(
        keyed_target(target, target_prefix, repeated_keys), "rel_key", "left"
    )
    return joined.withColumn("reason", difference()).filter(F.col("reason").isNotNull()).select(
        "key", "rel_key", "size", "etag", "reason"
    )


def orphan_anti_join(
    source: DataFrame, target: DataFrame, source_prefix: str = "", target_prefix: str = "",
    repeated_keys: bool = True,
) -> DataFrame:
    """Target rows without any source row; no glob, time or checkpoint rule takes part."""
    present = prefix_filter(source, source_prefix).select(
        relative_key("key", source_prefix).alias("rel_key")
    )
    present = present.distinct() if repeated_keys else present
    listed = keyed_target(target, target_prefix, repeated_keys, with_etag=False)
    return listed.join(present, "rel_key", "left_anti").select(
        F.col("t_key").alias("key"), "rel_key", F.col("t_size").alias("size")
    )


def mirror_status(
    source: DataFrame, target: DataFrame, source_prefix: str = "", target_prefix: str = "",
    repeated_keys: bool = True,
) -> DataFrame:
    """Both sides in one pass: missing, etag, size, same or orphan for every relative key."""
    needed = source.select("key", "size", "etag", "last_modified")
    joined = keyed_source(needed, source_prefix, repeated_keys).join(
        keyed_target(target, target_prefix, repeated_keys), "rel_key", "full_outer"
    )
    status = F.when(F.col("key").isNull(), F.lit("orphan")).otherwise(
        F.coalesce(difference(), F.lit("same"))
    )
    return joined.select(
        "rel_key", F.col("key").alias("source_key"), F.col("t_key").alias("target_key"),
        F.col("size").alias("source_size"), F.col("t_size").alias("target_size"),
        status.alias("status"),
    )


def validation_join(
    source: DataFrame, target_heads: DataFrame, source_prefix: str = "",
    target_prefix: str | None = None, repeated_keys: bool = True,
) -> DataFrame:
    """Source rows, one per key, with ``present``: whether the target has the same full key.

    Where a target prefix is given, keys are compared below the two prefixes instead.
    """
    src = single(prefix_filter(source, source_prefix), repeated_keys)
    if target_prefix is None:
        wanted = F.col("key")
    else:
        wanted = F.concat(F.lit(target_prefix), relative_key("key", source_prefix))
    marks = target_heads.select(F.col("key").alias("target_key")).distinct().withColumn(
        "found", F.lit(True))
    return src.withColumn("target_key", wanted).join(marks, "target_key", "left").withColumn(
        "present", F.coalesce(F.col("found"), F.lit(False))
    ).drop("found")


def metadata_attach(
    inventory: DataFrame, heads: DataFrame, preserve_metadata: bool = True,
    repeated_keys: bool = True,
) -> DataFrame:
    """Rows with ``metadata``, ``content_type`` and ``cache_control`` of the source object.

    A key without a head gets an empty map; without ``preserve_metadata`` there is no join.
    """
    if not preserve_metadata:
        none = F.lit(None).cast("string")
        return inventory.withColumns({
            "metadata": map_or_empty(F.lit(None).cast("map<string,string>")),
            "content_type": none, "cache_control": none,
        })
    wanted = single(
        heads.select("key", "last_modified", "metadata", "content_type", "cache_control"),
        repeated_keys,
    ).drop("last_modified")
    return inventory.join(wanted, "key", "left").withColumn("metadata", map_or_empty("metadata"))


def content_md5_join(
    source_digests: DataFrame, target_digests: DataFrame, repeated_keys: bool = True
) -> DataFrame:
    """Digest of both bodies per key, and whether they agree."""
    left = source_digests.select("key", F.col("md5").alias("source_md5"))
    right = target_digests.select("key", F.col("md5").alias("target_md5"))
    return single(left, repeated_keys).join(
        single(right, repeated_keys), "key", "inner"
    ).withColumn("match", F.col("source_md5") == F.col("target_md5"))
