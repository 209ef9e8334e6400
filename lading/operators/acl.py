"""Operators on tables of access-control lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.acl import acl_copy_grants, acl_copy_owner, grantee_label, grants_match
from ..functions.keys import basename_target
from ..sources.inventory import single


def acl_compare(
    source_acls: DataFrame, target_acls: DataFrame, mode: str = "reference", how: str = "inner",
    repeated_keys: bool = True,
) -> DataFrame:
    """``key, match, owner_match, grants_match`` for the keys of two ACL tables."""
    def side(acls: DataFrame, name: str) -> DataFrame:
        return single(acls.select(
            "key", F.col("owner.id").alias(f"{name}_owner"), F.col("grants").alias(f"{name}_grants")
        ), repeated_keys)

    left, right = side(source_acls, "s"), side(target_acls, "t")
    owner = F.col("s_owner").eqNullSafe(F.col("t_owner"))
    grants = grants_match(F.col("s_grants"), F.col("t_grants"), mode)
    return left.join(right, "key", how).select(
        "key", (owner & grants).alias("match"), owner.alias("owner_match"),
        grants.alias("grants_match"),
    )


def acl_copy(acls: DataFrame) -> DataFrame:
    """Each list in the form its copy receives."""
    return acls.withColumns({
        "owner": acl_copy_owner("owner"), "grants": acl_copy_grants("grants"),
    })


def acl_batch_copy(
    acls: DataFrame, keys: DataFrame, target_prefix: str = "", repeated_keys: bool = True
) -> DataFrame:
    """Copies the lists of listed keys; a key without a list is a failure row."""
    found = single(acls.select("key", "owner", "grants"), repeated_keys).withColumn(
        "found", F.lit(True))
    success = F.coalesce(F.col("found"), F.lit(False))
    return keys.select("key").join(found, "key", "left").select(
        "key",
        basename_target("key", target_prefix).alias("target_key"),
        success.alias("success"),
        F.when(~success, F.lit("NoSuchKey")).alias("error"),
        F.when(success, acl_copy_owner("owner")).alias("owner"),
        F.when(success, acl_copy_grants("grants")).alias("grants"),
    )


def acl_explode(acls: DataFrame, *also: str, keep_empty: bool = True) -> DataFrame:
    """One row per grant with a readable grantee; lists without grants stay as one row.

    ``also`` names further columns to keep, such as the bucket, by which the lists of buckets
    (null key) are told apart.
    """
    spread = F.posexplode_outer if keep_empty else F.posexplode
    rows = acls.select(*also, "key", F.col("owner.id").alias("owner_id"), spread("grants"))
    return rows.select(
        *also, "key", "owner_id", F.col("pos").alias("position"),
        F.col("col.permission").alias("permission"),
        F.when(F.col("col").isNotNull(), grantee_label(F.col("col.grantee"))).alias("grantee"),
    )
