"""Access-control lists in one nested layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def acl_scan(raw: DataFrame) -> DataFrame:
    """``Owner`` and ``Grants`` as the store spells them, to the ``ACL`` layout.

    A row without a key is the list of the bucket; there grantees carry no display name.
    """
    is_bucket = F.col("key").isNull()

    def grant(g):
        who = g["Grantee"]
        return F.struct(
            F.struct(
                who["Type"].alias("type"),
                who["ID"].alias("id"),
                F.when(~is_bucket, who["DisplayName"]).alias("display_name"),
                who["URI"].alias("uri"),
                F.lit(None).cast("string").alias("email_address"),
            ).alias("grantee"),
            g["Permission"].alias("permission"),
        )

    return raw.select(
        "bucket",
        "key",
        F.struct(
            F.col("Owner.ID").alias("id"), F.col("Owner.DisplayName").alias("display_name")
        ).alias("owner"),
        F.transform(F.coalesce(F.col("Grants"), F.array()), grant).alias("grants"),
    )
