"""Object heads: one row of properties and user metadata per object."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import DEFAULT_STORAGE_CLASS
from ..functions.keys import etag_normalize
from ..functions.maps import map_or_empty
from .inventory import prefix_filter, single

HEAD_FIELDS = (
    "content_length", "content_type", "content_md5", "last_modified", "etag", "storage_class",
    "metadata", "cache_control", "expires",
)


def head_scan(heads: DataFrame) -> DataFrame:
    """Key and the nine head fields, with their defaults."""
    fields = {
        "etag": etag_normalize("etag"),
        "storage_class": F.coalesce(F.col("storage_class"), F.lit(DEFAULT_STORAGE_CLASS)),
        "metadata": map_or_empty("metadata"),
    }
    keys = [c for c in ("bucket", "key") if c in heads.columns]
    return heads.select(
        *keys, *[fields.get(name, F.col(name)).alias(name) for name in HEAD_FIELDS]
    )


def object_info(heads: DataFrame, key: str, version_id: str | None = None) -> DataFrame:
    """Head of one object; both tests reach the scan."""
    one = heads.filter(F.col("key") == key)
    if version_id:
        one = one.filter(F.col("version_id") == version_id)
    return head_scan(one)


def prefix_metadata(
    inventory: DataFrame, heads: DataFrame, prefix: str = "", repeated_keys: bool = True
) -> DataFrame:
    """Listing under a prefix with the (newest) head of each key.

    The prefix is put on both sides, so both scans skip what lies outside it.
    """
    keys = [c for c in ("bucket", "key") if c in inventory.columns and c in heads.columns]
    current = single(head_scan(prefix_filter(heads, prefix)), repeated_keys, *keys)
    return prefix_filter(inventory, prefix).select(*keys).join(current, keys, "inner")
