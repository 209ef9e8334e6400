"""Object listings as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import DEFAULT_STORAGE_CLASS, PAGE_KEYS
from ..functions.keys import etag_normalize, from_micros, parse_instant
from ..schemas import INVENTORY, RAW_LISTING


def prefix_filter(inventory: DataFrame, prefix: str = "") -> DataFrame:
    """Keys that start with ``prefix``; reaches a Parquet scan as a StartsWith filter."""
    return inventory.filter(F.col("key").startswith(prefix)) if prefix else inventory


def inventory_scan(
    spark: SparkSession,
    path: str,
    prefix: str = "",
    fmt: str = "parquet",
    bucket: str | None = None,
    **options: str,
) -> DataFrame:
    """The complete listing under a prefix, read with the fixed layout.

    ``fmt`` is ``parquet``, ``orc``, ``json`` or ``csv``. A folder partitioned by ``bucket``
    is pruned to one bucket when ``bucket`` is given.
    """
    reader = spark.read.schema(INVENTORY).options(**options)
    listing = reader.format(fmt).load(path)
    if bucket is not None:
        listing = listing.filter(F.col("bucket") == bucket)
    return prefix_filter(listing, prefix)


def listing_scan(
    spark: SparkSession, path: str, prefix: str = "", fmt: str = "json", **options: str
) -> DataFrame:
    """A listing as delivered (text times, quoted ETags), cleaned on the way in."""
    raw = spark.read.schema(RAW_LISTING).options(**options).format(fmt).load(path)
    return inventory_normalize(prefix_filter(raw, prefix))


def inventory_normalize(raw: DataFrame) -> DataFrame:
    """Defaults and clean-up: size 0, default class, bare ETag, readable time or null."""
    return raw.withColumns({
        "size": F.coalesce(F.col("size"), F.lit(0).cast("long")),
        "storage_class": F.coalesce(F.col("storage_class"), F.lit(DEFAULT_STORAGE_CLASS)),
        "etag": etag_normalize("etag"),
        "last_modified": parse_instant("last_modified"),
    })


def tree_inventory(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Complete listing of a folder tree: names of any kind and empty files included.

    The file source of the engine hides names that begin with a dot or an underscore and files
    without bytes, so the tree is listed by tasks instead; no body is read.
    """
    from ..jobs.objects import list_objects

    return prefix_filter(list_objects(spark, root, prefix), prefix)


def tree_key(path: Column | str, root: str) -> Column:
    """Key of a file below ``root``; works for ``file:/x`` and ``file:///x`` spellings."""
    bare = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    marker = "/" + bare.strip("/") + "/"
    path = F.col(path) if isinstance(path, str) else path
    return F.substring(path, F.instr(path, marker) + len(marker), F.lit(2147483647))


def latest_per_key(rows: DataFrame, *keys: str) -> DataFrame:
    """The newest row of each key, for feeds and versioned listings or heads that repeat keys.

    A plain aggregate: rows of a hot key are combined before the shuffle. Ties on the time
    (and rows of tables without one) are settled by the remaining columns, so the outcome is
    the same on every run.
    """
    keys = keys or ("key",)
    rest = [c for c in rows.columns if c not in keys]
    rest.sort(key=lambda c: c != "last_modified")
    # Maps have no order; they are carried along but settle nothing.
    ordered = [c for c in rest if "map<" not in rows.schema[c].dataType.simpleString()]
    rank = F.struct(*ordered)
    newest = F.max(rank) if ordered == rest else F.max_by(F.struct(*rest), rank)
    return rows.groupBy(*keys).agg(newest.alias("newest")).select(
        *[F.col(c) if c in keys else F.col(f"newest.{c}") for c in rows.columns]
    )


def single(rows: DataFrame, repeated_keys: bool, *keys: str) -> DataFrame:
    """At most one row per key: ``latest_per_key``, or the table itself where that is given."""
    return latest_per_key(rows, *keys) if repeated_keys else rows


def page_rows(
    inventory: DataFrame, prefix: str, delimiter: str | None, max_keys: int, token: str | None
) -> DataFrame:
    """The rows of a page and one more, in key order."""
    rows = prefix_filter(inventory, prefix)
    if delimiter:
        rest = F.substring("key", len(prefix) + 1, 2147483647)
        rows = rows.filter(F.instr(rest, delimiter) == 0)
    if token:
        rows = rows.filter(F.col("key") > token)
    return rows.orderBy("key").limit(max_keys + 1)


def list_page(
    inventory: DataFrame,
    prefix: str = "",
    delimiter: str | None = None,
    max_keys: int = PAGE_KEYS,
    continuation_token: str | None = None,
) -> DataFrame:
    """One page in key order. The token is the last key of the page before.

    Keys that hold the delimiter after the prefix are rolled up and not returned.
    """
    return page_rows(inventory, prefix, delimiter, max_keys, continuation_token).limit(max_keys)


def page_summary(
    inventory: DataFrame,
    prefix: str = "",
    delimiter: str | None = None,
    max_keys: int = PAGE_KEYS,
    continuation_token: str | None = None,
) -> DataFrame:
    """One row on a page: prefix, is_truncated, next_continuation_token, key_count.

    One row beyond the page tells whether it is truncated; the token is the largest key that
    is left when that extra row is taken away.
    """
    rows = page_rows(inventory, prefix, delimiter, max_keys, continuation_token)
    found = rows.agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_list("key")).alias("keys"),
    )
    truncated = F.col("n") > max_keys
    return found.select(
        F.lit(prefix).alias("prefix"),
        truncated.alias("is_truncated"),
        F.when(truncated, F.element_at("keys", max_keys)).alias("next_continuation_token"),
        F.least(F.col("n"), F.lit(max_keys)).cast("long").alias("key_count"),
    )
