"""Row filters on inventories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.globs import glob_included
from ..functions.keys import instant


def glob_filter(
    inventory: DataFrame, exclude: Iterable[str] = (), include: Iterable[str] = (),
    column: str = "key",
) -> DataFrame:
    return inventory.filter(glob_included(column, exclude, include))


def since_filter(inventory: DataFrame, since: str | None) -> DataFrame:
    """Rows not older than ``since`` (UTC text); rows without a time stay."""
    if since is None:
        return inventory
    at = F.col("last_modified")
    return inventory.filter(at.isNull() | (at >= instant(since)))


def modified_since(inventory: DataFrame, since: str) -> DataFrame:
    """Rows not older than ``since``; rows without a time are dropped."""
    return inventory.filter(F.col("last_modified") >= instant(since))


def checkpoint_filter(
    inventory: DataFrame, checkpoint: DataFrame, source_bucket: str, target_bucket: str
) -> DataFrame:
    """Rows whose key no earlier run between these buckets has handled.

    No hint is given: the engine broadcasts the checkpoint only below its size threshold and
    shuffles both sides by key otherwise.
    """
    done = checkpoint_keys(checkpoint, source_bucket, target_bucket).distinct()
    return inventory.join(done, "key", "left_anti")


def checkpoint_keys(checkpoint: DataFrame, source_bucket: str, target_bucket: str) -> DataFrame:
    return checkpoint.filter(
        (F.col("source_bucket") == source_bucket) & (F.col("target_bucket") == target_bucket)
    ).select("key")
