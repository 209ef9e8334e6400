"""Operators on run states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import COMPLETED
from .running import running_totals


def last_sync_watermark(
    states: DataFrame, completed_only: bool = False, by_prefix: bool = False
) -> DataFrame:
    """Last sync time per bucket pair (and prefixes).

    ``completed_only`` leaves out previews and runs with failures, which would move the
    watermark past objects that were not copied.
    """
    if completed_only:
        states = states.filter(
            (F.col("status") == COMPLETED) & ~F.coalesce(F.col("dry_run"), F.lit(False))
        )
    keys = ["source_bucket", "target_bucket"]
    keys += ["source_prefix", "target_prefix"] if by_prefix else []
    return states.groupBy(*keys).agg(F.max("last_sync_time").alias("watermark"))


def effective_since(since: Column, watermark: Column) -> Column:
    """An explicit time has priority over the watermark."""
    return F.coalesce(since, watermark)


def history_row(states: DataFrame) -> DataFrame:
    """Display row of a run: time to the minute, success = uploaded + skipped, gaps as 0."""
    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("N/A"))

    return states.select(
        "sync_id",
        F.coalesce(F.date_format("start_time", "yyyy-MM-dd HH:mm"), F.lit("N/A")).alias("time"),
        text("status").alias("status"),
        text("source_bucket").alias("source"),
        count("total_objects").alias("total"),
        (count("uploaded") + count("skipped")).alias("success"),
        count("failed").alias("failed"),
    )


def progress_counts(results: DataFrame, order_by: tuple[str, ...] = ("completed_at", "key")) -> DataFrame:
    """Running totals after each object, in the order of completion."""
    ok, skipped = F.col("success"), F.coalesce(F.col("skipped"), F.lit(False))
    counts = {
        "processed": F.lit(1),
        "uploaded_so_far": (ok & ~skipped).cast("int"),
        "skipped_so_far": (ok & skipped).cast("int"),
        "failed_so_far": (~ok).cast("int"),
        "bytes_so_far": F.when(ok & ~skipped, F.col("size")).otherwise(0),
    }
    return running_totals(results, list(order_by), counts)
