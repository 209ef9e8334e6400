"""Top-k and sample reports; their limits are what they report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import (
    FAILED_ROWS, HISTORY_ROWS, PREVIEW_KEY_CHARS, PREVIEW_ROWS, PREVIEW_TIME_CHARS,
)
from ..functions.text import format_size
from ..session import stored


def sync_history(states: DataFrame, limit: int = HISTORY_ROWS) -> DataFrame:
    """The latest runs; runs without a time come last, ties go by id."""
    return states.orderBy(F.desc_nulls_last("last_sync_time"), "sync_id").limit(limit)


def validation_history(reports: DataFrame) -> DataFrame:
    return reports.orderBy(F.desc_nulls_last("timestamp"), "validation_id")


def failed_sample(results: DataFrame, limit: int = FAILED_ROWS) -> DataFrame:
    """The first failed rows by key."""
    return results.filter(~F.col("success")).orderBy("key").limit(limit)


def plan_preview(objects: DataFrame, limit: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a plan as shown to a reader, each with the number of rows left out.

    What is shown is written once, so that the plan is evaluated once for the rows and their number.
    """
    return shown_rows(held_for_preview(objects), limit)


def held_for_preview(objects: DataFrame) -> DataFrame:
    """The columns a preview needs, written to the shared folder."""
    return stored(objects.select("key", "size", "last_modified"), "preview")


def shown_rows(held: DataFrame, limit: int = PREVIEW_ROWS) -> DataFrame:
    total = held.agg(F.count("*")).scalar()
    return held.orderBy("key").limit(limit).select(
        F.substring("key", 1, PREVIEW_KEY_CHARS).alias("shown_key"),
        format_size(F.coalesce(F.col("size"), F.lit(0))).alias("shown_size"),
        F.coalesce(
            F.substring(F.date_format("last_modified", "yyyy-MM-dd'T'HH:mm:ss"), 1,
                        PREVIEW_TIME_CHARS), F.lit("")
        ).alias("shown_time"),
        F.greatest(total - limit, F.lit(0).cast("long")).alias("more"),
    )


def preview_totals(objects: DataFrame) -> DataFrame:
    return objects.agg(
        F.count("*").alias("objects"),
        F.coalesce(F.sum(F.coalesce(F.col("size"), F.lit(0))), F.lit(0)).alias("bytes"),
    )
