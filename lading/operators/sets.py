"""Set operations on keys and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import relative_key
from ..sources.inventory import prefix_filter


def checkpoint_union(done: DataFrame, newly_done: DataFrame) -> DataFrame:
    """Keys handled so far and keys just handled, each once."""
    return done.unionByName(newly_done.select(*done.columns)).distinct()


def key_except(
    source: DataFrame, target: DataFrame, source_prefix: str = "", target_prefix: str = ""
) -> DataFrame:
    """Relative target keys that the source has not."""
    def keys(side: DataFrame, prefix: str) -> DataFrame:
        return prefix_filter(side, prefix).select(
            relative_key("key", prefix).alias("rel_key")).distinct()

    return keys(target, target_prefix).join(keys(source, source_prefix), "rel_key", "left_anti")


def run_lookup(
    checkpoints: DataFrame, states: DataFrame, sync_id: str | None = None
) -> DataFrame:
    """One record per run: the checkpoint's where there is one, else the state's.

    A minimum over (priority, record) picks it, so many records of one run are combined
    before the shuffle.
    """
    shared = [c for c in checkpoints.columns if c in states.columns and c != "sync_id"]

    def ranked(side: DataFrame, priority: int, origin: str) -> DataFrame:
        record = F.struct(F.lit(priority).alias("priority"), F.lit(origin).alias("origin"), *shared)
        return side.select("sync_id", record.alias("record"))

    records = ranked(checkpoints, 0, "checkpoint").unionByName(ranked(states, 1, "state"))
    if sync_id is not None:
        records = records.filter(F.col("sync_id") == sync_id)
    return records.groupBy("sync_id").agg(F.min("record").alias("record")).select(
        "sync_id", "record.origin", *[F.col(f"record.{c}") for c in shared]
    )
