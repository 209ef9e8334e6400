"""Continuous planning: inventory files in, plan rows out, each file handled once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.options import SyncOptions
from ..plans.sync import PLAN_COLUMNS, sync_plan
from ..schemas import INVENTORY

_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def newest_versions(feed: DataFrame) -> DataFrame:
    """Of a stream of inventory rows, in update mode, the newest row of every key that got a newer one.

    The newest row of each key is kept as state over all batches. Rows carry the time of the batch they
    came in, which is one instant for a whole batch and the same one if a batch is repeated. Where the
    newest row of a key is as old as the last batch with that key, the key is given; where that batch
    only brought older versions, or the same one again, it is not.
    """
    rest = [c for c in INVENTORY.names if c not in ("key", "last_modified")]
    arrived = F.unix_micros(F.current_timestamp())
    # The last field lets the row win that came first, among rows that are the same otherwise.
    row = F.struct("last_modified", *rest, (-F.col("_arrived")).alias("_back"))
    return feed.withColumn("_arrived", arrived).groupBy("key").agg(
        F.max(row).alias("newest"), F.max("_arrived").alias("_seen")
    ).filter(F.col("newest._back") == -F.col("_seen")).select(
        *[F.col(c) if c == "key" else F.col(f"newest.{c}") for c in INVENTORY.names])


def plan_batch(
    batch: DataFrame, target: DataFrame, options: SyncOptions, small_batch: bool = True
) -> DataFrame:
    """Plan of one batch of the feed: the newest row of each key against the target."""
    return sync_plan(
        batch, target, replace(options, repeated_keys=True), small_source=small_batch)


def incremental_sync_stream(
    spark: SparkSession, feed: str, target: Callable[[], DataFrame], options: SyncOptions,
    plans: str, checkpoint: str, max_files_per_trigger: int | None = None,
    small_batches: bool = True, keep_newest: bool = True,
) -> StreamingQuery:
    """Starts a run over the files of ``feed`` no earlier run has seen, and ends after them.

    ``target`` is asked for the target inventory in every batch. The plan of a batch is
    written to ``plans/batch=<id>`` in overwrite mode, so a repeated batch replaces itself.
    ``small_batches`` reduces the target by the keys of a batch first; for a first run over a
    large backlog, say False. With ``keep_newest`` the newest version of every key is kept between
    batches and runs, in RocksDB below ``checkpoint``, and a version that is older than one seen
    before is not planned, whatever the target holds; a checkpoint belongs to one way of doing it.
    """
    reader = spark.readStream.schema(INVENTORY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(feed)

    def handle(batch: DataFrame, batch_id: int) -> None:
        plan_batch(batch, target(), options, small_batches).select(*PLAN_COLUMNS).write.mode(
            "overwrite").parquet(f"{plans}/batch={batch_id}")

    stream = newest_versions(rows).writeStream.outputMode("update") if keep_newest else rows.writeStream
    # A query takes the settings of its session with it when it starts.
    before = {name: spark.conf.get(name, None) for name in _STATE_STORE}
    try:
        for name, value in _STATE_STORE.items():
            spark.conf.set(name, value)
        return (
            stream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
