"""Sync plans: what happens to every object, and the accounting of a run.

Columns of a plan: ``key, rel_key, target_key, size, etag, last_modified, storage_class,
action, reason, target_included``. Actions: ``skip_checkpoint, skip_since, unchanged,
filtered, copy, delete``. For a copy, ``reason`` says why (missing, etag, size) and
``target_included`` whether the target key passes the globs as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (
    CANCELLED, COMPLETED, COMPLETED_WITH_ERRORS, DRY_RUN_DELETE, DRY_RUN_UPLOAD, FAILED_ROWS,
)
from ..functions.globs import glob_included
from ..functions.keys import instant, relative_key, storage_class_pick
from ..functions.text import run_duration
from ..operators.filters import checkpoint_keys
from ..operators.joins import difference, keyed_source, keyed_target
from ..operators.limits import failed_sample
from ..sources.inventory import prefix_filter
from .options import SyncOptions

PLAN_COLUMNS = (
    "key", "rel_key", "target_key", "size", "etag", "last_modified", "storage_class",
    "action", "reason", "target_included",
)
COUNTERS = (
    "total_objects", "processed_objects", "uploaded", "deleted", "skipped", "failed",
    "total_bytes", "transferred_bytes",
)


def _classified(
    source: DataFrame, target: DataFrame, options: SyncOptions, checkpoint: DataFrame | None,
    how: str, small_source: bool = False,
) -> DataFrame:
    """Source joined with checkpoint and target, one row per relative key and side.

    The checkpoint is brought to relative keys too (below one prefix that is one-to-one), so
    both joins use the same key and the source is shuffled once for the two of them.
    """
    repeated = options.repeated_keys
    needed = source.select("key", "last_modified", "size", "etag", "storage_class")
    src = keyed_source(needed, options.source_prefix, repeated).withColumn(
        "storage_class", storage_class_pick("storage_class", options.storage_class)
    )
    done: Column = F.lit(False)
    if checkpoint is not None:
        keys = checkpoint_keys(checkpoint, options.source_bucket, options.target_bucket)
        handled = prefix_filter(keys, options.source_prefix).select(
            relative_key("key", options.source_prefix).alias("rel_key")
        ).distinct().withColumn("done", F.lit(True))
        src = src.join(handled, "rel_key", "left")
        done = F.coalesce(F.col("done"), F.lit(False))
    tgt = keyed_target(target, options.target_prefix, repeated)
    if small_source:
        tgt = tgt.join(src.select("rel_key"), "rel_key", "left_semi")
    joined = src.join(tgt, "rel_key", how)

    at = F.col("last_modified")
    too_old = F.lit(False) if options.since is None else F.coalesce(
        at < instant(options.since), F.lit(False)
    )
    globs = (options.exclude_patterns, options.include_patterns)
    why = difference()
    target_key = F.concat(F.lit(options.target_prefix), F.col("rel_key"))
    action = (
        F.when(F.col("key").isNull(), F.lit("delete"))
        .when(done, F.lit("skip_checkpoint"))
        .when(too_old, F.lit("skip_since"))
        .when(why.isNull(), F.lit("unchanged"))
        .when(~glob_included("key", *globs), F.lit("filtered"))
        .otherwise("copy")
    )
    orphan = F.col("action") == "delete"
    return joined.select("*", action.alias("action"), why.alias("why")).select(
        F.when(orphan, F.col("t_key")).otherwise(F.col("key")).alias("key"),
        "rel_key",
        F.when(orphan, F.col("t_key")).otherwise(target_key).alias("target_key"),
        F.when(orphan, F.col("t_size")).otherwise(F.col("size")).alias("size"),
        "etag", "last_modified", "storage_class", "action",
        F.when(orphan, F.lit("orphan")).when(F.col("action") == "copy", F.col("why"))
        .alias("reason"),
        F.when(F.col("action") == "copy", glob_included(target_key, *globs))
        .alias("target_included"),
    )


def sync_plan(
    source: DataFrame, target: DataFrame, options: SyncOptions,
    checkpoint: DataFrame | None = None, small_source: bool = False,
) -> DataFrame:
    """Every source row with its action; the first rule that applies decides.

    ``small_source`` is for a source that is tiny against its target: the source keys first
    reduce the target by a semi-join. While they stay below the engine's size threshold that
    is a broadcast, and the target is filtered where it is read instead of being shuffled.
    """
    return _classified(source, target, options, checkpoint, "left", small_source)


def mirror_plan(
    source: DataFrame, target: DataFrame, options: SyncOptions,
    checkpoint: DataFrame | None = None, all_rows: bool = False,
) -> DataFrame:
    """Copies, and with ``options.delete`` the orphans to remove.

    Copies and orphans come out of one full outer join: each inventory is read and shuffled
    once. ``all_rows`` keeps the rows nothing is done for.
    """
    plan = _classified(
        source, target, options, checkpoint, "full_outer" if options.delete else "left"
    )
    return plan if all_rows else plan.filter(F.col("action").isin("copy", "delete"))


def dry_run_plan(plan: DataFrame) -> DataFrame:
    """Result rows of a preview; nothing moves. The second glob test is applied as well."""
    copy = F.col("action") == "copy"
    skipped = copy & ~F.col("target_included")
    return plan.filter(F.col("action").isin("copy", "delete")).select(
        "key", "target_key", F.lit(True).alias("success"), skipped.alias("skipped"),
        F.lit(None).cast("string").alias("error"),
        F.when(skipped, F.lit("filtered")).when(copy, F.lit(DRY_RUN_UPLOAD))
        .otherwise(DRY_RUN_DELETE).alias("reason"),
        "size",
    )


def _counters(rows: DataFrame, **given: Column) -> DataFrame:
    zero = F.lit(0)
    return rows.select(
        *[F.coalesce(given.get(name, zero), zero).cast("long").alias(name) for name in COUNTERS]
    )


def sync_counters(
    plan: DataFrame, results: DataFrame, deletes: DataFrame | None = None
) -> DataFrame:
    """The counters of a run as one row.

    Plan rows, copy results and delete results are each turned into counter rows and summed
    together: no join, and one partial aggregate per task before the only exchange.
    """
    def one(condition: Column) -> Column:
        return condition.cast("int")

    ok, skipped = F.col("success"), F.coalesce(F.col("skipped"), F.lit(False))
    action = F.col("action")
    parts = [
        _counters(
            plan.filter(action != "delete"),
            total_objects=one(action == "copy"),
            skipped=one(action.isin("skip_checkpoint", "skip_since")),
            total_bytes=F.col("size"),
        ),
        _counters(
            results,
            processed_objects=F.lit(1),
            uploaded=one(ok & ~skipped),
            skipped=one(ok & skipped),
            failed=one(~ok),
            transferred_bytes=F.when(ok & ~skipped, F.col("size")),
        ),
    ]
    if deletes is not None:
        parts.append(_counters(deletes, deleted=one(ok), failed=one(~ok)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in COUNTERS]
    )


def sync_summary(
    plan: DataFrame, results: DataFrame, options: SyncOptions, sync_id: str,
    start_time: str | None = None, end_time: str | None = None,
    deletes: DataFrame | None = None, stopped: bool = False,
) -> DataFrame:
    """One row on a run: identity, options, counters, status, duration, first failures."""
    failures = failed_sample(results, FAILED_ROWS).agg(
        F.array_sort(F.collect_list(F.struct("key", "error")))
    ).scalar()
    start, end = instant(start_time), instant(end_time)
    ended = F.when(F.col("failed") == 0, F.lit(COMPLETED)).otherwise(COMPLETED_WITH_ERRORS)
    status = F.lit(CANCELLED) if stopped else ended
    return sync_counters(plan, results, deletes).select(
        F.lit(sync_id).alias("sync_id"),
        status.alias("status"),
        F.lit(options.source_bucket).alias("source_bucket"),
        F.lit(options.target_bucket).alias("target_bucket"),
        F.lit(options.source_prefix).alias("source_prefix"),
        F.lit(options.target_prefix).alias("target_prefix"),
        F.lit(options.preserve_metadata).alias("preserve_metadata"),
        F.lit(options.preserve_acl).alias("preserve_acl"),
        F.lit(options.dry_run).alias("dry_run"),
        *COUNTERS,
        run_duration(start, end).alias("duration_seconds"),
        start.alias("start_time"),
        end.alias("end_time"),
        failures.alias("failed_list"),
    )
