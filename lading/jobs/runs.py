"""Whole runs: plan, act, account."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..constants import CANCELLED, FAILED, FAILED_ROWS, RUNNING
from ..functions.keys import instant, storage_class_pick
from ..functions.text import run_duration
from ..operators.acl import acl_copy
from ..operators.limits import failed_sample
from ..operators.joins import metadata_attach
from ..plans.options import SyncOptions, ValidateOptions
from ..plans.sync import dry_run_plan, mirror_plan, sync_summary
from ..plans.validate import (
    composite_cases, composite_verdicts, undecided_bodies, validate, validation_summary,
)
from ..schemas import RESULT
from ..sources.inventory import prefix_filter, single
from . import records
from .checkpoints import EVERY, CheckpointLog
from .journal import COUNTS, Journal
from .objects import copy_objects, delete_objects, dense_slices, digest_objects
from .parts import composite_digests
from .stopping import ancestors

TASK_BYTES = 1024 * 1024 * 1024


class EmptySourceError(RuntimeError):
    """A mirror run with deletion found no source object."""


def _now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


def new_run_id(kind: str) -> str:
    return f"{kind}-{datetime.now(timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"


def _stored(frame: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Writes a table and hands back the reader: what follows works on a fixed state."""
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _store_copies(
    plan: DataFrame, path: str, options: SyncOptions, source_heads: DataFrame | None,
    task_bytes: int, batches: int,
) -> tuple[DataFrame, int]:
    """The copies with ``batch`` and, inside it, ``task``; and the number of tasks in a batch.

    Tasks carry about equal numbers of bytes, batches equal numbers of tasks. Both are fixed
    once for the whole run.
    """
    rows = plan.filter("action = 'copy'").select("key", "target_key", "size", "target_included")
    if options.preserve_metadata and source_heads is not None:
        rows = metadata_attach(
            rows, source_heads, repeated_keys=options.repeated_keys).drop("metadata")
    sliced, tasks = dense_slices(rows, task_bytes)
    tasks = max(tasks, 1)
    steps = min(batches, tasks)
    # Steps of equal size: step b begins with task ceil(b * tasks / steps).
    batch = F.floor(F.col("task") * steps / tasks).cast("long")
    laid_out = sliced.withColumn("batch", batch).withColumns({
        "batch": F.col("batch").cast("int"),
        "task": (F.col("task") - F.ceil(F.col("batch") * tasks / steps)).cast("int")})
    per_batch = -(-tasks // steps)
    return _stored(laid_out, path, "batch"), per_batch


def run_sync(
    source: DataFrame, target: DataFrame, options: SyncOptions, store: str,
    source_root: str, target_root: str, source_heads: DataFrame | None = None,
    source_acls: DataFrame | None = None, resume: str | None = None, batches: int = 8,
    task_bytes: int = TASK_BYTES, sync_id: str | None = None,
    progress: Callable[[dict], None] | None = None, checkpoint_every: int = EVERY,
    take_over: bool = False,
) -> DataFrame:
    """Mirrors the source onto the target and returns the one-row summary.

    The run is claimed and journalled: one driver works on it, ``run_records`` tells how it stands, and
    ``request_stop`` ends it after the objects it is copying (``take_over`` ignores the claim of a
    driver that is gone). The plan is written first, so that acting on it cannot change it. Copies
    run in at most ``batches`` steps; tasks log what they handled after every ``checkpoint_every``
    objects, and ``progress`` is told the counts after each step. ``resume`` names an interrupted run:
    what it and the runs it resumed have handled is left out. All counts of the summary come from the
    written result tables.
    """
    spark = source.sparkSession
    sync_id = sync_id or new_run_id("sync")
    identity = {
        "source_bucket": options.source_bucket, "target_bucket": options.target_bucket,
        "source_prefix": options.source_prefix, "target_prefix": options.target_prefix,
        "dry_run": options.dry_run}
    journal = Journal(spark, store, sync_id, identity, resume, take_over)
    try:
        return _journalled(
            source, target, options, store, source_root, target_root, source_heads, source_acls,
            resume, batches, task_bytes, journal, progress, checkpoint_every)
    except BaseException:
        journal.end(FAILED)
        raise


def _journalled(
    source: DataFrame, target: DataFrame, options: SyncOptions, store: str, source_root: str,
    target_root: str, source_heads: DataFrame | None, source_acls: DataFrame | None,
    resume: str | None, batches: int, task_bytes: int, journal: Journal,
    progress: Callable[[dict], None] | None, checkpoint_every: int,
) -> DataFrame:
    spark, sync_id = source.sparkSession, journal.run_id
    start = _now()
    folder = f"{store}/runs/{sync_id}"
    places = (options.source_bucket, options.target_bucket)
    if options.since is None and options.since_last_sync:
        options = replace(options, since=records.watermark(
            spark, store, *places, options.source_prefix, options.target_prefix))
    if options.delete and not options.allow_empty_source:
        if prefix_filter(source, options.source_prefix).isEmpty():
            raise EmptySourceError("the source lists no object; nothing is deleted")

    checkpoint = None
    if resume:
        records.checkpoint_compact(spark, store, resume)
        checkpoint = records.read_checkpoints(spark, store, resume)
    if resume != sync_id:
        records.checkpoint_drop(spark, store, sync_id)
    plan = _stored(
        mirror_plan(source, target, options, checkpoint, all_rows=True), f"{folder}/plan", "action")

    if options.dry_run:
        preview = _stored(dry_run_plan(plan), f"{folder}/results")
        deletion = F.col("reason") == "[DRY-RUN] Would delete"
        results, deletes = preview.filter(~deletion), preview.filter(deletion)
    else:
        copies, tasks = _store_copies(
            plan, f"{folder}/copies", options, source_heads, task_bytes, batches)
        log = records.checkpoint_log(store, sync_id, *places, checkpoint_every)
        # Parts staged by a run are found again by those that go on from it.
        token = ancestors(store, sync_id)[-1]
        results = _copy_in_batches(
            copies, tasks, options, folder, source_root, target_root, progress, journal, log, token)
        deletes = None
        if options.delete and not journal.stop.raised(now=True):
            orphans = plan.filter("action = 'delete'")
            deletes = _stored(delete_objects(orphans, target_root), f"{folder}/deletes")
        _carry_over(results, options, store, sync_id, source_heads, source_acls)

    summary = sync_summary(
        plan, results, options, sync_id, start, _now(), deletes, journal.stop.raised(now=True))
    summary = _stored(summary, f"{folder}/summary")
    records.state_write(summary, store, sync_id)
    row = summary.first()
    journal.end(row["status"], **{name: row[name] for name in COUNTS})
    return summary


def _copy_in_batches(
    copies: DataFrame, tasks: int, options: SyncOptions, folder: str, source_root: str,
    target_root: str, progress: Callable[[dict], None] | None, journal: Journal,
    log: CheckpointLog, token: str,
) -> DataFrame:
    # A folder per attempt: a rerun under one id never counts the rows of an earlier one.
    path = f"{folder}/results/attempt={uuid.uuid4().hex}"
    last, total, largest = copies.agg(F.max("batch"), F.count("*"), F.max("size")).first()
    split = options.split_bytes
    split = split if split is not None and (largest or 0) > split else None
    so_far = dict.fromkeys(("processed", "uploaded", "skipped", "failed"), 0)
    for batch in range((last or 0) + 1):
        if batch and journal.stop.raised(now=True):
            break
        journal.record(RUNNING, total_objects=total, **{
            name: so_far[name] for name in ("uploaded", "skipped", "failed")})
        rows = copies.filter(F.col("batch") == batch).repartitionById(tasks, F.col("task"))
        counts = Observation(f"batch {batch}")
        moved = copy_objects(
            rows, source_root, target_root, options.part_bytes, split_bytes=split, token=token,
            log=log, stop=journal.stop)
        _stored(moved.observe(counts, *_batch_counts()), f"{path}/batch={batch}")
        for name, count in counts.get.items():
            so_far[name] += count or 0
        if progress:
            progress({**so_far, "total": total})
    return copies.sparkSession.read.schema(RESULT).option("basePath", path).parquet(path)


def _batch_counts() -> list[Column]:
    """Counters gathered while a batch is written, without a second pass."""
    ok, skipped = F.col("success"), F.col("skipped")
    return [
        F.count(F.lit(1)).alias("processed"), F.count_if(ok & ~skipped).alias("uploaded"),
        F.count_if(ok & skipped).alias("skipped"), F.count_if(~ok).alias("failed"),
    ]


def _carry_over(results, options, store, sync_id, source_heads, source_acls) -> None:
    """Metadata and lists of the copied objects, under their new keys."""
    copied = results.filter("success and not skipped").select("key", "target_key")

    def moved(table: DataFrame) -> DataFrame:
        return single(table, options.repeated_keys).join(copied, "key").withColumns({
            "key": F.col("target_key"), "bucket": F.lit(options.target_bucket)})

    if options.preserve_metadata and source_heads is not None:
        heads = moved(source_heads).withColumn(
            "storage_class", storage_class_pick("storage_class", options.storage_class))
        records.metadata_apply(heads, store, sync_id)
    if options.preserve_acl and source_acls is not None:
        records.acl_apply(moved(acl_copy(source_acls)), store, sync_id)


def cancel_sync(
    spark: SparkSession, options: SyncOptions, store: str, sync_id: str, start_time: str
) -> None:
    """State row of a run that was stopped; its checkpoint stays for a later resume."""
    end = instant(_now())
    start = instant(start_time)
    zero = F.lit(0).cast("long")
    row = spark.range(1).select(
        F.lit(sync_id).alias("sync_id"), F.lit(options.source_bucket).alias("source_bucket"),
        F.lit(options.target_bucket).alias("target_bucket"),
        F.lit(options.source_prefix).alias("source_prefix"),
        F.lit(options.target_prefix).alias("target_prefix"),
        F.lit(CANCELLED).alias("status"), F.lit(options.dry_run).alias("dry_run"),
        *[zero.alias(c) for c in ("total_objects", "uploaded", "deleted", "skipped", "failed")],
        start.alias("start_time"), end.alias("end_time"),
    )
    records.state_write(row, store, sync_id)


def composites_of(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame, options: ValidateOptions,
    source_root: str, target_root: str, folder: str,
) -> tuple[DataFrame, DataFrame]:
    """The pairs that a composite ETag leaves open, and for each whether the other body can have it.

    Only one body of a pair is read, in parts by separate tasks.
    """
    cases = _stored(
        composite_cases(source, source_heads, target_heads, options), f"{folder}/composites")
    found = [
        composite_digests(
            cases.filter("read_source" if side else "not read_source").select(
                F.col("key" if side else "target_key").alias("key"), "size", "parts"), root,
            options.etag_part_unit)
        for side, root in ((True, source_root), (False, target_root))]
    verdicts = composite_verdicts(cases, *found)
    return cases, _stored(verdicts, f"{folder}/composite_verdicts")


def run_validation(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame,
    options: ValidateOptions, store: str, source_root: str | None = None,
    target_root: str | None = None, source_acls: DataFrame | None = None,
    target_acls: DataFrame | None = None, validation_id: str | None = None,
    task_bytes: int = TASK_BYTES, progress: Callable[[dict], None] | None = None,
) -> DataFrame:
    """Checks the target against the source and returns the report row.

    Bodies are read only for objects that length and ETag leave undecided, once per side; where an
    ETag is composite, one side's body is first digested in such parts, which often settles it.
    ``progress`` is told the counts when the rows are written.
    """
    validation_id = validation_id or new_run_id("val")
    start = _now()
    folder = f"{store}/runs/{validation_id}"
    digests = {}
    if options.check_content and source_root and target_root:
        # Written first: the three steps below read one state of the stores, and what is live, or made
        # from bodies, is made once.
        source, source_heads, target_heads = (
            _stored(rows, f"{folder}/{name}") for name, rows in (
                ("source", source), ("source_heads", source_heads), ("target_heads", target_heads)))
        _, composites = composites_of(
            source, source_heads, target_heads, options, source_root, target_root, folder)
        open_cases = undecided_bodies(source, source_heads, target_heads, options, composites)
        to_read = _stored(dense_slices(open_cases, task_bytes)[0], f"{folder}/to_read")
        last = to_read.agg(F.max("task")).first()[0]
        spread = to_read.repartitionById((last or 0) + 1, F.col("task").cast("int"))
        digests = {
            "composites": composites,
            "source_digests": _stored(
                digest_objects(spread, source_root), f"{folder}/source_md5"),
            "target_digests": _stored(
                digest_objects(spread.select(F.col("target_key").alias("key")), target_root),
                f"{folder}/target_md5"),
        }
    checked = validate(
        source, source_heads, target_heads, options, source_acls, target_acls, **digests)
    counts = Observation("validation")
    rows = _stored(checked.observe(
        counts, F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("success")).alias("failed"),
    ), f"{folder}/validation")
    if progress:
        progress({**counts.get, "total": counts.get["processed"]})
    end = instant(_now())
    begin = instant(start)
    failures = failed_sample(rows, FAILED_ROWS).agg(
        F.array_sort(F.collect_list(F.struct("key", "errors")))).scalar()
    summary = validation_summary(rows, options)

    def text(at):
        return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")

    report = summary.select(
        F.lit(validation_id).alias("validation_id"), text(end).alias("timestamp"),
        F.lit("completed").alias("status"),
        F.lit(options.source_bucket).alias("source_bucket"),
        F.lit(options.target_bucket).alias("target_bucket"), F.lit(options.prefix).alias("prefix"),
        F.lit(options.check_content).alias("check_content"),
        F.lit(options.check_metadata).alias("check_metadata"),
        F.lit(options.check_acl).alias("check_acl"),
        F.struct(*summary.columns).alias("summary"),
        run_duration(begin, end).alias("duration_seconds"),
        text(begin).alias("start_time"), text(end).alias("end_time"),
        failures.alias("failed_objects"),
    )
    report = _stored(report, f"{folder}/report")
    records.report_write(report, store, validation_id)
    return report
