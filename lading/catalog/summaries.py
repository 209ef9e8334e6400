"""Aggregates, histories, previews and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.keys import instant
from ..functions.text import run_duration
from ..operators import limits, runs
from ..operators.joins import diff_join
from ..plans import reports, sync
from ..plans.options import SyncOptions
from ..session import stored
from ..sources.runs import report_scan
from .fixture_sql import using
from .planning import OPTIONS, PREFIXES, _sides, sample_plan
from .registry import query
from .scans import stored_reports


_ALL = SyncOptions(source_prefix=fx.SOURCE_PREFIX, target_prefix=fx.TARGET_PREFIX)


def _results(spark, sf):
    return fx.copy_results(sample_plan(spark, sf))


@query("sync_summary", using("results") + """
, p as (select cast(sum(size) as bigint) as total_bytes, cast(count_if(action = 'copy') as bigint) as total_objects,
               cast(count_if(action in ('skip_checkpoint', 'skip_since')) as bigint) as early from plan),
  r as (select count(*) as processed_objects,
               cast(coalesce(count_if(success and not skipped), 0) as bigint) as uploaded,
               cast(coalesce(count_if(skipped), 0) as bigint) as late,
               cast(coalesce(count_if(not success), 0) as bigint) as failed,
               cast(coalesce(sum(size) filter (success and not skipped), 0) as bigint)
                 as transferred_bytes,
               string_agg(key || '=' || error, ';' order by key)
                 filter (not success) as failures from results),
  o as (select count(*) as deleted from tgt where rel_key not in (select rel_key from src))
select 'sync-1' as sync_id,
       case when failed = 0 then 'completed' else 'completed_with_errors' end as status,
       'docs/' as source_prefix, 'mirror/' as target_prefix, total_objects, processed_objects,
       uploaded, deleted, early + late as skipped, failed, total_bytes, transferred_bytes,
       90.5 as duration_seconds, coalesce(failures, '') as failures
from p, r, o""".replace("90.5 as", "cast(90.5 as double) as"))
def sync_summary(spark, sf):
    # Written first, as a run does it: plan, results and deletes then come out of one evaluation.
    plan = stored(sync.mirror_plan(
        *_sides(spark, sf), OPTIONS, fx.checkpoint(spark, sf), all_rows=True), "plan")
    deleted = plan.filter("action = 'delete'").select("key", F.lit(True).alias("success"))
    return sync.sync_summary(
        plan, fx.copy_results(plan), OPTIONS, "sync-1", "2024-02-01 00:00:00",
        "2024-02-01 00:01:30.5", deleted,
    ).select(
        "sync_id", "status", "source_prefix", "target_prefix", "total_objects",
        "processed_objects", "uploaded", "deleted", "skipped", "failed", "total_bytes",
        "transferred_bytes", "duration_seconds",
        F.array_join(F.transform("failed_list", lambda f: F.concat(
            f["key"], F.lit("="), f["error"])), ";").alias("failures"),
    )


@query("preview_totals", using("diff") + """
select count(*) as objects, cast(coalesce(sum(size), 0) as bigint) as bytes
from diff where why is not null""")
def preview_totals(spark, sf):
    return limits.preview_totals(diff_join(*_sides(spark, sf), *PREFIXES))


@query("last_sync_watermark", using("states") + """
select source_bucket, target_bucket, max(last_sync_time) as watermark,
       coalesce(case when source_bucket = 'b1' then timestamp '2001-01-01 00:00:00' end,
                max(last_sync_time)) as since
from states group by source_bucket, target_bucket""")
def last_sync_watermark(spark, sf):
    marks = runs.last_sync_watermark(fx.run_state(spark, sf))
    explicit = F.when(F.col("source_bucket") == "b1", instant("2001-01-01 00:00:00"))
    return marks.withColumn("since", runs.effective_since(explicit, F.col("watermark")))


@query("last_sync_watermark_completed", using("states") + """
select source_bucket, target_bucket, source_prefix, target_prefix,
       max(last_sync_time) as watermark from states
where status = 'completed' and not dry_run group by all""")
def last_sync_watermark_completed(spark, sf):
    return runs.last_sync_watermark(fx.run_state(spark, sf), completed_only=True, by_prefix=True)


@query("progress_counts", using("results") + """
select key, count(*) over w as processed,
       cast(count_if(success and not skipped) over w as bigint) as uploaded_so_far,
       cast(count_if(skipped) over w as bigint) as skipped_so_far,
       cast(count_if(not success) over w as bigint) as failed_so_far,
       cast(sum(case when success and not skipped then size else 0 end) over w as bigint)
         as bytes_so_far
from results
window w as (order by completed_at, key rows between unbounded preceding and current row)""")
def progress_counts(spark, sf):
    return runs.progress_counts(_results(spark, sf)).select(
        "key", "processed", "uploaded_so_far", "skipped_so_far", "failed_so_far", "bytes_so_far")


@query("sync_history", using("states") + """
select sync_id, source_bucket, target_bucket, last_sync_time, status, uploaded, skipped, failed
from states order by last_sync_time desc, sync_id limit 10""")
def sync_history(spark, sf):
    return limits.sync_history(fx.run_state(spark, sf)).select(
        "sync_id", "source_bucket", "target_bucket", "last_sync_time", "status", "uploaded",
        "skipped", "failed")


@query("validation_history", using("states") + """
select 'val-' || o_orderkey as validation_id,
       strftime(start_time, '%Y-%m-%dT%H:%M:%S') as timestamp, status from states""")
def validation_history(spark, sf):
    stored = report_scan(spark, stored_reports(spark, sf), multi_line=False)
    return limits.validation_history(stored).select("validation_id", "timestamp", "status")


@query("failed_sample", using("results") + """
select key, error from results where not success order by key limit 100""")
def failed_sample(spark, sf):
    return limits.failed_sample(_results(spark, sf)).select("key", "error")


def _size_text(size: str) -> str:
    """All units, as sizes of any order of magnitude occur."""
    steps = ["B", "KB", "MB", "GB", "TB"]
    whens = " ".join(
        f"when {size} < {1024 ** (k + 1)} then printf('%.2f {unit}', ({size}) / {1024.0 ** k}::double)"
        for k, unit in enumerate(steps))
    return f"(case {whens} else printf('%.2f PB', ({size}) / {1024.0 ** 5}::double) end)"


_SIZE_TEXT = """case when size < 1024 then printf('%.2f B', cast(size as double))
  when size < 1048576 then printf('%.2f KB', size / 1024.0::double)
  else printf('%.2f MB', size / 1048576.0::double) end"""


@query("plan_preview", using("diff") + f"""
select substring(key, 1, 38) as shown_key, {_SIZE_TEXT} as shown_size,
       strftime(last_modified, '%Y-%m-%dT%H:%M:%S') as shown_time,
       greatest((select count(*) from diff where why is not null) - 50, 0) as more
from diff where why is not null order by key limit 50""")
def plan_preview(spark, sf):
    todo = sync.sync_plan(*_sides(spark, sf), _ALL).filter("action = 'copy'")
    return limits.plan_preview(todo)


_REPORT_STATES = using("states") + """
, s as (select *, date_diff('microsecond', start_time, end_time) / 1e6 as seconds from states)"""
_DURATION_TEXT = """case when coalesce(seconds, 0) < 60 then printf('%.1fs', coalesce(seconds, 0))
  when seconds < 3600 then printf('%.1fm', seconds / 60) else printf('%.1fh', seconds / 3600) end"""


def _line(label: str, value: str, width: int = 8) -> str:
    return f"'  {label:<{width}} ' || {value} || chr(10)"


def _rule() -> str:
    return "'" + "=" * 60 + "' || chr(10)"


def _blank(text: str = "") -> str:
    return f"'{text}' || chr(10)"


def _thousands(expr: str) -> str:
    return f"format('{{:,}}', coalesce({expr}, 0))"


_SYNC_TEXT = " || ".join([
    _rule(), _blank("SYNC REPORT"), _rule(), _blank(),
    _line("Sync ID:", "sync_id"), _line("Status:", "upper(status)"),
    _line("Start:", "strftime(start_time, '%Y-%m-%dT%H:%M:%S')"),
    _line("End:", "coalesce(strftime(end_time, '%Y-%m-%dT%H:%M:%S'), 'N/A')"),
    _line("Duration:", _DURATION_TEXT), _blank(),
    _blank("  Source:"), _line("  Bucket:", "source_bucket"),
    _line("  Prefix:", "source_prefix"), _blank(),
    _blank("  Target:"), _line("  Bucket:", "target_bucket"),
    _line("  Prefix:", "target_prefix"), _blank(),
    _blank("  Options:"), _line("  Preserve metadata:", "'yes'"), _line("  Preserve ACL:", "'no'"),
    "case when dry_run then " + _line("  Mode:", "'preview (dry-run)'") + " else '' end",
    _blank(), _blank("  Statistics:"),
    _line("  Objects:", _thousands("total_objects")), _line("  Uploaded:", _thousands("uploaded")),
    _line("  Deleted:", _thousands("deleted")), _line("  Skipped:", _thousands("skipped")),
    _line("  Failed:", _thousands("failed")), _blank(), "'" + "=" * 60 + "'",
])


def _summaries(spark, sf):
    return fx.run_state(spark, sf).withColumns({
        "duration_seconds": run_duration("start_time", "end_time"),
        "preserve_metadata": F.lit(True), "preserve_acl": F.lit(False),
    })


@query("report_text", _REPORT_STATES + f"select sync_id, {_SYNC_TEXT} as report from s")
def report_text(spark, sf):
    return reports.sync_report_text(_summaries(spark, sf))


_MIGRATION_TEXT = " || ".join([
    _rule(), _blank("MIGRATION REPORT"), _rule(), _blank(),
    _line("Sync ID:", "sync_id"), _line("Status:", "upper(status)"),
    _line("Start:", "strftime(start_time, '%Y-%m-%dT%H:%M:%S')"),
    _line("End:", "coalesce(strftime(end_time, '%Y-%m-%dT%H:%M:%S'), 'N/A')"),
    _line("Duration:", _DURATION_TEXT), _blank(),
    _blank("  Source:"), _line("  Bucket:", "source_bucket"),
    _line("  Prefix:", "source_prefix"), _blank(),
    _blank("  Target:"), _line("  Bucket:", "target_bucket"),
    _line("  Prefix:", "target_prefix"), _blank(),
    _blank("  Options:"), _line("  Preserve metadata:", "'yes'"), _line("  Preserve ACL:", "'no'"),
    _blank(), _blank("  Statistics:"),
    _line("  Objects:", _thousands("total_objects")),
    _line("  Processed:", _thousands("coalesce(uploaded, 0) + failed")),
    _line("  Failed:", _thousands("failed")),
    _line("  Total size:", _size_text("total_objects * 3000")),
    _line("  Transferred:", "printf('%.2f B', cast(total_objects as double) % 1000)"),
    "case when failed > 0 then " + _blank() + " || " + _blank("  Failed objects (first 10):")
    + " || '    - ' || sync_id || '/x: broken' || chr(10) || '    - N/A: unknown error' || chr(10)"
    + " else '' end",
    _blank(), "'" + "=" * 60 + "'",
])


@query("report_text_migration", _REPORT_STATES + f"""
select sync_id, {_MIGRATION_TEXT} as report from s""")
def report_text_migration(spark, sf):
    entry = "struct(concat(sync_id, '/x') as key, 'broken' as error)"
    nothing = "struct(cast(null as string) as key, cast(null as string) as error)"
    rows = _summaries(spark, sf).withColumns({
        "processed_objects": F.expr("coalesce(uploaded, 0) + failed"),
        "total_bytes": F.col("total_objects") * 3000,
        "transferred_bytes": F.col("total_objects") % 1000,
        "failed_list": F.expr(f"case when failed > 0 then array({entry}, {nothing}) end"),
    })
    return reports.migration_report_text(rows)


_VALIDATION_TEXT = " || ".join([
    _rule(), _blank("VALIDATION REPORT"), _rule(), _blank(),
    _line("Validation ID:", "'val-' || o_orderkey", 10),
    _line("Timestamp:", "strftime(start_time, '%Y-%m-%dT%H:%M:%S')", 10),
    _line("Status:", "upper(status)", 10), _line("Duration:", _DURATION_TEXT, 10), _blank(),
    _blank("  Source:"), _line("  Bucket:", "source_bucket", 10),
    _line("  Prefix:", "source_prefix", 10), _blank(),
    _blank("  Target:"), _line("  Bucket:", "target_bucket", 10), _blank(),
    _blank("  Summary:"), _line("  Objects:", _thousands("total_objects"), 10), _blank(),
    _line("  Content check:", "''", 10),
    _line("  Passed:", _thousands("total_objects - failed"), 10),
    _line("  Failed:", _thousands("failed"), 10), _blank(),
    _line("  Metadata check:", "''", 10),
    "case when o_orderkey % 2 = 0 then " + _line("  Passed:", "'0'", 10) + " || "
    + _line("  Failed:", "'0'", 10) + " else " + _line("  Skipped:", "'0'", 10) + " end",
    _blank(), _line("  ACL check:", "''", 10),
    _line("  Skipped:", _thousands("total_objects"), 10), _blank(), "'" + "=" * 60 + "'",
])


@query("report_text_validation", _REPORT_STATES
       + f"select 'val-' || o_orderkey as validation_id, {_VALIDATION_TEXT} as report from s")
def report_text_validation(spark, sf):
    stored = report_scan(spark, stored_reports(spark, sf), multi_line=False)
    return reports.validation_report_text(stored)


@query("report_json", using("states") + """
select '{"sync_id":"' || sync_id || '","status":"' || status || '","uploaded":'
  || coalesce(cast(uploaded as varchar), 'null') || ',"skipped":'
  || coalesce(cast(skipped as varchar), 'null') || ',"failed":' || failed
  || ',"dry_run":' || cast(dry_run as varchar) || '}' as json
from states""")
def report_json(spark, sf):
    return reports.report_json(fx.run_state(spark, sf).select(
        "sync_id", "status", "uploaded", "skipped", "failed", "dry_run"))


_TOTAL_TEXT = """case when sum(size) < 1048576 then printf('%.2f KB', sum(size) / 1024.0::double)
  when sum(size) < 1073741824 then printf('%.2f MB', sum(size) / 1048576.0::double)
  else printf('%.2f GB', sum(size) / 1073741824.0::double) end"""

_PREVIEW_TEXT = " || ".join([
    _rule(), _blank("MIGRATION PREVIEW"), _rule(), _blank(),
    _line("Source:", "'src-bucket'"), _line("Prefix:", "'docs/'"), _line("Target:", "'tgt-bucket'"),
    _blank(), _blank("  Statistics:"), _line("  Objects:", "format('{:,}', count(*))"),
    _line("  Total size:", _TOTAL_TEXT), _blank(), _blank("  Objects to migrate:"),
    f"'  {'Key':<38} {'Size':>12} {'Last modified':<20}' || chr(10)",
    "'  " + "-" * 56 + "' || chr(10)", "(select lines from shown) || chr(10)",
    "case when count(*) > 50 then '  ... ' || (count(*) - 50) || ' more objects' || chr(10)"
    " else '' end", _blank(), "'" + "=" * 60 + "'",
])


@query("report_preview_migration", using("diff") + f"""
, first as (select key, {_SIZE_TEXT} as size_text, last_modified from diff where why is not null
            order by key limit 50),
  shown as (select string_agg('  ' || rpad(key, 38, ' ') || ' ' || lpad(size_text, 12, ' ') || ' '
              || rpad(strftime(last_modified, '%Y-%m-%dT%H:%M:%S'), 20, ' '), chr(10)
              order by key) as lines from first)
select {_PREVIEW_TEXT} as preview from diff where why is not null""")
def report_preview_migration(spark, sf):
    todo = sync.sync_plan(*_sides(spark, sf), _ALL).filter("action = 'copy'")
    return reports.migration_preview_text(todo, fx.SOURCE_BUCKET, fx.TARGET_BUCKET, "docs/")


@query("report_preview_sync", using("diff") + """
select '%s' || chr(10) || 'SYNC PREVIEW' || chr(10) || '%s' || chr(10) || chr(10)
  || '  Source:  src-bucket' || chr(10) || '  Target:  tgt-bucket' || chr(10)
  || '  Since:   2024-01-01T04:00:00' || chr(10) || chr(10) || '  Statistics:' || chr(10)
  || '    Objects: ' || format('{:,}', count(*)) || chr(10) || '    Total size: '
  || %s || chr(10) || chr(10) || '%s' as preview
from diff where why is not null""" % ("=" * 60, "=" * 60, _TOTAL_TEXT, "=" * 60))
def report_preview_sync(spark, sf):
    todo = sync.sync_plan(*_sides(spark, sf), _ALL).filter("action = 'copy'")
    return reports.sync_preview_text(
        todo, fx.SOURCE_BUCKET, fx.TARGET_BUCKET, "2024-01-01T04:00:00")
