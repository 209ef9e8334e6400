"""Jobs with side effects, their records, and the stream.

Each works in a fresh folder below the session's shared folder.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..jobs import journal, objects, parts, records, runs as job_runs
from ..jobs.heads import inventory_of, live_heads
from ..jobs.tasks import default_tasks
from ..operators.acl import acl_copy
from ..operators.metadata import metadata_batch_update
from ..plans import sync, validate as validation
from ..plans.options import SyncOptions
from ..session import new_run_dir
from ..sources.heads import head_scan, prefix_metadata
from ..sources.runs import report_scan
from ..streaming.incremental import incremental_sync_stream
from .fixture_sql import using
from .nested import FORMS, OPTIONS as VALIDATE_OPTIONS, checked
from .planning import OPTIONS, _sides, sample_plan
from .registry import query
from .summaries import _results

_TASK_BYTES = 64 * 1024 * 1024


def _kept(frame, folder, name):
    """A table with side effects behind it is computed once, into a folder."""
    path = f"{folder}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _spread(keys, key="key"):
    """Keys over all tasks: what they stand for is work, however few files they lie in."""
    return keys.repartition(default_tasks(keys.sparkSession), key)


def _source_tree(spark, sf, folder):
    """The bodies of the documents as objects; two of a hundred are left out."""
    rows = fx.bodies(spark, sf).filter("doc_id % 50 <> 1")
    _kept(objects.write_objects(rows, f"{folder}/source"), folder, "written")
    return f"{folder}/source"


@query("copy_objects", using("plan") + """
select key, case when doc_id % 50 <> 1 and rel_key not like 'src1/%' then 'mirror/' || rel_key end
         as target_key,
       rel_key like 'src1/%' or doc_id % 50 <> 1 as success, rel_key like 'src1/%' as skipped,
       rel_key not like 'src1/%' and doc_id % 50 = 1 as has_error,
       case when rel_key like 'src1/%' then 'filtered' end as reason, size
from plan where action = 'copy'""")
def copy_objects(spark, sf):
    """Objects without a body fail, those with an excluded target are skipped."""
    folder = new_run_dir(spark, "copy")
    source = _source_tree(spark, sf, folder)
    options = replace(OPTIONS, exclude_patterns=("*.tmp", "mirror/src1/*"))
    plan = sample_plan(spark, sf, options).filter("action = 'copy'")
    moved = objects.copy_objects(plan, source, f"{folder}/target", task_bytes=_TASK_BYTES)
    return _kept(moved, folder, "results").select(
        "key", "target_key", "success", "skipped", F.col("error").isNotNull().alias("has_error"),
        "reason", "size")


@query("inventory_scan_store", using("docs") + """
select key, size from docs where doc_id % 50 <> 1 and key like 'docs/src1%'""")
def inventory_scan_store(spark, sf):
    """Live listing of a store that holds the documents."""
    folder = new_run_dir(spark, "list")
    source = _source_tree(spark, sf, folder)
    return objects.list_objects(spark, source, "docs/src1").select("key", "size")


@query("inventory_scan_flat", using("docs") + """
select md5(key) as key, size from docs""")
def inventory_scan_flat(spark, sf):
    """Live listing of one folder that holds every document, dealt to tasks by names."""
    folder = new_run_dir(spark, "flat")
    rows = fx.bodies(spark, sf).select(F.md5("key").alias("key"), "content")
    _kept(objects.write_objects(rows, f"{folder}/flat"), folder, "written")
    return objects.list_objects(spark, f"{folder}/flat", names_at_once=100).select("key", "size")


_LIVE_SQL = using("docs") + """
select 'b' as bucket, key, size as content_length, md5(text) as etag, 'STANDARD' as storage_class
from docs where doc_id % 50 <> 1"""


@query("head_scan_live", _LIVE_SQL)
def head_scan_live(spark, sf):
    """Heads read from a store that holds the documents."""
    source = _source_tree(spark, sf, new_run_dir(spark, "heads"))
    return head_scan(live_heads(spark, source, bucket="b", etags="md5")).select(
        "bucket", "key", "content_length", "etag", "storage_class")


@query("prefix_metadata_live", _LIVE_SQL + " and key like 'docs/src3/%'")
def prefix_metadata_live(spark, sf):
    """Heads below a prefix: folders outside it are not listed."""
    source = _source_tree(spark, sf, new_run_dir(spark, "heads"))
    heads = live_heads(spark, source, "docs/src3/", "b", "md5")
    return prefix_metadata(inventory_of(heads), heads, "docs/src3/").select(
        "bucket", "key", "content_length", "etag", "storage_class")


@query("run_validation_live", using("docs") + """
select count(*) as total_objects,
       cast(count_if(doc_id % 10 <> 3 and doc_id % 7 <> 0) as bigint) as content_passed,
       cast(count_if(doc_id % 10 <> 3 and doc_id % 7 <> 0) as bigint) as metadata_passed
from docs where doc_id % 50 <> 1""")
def run_validation_live(spark, sf):
    """Source against target from what the two stores say now, without any table of heads."""
    folder = new_run_dir(spark, "live")
    source, target = _source_tree(spark, sf, folder), f"{folder}/target"
    _kept(objects.write_objects(fx.bodies(spark, sf, target=True), target), folder, "put")
    heads = _kept(live_heads(spark, source), folder, "listed")
    report = job_runs.run_validation(
        inventory_of(heads), heads, live_heads(spark, target),
        replace(VALIDATE_OPTIONS, metadata_fields=("ContentLength",)), f"{folder}/store", source, target,
        task_bytes=_TASK_BYTES)
    return report.select(
        "summary.total_objects", "summary.content_passed", "summary.metadata_passed")


@query("copy_object", using("docs") + """
select key, 'copy/' || key as target_key, md5(text) as md5 from docs
where doc_id % 50 <> 1""")
def copy_object(spark, sf):
    """Copies along a mapping, then reads the copies back for their digests."""
    folder = new_run_dir(spark, "cp")
    source = _source_tree(spark, sf, folder)
    mapping = fx.src_inventory(spark, sf).filter("doc_id % 50 <> 1").select(
        F.col("key").alias("source_key"), F.concat(F.lit("copy/"), "key").alias("target_key"),
        "size")
    moved = _kept(objects.copy_object(_spread(mapping, "source_key"), source, f"{folder}/target"), folder, "results")
    digests = objects.digest_objects(
        _spread(moved.select(F.col("target_key").alias("key"))), f"{folder}/target")
    return digests.select(
        F.substring("key", 6, 2147483647).alias("key"), F.col("key").alias("target_key"), "md5")


@query("delete_objects", using("src", "tgt") + """
select key, true as success, size from tgt where rel_key not in (select rel_key from src)""")
def delete_objects(spark, sf):
    folder = new_run_dir(spark, "delete")
    orphans = sync.mirror_plan(*_sides(spark, sf), OPTIONS).filter("action = 'delete'")
    html = fx.table(spark, sf, "pages").selectExpr(
        "'mirror/orphan/' || cast(page_id as string) as key", "cast(html as binary) as content")
    _kept(objects.write_objects(html, f"{folder}/target"), folder, "written")
    gone = _kept(objects.delete_objects(orphans, f"{folder}/target"), folder, "deleted")
    return gone.select("key", "success", "size")


@query("run_sync", using("diff") + """
, a as (select *, case when last_modified < timestamp '2024-01-01 04:00:00' then 'since'
                       when why is null then 'same' when key like '%.tmp' then 'filtered'
                       else 'copy' end as action, doc_id % 50 <> 1 as readable from diff),
  o as (select count(*) as n from tgt where rel_key not in (select rel_key from src))
select case when count_if(action = 'copy' and not readable) = 0 then 'completed'
            else 'completed_with_errors' end as status,
       cast(count_if(action = 'copy') as bigint) as total_objects,
       cast(count_if(action = 'copy') as bigint) as processed_objects,
       cast(count_if(action = 'copy' and readable) as bigint) as uploaded,
       max(o.n) as deleted, cast(count_if(action = 'since') as bigint) as skipped,
       cast(count_if(action = 'copy' and not readable) as bigint) as failed,
       cast(sum(size) as bigint) as total_bytes,
       cast(sum(case when action = 'copy' and readable then size else 0 end) as bigint)
         as transferred_bytes
from a, o""")
def run_sync(spark, sf):
    folder = new_run_dir(spark, "sync")
    source = _source_tree(spark, sf, folder)
    summary = job_runs.run_sync(
        *_sides(spark, sf), OPTIONS, f"{folder}/store", source, f"{folder}/target", batches=2)
    return summary.select("status", *sync.COUNTERS)


@query("state_write", using("states") + """
select sync_id, source_bucket, target_bucket, start_time as last_sync_time, status, uploaded
from states""")
def state_write(spark, sf):
    store = new_run_dir(spark, "state")
    records.state_write(fx.run_state(spark, sf), store, "all")
    return records.read_states(spark, store).select(
        "sync_id", "source_bucket", "target_bucket", "last_sync_time", "status", "uploaded")


@query("checkpoint_write", using("results") + """
select 'src-bucket' as source_bucket, 'tgt-bucket' as target_bucket, key from results
where success""")
def checkpoint_write(spark, sf):
    store = new_run_dir(spark, "checkpoint")
    results = _kept(_results(spark, sf), store, "results")
    for batch in range(2):
        records.checkpoint_write(
            results.filter(F.pmod(F.xxhash64("key"), F.lit(2)) == batch), store, "one",
            fx.SOURCE_BUCKET, fx.TARGET_BUCKET, batch)
    return records.read_checkpoints(spark, store)


@query("checkpoint_log", using("docs") + """
select 'src-bucket' as source_bucket, 'tgt-bucket' as target_bucket, key from docs
where doc_id % 50 <> 1""")
def checkpoint_log(spark, sf):
    """Keys that copying tasks logged themselves; objects without a body failed and are not there."""
    folder = new_run_dir(spark, "log")
    source = _source_tree(spark, sf, folder)
    log = records.checkpoint_log(
        f"{folder}/store", "one", fx.SOURCE_BUCKET, fx.TARGET_BUCKET, 20)
    listed = fx.src_inventory(spark, sf).select("key", F.col("key").alias("target_key"), "size")
    _kept(objects.copy_objects(_spread(listed), source, f"{folder}/target", log=log), folder, "results")
    records.checkpoint_compact(spark, f"{folder}/store", "one")
    return records.read_checkpoints(spark, f"{folder}/store", "one")


@query("run_lookup_journal", using("diff") + """
, c as (select count(*) as total, coalesce(count_if(doc_id % 50 <> 1), 0) as uploaded from diff
        where why is not null and last_modified >= timestamp '2024-01-01 04:00:00'
          and key not like '%.tmp')
select 'ended' as sync_id, 'state' as origin,
       case when total = uploaded then 'completed' else 'completed_with_errors' end as status,
       cast(uploaded as bigint) as uploaded, cast(total - uploaded as bigint) as failed from c
union all select 'going on', 'checkpoint', 'running', cast(uploaded as bigint), 0 from c""")
def run_lookup_journal(spark, sf):
    """Two runs as they stand: one that ended, and one whose last record says that it goes on."""
    folder = new_run_dir(spark, "journal")
    source, store = _source_tree(spark, sf, folder), f"{folder}/store"
    row = job_runs.run_sync(
        *_sides(spark, sf), replace(OPTIONS, delete=False), store, source, f"{folder}/target",
        sync_id="ended", batches=2).first()
    journal.Journal(spark, store, "going on", {}, "ended").record("running", uploaded=row["uploaded"])
    return journal.run_records(spark, store).select(
        "sync_id", "origin", "status", "uploaded", "failed")


_PASSED = """doc_id % 10 <> 3 and doc_id % 11 <> 0
    and (doc_id % 7 <> 0 or doc_id % 14 = 0)"""


@query("report_write", using("docs") + f"""
select count(*) as total_objects, cast(count_if({_PASSED}) as bigint) as content_passed,
       cast(least(count_if(not ({_PASSED})), 100) as bigint) as failures_listed from docs""")
def report_write(spark, sf):
    """A validation run by heads alone; its report is written as JSON and read back."""
    store = new_run_dir(spark, "report")
    job_runs.run_validation(
        fx.src_inventory(spark, sf), fx.src_heads(spark, sf), fx.tgt_heads(spark, sf),
        replace(VALIDATE_OPTIONS, check_metadata=False), store, validation_id="val-1")
    stored = report_scan(
        spark, f"{store}/{records.REPORTS}", "val-1", multi_line=False)
    return stored.select(
        "summary.total_objects", "summary.content_passed",
        F.size("failed_objects").cast("long").alias("failures_listed"))


def _register_validation(suffix, options):
    read = f"s_len <= {options.digest_limit}" if options.digest_limit else "true"

    @query(f"run_validation{suffix}", using("heads") + checked(options.digest_limit) + f"""
, body as (select *, case when {read} then doc_id % 50 <> 1 and s_md5 = t_md5 else true end
             as body_ok from checked)
select count(*) as total_objects,
       cast(count_if(present and s_len = t_len and (t_tag = '' or t_tag = s_tag) and body_ok)
         as bigint) as content_passed,
       cast(count_if(meta_ok) as bigint) as metadata_passed, count(*) as acl_skipped
from body""")
    def run_validation(spark, sf):
        """A whole validation run over stored bodies; only undecided ones are read."""
        folder = new_run_dir(spark, "validation")
        source = _source_tree(spark, sf, folder)
        target = f"{folder}/target"
        _kept(objects.write_objects(fx.bodies(spark, sf, target=True), target), folder, "put")
        report = job_runs.run_validation(
            fx.src_inventory(spark, sf), fx.src_heads(spark, sf), fx.tgt_heads(spark, sf),
            options, f"{folder}/store", source, target, task_bytes=_TASK_BYTES)
        return report.select(
            "summary.total_objects", "summary.content_passed", "summary.metadata_passed",
            "summary.acl_skipped")


for _suffix, _options in FORMS:
    _register_validation(_suffix, _options)


_PART = 1024


def _parts_sql(text):
    """Digests of the parts of a text, and the ETag an upload of them has."""
    return f"""
  select key, count(*) as n_parts, md5(any_value({text})) as md5,
         case when count(*) = 1 then min(h) else md5(unhex(string_agg(h, '' order by n))) || '-' || count(*)
         end as etag
  from (select *, md5(encode({text})[(n - 1) * {_PART} + 1:n * {_PART}]) as h
        from (select *, unnest(range(1, greatest(1, (strlen({text}) + {_PART - 1}) // {_PART}) + 1)) as n
              from docs))
  group by key"""


@query("copy_objects_in_parts", using("docs") + ", p as (" + _parts_sql("text") + """)
select key, 'copy/' || key as target_key, md5, etag, n_parts from p""")
def copy_objects_in_parts(spark, sf):
    """Every document copied by its parts, of 1 KiB here; the copies are read back whole."""
    folder = new_run_dir(spark, "parts")
    source, target = f"{folder}/source", f"{folder}/target"
    _kept(objects.write_objects(fx.bodies(spark, sf), source), folder, "written")
    listed = fx.src_inventory(spark, sf).select(
        "key", F.concat(F.lit("copy/"), "key").alias("target_key"), "size")
    moved, manifest = parts.copy_in_parts(listed, source, target, "run", _PART, _TASK_BYTES)
    moved = _kept(moved, folder, "results")
    digests = objects.digest_objects(
        _spread(moved.filter("success").select(F.col("target_key").alias("key"))), target)
    return digests.withColumnRenamed("key", "target_key").join(
        parts.manifest_etags(manifest), "target_key").select("key", "target_key", "md5", "etag", "n_parts")


@query("content_check_composite", using("docs") + ", p as (" + _parts_sql("text") + """),
q as (""" + _parts_sql("case when doc_id % 7 = 0 then '#' || substring(text, 2) else text end") + """)
select key, strlen(text) = strlen(case when doc_id % 7 = 0 then '#' || substring(text, 2) else text end)
            and p.md5 = q.md5 as match,
       strlen(text) = strlen(case when doc_id % 7 = 0 then '#' || substring(text, 2) else text end)
            and (doc_id % 3 = 0 and p.n_parts > 1 or doc_id % 3 = 1 and q.n_parts > 1) as by_composite
from docs join p using (key) join q using (key)""")
def content_check_composite(spark, sf):
    """One side's ETags are made from parts; the other side's bodies are digested in such parts."""
    folder = new_run_dir(spark, "composite")
    changed = "case when doc_id % 7 = 0 then '#' || substring(text, 2) else text end"
    heads = {}
    for side, text, composite in (("source", "text", 0), ("target", changed, 1)):
        rows = fx.table(spark, sf, "documents").selectExpr(
            fx._KEY.format(prefix=fx.SOURCE_PREFIX) + " as key", f"cast({text} as binary) as content",
            "doc_id")
        _kept(objects.write_objects(rows.select("key", "content"), f"{folder}/{side}"), folder, f"put_{side}")
        heads[side] = _kept(rows.selectExpr(
            "key", "doc_id", "cast(octet_length(content) as bigint) as content_length",
            f"case when doc_id % 3 = {composite} then {fx.parts_etag('content', _PART)}"
            " else md5(content) end as etag",
            "timestamp_ntz'2024-01-01 00:00:00' as last_modified"), folder, f"heads_{side}")
    listing = _kept(fx.src_inventory(spark, sf), folder, "listing")
    options = replace(VALIDATE_OPTIONS, etag_part_unit=_PART // 8)
    given = listing, heads["source"], heads["target"], options
    cases, verdicts = job_runs.composites_of(
        *given, f"{folder}/source", f"{folder}/target", folder)
    open_cases = _kept(validation.undecided_bodies(*given, verdicts), folder, "open")
    source_md5, target_md5 = (
        objects.digest_objects(_spread(open_cases.select(F.col(c).alias("key"))), f"{folder}/{side}")
        for c, side in (("key", "source"), ("target_key", "target")))
    checks = validation.content_check(*given, source_md5, target_md5, verdicts)
    return checks.join(cases.select("key", F.lit(True).alias("tried")), "key", "left").select(
        "key", "match", F.coalesce("tried", F.lit(False)).alias("by_composite"))


@query("metadata_apply", using("heads") + """
select key, 'xx' as lang, meta_source as source from s_heads where doc_id % 4 = 0""")
def metadata_apply(spark, sf):
    store = new_run_dir(spark, "heads")
    heads = fx.src_heads(spark, sf)
    updated = metadata_batch_update(
        heads, heads.filter("doc_id % 4 = 0").select("key"), {"lang": "xx"}, "COPY")
    records.metadata_apply(updated.filter("success"), store, "one")
    return records.read_heads(spark, store).select(
        "key", F.try_element_at("metadata", F.lit("lang")).alias("lang"),
        F.try_element_at("metadata", F.lit("source")).alias("source"))


@query("acl_apply", using("acls") + """
select key, 'u' || c_nationkey as owner_id,
       cast(case when c_custkey % 4 = 1 then 3 else 2 end as integer) as n_grants from acls""")
def acl_apply(spark, sf):
    store = new_run_dir(spark, "acls")
    records.acl_apply(acl_copy(fx.mixed_acls(spark, sf)), store, "one")
    return records.read_acls(spark, store).select(
        "key", F.col("owner.id").alias("owner_id"), F.size("grants").alias("n_grants"))


_STREAM_HALF = "timestamp '2024-01-16 00:00:00'"


@query("incremental_sync_stream", using("feed") + f"""
, firsts as (select * from feed qualify row_number() over (partition by key
               order by last_modified, size, etag) = 1),
  newest as (
    select *, last_modified >= {_STREAM_HALF} as second_half from feed
    qualify row_number() over (partition by key, last_modified >= {_STREAM_HALF}
      order by last_modified desc, size desc, etag desc) = 1)
select cast(second_half as integer) as batch, n.key, n.size,
       case when n.etag = f.etag and n.size = f.size then 'unchanged' else 'copy' end as action,
       case when n.etag <> f.etag then 'etag' when n.size <> f.size then 'size' end as reason
from newest n join firsts f on n.key = f.key""")
def incremental_sync_stream_query(spark, sf):
    """Two runs over a growing feed: the second one sees only what is new."""
    folder = new_run_dir(spark, "stream")
    feed = fx.inventory_feed(spark, sf)
    later = F.col("last_modified") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    options = SyncOptions()
    target = _kept(fx.feed_target(spark, sf), folder, "target")
    for part in (feed.filter(~later), feed.filter(later)):
        part.write.mode("append").parquet(f"{folder}/feed")
        incremental_sync_stream(
            spark, f"{folder}/feed", lambda: target, options, f"{folder}/plans",
            f"{folder}/offsets").awaitTermination()
    return spark.read.parquet(f"{folder}/plans").select(
        "batch", "key", "size", "action", "reason")


@query("incremental_sync_stream_versions", using("feed") + f"""
, firsts as (select * from feed qualify row_number() over (partition by key
               order by last_modified, size, etag) = 1),
  newest as (select * from feed qualify row_number() over (partition by key
               order by last_modified desc, size desc, etag desc) = 1)
select case when n.last_modified >= {_STREAM_HALF} then 0 else 1 end as batch, n.key, n.size,
       case when n.etag = f.etag and n.size = f.size then 'unchanged' else 'copy' end as action
from newest n join firsts f on n.key = f.key""")
def incremental_sync_stream_versions(spark, sf):
    """The later half of the feed comes first: of the earlier half only keys without a newer row are
    planned, though every row of it is new to the stream."""
    folder = new_run_dir(spark, "versions")
    feed = fx.inventory_feed(spark, sf)
    later = F.col("last_modified") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    target = _kept(fx.feed_target(spark, sf), folder, "target")
    for part in (feed.filter(later), feed.filter(~later)):
        part.write.mode("append").parquet(f"{folder}/feed")
        incremental_sync_stream(
            spark, f"{folder}/feed", lambda: target, SyncOptions(), f"{folder}/plans",
            f"{folder}/offsets").awaitTermination()
    return spark.read.parquet(f"{folder}/plans").select("batch", "key", "size", "action")
