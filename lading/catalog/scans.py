"""Scans, sources and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.keys import size_class, task_share
from ..functions.text import run_duration
from ..jobs.objects import body_digests, write_objects
from ..operators import filters
from ..plans.reports import report_json
from ..session import new_run_dir
from ..sources import acls, bodies, heads, inventory, pages, runs
from .fixture_sql import using
from .registry import ORACLES, query

_LISTING = "bucket, key, last_modified, size, storage_class, etag, version_id"


def _stored(spark, frame, label, fmt, **options):
    """A listing as a table in the session's shared folder, the usual form of the input."""
    path = new_run_dir(spark, label)
    frame.write.format(fmt).options(**options).save(path)
    return path


_SCAN_SQL = using("src") + f"select {_LISTING} from src where key like 'docs/src1%'"


def _scan(fmt):
    def run(spark, sf):
        listing = fx.src_inventory(spark, sf).drop("doc_id")
        path = _stored(spark, listing, "inventory", fmt)
        return inventory.inventory_scan(spark, path, "docs/src1", fmt)

    return run


for _fmt in ("parquet", "orc", "json", "csv"):
    query("inventory_scan" if _fmt == "parquet" else f"inventory_scan_{_fmt}", _SCAN_SQL)(
        _scan(_fmt)
    )

_NORMALIZE_SQL = using("docs") + """
select 'src-bucket' as bucket, key,
       case when doc_id % 13 = 0 then null else last_modified end as last_modified,
       case when doc_id % 6 = 0 then 0 else size end as size,
       case when doc_id % 4 = 1 then 'STANDARD' else storage_class end as storage_class,
       case when doc_id % 15 = 0 then '' else etag end as etag,
       cast(null as varchar) as version_id
from docs"""


@query("inventory_normalize", _NORMALIZE_SQL)
def inventory_normalize(spark, sf):
    return inventory.inventory_normalize(fx.raw_listing(spark, sf))


@query("listing_scan_json", _NORMALIZE_SQL)
def listing_scan_json(spark, sf):
    path = _stored(spark, fx.raw_listing(spark, sf), "listing", "json")
    return inventory.listing_scan(spark, path)


@query("list_page", using("src") + f"""
select {_LISTING} from src where key > 'docs/src1/en/3' and key like 'docs/src1%'
order by key limit 40""")
def list_page(spark, sf):
    return inventory.list_page(
        fx.src_inventory(spark, sf).drop("doc_id"), prefix="docs/src1", max_keys=40,
        continuation_token="docs/src1/en/3",
    )


@query("list_page_indexed", using("src") + f"""
select {_LISTING} from src where key > 'docs/src1/en/3' and key like 'docs/src1%'
order by key limit 40""")
def list_page_indexed(spark, sf):
    """The same page of a listing stored in key order, from the files that hold it."""
    path = new_run_dir(spark, "pages")
    pages.write_page_index(fx.src_inventory(spark, sf).drop("doc_id"), path, 16)
    return pages.indexed_page(spark, path, "docs/src1", None, 40, "docs/src1/en/3")


@query("list_page_delimiter", using("tgt") + """
select key, size from tgt
where key like 'mirror/orphan/%' and instr(substring(key, 15), '/') = 0
order by key limit 1000""")
def list_page_delimiter(spark, sf):
    return inventory.list_page(
        fx.tgt_inventory(spark, sf), prefix="mirror/orphan/", delimiter="/"
    ).select("key", "size")


@query("list_page_summary", using("src") + """
, ranked as (select key, row_number() over (order by key) as n from src
             where key like 'docs/src1%' and key > 'docs/src1/en/3')
select 'docs/src1' as prefix, count(*) > 40 as is_truncated,
       case when count(*) > 40 then max(case when n = 40 then key end) end
         as next_continuation_token,
       least(count(*), 40) as key_count
from ranked""")
def list_page_summary(spark, sf):
    return inventory.page_summary(
        fx.src_inventory(spark, sf), prefix="docs/src1", max_keys=40,
        continuation_token="docs/src1/en/3",
    )


_HEAD_SQL = """select key, content_length, content_type, content_md5, last_modified, etag,
    storage_class, cache_control, expires, meta_lang, meta_source,
    cast(case when meta_lang is null then 0 else 2 end as integer) as meta_entries from s_heads """


def _flat_head(frame):
    return frame.select(
        "key", "content_length", "content_type", "content_md5", "last_modified", "etag",
        "storage_class", "cache_control", "expires",
        F.try_element_at("metadata", F.lit("lang")).alias("meta_lang"),
        F.try_element_at("metadata", F.lit("source")).alias("meta_source"),
        F.size("metadata").alias("meta_entries"),
    )


@query("head_scan", using("heads") + _HEAD_SQL)
def head_scan(spark, sf):
    return _flat_head(heads.head_scan(fx.src_heads(spark, sf)))


@query("object_info", using("heads") + _HEAD_SQL
       + "where key = (select max(key) from docs where doc_id = 8) and version_id = 'v8'")
def object_info(spark, sf):
    src = fx.src_heads(spark, sf)
    key = src.filter("doc_id = 8").select("key").scalar()
    return _flat_head(heads.object_info(src, key, "v8"))


@query("prefix_metadata", using("heads") + _HEAD_SQL + "where key like 'docs/src3/%'")
def prefix_metadata(spark, sf):
    return _flat_head(heads.prefix_metadata(
        fx.src_inventory(spark, sf), fx.src_heads(spark, sf), "docs/src3/"))


_BODIES_SQL = using("docs") + """
select key, strlen(text) as length, md5(text) as md5 from docs"""


@query("content_scan", _BODIES_SQL)
def content_scan(spark, sf):
    """Bodies of any length, stored as objects: those of up to 20,000 bytes as a column, longer ones
    digested where they are read."""
    folder = new_run_dir(spark, "bodies")
    write_objects(fx.bodies(spark, sf), f"{folder}/root").write.parquet(f"{folder}/written")
    return body_digests(spark, f"{folder}/root", 20000)


@query("content_scan_whole", _BODIES_SQL)
def content_scan_whole(spark, sf):
    return bodies.content_digest(fx.bodies(spark, sf))


@query("content_scan_limited", _BODIES_SQL + " where strlen(text) <= 20000")
def content_scan_limited(spark, sf):
    return bodies.content_digest(fx.bodies(spark, sf), 20000)


@query("acl_scan", using("acls") + """
, listed as (
  select *, unnest(case when c_custkey % 5 = 0 then [0] else [1, 2] end) as n from acls)
select 'b' || (c_custkey % 10) as bucket,
       case when c_custkey % 50 <> 0 then key end as key,
       'u' || c_nationkey as owner_id,
       case when c_custkey % 2 = 0 then c_name end as owner_name,
       case n when 1 then 'CanonicalUser' when 2 then 'Group' end as grantee_type,
       case n when 1 then 'u' || c_custkey end as grantee_id,
       case when n = 1 and c_custkey % 50 <> 0 then c_name end as grantee_name,
       case n when 2 then 'https://acs.amazonaws.com/groups/global/AllUsers' end as grantee_uri,
       case n when 1 then 'FULL_CONTROL' when 2 then 'READ' end as permission
from listed""")
def acl_scan(spark, sf):
    return acls.acl_scan(fx.raw_acls(spark, sf)).select(
        "bucket", "key", "owner", F.explode_outer("grants").alias("g")
    ).select(
        "bucket", "key", F.col("owner.id").alias("owner_id"),
        F.col("owner.display_name").alias("owner_name"),
        F.col("g.grantee.type").alias("grantee_type"), F.col("g.grantee.id").alias("grantee_id"),
        F.col("g.grantee.display_name").alias("grantee_name"),
        F.col("g.grantee.uri").alias("grantee_uri"), F.col("g.permission").alias("permission"),
    )


def _json_lines(spark, documents, label):
    path = new_run_dir(spark, label)
    documents.write.text(path)
    return path


@query("state_scan", using("states") + """
select sync_id, source_bucket, target_bucket, last_sync_time, status, total_objects, failed
from states where o_orderkey % 97 <> 0""")
def state_scan(spark, sf):
    """Every 97th document is cut off in the middle and has to be left out."""
    states = fx.run_state(spark, sf).drop("dry_run")
    whole = report_json(states)
    cut = F.regexp_extract("json", r'"sync_id":"sync-(\d+)"', 1).cast("long") % 97 == 0
    path = _json_lines(spark, whole.select(
        F.when(cut, F.substring("json", 1, 60)).otherwise(F.col("json")).alias("value")), "states")
    return runs.state_scan(spark, path, multi_line=False).select(
        "sync_id", "source_bucket", "target_bucket", "last_sync_time", "status",
        "total_objects", "failed",
    )


_REPORT_COLUMNS = """select 'val-' || o_orderkey as validation_id, status, source_bucket,
    total_objects, failed as content_failed, duration_seconds
  from (select *, date_diff('microsecond', start_time, end_time) / 1e6 as duration_seconds
        from states) """


def stored_reports(spark, sf):
    """Validation reports as JSON documents, one per line."""
    number = F.substring_index("sync_id", "-", -1)
    zero = F.lit(0).cast("long")
    documents = fx.run_state(spark, sf).select(
        F.concat(F.lit("val-"), number).alias("validation_id"),
        F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "status", "source_bucket", "target_bucket", F.col("source_prefix").alias("prefix"),
        F.lit(True).alias("check_content"), (number % 2 == 0).alias("check_metadata"),
        F.lit(False).alias("check_acl"),
        F.struct(
            "total_objects", (F.col("total_objects") - F.col("failed")).alias("content_passed"),
            F.col("failed").alias("content_failed"), zero.alias("metadata_passed"),
            zero.alias("metadata_failed"), zero.alias("metadata_skipped"),
            zero.alias("acl_passed"), zero.alias("acl_failed"),
            F.col("total_objects").alias("acl_skipped"),
        ).alias("summary"),
        run_duration("start_time", "end_time").alias("duration_seconds"),
    )
    return _json_lines(spark, report_json(documents, "value"), "reports")


def _flat_report(frame):
    return frame.select(
        "validation_id", "status", "source_bucket",
        F.col("summary.total_objects").alias("total_objects"),
        F.col("summary.content_failed").alias("content_failed"), "duration_seconds",
    )


@query("report_scan", using("states") + _REPORT_COLUMNS)
def report_scan(spark, sf):
    return _flat_report(runs.report_scan(spark, stored_reports(spark, sf), multi_line=False))


@query("report_scan_one", using("states") + _REPORT_COLUMNS + "where o_orderkey = 77")
def report_scan_one(spark, sf):
    path = stored_reports(spark, sf)
    return _flat_report(runs.report_scan(spark, path, "val-77", multi_line=False))


# Filters.

@query("prefix_filter", using("src") + "select key, size from src where key like 'docs/src2/%'")
def prefix_filter(spark, sf):
    return inventory.prefix_filter(fx.src_inventory(spark, sf), "docs/src2/").select("key", "size")


@query("glob_filter", using("src") + r"""
select key from src
where not (regexp_full_match(key, '(?s).*\.tmp') or regexp_full_match(key, '(?s)docs/src1./.*'))
  and (regexp_full_match(key, '(?s).*/en/.*') or regexp_full_match(key, '(?s)docs/src[2-5]/.*')
       or regexp_full_match(key, '(?s).*\.[^jl].*'))""")
def glob_filter(spark, sf):
    return filters.glob_filter(
        fx.src_inventory(spark, sf), exclude=["*.tmp", "docs/src1?/*"],
        include=["*/en/*", "docs/src[2-5]/*", "*.[!jl]*"],
    ).select("key")


@query("since_filter", using("docs") + """
select key, last_modified from (
  select key, case when doc_id % 13 = 0 then null else last_modified end as last_modified
  from docs) where last_modified is null or last_modified >= timestamp '2024-01-01 04:00:00'""")
def since_filter(spark, sf):
    listing = inventory.inventory_normalize(fx.raw_listing(spark, sf))
    return filters.since_filter(listing, "2024-01-01 04:00:00").select("key", "last_modified")


for _name, _since in (("utc", "2024-01-01T04:00:00Z"), ("offset", "2024-01-01T06:00:00+02:00")):
    @query(f"since_filter_{_name}", ORACLES["since_filter"])
    def since_filter_of(spark, sf, since=_since):
        listing = inventory.inventory_normalize(fx.raw_listing(spark, sf))
        return filters.since_filter(listing, since).select("key", "last_modified")


@query("modified_since", using("docs") + """
select key, last_modified from docs
where doc_id % 13 <> 0 and last_modified >= timestamp '2024-01-01 04:00:00'""")
def modified_since(spark, sf):
    listing = inventory.inventory_normalize(fx.raw_listing(spark, sf))
    return filters.modified_since(listing, "2024-01-01 04:00:00").select("key", "last_modified")


@query("checkpoint_filter", using("src") + "select key, size from src where doc_id % 9 <> 0")
def checkpoint_filter(spark, sf):
    return filters.checkpoint_filter(
        fx.src_inventory(spark, sf), fx.checkpoint(spark, sf), fx.SOURCE_BUCKET, fx.TARGET_BUCKET
    ).select("key", "size")


@query("size_class", using("large") + """
select key, size, case when size > 104857600 then 'large' else 'small' end as class,
       case when size > 104857600 then 3 else 12 end as workers from large""")
def size_class_query(spark, sf):
    return fx.large_objects(spark, sf).select(
        "key", "size", size_class("size").alias("class"), task_share("size", 12).alias("workers"))


@query("inventory_latest", using("feed") + """
select key, last_modified, size, etag, version_id from feed
qualify row_number() over (partition by key
  order by last_modified desc, size desc, etag desc, version_id desc) = 1""")
def inventory_latest(spark, sf):
    return inventory.latest_per_key(fx.inventory_feed(spark, sf)).select(
        "key", "last_modified", "size", "etag", "version_id")
