"""Scalar projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import acl as acl_fn, keys, text
from ..functions.maps import metadata_normalize
from ..operators import runs
from .fixture_sql import _CONTENT_TYPE, using
from .registry import query


@query("relative_key", using("src") + "select key, substring(key, 6) as rel_key from src")
def relative_key(spark, sf):
    return fx.src_inventory(spark, sf).select(
        "key", keys.relative_key("key", fx.SOURCE_PREFIX).alias("rel_key"))


@query("target_key", using("src") + "select key, 'mirror/' || substring(key, 6) as target_key from src")
def target_key(spark, sf):
    return fx.src_inventory(spark, sf).select(
        "key", keys.target_key("key", fx.SOURCE_PREFIX, fx.TARGET_PREFIX).alias("target_key"))


@query("basename_target", using("src") + """
select key, 'flat/' || split_part(key, '/', -1) as with_prefix, key as without_prefix from src""")
def basename_target(spark, sf):
    return fx.src_inventory(spark, sf).select(
        "key", keys.basename_target("key", "flat/").alias("with_prefix"),
        keys.basename_target("key").alias("without_prefix"))


@query("etag_normalize", using("docs") + """
select key, case when doc_id % 15 = 0 then '' else etag end as etag from docs""")
def etag_normalize(spark, sf):
    return fx.raw_listing(spark, sf).select("key", keys.etag_normalize("etag").alias("etag"))


@query("storage_class_pick", using("docs") + """
select key, case when doc_id % 4 = 1 then 'STANDARD' else storage_class end as kept,
       'GLACIER' as overridden from docs""")
def storage_class_pick(spark, sf):
    return fx.raw_listing(spark, sf).select(
        "key", keys.storage_class_pick("storage_class", "").alias("kept"),
        keys.storage_class_pick("storage_class", "GLACIER").alias("overridden"))


@query("copy_source", using("src") + """
select key, bucket || '/' || key || coalesce('?versionId=' || version_id, '') as copy_source
from src""")
def copy_source(spark, sf):
    return fx.src_inventory(spark, sf).select(
        "key", keys.copy_source("bucket", "key", "version_id").alias("copy_source"))


@query("parse_since", """
select event_id, date_trunc('second', ts) as with_z, date_trunc('second', ts) as with_offset,
       date_trunc('second', ts) as bare, ts as micros from events""")
def parse_since(spark, sf):
    whole = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    shifted = F.date_format(F.col("ts") - F.expr("interval '5:30' hour to minute"),
                            "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return fx.table(spark, sf, "events").select(
        "event_id",
        keys.parse_instant(F.concat(whole, F.lit("Z"))).alias("with_z"),
        keys.parse_instant(F.concat(shifted, F.lit("-05:30"))).alias("with_offset"),
        keys.parse_instant(whole).alias("bare"),
        keys.parse_instant(F.concat(micros, F.lit("+00:00"))).alias("micros"),
    )


@query("metadata_normalize", using("docs") + f"""
, flat as (
  select key, 'ContentType' as name, {_CONTENT_TYPE} as value from docs
  union all select key, 'ContentLength', cast(size as varchar) from docs
  union all select key, 'Lang', lang from docs
  union all select key, 'Source', source from docs
  union all select key, 'ETag', 'later' from docs where doc_id % 3 = 0
  union all select key, 'x-other', '1' from docs)
select key, name, value from flat""")
def metadata_normalize_query(spark, sf):
    return fx.raw_headers(spark, sf).select(
        "key", F.explode(metadata_normalize("headers")).alias("name", "value"))


@query("format_size", """
, sizes as (
  select o_orderkey, cast(trunc(o_totalprice * 1024) as bigint) as size from orders
  union all select -1 - o_orderkey, o_orderkey from orders
  union all select -1000000000 - o_orderkey, o_orderkey * 987654321098 from orders)
select o_orderkey as id, size,
  case when size < 1024 then printf('%.2f B', cast(size as double))
       when size < 1048576 then printf('%.2f KB', size / 1024.0::double)
       when size < 1073741824 then printf('%.2f MB', size / 1048576.0::double)
       when size < 1099511627776 then printf('%.2f GB', size / 1073741824.0::double)
       when size < 1125899906842624 then printf('%.2f TB', size / 1099511627776.0::double)
       else printf('%.2f PB', size / 1125899906842624.0::double) end as shown
from sizes""".replace(", sizes as", "with sizes as", 1))
def format_size(spark, sf):
    orders = fx.table(spark, sf, "orders")
    sizes = orders.selectExpr("o_orderkey as id", "cast(o_totalprice * 1024 as bigint) as size")
    small = orders.selectExpr("-1 - o_orderkey as id", "o_orderkey as size")
    huge = orders.selectExpr("-1000000000 - o_orderkey as id", "o_orderkey * 987654321098 as size")
    return sizes.unionByName(small).unionByName(huge).select(
        "id", "size", text.format_size("size").alias("shown"))


@query("format_duration", """
with d as (select event_id, value * 37.3 as seconds from events)
select event_id,
  case when seconds < 60 then printf('%.1fs', seconds)
       when seconds < 3600 then printf('%.1fm', seconds / 60)
       else printf('%.1fh', seconds / 3600) end as shown
from d""")
def format_duration(spark, sf):
    return fx.table(spark, sf, "events").select(
        "event_id", text.format_duration(F.col("value") * 37.3).alias("shown"))


@query("run_duration", using("states") + """
select sync_id, date_diff('microsecond', start_time, end_time) / 1e6 as duration_seconds
from states""")
def run_duration(spark, sf):
    return fx.run_state(spark, sf).select(
        "sync_id", text.run_duration("start_time", "end_time").alias("duration_seconds"))


@query("progress_ratio", using("states") + """
select sync_id, case when total_objects > 0
  then cast(coalesce(uploaded, 0) as double) / total_objects * 100.0 else 0.0 end as percent
from states""")
def progress_ratio(spark, sf):
    return fx.run_state(spark, sf).select(
        "sync_id",
        text.progress_ratio(F.coalesce(F.col("uploaded"), F.lit(0)), "total_objects")
        .alias("percent"))


@query("history_row", using("states") + """
select sync_id, strftime(start_time, '%Y-%m-%d %H:%M') as time, status, source_bucket as source,
       total_objects as total, coalesce(uploaded, 0) + coalesce(skipped, 0) as success, failed
from states""")
def history_row(spark, sf):
    return runs.history_row(fx.run_state(spark, sf))


_GRANT_ROWS = """
, listed as (
  select *, unnest([1] || case when c_custkey % 3 = 0 then [2] else [] end
                       || case when c_custkey % 8 = 0 then [3] else [] end) as n from acls)"""


@query("grantee_label", using("acls") + _GRANT_ROWS + """
select key, case n when 1 then c_name when 2 then 'AllUsers (public)' else 'e' || c_custkey end
  as grantee from listed""")
def grantee_label(spark, sf):
    return fx.src_acls(spark, sf).select("key", F.explode("grants").alias("g")).select(
        "key", acl_fn.grantee_label(F.col("g.grantee")).alias("grantee"))


@query("acl_format", using("acls") + r"""
select key, 'Owner: u' || c_nationkey || ' (' || c_mktsegment || ')'
  || chr(10) || '  FULL_CONTROL: u' || c_custkey || ' (' || c_name || ')'
  || case when c_custkey % 3 = 0
       then chr(10) || '  READ: https://acs.amazonaws.com/groups/global/AllUsers' else '' end
  || case when c_custkey % 8 = 0
       then chr(10) || '  READ: e' || c_custkey || ' ()' else '' end as shown
from acls""")
def acl_format(spark, sf):
    return fx.src_acls(spark, sf).select("key", acl_fn.acl_format("owner", "grants").alias("shown"))
