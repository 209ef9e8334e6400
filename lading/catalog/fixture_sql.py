"""The fixtures as SQL common table expressions, for the checking side."""

from __future__ import annotations

_DOCUMENTS = """
docs as (
  select 'docs/' || source || '/' || lang || '/' || cast(doc_id as varchar)
         || case doc_id % 5 when 0 then '.txt' when 1 then '.jpg' when 2 then '.tmp'
                            when 3 then '.log' else '.html' end as key,
         strlen(text) as size, md5(text) as etag,
         timestamp '2024-01-01 00:00:00' + to_minutes(doc_id) as last_modified,
         case doc_id % 4 when 0 then 'STANDARD_IA' else 'STANDARD' end as storage_class,
         doc_id, lang, source, text
  from documents)"""

_SRC = """
src as (
  select 'src-bucket' as bucket, key, last_modified, size, storage_class, etag,
         case when doc_id % 8 = 0 then 'v' || doc_id end as version_id, doc_id,
         substring(key, 6) as rel_key
  from docs)"""

_TGT = """
tgt as (
  select 'mirror/' || substring(key, 6) as key,
         case when doc_id % 11 = 0 then size + 1 else size end as size,
         case when doc_id % 7 = 0 then md5(etag) else etag end as etag,
         last_modified, doc_id, substring(key, 6) as rel_key
  from docs where doc_id % 10 <> 3
  union all
  select 'mirror/orphan/' || cast(page_id as varchar), 1, md5(html),
         timestamp '2024-01-01 00:00:00', -1, 'orphan/' || cast(page_id as varchar)
  from pages)"""

_DIFF = """
diff as (
  select s.*, t.key as t_key,
         case when t.key is null then 'missing' when s.etag <> t.etag then 'etag'
              when s.size <> t.size then 'size' end as why
  from src s left join tgt t on s.rel_key = t.rel_key)"""

_PLAN = """
plan as (
  select *,
         case when doc_id % 9 = 0 then 'skip_checkpoint'
              when last_modified < timestamp '2024-01-01 04:00:00' then 'skip_since'
              when why is null then 'unchanged'
              when key like '%.tmp' then 'filtered'
              else 'copy' end as action
  from diff)"""

_RESULTS = """
results as (
  select key, 'mirror/' || rel_key as target_key, doc_id % 23 <> 0 as success,
         doc_id % 23 <> 0 and key like '%.log' as skipped,
         case when doc_id % 23 = 0 then 'E' || (doc_id % 4) end as error,
         case when doc_id % 23 <> 0 and key like '%.log' then 'filtered' end as reason,
         size,
         timestamp '2024-02-01 00:00:00' + to_seconds((doc_id * 7919) % 1000) as completed_at,
         doc_id
  from plan where action = 'copy')"""

_CONTENT_TYPE = """case doc_id % 5 when 0 then 'text/plain' when 1 then 'image/jpeg'
    when 4 then 'text/html' else 'application/octet-stream' end"""

_HEADS = f"""
s_heads as (
  select key, size as content_length, {_CONTENT_TYPE} as content_type, etag as content_md5,
         last_modified, etag, case when doc_id % 4 = 1 then 'STANDARD' else storage_class end
           as storage_class,
         case when doc_id % 6 = 0 then null else 'max-age=' || (doc_id % 3) end as cache_control,
         case when doc_id % 10 = 0 then '2030-01-01T00:00:00' end as expires,
         case when doc_id % 25 = 0 then null else lang end as meta_lang,
         case when doc_id % 25 = 0 then null else source end as meta_source,
         case when doc_id % 8 = 0 then 'v' || doc_id end as version_id, doc_id
  from docs),
t_heads as (
  select key, case when doc_id % 11 = 0 then size + 1 else size end as content_length,
         case when doc_id % 7 = 0 then md5(etag) else etag end as content_md5,
         case when doc_id % 14 = 0 then ''
              when doc_id % 7 = 0 then md5(etag) else etag end as etag,
         doc_id % 25 = 0 or (doc_id % 17 <> 0 and doc_id % 19 <> 0) as meta_same,
         doc_id
  from docs where doc_id % 10 <> 3)"""

_ACLS = """
acls as (
  select 'acl/' || c_mktsegment || '/' || cast(c_custkey as varchar) as key, c_custkey,
         c_nationkey, c_name, c_mktsegment
  from customer)"""

_LARGE = """
large as (
  select 'o/' || cast(o_orderkey as varchar) as key,
         cast(trunc(o_totalprice * 1024) as bigint) as size
  from orders)"""

_STATES = """
states as (
  select 'sync-' || cast(o_orderkey as varchar) as sync_id,
         'b' || (o_custkey % 10) as source_bucket, 't' || (o_custkey % 3) as target_bucket,
         'docs/' as source_prefix, '' as target_prefix, o_orderdate as last_sync_time,
         case o_orderstatus when 'F' then 'completed' when 'O' then 'completed_with_errors'
              else 'cancelled' end as status,
         o_orderkey % 31 = 0 as dry_run, o_orderkey % 5000 as total_objects,
         case when o_orderkey % 7 = 0 then null else o_orderkey % 4000 end as uploaded,
         o_orderkey % 90 as deleted,
         case when o_orderkey % 11 = 0 then null else o_orderkey % 300 end as skipped,
         case when o_orderstatus = 'O' then 1 + o_orderkey % 9 else 0 end as failed,
         o_orderdate + to_seconds(o_orderkey % 86400) as start_time,
         case when o_orderstatus <> 'P'
              then o_orderdate + to_seconds(o_orderkey % 86400)
                   + to_milliseconds(((o_custkey * 37) % 20000) * 1000 + 250) end as end_time,
         o_orderkey
  from orders)"""

_FEED = """
feed as (
  select 'u/' || cast(user_id as varchar) || '/' || event_type as key, ts as last_modified,
         cast(trunc(value * 100) as bigint) as size, md5(cast(event_id as varchar)) as etag,
         cast(event_id as varchar) as version_id
  from events)"""

_CTES = {
    "docs": (_DOCUMENTS, ()), "src": (_SRC, ("docs",)), "tgt": (_TGT, ("docs",)),
    "diff": (_DIFF, ("src", "tgt")), "plan": (_PLAN, ("diff",)),
    "results": (_RESULTS, ("plan",)), "heads": (_HEADS, ("docs",)), "acls": (_ACLS, ()),
    "large": (_LARGE, ()), "states": (_STATES, ()), "feed": (_FEED, ()),
}


def using(*names: str) -> str:
    """``with`` clause that defines the named fixtures and what they rest on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        text, needs = _CTES[name]
        for need in needs:
            add(need)
        if text not in ordered:
            ordered.append(text)

    for name in names:
        add(name)
    return "with" + ",".join(ordered) + "\n"
