"""Joins, plans and set operations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import joins, parts, sets
from ..plans import ranges, sync
from ..plans.options import SyncOptions
from ..session import new_run_dir
from ..sources.bodies import content_digest
from .fixture_sql import using
from .registry import query

OPTIONS = SyncOptions(
    source_bucket=fx.SOURCE_BUCKET, target_bucket=fx.TARGET_BUCKET,
    source_prefix=fx.SOURCE_PREFIX, target_prefix=fx.TARGET_PREFIX,
    since="2024-01-01 04:00:00", exclude_patterns=("*.tmp",), delete=True,
)
PREFIXES = (fx.SOURCE_PREFIX, fx.TARGET_PREFIX)


def _sides(spark, sf):
    return fx.src_inventory(spark, sf), fx.tgt_inventory(spark, sf)


def sample_plan(spark, sf, options=OPTIONS):
    """Plan of the fixtures with every kind of row but orphans."""
    return sync.sync_plan(*_sides(spark, sf), options, fx.checkpoint(spark, sf))


@query("diff_join", using("diff") + """
select key, rel_key, size, etag, why as reason from diff where why is not null""")
def diff_join(spark, sf):
    return joins.diff_join(*_sides(spark, sf), *PREFIXES)


@query("diff_join_ranges", using("diff") + """
select key, rel_key, size, etag, why as reason from diff where why is not null""")
def diff_join_ranges(spark, sf):
    """Both listings stored with digests of their ranges; only ranges that differ are joined."""
    folder = new_run_dir(spark, "ranges")
    for name, side, prefix in zip(("source", "target"), _sides(spark, sf), PREFIXES):
        ranges.store_listing(side, f"{folder}/{name}", prefix)
    return ranges.diff_by_ranges(spark, f"{folder}/source", f"{folder}/target")


@query("orphan_anti_join", using("src", "tgt") + """
select key, rel_key, size from tgt where rel_key not in (select rel_key from src)""")
def orphan_anti_join(spark, sf):
    return joins.orphan_anti_join(*_sides(spark, sf), *PREFIXES)


@query("mirror_status", using("diff") + """
select rel_key, key as source_key, t_key as target_key, size as source_size,
       (select max(t.size) from tgt t where t.key = diff.t_key) as target_size,
       coalesce(why, 'same') as status from diff
union all
select rel_key, null, key, null, size, 'orphan' from tgt
where rel_key not in (select rel_key from src)""")
def mirror_status(spark, sf):
    return joins.mirror_status(*_sides(spark, sf), *PREFIXES)


@query("validation_join", using("docs") + """
select key, doc_id % 10 <> 3 as present from docs""")
def validation_join(spark, sf):
    return joins.validation_join(
        fx.src_inventory(spark, sf), fx.tgt_heads(spark, sf)).select("key", "present")


@query("validation_join_mapped", using("docs") + """
select key, 'mirror/' || substring(key, 6) as target_key, doc_id % 10 <> 3 as present from docs""")
def validation_join_mapped(spark, sf):
    return joins.validation_join(
        fx.src_inventory(spark, sf), fx.tgt_heads(spark, sf, fx.TARGET_PREFIX), *PREFIXES
    ).select("key", "target_key", "present")


@query("metadata_attach", using("diff", "heads") + """
select d.key, h.content_type, h.cache_control, h.meta_lang as lang,
       cast(case when h.meta_lang is null then 0 else 2 end as integer) as entries
from diff d join s_heads h on d.key = h.key where d.why is not null""")
def metadata_attach(spark, sf):
    todo = joins.diff_join(*_sides(spark, sf), *PREFIXES)
    return joins.metadata_attach(todo, fx.src_heads(spark, sf)).select(
        "key", "content_type", "cache_control",
        F.try_element_at("metadata", F.lit("lang")).alias("lang"),
        F.size("metadata").alias("entries"),
    )


_MD5_SQL = using("docs") + """
select key, md5(text) as source_md5,
       md5(case when doc_id % 7 = 0 then text || '#' else text end) as target_md5,
       doc_id % 7 <> 0 as match
from docs where doc_id % 10 <> 3"""


def _md5_join(spark, sf, limit=None):
    return joins.content_md5_join(
        content_digest(fx.bodies(spark, sf), limit),
        content_digest(fx.bodies(spark, sf, target=True), limit))


@query("content_md5_join", _MD5_SQL)
def content_md5_join(spark, sf):
    return _md5_join(spark, sf)


@query("content_md5_join_whole", _MD5_SQL)
def content_md5_join_whole(spark, sf):
    return _md5_join(spark, sf)


@query("content_md5_join_limited", _MD5_SQL + """ and strlen(text) <= 20000
  and strlen(case when doc_id % 7 = 0 then text || '#' else text end) <= 20000""")
def content_md5_join_limited(spark, sf):
    return _md5_join(spark, sf, 20000)


_PLAN_SQL = """
select key, rel_key, 'mirror/' || rel_key as target_key, size, action,
       case when action = 'copy' then why end as reason from plan"""


@query("sync_plan", using("plan") + _PLAN_SQL)
def sync_plan(spark, sf):
    return sample_plan(spark, sf).select(
        "key", "rel_key", "target_key", "size", "action", "reason")


@query("sync_plan_counts", using("diff") + """
, a as (select *, case when last_modified < timestamp '2024-01-01 04:00:00' then 'skip_since'
                       when why is null then 'unchanged' when key like '%.tmp' then 'filtered'
                       else 'copy: ' || why end as action from diff)
select action, count(*) as objects, cast(sum(size) as bigint) as bytes from a group by action
union all
select 'delete: orphan', count(*), cast(sum(size) as bigint) from tgt
where rel_key not in (select rel_key from src)""")
def sync_plan_counts(spark, sf):
    plan = sync.mirror_plan(*_sides(spark, sf), OPTIONS, all_rows=True)
    return plan.groupBy(F.concat_ws(": ", "action", "reason").alias("action")).agg(
        F.count("*").alias("objects"), F.sum("size").alias("bytes"))


@query("dry_run_plan", using("plan") + """
select key, 'mirror/' || rel_key as target_key, true as success,
       rel_key like 'src1/%' as skipped, cast(null as varchar) as error,
       case when rel_key like 'src1/%' then 'filtered' else '[DRY-RUN] Would upload' end as reason,
       size from plan where action = 'copy'
union all
select key, key, true, false, null, '[DRY-RUN] Would delete', size from tgt
where rel_key not in (select rel_key from src)""")
def dry_run_plan(spark, sf):
    options = replace(OPTIONS, exclude_patterns=("*.tmp", "mirror/src1/*"), dry_run=True)
    return sync.dry_run_plan(sync.mirror_plan(
        *_sides(spark, sf), options, fx.checkpoint(spark, sf)))


@query("mirror_plan", using("plan") + """
select key, 'mirror/' || rel_key as target_key, size, action, why as reason
from plan where action = 'copy'
union all
select key, key, size, 'delete', 'orphan' from tgt
where rel_key not in (select rel_key from src)""")
def mirror_plan(spark, sf):
    return sync.mirror_plan(
        *_sides(spark, sf), OPTIONS, fx.checkpoint(spark, sf)
    ).select("key", "target_key", "size", "action", "reason")


@query("part_plan", using("large") + """
, n as (select key, size, greatest(1, (size + 8388607) // 8388608) as parts from large),
  p as (select key, size, unnest(generate_series(1, cast(parts as bigint))) as part_number from n)
select key, part_number, (part_number - 1) * 8388608 as "offset",
       least(8388608, size - (part_number - 1) * 8388608) as length from p""")
def part_plan(spark, sf):
    return parts.part_plan(fx.large_objects(spark, sf))


@query("part_order", using("large") + """
, n as (select key, greatest(1, (size + 8388607) // 8388608) as parts from large),
  p as (select key, unnest(generate_series(1, cast(parts as bigint))) as part_number from n)
select key, (part_number - 1) // 10 as block, count(*) as n_parts,
       string_agg(part_number || ':' || left(md5(key || '#' || part_number), 8), ','
                  order by part_number) as manifest
from p group by 1, 2""")
def part_order(spark, sf):
    # Objects are spread by key before each becomes some thirty parts; the parts of a key are
    # then already together and are not shuffled again. The number is given, since adaptive
    # coalescing would size the partitions by the few bytes that come in.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = fx.large_objects(spark, sf).repartition(tasks, "key")
    uploaded = parts.part_plan(spread).select(
        "key", "part_number",
        F.md5(F.concat("key", F.lit("#"), F.col("part_number").cast("string"))).alias("etag"))
    return parts.part_order(uploaded, 10).select(
        "key", "block", F.size("parts").cast("long").alias("n_parts"),
        F.array_join(F.transform("parts", lambda p: F.concat(
            p["part_number"].cast("string"), F.lit(":"), F.substring(p["etag"], 1, 8))), ",")
        .alias("manifest"),
    )


@query("checkpoint_union", using("plan") + """
select 'src-bucket' as source_bucket, 'tgt-bucket' as target_bucket, key from docs
where doc_id % 9 = 0
union select 'src-bucket', 'other-bucket', key || '.old' from docs where doc_id % 9 = 0
union select 'src-bucket', 'tgt-bucket', key from plan where why is not null""")
def checkpoint_union(spark, sf):
    handled = joins.diff_join(*_sides(spark, sf), *PREFIXES).select(
        F.lit(fx.SOURCE_BUCKET).alias("source_bucket"),
        F.lit(fx.TARGET_BUCKET).alias("target_bucket"), "key")
    return sets.checkpoint_union(fx.checkpoint(spark, sf), handled)


@query("key_except", using("src", "tgt") + """
select rel_key from tgt except select rel_key from src""")
def key_except(spark, sf):
    return sets.key_except(*_sides(spark, sf), *PREFIXES)


@query("run_lookup", using("states") + """
select sync_id, case when o_orderkey % 3 = 0 then 'checkpoint' else 'state' end as origin,
       case when o_orderkey % 3 = 0 then 'running' else status end as status,
       case when o_orderkey % 3 = 0 then 5 else uploaded end as uploaded
from states""")
def run_lookup(spark, sf):
    number = F.substring_index("sync_id", "-", -1)
    states = fx.run_state(spark, sf).select("sync_id", "status", "uploaded")
    saved = states.filter(number % 3 == 0).select(
        "sync_id", F.lit("running").alias("status"), F.lit(5).cast("long").alias("uploaded"))
    return sets.run_lookup(saved, states)
