"""Metadata maps, access-control lists and validation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import acl as acl_fn
from ..functions.maps import map_literal, metadata_merge, metadata_replace
from ..operators import acl, metadata
from ..plans import validate as checks
from ..plans.options import ValidateOptions
from ..sources.acls import acl_scan
from ..sources.bodies import content_digest
from .fixture_sql import using
from .registry import query


def _entries(frame, *keys, column="metadata"):
    return frame.select(*keys, F.explode(column).alias("name", "value"))


_OLD = """
, old as (select key, 'lang' as name, meta_lang as value, doc_id from s_heads
          where meta_lang is not null
          union all select key, 'source', meta_source, doc_id from s_heads
          where meta_source is not null)"""


@query("metadata_merge", using("heads") + _OLD + """
select key, name, case when name = 'lang' then 'xx' else value end as value from old
union all select key, 'reviewed', 'yes' from s_heads
union all select key, 'lang', 'xx' from s_heads where meta_lang is null""")
def metadata_merge_query(spark, sf):
    new = map_literal({"lang": "xx", "reviewed": "yes"})
    return _entries(fx.src_heads(spark, sf).select(
        "key", metadata_merge("metadata", new).alias("metadata")), "key")


@query("metadata_replace", using("heads") + _OLD + """
select key, 'lang' as name, 'xx' as value from s_heads where doc_id % 2 = 0
union all select key, name, value from old where doc_id % 2 = 1""")
def metadata_replace_query(spark, sf):
    new = F.when(F.col("doc_id") % 2 == 0, map_literal({"lang": "xx"})).otherwise(map_literal({}))
    return _entries(fx.src_heads(spark, sf).select(
        "key", metadata_replace("metadata", new).alias("metadata")), "key")


_BATCH_KEYS = """
, wanted as (select key, doc_id, true as known from docs where doc_id % 4 = 0
             union all select key || '.gone', doc_id, false from docs where doc_id % 12 = 0)"""


def _batch_keys(spark, sf):
    listing = fx.src_inventory(spark, sf)
    return listing.filter("doc_id % 4 = 0").select("key").unionByName(
        listing.filter("doc_id % 12 = 0").selectExpr("key || '.gone' as key"))


def _batch(spark, sf, operation):
    return metadata.metadata_batch_update(
        fx.src_heads(spark, sf), _batch_keys(spark, sf), {"lang": "xx"}, operation
    ).select(
        "key", "success", "error", F.try_element_at("metadata", F.lit("lang")).alias("lang"),
        F.try_element_at("metadata", F.lit("source")).alias("source"))


@query("metadata_batch_update", using("heads") + _BATCH_KEYS + """
select w.key, known as success, case when not known then 'Not Found' end as error,
       case when known then 'xx' end as lang, h.meta_source as source
from wanted w left join s_heads h on w.key = h.key""")
def metadata_batch_update(spark, sf):
    return _batch(spark, sf, "COPY")


@query("metadata_batch_replace", using("docs") + _BATCH_KEYS + """
select key, known as success, case when not known then 'Not Found' end as error,
       case when known then 'xx' end as lang, cast(null as varchar) as source from wanted""")
def metadata_batch_replace(spark, sf):
    return _batch(spark, sf, "REPLACE")


def _mapping(spark, sf):
    return fx.src_inventory(spark, sf).select(
        F.col("key").alias("source_key"), F.concat(F.lit("copy/"), "key").alias("target_key"))


@query("metadata_copy", using("heads") + _OLD + """
select key as source_key, 'copy/' || key as target_key, name, value from old""")
def metadata_copy(spark, sf):
    copied = metadata.metadata_copy(fx.src_heads(spark, sf), _mapping(spark, sf))
    return _entries(copied, "source_key", "target_key")


@query("metadata_copy_replace", using("docs") + """
select key as source_key, 'copy/' || key as target_key, 'team' as name, 'a' as value from docs""")
def metadata_copy_replace(spark, sf):
    copied = metadata.metadata_copy(
        fx.src_heads(spark, sf), _mapping(spark, sf), False, {"team": "a"})
    return _entries(copied, "source_key", "target_key")


_DIFFERENCES = """
, pairs as (select s.key, s.doc_id, s.content_type, s.cache_control, s.expires,
                   s.content_length as s_len, t.content_length as t_len,
                   s.content_md5 as s_md5, t.content_md5 as t_md5, t.meta_same
            from s_heads s join t_heads t on s.key = t.key),
  listed as (
    select key, 'ContentType' as field, content_type as source, content_type as target,
           true as match from pairs
    union all select key, 'ContentLength', cast(s_len as varchar), cast(t_len as varchar),
           s_len = t_len from pairs
    union all select key, 'CacheControl', cache_control, cache_control, true from pairs
    union all select key, 'Expires', expires, expires, true from pairs
    union all select key, 'Metadata', null, null, false from pairs where not meta_same
    {extra})
select key, field, source, target, match from listed"""


def _flat_differences(frame):
    shown = F.col("d.field") != "Metadata"
    return frame.select("key", F.explode("differences").alias("d")).select(
        "key", "d.field", F.when(shown, F.col("d.source")).alias("source"),
        F.when(shown, F.col("d.target")).alias("target"), "d.match")


@query("metadata_compare", using("heads") + _DIFFERENCES.format(
    extra="union all select key, 'ContentMD5', s_md5, t_md5, s_md5 = t_md5 from pairs"))
def metadata_compare(spark, sf):
    return _flat_differences(metadata.metadata_compare(
        fx.src_heads(spark, sf), fx.tgt_heads(spark, sf)))


@query("metadata_compare_map", using("heads") + "select key, meta_same as match from t_heads")
def metadata_compare_map(spark, sf):
    return metadata.metadata_compare(
        fx.src_heads(spark, sf), fx.tgt_heads(spark, sf), ["Metadata"]).select("key", "match")


@query("metadata_check", using("heads") + _DIFFERENCES.format(extra=""))
def metadata_check(spark, sf):
    return _flat_differences(checks.metadata_check(
        fx.src_inventory(spark, sf), fx.src_heads(spark, sf), fx.tgt_heads(spark, sf),
        ValidateOptions()))


# Access control.

def _flat_grants(frame, *keys):
    return frame.select(*keys, F.posexplode("grants").alias("position", "g")).select(
        *keys, "position", F.col("g.grantee.type").alias("grantee_type"),
        F.col("g.grantee.id").alias("grantee_id"), F.col("g.grantee.uri").alias("grantee_uri"),
        F.col("g.grantee.email_address").alias("email_address"),
        F.col("g.permission").alias("permission"))


_EVERYONE = "https://acs.amazonaws.com/groups/global/AllUsers"
_SIGNED_IN = "https://acs.amazonaws.com/groups/global/AuthenticatedUsers"


@query("acl_build", using("acls") + f"""
, g as (
  select key, 1 as n, 'CanonicalUser' as t, 'u' || c_custkey as i, null as u, 'FULL_CONTROL' as p
    from acls
  union all select key, 2, 'Group', null, '{_EVERYONE}', 'READ' from acls where c_custkey % 3 = 0
  union all select key, 3, 'AmazonCustomerByEmail', 'e' || c_custkey, null, 'READ' from acls
    where c_custkey % 8 = 0
  union all select key, 4, 'Group', null, '{_EVERYONE}', 'READ' from acls where c_custkey % 2 = 0
  union all select key, 5, 'Group', null, '{_EVERYONE}', 'WRITE' from acls where c_custkey % 5 = 0
  union all select key, 6, 'Group', null, '{_EVERYONE}', 'FULL_CONTROL' from acls
    where c_custkey % 7 = 0
  union all select key, 7, 'Group', null, '{_SIGNED_IN}', 'READ_ACP' from acls
  union all select key, 8, 'Group', null, '{_SIGNED_IN}', 'WRITE_ACP' from acls
    where c_custkey % 9 = 0)
select key, cast(row_number() over (partition by key order by n) - 1 as integer) as position,
       t as grantee_type, i as grantee_id, u as grantee_uri, cast(null as varchar) as email_address,
       p as permission from g""")
def acl_build(spark, sf):
    number = F.col("c_custkey")
    built = acl_fn.acl_build(
        "grants", grant_read=number % 2 == 0, grant_write=number % 5 == 0,
        grant_full_control=number % 7 == 0, grant_read_acp=True, grant_write_acp=number % 9 == 0)
    return _flat_grants(fx.src_acls(spark, sf).select("key", built.alias("grants")), "key")


@query("acl_build_basic", using("acls") + """
, g as (select key, 1 as n, 'READ' as p from acls where c_custkey % 2 = 0
        union all select key, 2, 'FULL_CONTROL' from acls where c_custkey % 3 = 0)
select key, cast(row_number() over (partition by key order by n) - 1 as integer) as position,
       'uri' as grantee_type, cast(null as varchar) as grantee_id,
       'http://acs.amazonaws.com/groups/global/AllUsers' as grantee_uri,
       cast(null as varchar) as email_address, p as permission from g""")
def acl_build_basic(spark, sf):
    number = F.col("c_custkey")
    built = acl_fn.acl_build_basic(number % 2 == 0, number % 3 == 0)
    return _flat_grants(fx.src_acls(spark, sf).select("key", built.alias("grants")), "key")


_COPIED = """
, g as (
  select key, c_custkey, 1 as n, 'CanonicalUser' as t, 'u' || c_custkey as i, null as u, null as e,
         'FULL_CONTROL' as p from acls
  union all select key, c_custkey, 2, 'Group', null,
    'https://acs.amazonaws.com/groups/s3/LogDelivery', null, 'READ_ACP' from acls
  union all select key, c_custkey, 3, 'AmazonCustomerByEmail', null, null, 'e' || c_custkey,
    'WRITE' from acls where c_custkey % 4 = 1)"""
_COPIED_COLUMNS = """cast(n - 1 as integer) as position, t as grantee_type,
  i as grantee_id, u as grantee_uri, e as email_address, p as permission"""


@query("acl_copy", using("acls") + _COPIED + f"""
select g.key, 'u' || c_nationkey as owner_id,
       case when g.c_custkey % 2 = 0 then c_name else '' end as owner_name, {_COPIED_COLUMNS}
from g join acls on g.key = acls.key""")
def acl_copy(spark, sf):
    copied = acl.acl_copy(fx.mixed_acls(spark, sf)).withColumns({
        "owner_id": F.col("owner.id"), "owner_name": F.col("owner.display_name")})
    return _flat_grants(copied, "key", "owner_id", "owner_name")


@query("acl_batch_copy", using("acls") + """
select key, 'flat/' || split_part(key, '/', -1) as target_key, true as success,
       cast(null as varchar) as error, 'u' || c_nationkey as owner_id,
       cast(case when c_custkey % 4 = 1 then 3 else 2 end as integer) as n_grants
from acls where c_custkey % 3 = 0
union all
select 'lost/' || c_custkey, 'flat/' || c_custkey, false, 'NoSuchKey', null, null
from acls where c_custkey % 30 = 0""")
def acl_batch_copy(spark, sf):
    lists = fx.mixed_acls(spark, sf)
    keys = lists.filter("c_custkey % 3 = 0").select("key").unionByName(
        lists.filter("c_custkey % 30 = 0").selectExpr("'lost/' || c_custkey as key"))
    return acl.acl_batch_copy(lists, keys, "flat/").select(
        "key", "target_key", "success", "error", F.col("owner.id").alias("owner_id"),
        F.when(F.col("success"), F.size("grants")).alias("n_grants"))


@query("acl_explode", using("acls") + """
, g as (select *, unnest(case when c_custkey % 5 = 0 then [0] else [1, 2] end) as n from acls)
select 'b' || (c_custkey % 10) as bucket, case when c_custkey % 50 <> 0 then key end as key,
       'u' || c_nationkey as owner_id,
       cast(case when n > 0 then n - 1 end as integer) as position,
       case n when 1 then 'FULL_CONTROL' when 2 then 'READ' end as permission,
       case n when 1 then case when c_custkey % 50 <> 0 then c_name else 'u' || c_custkey end
              when 2 then 'AllUsers (public)' end as grantee
from g""")
def acl_explode(spark, sf):
    return acl.acl_explode(acl_scan(fx.raw_acls(spark, sf)), "bucket")


_ACL_MATCH = """select key, c_custkey % 13 <> 0 as owner_match, {grants} as grants_match,
  c_custkey % 13 <> 0 and {grants} as match from acls"""


@query("acl_compare", using("acls") + _ACL_MATCH.format(grants="c_custkey % 11 <> 0"))
def acl_compare(spark, sf):
    return acl.acl_compare(fx.src_acls(spark, sf), fx.tgt_acls(spark, sf))


@query("acl_compare_strict", using("acls") + _ACL_MATCH.format(
    grants="(c_custkey % 11 <> 0 and c_custkey % 7 <> 0)"))
def acl_compare_strict(spark, sf):
    return acl.acl_compare(fx.src_acls(spark, sf), fx.tgt_acls(spark, sf), "strict")


# Validation. Heads agree on the ETag only where the target has one; where it has none the
# bodies decide, of any length, or in the ``_limited`` queries up to a limit.

LIMIT = 3000
OPTIONS = ValidateOptions(check_acl=False)
FORMS = (("", OPTIONS), ("_limited", replace(OPTIONS, digest_limit=LIMIT)))


def _object_acls(spark, sf, changed=False):
    """One list per document, so that all three checks meet on the same keys."""
    owner = "case when doc_id % 29 = 0 then 'zz' else 'o' end" if changed else "'o'"
    permission = "case when doc_id % 31 = 0 then 'WRITE' else 'READ' end" if changed else "'READ'"
    return fx.src_inventory(spark, sf).selectExpr(
        "key", f"named_struct('id', {owner}, 'display_name', 'x') as owner",
        f"array({fx._grant('CanonicalUser', permission, id='bucket')}) as grants")


def _digests(spark, sf, limit):
    return (content_digest(fx.bodies(spark, sf), limit),
            content_digest(fx.bodies(spark, sf, target=True), limit and limit + 1))


def _heads(spark, sf):
    return fx.src_inventory(spark, sf), fx.src_heads(spark, sf), fx.tgt_heads(spark, sf)


def _validated(spark, sf, options, **given):
    source_md5, target_md5 = _digests(spark, sf, options.digest_limit)
    return checks.validate(
        *_heads(spark, sf), options, source_digests=source_md5, target_digests=target_md5, **given)


def checked(limit):
    """The pairs and what they are to be found to be."""
    beyond = f"when s_len > {limit} then null" if limit else ""
    return f"""
, pairs as (
  select d.key, d.doc_id, d.doc_id % 10 <> 3 as present, d.size as s_len,
         t.content_length as t_len, d.etag as s_tag, t.etag as t_tag, t.meta_same,
         md5(d.text) as s_md5,
         md5(case when d.doc_id % 7 = 0 then d.text || '#' else d.text end) as t_md5
  from docs d left join t_heads t on d.key = t.key),
  checked as (
  select *, case
      when s_len <> t_len then 'Size mismatch: source=' || s_len || ', target=' || t_len
      when t_tag <> '' and s_tag <> t_tag
        then 'ETag mismatch: source=' || s_tag || ', target=' || t_tag
      {beyond}
      when s_md5 <> t_md5 then 'MD5 mismatch: source=' || s_md5 || ', target=' || t_md5
    end as why,
    present and s_len = t_len and meta_same as meta_ok,
    present and doc_id % 29 <> 0 and doc_id % 31 <> 0 as acl_good
  from pairs),
  verdict as (
  select *, case when not present then 'Target object not found: ' || key
    else concat_ws('|', 'content_mismatch: ' || why,
      case when s_len <> t_len then 'metadata_mismatch: ContentLength' end,
      case when not meta_same then 'metadata_mismatch: Metadata' end) end as errors,
    case when present and not acl_good then '|acl_mismatch' else '' end as acl_error
  from checked)
"""


def _flat_validation(frame):
    return frame.withColumn("errors", F.array_join("errors", "|"))


def _register(suffix, options):
    limit = options.digest_limit
    verdict = using("heads") + checked(limit)
    within = f"and s_len <= {limit}" if limit else ""

    @query(f"content_check{suffix}", verdict + """
select key, why is null as match, why as reason from verdict where present""")
    def content_check(spark, sf):
        return checks.content_check(*_heads(spark, sf), options, *_digests(spark, sf, limit))

    @query(f"undecided_bodies{suffix}", verdict + f"""
select key from verdict
where present and s_len = t_len and (t_tag = '' or t_tag = s_tag) {within}""")
    def undecided_bodies(spark, sf):
        return checks.undecided_bodies(*_heads(spark, sf), options).select("key")

    @query(f"validate{suffix}", verdict + """
select key, case when present then key end as target_key,
       present and why is null and meta_ok and acl_good as success,
       case when present then why is null end as content_ok,
       case when present then meta_ok end as metadata_ok,
       case when present then acl_good end as acl_ok,
       ltrim(errors || acl_error, '|') as errors from verdict""")
    def validate(spark, sf):
        return _flat_validation(_validated(
            spark, sf, replace(options, check_acl=True), source_acls=_object_acls(spark, sf),
            target_acls=_object_acls(spark, sf, changed=True)))

    @query(f"validation_errors{suffix}", verdict + """
select key, errors from verdict where errors <> ''""")
    def validation_errors(spark, sf):
        return _flat_validation(checks.validation_errors(_validated(spark, sf, options)))

    @query(f"validation_summary{suffix}", verdict + """
select count(*) as total_objects,
       cast(count_if(present and why is null) as bigint) as content_passed,
       cast(count(*) - count_if(present and why is null) as bigint) as content_failed,
       cast(count_if(meta_ok) as bigint) as metadata_passed,
       cast(count(*) - count_if(meta_ok) as bigint) as metadata_failed,
       cast(0 as bigint) as metadata_skipped, cast(0 as bigint) as acl_passed,
       cast(0 as bigint) as acl_failed, count(*) as acl_skipped
from verdict""")
    def validation_summary(spark, sf):
        return checks.validation_summary(_validated(spark, sf, options), options)


for _suffix, _options in FORMS:
    _register(_suffix, _options)


@query("validate_mapped", using("heads") + checked(None) + """
select key, case when present then 'mirror/' || substring(key, 6) end as target_key,
       present and s_len = t_len and (t_tag = '' or s_tag = t_tag) as success
from verdict""")
def validate_mapped(spark, sf):
    """Targets below another prefix; lengths and ETags only."""
    options = ValidateOptions(
        prefix=fx.SOURCE_PREFIX, target_prefix=fx.TARGET_PREFIX, check_metadata=False,
        check_acl=False)
    return checks.validate(
        fx.src_inventory(spark, sf), fx.src_heads(spark, sf),
        fx.tgt_heads(spark, sf, fx.TARGET_PREFIX), options,
    ).select("key", "target_key", "success")
