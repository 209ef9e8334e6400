"""Inventories, heads, lists and run records derived from the test tables.

The tables hold no bucket listing, so each input of the operators is a deterministic recipe
over ``documents``, ``pages``, ``orders``, ``customer`` or ``events`` (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SOURCE_BUCKET, TARGET_BUCKET = "src-bucket", "tgt-bucket"
SOURCE_PREFIX, TARGET_PREFIX = "docs/", "mirror/"

_KEY = """
    '{prefix}' || source || '/' || lang || '/' || cast(doc_id as string)
    || case doc_id % 5 when 0 then '.txt' when 1 then '.jpg' when 2 then '.tmp'
                       when 3 then '.log' else '.html' end
"""
_TIME = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id * 60)"
_T_SIZE = "case when doc_id % 11 = 0 then size + 1 else size end"
_T_ETAG = "case when doc_id % 7 = 0 then md5(etag) else etag end"


# Given layouts spare a job per table that would only read file footers.
_LAYOUTS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
                " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
              " value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str, prefix: str = SOURCE_PREFIX) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        _KEY.format(prefix=prefix) + " as key",
        "cast(octet_length(text) as bigint) as size",
        "md5(text) as etag",
        _TIME + " as last_modified",
        "case doc_id % 4 when 0 then 'STANDARD_IA' else 'STANDARD' end as storage_class",
        "doc_id", "lang", "source",
    )


def src_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).selectExpr(
        f"'{SOURCE_BUCKET}' as bucket", "key", "last_modified", "size", "storage_class", "etag",
        "case when doc_id % 8 = 0 then 'v' || doc_id end as version_id", "doc_id",
    )


def tgt_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = _documents(spark, sf_dir, TARGET_PREFIX).filter("doc_id % 10 <> 3").selectExpr(
        f"'{TARGET_BUCKET}' as bucket", "key", "last_modified", f"{_T_SIZE} as size",
        "storage_class", f"{_T_ETAG} as etag", "cast(null as string) as version_id", "doc_id",
    )
    orphans = table(spark, sf_dir, "pages").selectExpr(
        f"'{TARGET_BUCKET}' as bucket",
        f"'{TARGET_PREFIX}orphan/' || cast(page_id as string) as key",
        "timestamp_ntz'2024-01-01 00:00:00' as last_modified", "cast(1 as bigint) as size",
        "'STANDARD' as storage_class", "md5(html) as etag", "cast(null as string) as version_id",
        "cast(-1 as bigint) as doc_id",
    )
    return copies.unionByName(orphans)


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).selectExpr(
        f"'{SOURCE_BUCKET}' as bucket", "key",
        """case when doc_id % 13 = 0 then null
                when doc_id % 2 = 0
                then date_format(last_modified, "yyyy-MM-dd'T'HH:mm:ss") || '+00:00'
                else date_format(last_modified + interval '2' hour, "yyyy-MM-dd'T'HH:mm:ss")
                     || '+02:00' end as last_modified""",
        "case when doc_id % 6 = 0 then null else size end as size",
        "case when doc_id % 4 = 1 then null else storage_class end as storage_class",
        "case when doc_id % 15 = 0 then null else '\"' || etag || '\"' end as etag",
        "cast(null as string) as version_id",
    )


def checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handled keys of this bucket pair, and the same keys under another pair."""
    done = _documents(spark, sf_dir).filter("doc_id % 9 = 0").selectExpr(
        f"'{SOURCE_BUCKET}' as source_bucket",
        f"explode(array('{TARGET_BUCKET}', 'other-bucket')) as target_bucket",
        "key", "doc_id",
    )
    return done.selectExpr(
        "source_bucket", "target_bucket",
        "case when target_bucket = 'other-bucket' then key || '.old' else key end as key",
    )


_CONTENT_TYPE = """case doc_id % 5 when 0 then 'text/plain' when 1 then 'image/jpeg'
    when 4 then 'text/html' else 'application/octet-stream' end"""
_CACHE = "case when doc_id % 6 = 0 then null else 'max-age=' || (doc_id % 3) end"
_EXPIRES = "case when doc_id % 10 = 0 then '2030-01-01T00:00:00' end"


def src_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).selectExpr(
        f"'{SOURCE_BUCKET}' as bucket", "key", "size as content_length",
        f"{_CONTENT_TYPE} as content_type", "etag as content_md5", "last_modified",
        "'\"' || etag || '\"' as etag",
        "case when doc_id % 4 = 1 then null else storage_class end as storage_class",
        "case when doc_id % 25 = 0 then null else map('lang', lang, 'source', source) end"
        " as metadata",
        "case when doc_id % 8 = 0 then 'v' || doc_id end as version_id",
        f"{_CACHE} as cache_control", f"{_EXPIRES} as expires", "doc_id",
    )


def tgt_heads(spark: SparkSession, sf_dir: str, prefix: str = SOURCE_PREFIX) -> DataFrame:
    """Heads of the copies; keys below ``prefix``. Every tenth object is missing."""
    return _documents(spark, sf_dir, prefix).filter("doc_id % 10 <> 3").selectExpr(
        f"'{TARGET_BUCKET}' as bucket", "key", f"{_T_SIZE} as content_length",
        f"{_CONTENT_TYPE} as content_type", f"{_T_ETAG} as content_md5", "last_modified",
        f"case when doc_id % 14 = 0 then '' else {_T_ETAG} end as etag", "storage_class",
        """case when doc_id % 25 = 0 then map()
                when doc_id % 19 = 0 then map('extra', 'x', 'source', source,
                    'lang', case when doc_id % 17 = 0 then 'zz' else lang end)
                else map('source', source, 'lang',
                    case when doc_id % 17 = 0 then 'zz' else lang end) end as metadata""",
        "cast(null as string) as version_id",
        f"{_CACHE} as cache_control", f"{_EXPIRES} as expires", "doc_id",
    )


def bodies(
    spark: SparkSession, sf_dir: str, target: bool = False, prefix: str = SOURCE_PREFIX
) -> DataFrame:
    text = "case when doc_id % 7 = 0 then text || '#' else text end" if target else "text"
    rows = table(spark, sf_dir, "documents")
    rows = rows.filter("doc_id % 10 <> 3") if target else rows
    return rows.selectExpr(
        _KEY.format(prefix=prefix) + " as key", f"cast({text} as binary) as content", "doc_id",
    )


def parts_etag(content: str, part: int) -> str:
    """The ETag that an upload of a body in parts gives it."""
    count = f"cast(greatest(1, ceil(octet_length({content}) / {part})) as int)"
    digests = (f"transform(sequence(1, {count}),"
               f" i -> md5(substring({content}, (i - 1) * {part} + 1, {part})))")
    return (f"case when {count} = 1 then md5({content})"
            f" else md5(unhex(array_join({digests}, ''))) || '-' || {count} end")


def raw_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).selectExpr(
        "key",
        f"""map_from_entries(filter(array(
              struct('Content-Type' as k, {_CONTENT_TYPE} as v),
              struct('CONTENT-LENGTH' as k, cast(size as string) as v),
              struct('X-Amz-Meta-Lang' as k, lang as v),
              struct('x-amz-meta-Source' as k, source as v),
              struct(case when doc_id % 3 = 0 then 'ETAG' end as k, etag as v),
              struct(case when doc_id % 3 = 0 then 'etag' end as k, 'later' as v),
              struct('x-other' as k, '1' as v)), e -> e.k is not null)) as headers""",
        "doc_id",
    )


_ACL_KEY = "'acl/' || c_mktsegment || '/' || cast(c_custkey as string)"


def _grant(kind: str, permission: str, id: str = "null", name: str = "null", uri: str = "null") -> str:
    return f"""named_struct('grantee', named_struct('type', '{kind}', 'id', cast({id} as string),
        'display_name', cast({name} as string), 'uri', cast({uri} as string),
        'email_address', cast(null as string)), 'permission', {permission})"""


_PUBLIC = "'https://acs.amazonaws.com/groups/global/AllUsers'"
_EMPTY_GRANTS = "filter(array({g}), x -> false)"


def _grants(user_id: str, user_permission: str) -> str:
    user = _grant("CanonicalUser", user_permission, user_id, "c_name")
    public = _grant("Group", "'READ'", uri=_PUBLIC)
    mail = _grant("AmazonCustomerByEmail", "'READ'", "'e' || c_custkey")
    none = _EMPTY_GRANTS.format(g=user)
    return f"""concat(array({user}),
        case when c_custkey % 3 = 0 then array({public}) else {none} end,
        case when c_custkey % 8 = 0 then array({mail}) else {none} end)"""


def src_acls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        f"'{SOURCE_BUCKET}' as bucket", f"{_ACL_KEY} as key",
        "named_struct('id', 'u' || c_nationkey, 'display_name', c_mktsegment) as owner",
        _grants("'u' || c_custkey", "'FULL_CONTROL'") + " as grants", "c_custkey",
    )


def tgt_acls(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed_id = "case when c_custkey % 7 = 0 then 'other' else 'u' || c_custkey end"
    changed = "case when c_custkey % 11 = 0 then 'WRITE' else 'FULL_CONTROL' end"
    return table(spark, sf_dir, "customer").selectExpr(
        f"'{TARGET_BUCKET}' as bucket", f"{_ACL_KEY} as key",
        """named_struct('id', case when c_custkey % 13 = 0 then 'zz' else 'u' || c_nationkey end,
                        'display_name', c_mktsegment) as owner""",
        f"reverse({_grants(changed_id, changed)}) as grants", "c_custkey",
    )


def raw_acls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists as the store spells them; every fiftieth row is the list of a bucket."""
    return table(spark, sf_dir, "customer").selectExpr(
        "'b' || (c_custkey % 10) as bucket",
        f"case when c_custkey % 50 <> 0 then {_ACL_KEY} end as key",
        """named_struct('ID', 'u' || c_nationkey,
             'DisplayName', case when c_custkey % 2 = 0 then c_name end) as Owner""",
        f"""case when c_custkey % 5 = 0 then null else array(
              named_struct('Grantee', named_struct('Type', 'CanonicalUser',
                'ID', 'u' || c_custkey, 'DisplayName', c_name, 'URI', cast(null as string)),
                'Permission', 'FULL_CONTROL'),
              named_struct('Grantee', named_struct('Type', 'Group', 'ID', cast(null as string),
                'DisplayName', cast(null as string), 'URI', {_PUBLIC}),
                'Permission', 'READ')) end as Grants""",
        "c_custkey",
    )


def mixed_acls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists with usable and unusable grants: unknown permission, user without id."""
    user = _grant("CanonicalUser", "'FULL_CONTROL'", "'u' || c_custkey", "c_name")
    no_id = _grant("CanonicalUser", "'READ'")
    odd = _grant("CanonicalUser", "'LIST'", "'u' || c_custkey")
    group = _grant("Group", "'READ_ACP'", uri="'https://acs.amazonaws.com/groups/s3/LogDelivery'")
    mail = _grant("AmazonCustomerByEmail", "'WRITE'", "'e' || c_custkey")
    return table(spark, sf_dir, "customer").selectExpr(
        f"{_ACL_KEY} as key",
        """named_struct('id', 'u' || c_nationkey,
             'display_name', case when c_custkey % 2 = 0 then c_name end) as owner""",
        f"""concat(array({user}, {group}),
              case when c_custkey % 4 = 0 then array({no_id}, {odd})
                   when c_custkey % 4 = 1 then array({mail})
                   else {_EMPTY_GRANTS.format(g=user)} end) as grants""",
        "c_custkey",
    )


def large_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "'o/' || cast(o_orderkey as string) as key", "cast(o_totalprice * 1024 as bigint) as size",
    )


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"
    return table(spark, sf_dir, "orders").selectExpr(
        "'sync-' || cast(o_orderkey as string) as sync_id",
        "'b' || (o_custkey % 10) as source_bucket", "'t' || (o_custkey % 3) as target_bucket",
        "'docs/' as source_prefix", "'' as target_prefix", "o_orderdate as last_sync_time",
        """case o_orderstatus when 'F' then 'completed' when 'O' then 'completed_with_errors'
                else 'cancelled' end as status""",
        "o_orderkey % 31 = 0 as dry_run",
        "o_orderkey % 5000 as total_objects",
        "case when o_orderkey % 7 = 0 then null else o_orderkey % 4000 end as uploaded",
        "o_orderkey % 90 as deleted",
        "case when o_orderkey % 11 = 0 then null else o_orderkey % 300 end as skipped",
        "case when o_orderstatus = 'O' then 1 + o_orderkey % 9 else 0 end as failed",
        f"{start} as start_time",
        f"""case when o_orderstatus <> 'P'
                 then {start} + make_dt_interval(0, 0, 0, (o_custkey * 37) % 20000 + 0.25)
            end as end_time""",
    )


def inventory_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        f"'{SOURCE_BUCKET}' as bucket",
        "'u/' || cast(user_id as string) || '/' || event_type as key", "ts as last_modified",
        "cast(value * 100 as bigint) as size", "'STANDARD' as storage_class",
        "md5(cast(event_id as string)) as etag", "cast(event_id as string) as version_id",
    )


def feed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target of the feed: one object per user and kind of event, as of the first event."""
    first = inventory_feed(spark, sf_dir).groupBy("key").agg(
        F.min(F.struct("last_modified", "size", "etag")).alias("first")
    )
    return first.select(
        F.lit(TARGET_BUCKET).alias("bucket"), "key", "first.last_modified", "first.size",
        F.lit("STANDARD").alias("storage_class"), "first.etag",
        F.lit(None).cast("string").alias("version_id"),
    )


def copy_results(plan: DataFrame) -> DataFrame:
    """Outcome of a plan's copy rows, as if run: some fail, excluded targets are skipped."""
    doc_id = F.regexp_extract("key", r"/(\d+)\.\w+$", 1).cast("long")
    failed: Column = F.col("doc_id") % 23 == 0
    skipped = ~failed & F.col("key").endswith(".log")
    return plan.filter("action = 'copy'").withColumn("doc_id", doc_id).select(
        "key", "target_key", (~failed).alias("success"), skipped.alias("skipped"),
        F.when(failed, F.concat(F.lit("E"), F.col("doc_id") % 4)).alias("error"),
        F.when(skipped, F.lit("filtered")).alias("reason"),
        "size",
        F.expr("timestamp_ntz'2024-02-01 00:00:00'"
               " + make_dt_interval(0, 0, 0, (doc_id * 7919) % 1000)").alias("completed_at"),
        "doc_id",
    )
