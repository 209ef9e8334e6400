"""Table layouts.

Instants are ``TIMESTAMP_NTZ`` holding UTC wall-clock time, so no result depends on the
session time zone.
"""

from pyspark.sql import types as T

_str, _long, _bool, _dbl = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType()
_ts = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


INVENTORY = _struct(
    ("bucket", _str), ("key", _str), ("last_modified", _ts), ("size", _long),
    ("storage_class", _str), ("etag", _str), ("version_id", _str),
)

# A listing as delivered: text times, quoted ETags, gaps.
RAW_LISTING = _struct(
    ("bucket", _str), ("key", _str), ("last_modified", _str), ("size", _long),
    ("storage_class", _str), ("etag", _str), ("version_id", _str),
)

HEAD = _struct(
    ("bucket", _str), ("key", _str), ("content_length", _long), ("content_type", _str),
    ("content_md5", _str), ("last_modified", _ts), ("etag", _str), ("storage_class", _str),
    ("metadata", T.MapType(_str, _str)), ("version_id", _str), ("cache_control", _str),
    ("expires", _str),
)

GRANTEE = _struct(
    ("type", _str), ("id", _str), ("display_name", _str), ("uri", _str), ("email_address", _str),
)
GRANT = _struct(("grantee", GRANTEE), ("permission", _str))
OWNER = _struct(("id", _str), ("display_name", _str))
ACL = _struct(
    ("bucket", _str), ("key", _str), ("owner", OWNER), ("grants", T.ArrayType(GRANT)),
)

# Access control as the store's API spells it.
RAW_GRANTEE = _struct(("Type", _str), ("ID", _str), ("DisplayName", _str), ("URI", _str))
RAW_ACL = _struct(
    ("Owner", _struct(("ID", _str), ("DisplayName", _str))),
    ("Grants", T.ArrayType(_struct(("Grantee", RAW_GRANTEE), ("Permission", _str)))),
)

RESULT = _struct(
    ("key", _str), ("target_key", _str), ("success", _bool), ("skipped", _bool),
    ("error", _str), ("reason", _str), ("size", _long),
)

CHECKPOINT = _struct(("source_bucket", _str), ("target_bucket", _str), ("key", _str))

STATE = _struct(
    ("sync_id", _str), ("source_bucket", _str), ("target_bucket", _str),
    ("source_prefix", _str), ("target_prefix", _str), ("last_sync_time", _ts),
    ("status", _str), ("dry_run", _bool), ("total_objects", _long), ("uploaded", _long),
    ("deleted", _long), ("skipped", _long), ("failed", _long), ("start_time", _ts),
    ("end_time", _ts),
)

# State and reports as JSON files carry their times as ISO text.
STATE_JSON = _struct(
    ("sync_id", _str), ("source_bucket", _str), ("target_bucket", _str),
    ("source_prefix", _str), ("target_prefix", _str), ("last_sync_time", _str),
    ("status", _str), ("total_objects", _long), ("uploaded", _long), ("deleted", _long),
    ("skipped", _long), ("failed", _long), ("start_time", _str), ("end_time", _str),
)

# A journal record: how a run stands.
_JOURNAL = (
    ("sync_id", _str), ("source_bucket", _str), ("target_bucket", _str), ("source_prefix", _str),
    ("target_prefix", _str), ("status", _str), ("dry_run", _bool), ("total_objects", _long),
    ("uploaded", _long), ("deleted", _long), ("skipped", _long), ("failed", _long), ("seq", _long),
    ("resumed_from", _str),
)
JOURNAL = _struct(*_JOURNAL, ("start_time", _ts), ("updated_at", _ts))
JOURNAL_JSON = _struct(*_JOURNAL, ("start_time", _str), ("updated_at", _str))

VALIDATION = _struct(
    ("key", _str), ("target_key", _str), ("success", _bool), ("content_ok", _bool),
    ("metadata_ok", _bool), ("acl_ok", _bool), ("errors", T.ArrayType(_str)),
)

VALIDATION_SUMMARY = _struct(
    ("total_objects", _long), ("content_passed", _long), ("content_failed", _long),
    ("metadata_passed", _long), ("metadata_failed", _long), ("metadata_skipped", _long),
    ("acl_passed", _long), ("acl_failed", _long), ("acl_skipped", _long),
)

REPORT_JSON = _struct(
    ("validation_id", _str), ("timestamp", _str), ("status", _str), ("source_bucket", _str),
    ("target_bucket", _str), ("prefix", _str), ("check_content", _bool),
    ("check_metadata", _bool), ("check_acl", _bool), ("summary", VALIDATION_SUMMARY),
    ("duration_seconds", _dbl), ("start_time", _str), ("end_time", _str),
    ("failed_objects", T.ArrayType(_struct(("key", _str), ("errors", T.ArrayType(_str))))),
)

PART = _struct(("key", _str), ("part_number", _long), ("offset", _long), ("length", _long))

# What became of one part of a copy, and which task did it.
PART_RESULT = _struct(
    ("key", _str), ("target_key", _str), ("part_number", _long), ("offset", _long),
    ("length", _long), ("md5", _str), ("error", _str), ("task", _long),
)
